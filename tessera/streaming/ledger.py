"""A ledger's state as a stream: the newest row of each key, valid until a week has passed without another."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tessera.operators.state import VALID_HOURS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGES = "key string, at timestamp, row_id long, fingerprint string, status string, step int"
_HELD = "at_ms long, at timestamp, row_id long, fingerprint string"


class _Newest(StatefulProcessor):
    """Keeps the newest row of a key, by time and then row_id, and a timer for when it is a week old."""

    def __init__(self, valid_ms: int):
        self.valid_ms = valid_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", _HELD)

    @staticmethod
    def _row(key, held, status: str, step: int) -> pd.DataFrame:
        _, at, row_id, fingerprint = held
        return pd.DataFrame({"key": [key[0]], "at": [at], "row_id": [row_id], "fingerprint": [fingerprint], "status": [status], "step": [step]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        was = self.newest.get() if self.newest.exists() else None
        best = was
        for part in rows:
            for at, row_id, fingerprint in zip(part["at"], part["row_id"], part["fingerprint"], strict=True):
                if best is None or (at, row_id) > (pd.Timestamp(best[1]), best[2]):
                    best = int(at.value // 1_000_000), at.to_pydatetime(), int(row_id), fingerprint
        if best is not was:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.newest.update(best)
            self.handle.registerTimer(best[0] + self.valid_ms)
            yield self._row(key, best, "valid", 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.newest.get()
        if held[0] + self.valid_ms <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._row(key, held, "stale", 1)


def changes(rows: DataFrame, late: str = "1 hour", hours: int = VALID_HOURS) -> DataFrame:
    """The changes of state of a stream of rows(key, at, row_id, fingerprint): valid when a newer row of a key comes, and stale
    when the stream's time, which is late behind the latest row, is a week past it. A row that is late counts if it is
    the newest of its key; a null key is a key. The session's state store must be RocksDB."""
    whole = rows.select(F.col("key").cast("string").alias("key"), F.col("at").cast("timestamp").alias("at"), F.col("row_id").cast("long").alias("row_id"), F.col("fingerprint").cast("string").alias("fingerprint"))
    return whole.where("at is not null").withWatermark("at", late).groupBy("key").transformWithStateInPandas(_Newest(hours * 3_600_000), CHANGES, "Append", "EventTime")


def follow(spark: SparkSession, rows: DataFrame, out: str, checkpoint: str, **options) -> None:
    """Appends what a stream's new rows change to the table at out, by batches: one that runs again writes its own once more."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        changes(rows, **options).writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)


def states(spark: SparkSession, out: str) -> DataFrame:
    """(key, at, row_id, fingerprint, status): the last state of each key."""
    rows = spark.read.schema(CHANGES + ", batch int").parquet(out)
    return rows.groupBy("key").agg(F.max_by(F.struct("at", "row_id", "fingerprint", "status"), F.struct("batch", "step")).alias("x")).select("key", "x.*")
