"""Tables in the folder that the driver and all executors share; they go when the driver ends, or with clear()."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []
_once: dict[tuple, str] = {}
_jvm = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a folder that goes with its process; a cluster must name one.
    """
    known = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = f"/tmp/checkpoints/{os.getuid()}-{os.getpid()}"
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    spark.sparkContext.setCheckpointDir(own)
    return own


def _delete(jvm, path: str) -> None:
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)


def _sweep() -> None:
    for path in _made:
        with contextlib.suppress(Exception):  # the driver is ending; what can't be deleted stays
            _delete(_jvm, path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. No table outlives the driver, for only its DataFrames read it."""
    global _jvm
    if _jvm is None:
        atexit.register(_sweep)
    _jvm = spark.sparkContext._jvm
    _made.append(f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}")
    return _made[-1]


#: Narrow rows of a file, where a table's number of rows is known to be bound.
FILE_ROWS = 250_000


def materialise(df: DataFrame, name: str, compression: str = "zstd", most_rows: int | None = None) -> DataFrame:
    """Cuts the lineage: writes df as Parquet to the shared folder and reads it back.

    most_rows: a bound of the number of narrow rows, so that a small table is few files, however many partitions it comes from.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    if most_rows is not None:
        df = df.coalesce(max(1, -(-most_rows // FILE_ROWS)))
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, name: str, inputs: list[str], write: Callable[[str], None]) -> str:
    """The path of a table that write(path) makes from input files, once a session for as long as they stay the same."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def seen(path: str) -> tuple:
        at = jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(conf).listStatus(at)
        return path, *((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in files)

    key = spark.sparkContext.applicationId, name, *map(seen, inputs)
    if _once.get(key) not in _made:
        path = scratch(spark, name)
        write(path)
        _once[key] = path
    return _once[key]


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table, by whatever file system it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Deletes all scratch tables so far. DataFrames that read them can't be used any more."""
    while _made:
        drop(spark, _made.pop())
