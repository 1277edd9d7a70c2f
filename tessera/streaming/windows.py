"""Streams, an extension: event windows, and a fragment cache filled from new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import scratch


def windowed(events: DataFrame, size: str = "1 hour", late: str = "10 minutes", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts and sums by event-time window; rows later than the watermark allows are dropped by a stream."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), *keys)
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of users: events less than a gap apart."""
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return w.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def hourly_totals(spark: SparkSession, path: str) -> DataFrame:
    """The windows of a file of events, read as a stream to its end; the sink's batches are written by their numbers."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    rows = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if not _is_folder(spark, path) else spark.readStream.schema(schema).parquet(path)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    out, state = scratch(spark, "windows"), scratch(spark, "stream-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = windowed(rows).writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start()
    run.awaitTermination()
    got = spark.read.parquet(out)
    last = got.groupBy("window_start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("r"))
    return last.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "r.n", F.round("r.total", 4).alias("total"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def fill_cache(spark: SparkSession, source: str, cache: str, state: str):
    """Extracts files that appear below source and appends their fragments, under their keys, to the cache table.

    A batch that runs again finds its keys there: fragments depend on path and content alone.
    """
    from tessera.operators.extract import VERSION, fragments
    from tessera.operators.state import fragment_key

    files = spark.readStream.schema("path string, modificationTime timestamp, length bigint, content binary").format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", "content")

    def write(batch: DataFrame, number: int) -> None:
        keyed = batch.withColumn("key_sha256", fragment_key(F.col("path"), F.sha2("content", 256), "structural", VERSION))
        fragments(keyed).join(keyed.select("path", "key_sha256"), "path").write.mode("overwrite").parquet(f"{cache}/batch={number}")

    return files.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start()
