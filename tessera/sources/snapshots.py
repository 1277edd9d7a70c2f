"""Snapshots of graphs as Parquet, with a manifest and a pointer to the latest; promotion behind a gate.

A snapshot is a folder named by its time and the start of its digest. It is written beside its place and renamed into
it, and the pointer is a table of one row that is replaced last, so a reader sees a whole snapshot or the one before.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import catalogs, outputs
from tessera.sources.scratch import scratch


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def content_digest(df: DataFrame) -> str:
    """A digest of the rows of a table, in whatever order and partitions they come."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    shares = df.select(row.alias("d")).groupBy(F.substring("d", 1, 3).alias("share")).agg(F.sum(F.conv(F.substring("d", 4, 15), 16, 10).cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    joined = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "share", F.col("s").cast("string"), F.col("n").cast("string")))), ",")
    return shares.agg(F.sha2(joined, 256).alias("d")).first()["d"]  # 4,096 shares at most


def write(spark: SparkSession, path: str, nodes: DataFrame, links: DataFrame, now: datetime | None = None) -> str:
    """Writes a snapshot and points to it; equal content in the same second finds its folder there and keeps it."""
    fs, at = _fs(spark, path)
    staged = scratch(spark, "snapshot")
    for name, df in (("nodes", nodes), ("edges", links)):
        df.write.option("compression", "zstd").parquet(f"{staged}/{name}")
    read = {n: spark.read.parquet(f"{staged}/{n}") for n in ("nodes", "edges")}
    rows = [(n, content_digest(df), df.count()) for n, df in read.items()]
    digest = spark.range(1).select(F.sha2(F.lit("|".join(r[1] for r in rows)), 256)).first()[0]
    spark.createDataFrame(rows, "part string, digest string, rows bigint").coalesce(1).write.json(f"{staged}/manifest")
    name = f"{(now or datetime.now(UTC)):%Y%m%dT%H%M%SZ}-{digest[:8]}"
    fs.mkdirs(at(path))
    if fs.exists(at(f"{path}/{name}")):
        fs.delete(at(staged), True)
    elif not fs.rename(at(staged), at(f"{path}/{name}")):
        raise OSError(f"cannot place snapshot {name}")
    point(spark, path, "latest", name)
    return name


def point(spark: SparkSession, path: str, pointer: str, name: str) -> None:
    """A pointer is one file, and another takes its place in one step: a reader always finds one."""
    outputs.replace(spark, f"{path}/_{pointer}", [name.encode()])


def pointed(spark: SparkSession, path: str, pointer: str = "latest") -> str:
    name = outputs.read(spark, f"{path}/_{pointer}")
    if name is None:
        raise FileNotFoundError(f"{path}/_{pointer}")
    return name.decode()


def open_latest(spark: SparkSession, path: str, pointer: str = "latest") -> SparkSession:
    """A session of its own whose views nodes and edges are the snapshot's."""
    own = spark.newSession()
    # the size of a compressed file says little of its rows: sides are broadcast by the size that a shuffle has found, and by no guess
    own.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", own.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    name = pointed(spark, path, pointer)
    for part in ("nodes", "edges"):
        own.read.parquet(f"{path}/{name}/{part}").createOrReplaceTempView(part)
    return own


def verify(spark: SparkSession, path: str, name: str) -> bool:
    """Whether the rows of a snapshot are those of its manifest."""
    listed = {r["part"]: (r["digest"], r["rows"]) for r in spark.read.schema("part string, digest string, rows bigint").json(f"{path}/{name}/manifest").collect()}
    found = {n: spark.read.parquet(f"{path}/{name}/{n}") for n in ("nodes", "edges")}
    return listed == {n: (content_digest(df), df.count()) for n, df in found.items()}


def promote(spark: SparkSession, path: str, name: str, attribution: str, status: str) -> None:
    """Points current to a snapshot, unless nobody answers for it or its checks blocked it."""
    if not attribution:
        raise ValueError("a promotion needs an attribution")
    if status.upper().startswith(("BLOCKED", "FAIL")):
        raise ValueError(f"not promoted: {status}")
    point(spark, path, "current", name)


def pull(entries: DataFrame, repositories: list[str], source: str, target: str) -> str:
    """Copies the archives of repositories, all their slices, from one store to a new one, with their catalogue entries, which
    are held against what was copied. Gives the digest of the whole upstream catalogue, which the new store notes."""
    spark = entries.sparkSession
    wanted = entries.where(F.col("repository").isin(repositories))
    rows = wanted.collect()  # a catalogue has 128 entries at most
    missing = set(repositories) - {r["repository"] for r in rows}
    if missing:
        raise ValueError(f"not in the catalogue: {sorted(missing)}")
    fs, at = _fs(spark, target)
    if fs.exists(at(target)):
        raise ValueError(f"{target} is there already")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    upstream = at(source).getFileSystem(conf)
    for r in rows:
        jvm.org.apache.hadoop.fs.FileUtil.copy(upstream, at(f"{source}/{r['archive']}"), fs, at(f"{target}/{r['archive']}"), False, conf)
    faults = catalogs.verified_archives(spark, wanted, target).collect()
    if faults:
        fs.delete(at(target), True)
        raise ValueError(f"other content upstream: {faults[:5]}")
    digest = content_digest(entries)
    wanted.coalesce(1).write.parquet(f"{target}/catalog")
    outputs.create_only(spark, f"{target}/upstream", [digest.encode()])
    return digest
