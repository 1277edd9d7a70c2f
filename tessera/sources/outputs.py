"""Single documents and ledgers in the file system that all executors share.

Documents that must be one file are written by the driver through Hadoop's file system, piece by piece, so their size
is no matter of memory; a document is seen whole or not at all.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import CURIE
from tessera.operators import state
from tessera.sources.scratch import materialise


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and what makes its paths."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def create_only(spark: SparkSession, path: str, parts: Iterable[bytes]) -> None:
    """Writes a new file; one that is there already, or comes meanwhile, stays, and is an error."""
    fs, at = file_system(spark, path)
    out = fs.create(at(path), False)
    done = False
    try:
        for part in parts:
            out.write(bytearray(part))
        done = True
    finally:
        out.close()
        if not done:  # this call's own file alone is removed
            fs.delete(at(path), False)


def put_if_absent(spark: SparkSession, path: str, data: bytes) -> bool:
    """Makes a new file that is seen whole or not at all; False if there is one, which stays. Of several writers one wins.

    The file is written aside and takes its name by a link on local disks, where renames replace files, and elsewhere by a
    rename that must be atomic and not replace, as HDFS's is.
    """
    jvm = spark.sparkContext._jvm
    fs, at = file_system(spark, path)
    folder, _, name = path.rpartition("/")
    fs.mkdirs(at(folder))
    real = fs.resolvePath(at(folder)).toString()  # what a mounted path stands for
    aside = f"{real}/.{uuid.uuid4().hex}"
    create_only(spark, aside, [data])
    own, _ = file_system(spark, aside)
    try:
        if own.getScheme() == "file":
            nio = lambda p: jvm.java.nio.file.Paths.get(at(p).toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(nio(f"{real}/{name}"), nio(aside))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at(aside).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(at(aside), at(f"{real}/{name}"), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
    except Py4JJavaError as e:
        if not e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise
        own.delete(at(aside), False)
        return False
    own.delete(at(aside), False)
    return True


def replace(spark: SparkSession, path: str, parts: Iterable[bytes]) -> None:
    """Puts a file in the place of another by a rename, so that a reader finds the old one or the new one."""
    jvm = spark.sparkContext._jvm
    aside = f"{path}.{uuid.uuid4().hex}"
    create_only(spark, aside, parts)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(path) if "://" in path else jvm.java.io.File(path.removeprefix("file:")).toURI(), spark.sparkContext._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(path), how)


def read(spark: SparkSession, path: str) -> bytes | None:
    """A small file's bytes; None if there is none."""
    fs, at = file_system(spark, path)
    if not fs.exists(at(path)):
        return None
    stream = fs.open(at(path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def _lines(rows: DataFrame) -> Iterator[bytes]:
    """A JSON array of the rows, one at a time."""
    yield b"["
    comma = b""
    for r in rows.select(F.to_json(F.struct(*rows.columns)).alias("j")).toLocalIterator():
        yield comma + b"\n" + r["j"].encode()
        comma = b","
    yield b"]"


def write_node_link(nodes: DataFrame, links: DataFrame, path: str, **about) -> None:
    """Writes a graph as one node-link document, nodes and links in their canonical orders, to a new file."""

    def parts() -> Iterator[bytes]:
        head = json.dumps({"directed": True, "multigraph": True, **about})
        yield head[:-1].encode() + b', "nodes": '
        yield from _lines(nodes.orderBy("id"))
        yield b', "links": '
        yield from _lines(links.orderBy(*[c for c in ("source_file", "source", "target", "type", "kind", "ord") if c in links.columns]))
        yield b"}\n"

    create_only(nodes.sparkSession, path, parts())


def write_validation(spark: SparkSession, folder: str, status: str, counts: dict[str, int], fatals: list[str], warnings: dict[str, int], fingerprint: str, now: str) -> None:
    """validation.json and freshness.json of a check, and baseline.json if it is the first one and did not fail."""
    validation = {"status": status, **counts, "fatal_classes": sorted({f.split(":")[0] for f in fatals}), "fatals": fatals[:50], "fatal_count": len(fatals), "warnings": {"classes": warnings}, "checked_utc": now}
    freshness = {"source_fingerprint": fingerprint, "classification": "valid", "checked_utc": now}
    for name, doc in (("validation", validation), ("freshness", freshness)):
        replace(spark, f"{folder}/{name}.json", [json.dumps(doc, indent=1).encode()])
    if status in ("PASS", "PASS_WITH_WARNINGS") and read(spark, f"{folder}/baseline.json") is None:
        create_only(spark, f"{folder}/baseline.json", [json.dumps({"classes": warnings}).encode()])


class Ledger:
    """Append-only tables below a path, for any number of writers: freshness rows, the evidence of runs (the newest of a run
    counts), identities and aliases."""

    # fixed values: what classes and statuses are called
    CLASSES = ("valid", "stale", "unknown")
    STATUSES = ("PASS", "PASS_WITH_WARNINGS", "BLOCKED")
    _SCHEMAS = {
        "freshness": "run_id string, corpus string, source_fingerprint string, classification string, checked_utc string",
        "evidence": "run_id string, status string, fatals array<string>, recorded_utc string",
        "ids": "id long, curie string",
        "aliases": "old_curie string, new_curie string, reason string, rank long",
    }

    def __init__(self, spark: SparkSession, path: str):
        from tessera.sources.commit_log import CommitLog

        self.spark = spark
        self.log = CommitLog(spark, path, self._SCHEMAS)

    def table(self, name: str) -> DataFrame:
        """A table's rows; row_id and alias_id are structs that put them in the order of their commits."""
        rows = self.log.snapshot().table(name)
        place = F.struct(F.col("_version").alias("version"), *([F.col("rank")] if name == "aliases" else []), F.col("_at").alias("at"))
        named = {"ids": [], "aliases": [place.alias("alias_id")]}.get(name, [place.alias("row_id")])
        return rows.select(*named, *[c for c in rows.columns if c not in ("_version", "_at", "rank")])

    def record(self, run_id: str, corpus: str, fingerprint: str, classification: str, now: str, status: str | None = None, fatals: list[str] = ()) -> None:
        """Appends a freshness row and, with a status, the run's evidence: both or neither. No job runs."""
        if classification not in self.CLASSES or status not in (None, *self.STATUSES):
            raise ValueError(f"bad classification or status: {classification}, {status}")
        rows = {"freshness": [(run_id, corpus, fingerprint, classification, now)]}
        if status is not None:
            rows["evidence"] = [(run_id, status, list(fatals), now)]
        self.log.commit(self.log.snapshot(), rows=rows)

    def evidence(self) -> DataFrame:
        """(run_id, status, fatals): what was recorded last of each run."""
        return state.latest(self.table("evidence"), "run_id", "row_id").select("run_id", "status", "fatals")

    def intern(self, curies: DataFrame) -> DataFrame:
        """Gives new curies ids, once and for ever; (id, curie) of all. Another writer's new ids make this one start anew."""
        if curies.where(~F.coalesce(F.col("curie").rlike(CURIE), F.lit(False))).take(1):
            raise ValueError("not a curie")

        def attempt(seen):
            known = seen.table("ids").select("id", "curie")
            new = materialise(state.intern(known, curies).join(known.select("id"), "id", "left_anti"), "interned")
            if new.take(1):
                self.log.commit(seen, {"ids": new}, conflicts=lambda c: c.adds_to("ids"))

        self.log.retried(attempt)
        return self.table("ids")

    def alias(self, renames: DataFrame) -> None:
        """Appends renames(old_curie, new_curie, reason), in the order of the old curies."""
        from tessera.operators.entity import global_rank

        fine = F.col("old_curie").rlike(CURIE) & F.col("new_curie").rlike(CURIE) & (F.col("old_curie") != F.col("new_curie"))
        if renames.where(~F.coalesce(fine, F.lit(False))).take(1):
            raise ValueError("an alias leads from one curie to another")
        numbered = global_rank(renames.select("old_curie", "new_curie", "reason"), "old_curie", "new_curie")
        self.log.commit(self.log.snapshot(), {"aliases": numbered.withColumn("rank", F.col("rank").cast("long"))})

    def resolve(self, curies: DataFrame) -> DataFrame:
        """(curie, id) along the aliases."""
        return state.resolve_aliases(curies, self.table("ids"), self.table("aliases"))


class FragmentStore:
    """A cache that stores payloads under their keys, once: nothing is replaced, whoever writes. quota_bytes bounds their sum."""

    def __init__(self, spark: SparkSession, path: str, quota_bytes: int):
        from tessera.sources.commit_log import CommitLog

        self.log = CommitLog(spark, path, {"fragments": "key_sha256 string, payload string, payload_sha256 string"})
        self.quota = quota_bytes

    def table(self) -> DataFrame:
        return self.log.snapshot().table("fragments").drop("_version", "_at")

    def put(self, new: DataFrame) -> DataFrame:
        """new(key_sha256, payload, payload_sha256), each key once, with outcome stored, exists_verified, exists_conflict, full or
        error. A payload that is not what its digest says is an error. What others store meanwhile counts as there."""

        def attempt(seen):
            cache = seen.table("fragments").drop("_version", "_at")
            sound = F.coalesce(F.sha2("payload", 256) == F.col("payload_sha256"), F.lit(False)) & F.col("key_sha256").isNotNull()
            # what can't be read back is no proof that the same is there
            held = cache.withColumn("payload_sha256", F.sha2("payload", 256))
            outcomes = state.put(held, new.where(sound), self.quota, used=seen.sums.get("bytes", 0))
            outcomes = materialise(outcomes.unionByName(new.where(~sound).withColumn("outcome", F.lit("error"))), "put")
            stored = outcomes.where("outcome = 'stored'").drop("outcome")
            size = stored.agg(F.sum(F.octet_length("payload"))).first()[0]
            if size is not None:
                self.log.commit(seen, {"fragments": stored}, sums={"bytes": size}, conflicts=lambda c: c.adds_to("fragments"))
            return outcomes

        return self.log.retried(attempt)
