"""Refreshing a build: what need not be done, what is done once more, and the order of the tasks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import state
from tessera.operators.checks import same
from tessera.sources.scratch import materialise


def unchanged(previous: dict[str, str], current: dict[str, str], old_files: DataFrame, files: DataFrame, old_unsupported: DataFrame, unsupported: DataFrame) -> bool:
    """Whether a build need not be made: the same identities (commit, tree, policy, extractor, runtime; a null one is never
    the same), the same files(path, blob_oid), and the same unsupported(path, reason)."""
    if not current or previous != current or None in current.values():
        return False
    return same(old_files.select("path", "blob_oid"), files.select("path", "blob_oid")) and same(old_unsupported.select("path", "reason"), unsupported.select("path", "reason"))


@dataclass
class Extracted:
    fragments: DataFrame
    attempts: int
    #: The fragments that may be put in the cache; none after a rejected reuse.
    to_store: DataFrame
    reason: str | None


def extract_with_reuse(files: DataFrame, cache: DataFrame, extract: Callable[[DataFrame], DataFrame], accepted: Callable[[DataFrame], bool]) -> Extracted:
    """Fragments of files(path, key_sha256, ...), from cache(key_sha256, path, ...) where it has them. If the whole is not
    accepted and something was reused, all files are extracted once more, and nothing is stored."""
    keys = cache.select("key_sha256").distinct()
    reused = cache.join(files.select("key_sha256").distinct(), "key_sha256", "left_semi").drop("key_sha256")
    made = materialise(extract(files.join(keys, "key_sha256", "left_anti")), "extracted")
    whole = reused.select(*made.columns).unionByName(made)
    if accepted(whole):
        return Extracted(whole, 1, made, None)
    if not reused.take(1):
        raise ValueError("the extraction is not accepted")
    again = materialise(extract(files), "extracted")
    if not accepted(again):
        raise ValueError("the extraction is not accepted")
    return Extracted(again, 2, again.limit(0), "reuse_rejected")


def request_sizes(files: DataFrame, index: DataFrame, most_bytes: int, most_files: int, most_paths: int) -> DataFrame:
    """(slice, n_files, content_bytes, encoded_bytes, index_paths, bounds) before a slice of files(slice, path, bytes) is sent
    to an extractor: contents in base64, paths and digests in quotes; index(slice, path) are the paths it may refer to."""
    encoded = 4 * F.ceil(F.col("bytes") / 3) + F.octet_length("path") + 64 + len('{"path":"","sha256":"","content":""},')
    own = files.groupBy("slice").agg(F.count("*").alias("n_files"), F.sum("bytes").cast("long").alias("content_bytes"), F.sum(encoded).cast("long").alias("encoded_bytes"))
    paths = index.groupBy("slice").agg(F.count("*").alias("index_paths")).withColumnRenamed("slice", "_s")
    rows = own.join(paths, F.col("slice") == F.col("_s"), "left").withColumn("index_paths", F.coalesce("index_paths", F.lit(0)))
    over = [F.when(F.col(c) > most, F.lit(name)) for c, most, name in (("encoded_bytes", most_bytes, "bytes"), ("n_files", most_files, "files"), ("index_paths", most_paths, "paths"))]
    return rows.select("slice", "n_files", "content_bytes", "encoded_bytes", "index_paths", F.array_join(F.array_compact(F.array(*over)), ",").alias("bounds"))


def slice_documents(files: DataFrame, coverage: DataFrame, references: DataFrame) -> dict[str, DataFrame]:
    """The documents of a run over slices: inventory(slice, path, sha256, coverage) of files(slice, path, sha256), report of each
    slice, its set(slice, input_digest) that later runs compare, and the one row of the run."""
    known = coverage.select(F.col("path").alias("_p"), "coverage")
    inventory = files.join(known, F.col("path") == F.col("_p"), "left").select("slice", "path", "sha256", F.coalesce("coverage", F.lit("unknown")).alias("coverage"))
    outward = references.groupBy("slice").agg(F.count("*").alias("references"), F.count_if(F.col("outcome") == "cross").alias("cross_slice"), F.count_if(F.col("outcome") == "unresolved").alias("unresolved")).withColumnRenamed("slice", "_s")
    report = inventory.groupBy("slice").agg(F.count("*").alias("files"), F.count_if(F.col("coverage") == "unknown").alias("unknown")).join(outward, F.col("slice") == F.col("_s"), "left")
    report = report.select("slice", "files", "unknown", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("references", "cross_slice", "unresolved")])
    digests = state.input_digest(files, "slice").select("slice", F.col("digest").alias("input_digest"))
    run = report.agg(F.count("*").alias("slices"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("files", "unknown", "references", "cross_slice", "unresolved")])
    return {"inventory": inventory, "slice_report": report, "slice_set": digests, "slice_run": run}


def run_tasks(tasks: list[tuple[str, Callable[[], str]]], cancelled: Callable[[], bool] = lambda: False) -> list[tuple[str, str]]:
    """The status of each task, in turn. After one that fails, is unknown or deferred, or once the run is cancelled, the rest
    is not begun; whatever a task raises leaves its effect unknown."""
    done, on = [], True
    for name, task in tasks:
        if on and cancelled():
            on = False
            done.append((name, "cancelled"))
            continue
        if not on:
            done.append((name, "not_begun"))
            continue
        try:
            status = task()
        except Exception:  # the run reports it, and goes no further
            status = "unknown"
        done.append((name, status))
        on = status == "completed"
    return done


def refresh_tasks(sample: Callable[[], str], capture: Callable[[], object], extract: Callable[[object], object], pack: Callable[[object], object]) -> list[tuple[str, Callable[[], str]]]:
    """sample, capture, extract, sample again, pack: nothing is packed of a source that moved meanwhile."""
    seen: dict[str, object] = {}

    def put(name: str, make: Callable[[], object]) -> str:
        seen[name] = make()
        return "completed"

    def again() -> str:
        return "completed" if sample() == seen["sample"] else "deferred"

    return [("sample", lambda: put("sample", sample)), ("capture", lambda: put("capture", capture)), ("extract", lambda: put("extract", lambda: extract(seen["capture"]))), ("resample", again), ("pack", lambda: put("pack", lambda: pack(seen["extract"])))]
