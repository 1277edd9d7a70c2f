"""References and slices: which candidate path a use refers to, and what lies in another slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import materialise


def resolve(refs: DataFrame, index: DataFrame) -> DataFrame:
    """refs(source_file, kind, target, line, candidates, resolution) with target_path, target_slice and outcome.

    index(path, slice) is the universe of files. unique: resolved if exactly one candidate is there; first: the
    earliest candidate that is there. outcome: link (own slice), cross (another slice) or unresolved. Each candidate
    is shuffled once; references are numbered, so that equal ones stay apart.
    """
    # numbered once: the references are read twice below, and may come in another order the second time
    rows = materialise(refs.withColumn("_ref", F.monotonically_increasing_id()), "references")
    asked = rows.select("_ref", F.posexplode("candidates").alias("pos", "path"))
    found = asked.join(index, "path").groupBy("_ref").agg(F.countDistinct("path").alias("hits"), F.min(F.struct("pos", "path", "slice")).alias("first"))
    own = index.select(F.col("path").alias("_own"), F.col("slice").alias("_own_slice"))
    joined = rows.join(found, "_ref", "left").join(own, rows["source_file"] == own["_own"], "left")
    ok = F.coalesce(F.when(F.col("resolution") == "unique", F.col("hits") == 1).otherwise(F.col("hits") >= 1), F.lit(False))
    return joined.select(
        *[rows[c] for c in refs.columns],
        F.when(ok, F.col("first.path")).alias("target_path"),
        F.when(ok, F.col("first.slice")).alias("target_slice"),
        F.when(~ok, "unresolved").when(F.col("first.slice").eqNullSafe(F.col("_own_slice")), "link").otherwise("cross").alias("outcome"),
    )


def misplaced(cross: DataFrame, index: DataFrame) -> DataFrame:
    """Cross-slice records whose target isn't where the index has it, or is in the source's own slice."""
    home = index.select(F.col("path").alias("_p"), F.col("slice").alias("_home"))
    own = index.select(F.col("path").alias("_s"), F.col("slice").alias("_own"))
    rows = cross.join(home, cross["target_path"] == home["_p"], "left").join(own, cross["source_file"] == own["_s"], "left")
    return rows.where(F.col("_home").isNull() | (F.col("_home") != F.col("target_slice")) | (F.col("_own") == F.col("target_slice"))).select(*[cross[c] for c in cross.columns])


def candidate_paths(refs: DataFrame) -> DataFrame:
    """The distinct candidate paths of all references."""
    return refs.select(F.explode("candidates").alias("path")).distinct()


def canonical_links(links: DataFrame) -> DataFrame:
    """Each (source_file, source, target, type) once, the earliest, in canonical order."""
    return links.groupBy("source_file", "source", "target", "type").agg(F.min("ord").alias("ord")).orderBy("source_file", "source", "target", "type")
