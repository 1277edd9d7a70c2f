"""Checks of registries and builds: what differs from what is expected, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other has not, as often as that is, with side."""
    a = left.exceptAll(right).withColumn("side", F.lit("left"))
    return a.unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def same(left: DataFrame, right: DataFrame) -> bool:
    return not differences(left, right).take(1)


def reciprocity(claims: DataFrame, lanes: DataFrame) -> DataFrame:
    """(claim, lane, side): pairs that only the claims or only the lanes have."""
    return differences(claims.select("claim", "lane").distinct(), lanes.select("claim", "lane").distinct())


def class_counts(rows: DataFrame, expected: DataFrame, key: str = "class") -> DataFrame:
    """(class, n, expected, ok) of each class on either side."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    joined = n.join(expected.select(F.col(key).alias("_k"), "expected"), F.col(key).eqNullSafe(F.col("_k")), "full_outer")
    return joined.select(F.coalesce(key, "_k").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("expected", F.lit(0)).cast("long").alias("expected"), (F.coalesce("n", F.lit(0)) == F.coalesce("expected", F.lit(0))).alias("ok"))


def partition_faults(parts: DataFrame, first: int, last: int) -> DataFrame:
    """(member, times): members from first to last that the parts(part, member) do not have exactly once, and strangers."""
    spark = parts.sparkSession
    every = spark.range(first, last + 1).select(F.col("id").alias("_m"))
    n = parts.groupBy("member").agg(F.count("*").alias("times"))
    joined = every.join(n, F.col("_m") == F.col("member"), "full_outer")
    return joined.where(F.col("_m").isNull() | F.coalesce(F.col("times") != 1, F.lit(True))).select(F.coalesce("_m", "member").alias("member"), F.coalesce("times", F.lit(0)).cast("long").alias("times"))


def provenance_faults(rows: DataFrame, observed: DataFrame) -> DataFrame:
    """(path, field) where a registered blob id or digest isn't the observed one; a file that is missing must have -."""
    o = observed.select(F.col("path").alias("_p"), F.col("blob_oid").alias("_oid"), F.col("sha256").alias("_sha"))
    joined = rows.join(o, rows["path"] == o["_p"], "left")
    bad = F.array_compact(F.array(F.when(F.col("blob_oid") != F.coalesce("_oid", F.lit("-")), "blob_oid"), F.when(F.col("sha256") != F.coalesce("_sha", F.lit("-")), "sha256")))
    return joined.select("path", F.explode(bad).alias("field"))


def citation_counts(lanes: DataFrame) -> DataFrame:
    """(lane, urls, ok): URLs in each lane's text; at least one is needed."""
    urls = F.regexp_count("text", F.lit(r"https?://[^\s)>\]]+"))
    return lanes.groupBy("lane").agg(F.sum(F.coalesce(urls, F.lit(0))).cast("long").alias("urls")).withColumn("ok", F.col("urls") > 0)


def citations(lanes: DataFrame) -> DataFrame:
    """citation_counts, and their total as the lane *."""
    each = citation_counts(lanes)
    return each.unionByName(each.agg(F.lit("*").alias("lane"), F.coalesce(F.sum("urls"), F.lit(0)).cast("long").alias("urls"), F.coalesce(F.min("ok"), F.lit(False)).alias("ok")))


def not_once(rows: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, times) of expected(key) that the rows have not exactly once, and of keys that are not expected: markers, sections."""
    n = rows.groupBy(key).agg(F.count("*").alias("times"))
    both = n.join(expected.select(F.col(key).alias("_k")).distinct(), F.col(key).eqNullSafe(F.col("_k")), "full_outer")
    return both.where(F.col("_k").isNull() | (F.coalesce("times", F.lit(0)) != 1)).select(F.coalesce(key, "_k").alias(key), F.coalesce("times", F.lit(0)).cast("long").alias("times"))


def compatibility(mapped: DataFrame, required: DataFrame) -> DataFrame:
    """(requirement, fault) where a map(requirement, label) isn't that of required(requirement, label): missing, unknown,
    repeated, or another label."""
    m = mapped.groupBy("requirement").agg(F.count("*").alias("_n"), F.min("label").alias("_least"), F.max("label").alias("_most"))
    r = required.select(F.col("requirement").alias("_r"), F.col("label").alias("_label"))
    rows = m.join(r, F.col("requirement") == F.col("_r"), "full_outer")
    other = ~(F.col("_least").eqNullSafe(F.col("_label")) & F.col("_most").eqNullSafe(F.col("_label")))
    fault = F.when(F.col("requirement").isNull(), "missing").when(F.col("_r").isNull(), "unknown").when(F.col("_n") > 1, "repeated").when(other, "other_label")
    return rows.select(F.coalesce("requirement", "_r").alias("requirement"), fault.alias("fault")).where("fault is not null")


def phrases(texts: DataFrame, required: Sequence[str], prohibited: Sequence[str]) -> DataFrame:
    """(path, phrase, fault): required phrases that a text lacks, prohibited ones that it has."""
    rows = [F.when(~F.col("text").contains(p), F.struct(F.lit(p).alias("phrase"), F.lit("missing").alias("fault"))) for p in required]
    rows += [F.when(F.col("text").contains(p), F.struct(F.lit(p).alias("phrase"), F.lit("prohibited").alias("fault"))) for p in prohibited]
    return texts.select("path", F.explode(F.array_compact(F.array(*rows))).alias("x")).select("path", "x.phrase", "x.fault")


def ratchet(warnings: DataFrame, baseline: DataFrame | None, slack: float = 1.10) -> DataFrame:
    """(class, n, allowed, verdict): against a baseline(class, n), a class over its slack, or a new one, is fatal.

    Without a baseline each class is recorded; it is the first run.
    """
    n = warnings.groupBy("class").agg(F.count("*").alias("n"))
    if baseline is None:
        return n.select("class", "n", F.lit(None).cast("double").alias("allowed"), F.lit("recorded").alias("verdict"))
    b = baseline.select(F.col("class").alias("_c"), (F.col("n") * F.lit(slack)).alias("allowed"))
    joined = n.join(b, F.col("class") == F.col("_c"), "left")
    return joined.select("class", "n", "allowed", F.when(F.col("allowed").isNull(), "fatal_new").when(F.col("n") > F.col("allowed"), "fatal_over").otherwise("within").alias("verdict"))


def ratchet_status(verdicts: DataFrame, has_baseline: bool) -> str:
    """FAIL with a fatal class, else PASS_WITH_WARNINGS with warnings or a baseline (even without warnings), else PASS."""
    rows = verdicts.agg(F.count("*").alias("n"), F.count_if(F.col("verdict").startswith("fatal")).alias("bad")).first()
    return "FAIL" if rows["bad"] else "PASS_WITH_WARNINGS" if has_baseline or rows["n"] else "PASS"


def table_rows(lines: DataFrame, cells: int) -> DataFrame:
    """(ord, cells) of the Markdown table rows of lines(ord, value) that have that many cells; separator rows are left out."""
    body = F.regexp_replace(F.trim("value"), r"^\||\|$", "")
    rows = lines.where(F.col("value").rlike(r"^\s*\|.*\|\s*$")).select("ord", F.transform(F.split(body, r"\|"), lambda c: F.trim(c)).alias("cells"))
    return rows.where((F.size("cells") == cells) & ~F.forall("cells", lambda c: c.rlike(r"^:?-+:?$")))
