"""Mixing sources to target weights by hash-threshold histograms. DataFrame operations only.

Each source gets a budget. Whole copies of the source fill it as far as they fit; what is left is filled by the
documents whose hash lies below a threshold. The threshold comes from sums of sizes by source and hash bucket: the
bucket in which the running sum passes the budget is cut into finer buckets, and only its own rows are read for
that, until it holds one hash value. Nothing is sorted but the at most 4,096 bucket sums of each source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common

#: A hash has 60 bits, of which each level looks at 12.
HASH_BITS, LEVEL_BITS = 60, 12


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    #: Times that a document may be taken, and so times its size that a source may give.
    most: int = 3
    #: Sources that may be broadcast; with more, the plan is joined by shuffles.
    broadcast_sources: int = 100_000


def dice(doc_id: str = "doc_id") -> Column:
    """60 bits of the MD5 of doc_id as text (null: empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and hash of each row."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)).cast("long").alias("size"), dice().alias("hash"))


def budgets(sizes: DataFrame, p: Mix = Mix()) -> DataFrame:
    """source, source_size and target of each source.

    The targets are a level times the weight, or the cap where that is less: going through the sources by cap over
    weight, the level is what is left of the total over what is left of the weights, at the first source that it
    doesn't lift over its cap. One row for each source is handled in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in p.weights]), (place % len(p.weights) + 1).cast("int"))
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(p.most))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    all_of = Window.partitionBy(F.lit(0))
    steps = each.withColumn("level", (F.sum("source_size").over(all_of) - capped) / open_weight).withColumn("k", F.row_number().over(by))
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("k", "level"))).over(all_of)
    return steps.withColumn("l", fits["level"]).select("source", "source_size", F.least("cap", F.coalesce(F.col("l") * F.col("weight"), F.col("cap"))).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, p: Mix = Mix()) -> DataFrame:
    """targets with copies (of the whole source) and below: rows of a lower hash are taken once more."""
    copies = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(p.most))).otherwise(0).cast("long")
    plan = targets.withColumn("copies", copies).withColumn("need", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("prefix", F.lit(0).cast("long"))
    plan = common.materialise(plan.withColumn("below", F.lit(0).cast("long")), "plan")
    few = plan.count() <= p.broadcast_sources
    held = F.broadcast if few else lambda df: df
    for level in range(HASH_BITS // LEVEL_BITS):
        left = HASH_BITS - LEVEL_BITS * (level + 1)
        open_ = plan.where((F.col("need") > 0) & (F.col("source_size") > 0)).select(F.col("source").alias("s"), "prefix", "need")
        # at the first level each row is in the open bucket; afterwards the hash's first bits must be the prefix
        rows = sizes.join(held(open_), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", left + LEVEL_BITS) == F.col("prefix")))
        sums = rows.groupBy("s", "need", F.shiftright("hash", left).alias("bucket")).agg(F.sum("size").alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("s").orderBy("bucket"))
        edge = sums.withColumn("upto", upto).where(F.col("upto") >= F.col("need")).groupBy("s").agg(F.min(F.struct("bucket", "upto", "n", "lo", "hi")).alias("e"))
        plan = plan.join(held(edge), F.col("source").eqNullSafe(F.col("s")), "left")
        need = F.col("need") - (F.col("e.upto") - F.col("e.n"))
        one = F.col("e.lo") == F.col("e.hi")
        # one hash value is left: it is taken if that comes nearer to the budget than leaving it
        below = F.when(one, F.when(2 * need >= F.col("e.n"), F.col("e.hi") + 1).otherwise(F.col("e.lo")))
        plan = plan.select(
            "source", "source_size", "target", "copies", F.when(F.col("e").isNull() | one, F.lit(0.0)).otherwise(need).alias("need"), F.coalesce("e.bucket", F.lit(0)).alias("prefix"), F.coalesce(below, "below").alias("below")
        )
        plan = common.materialise(plan, "plan")
        if not plan.where("need > 0").take(1):
            break
    return plan.select("source", "source_size", "target", "copies", "below")


def _planned(rows: DataFrame, plan: DataFrame, p: Mix) -> DataFrame:
    plan = plan.withColumnRenamed("source", "_s")
    held = F.broadcast(plan) if plan.count() <= p.broadcast_sources else plan
    return rows.join(held, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_times", F.col("copies") + (F.col("hash") < F.col("below")).cast("long"))


def mix(docs: DataFrame, p: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row of docs(doc_id, source, text).

    Null text has size 0, and so has text without words; such a row is taken for 0 words. A null source is a source
    and comes last. Rows that repeat a doc_id, or have none, are taken or left together: where few ids, or none, stand for most
    words of a source, its target is missed by as much as theirs. With no words at all each target is 0. An
    empty table gives an empty one. Other columns of docs are not read. The same rows give the same mix.
    """
    sizes = common.materialise(measured(common.slim(docs, "doc_id", "source", "text")), "sizes")
    plan = thresholds(sizes, budgets(sizes, p), p)
    return _planned(sizes, plan, p).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("_times")).alias("taken"))


def mixed_rows(docs: DataFrame, p: Mix = Mix()) -> DataFrame:
    """The rows of docs as often as the mix takes them, with all their columns."""
    sizes = common.materialise(measured(common.slim(docs, "doc_id", "source", "text")), "sizes")
    plan = thresholds(sizes, budgets(sizes, p), p)
    own = docs.select(F.struct("*").alias("_row"), F.col("source").alias("source"), dice().alias("hash"))
    taken = _planned(own, plan, p).where("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_n"))
    return taken.select("_row.*")


MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents
), placed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sizes GROUP BY source
), capped AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap FROM placed
), steps AS (
  SELECT *, row_number() OVER o AS k,
         ((SELECT CAST(sum(source_size) AS BIGINT) FROM placed)
          - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
), level AS (
  SELECT arg_min(level, k) AS l FROM steps WHERE level * weight <= cap
), targets AS (
  SELECT source, source_size, least(cap, coalesce(l * weight, cap)) AS target FROM steps, level
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM targets
), run AS (
  SELECT s.source, s.hash, sum(s.size) AS n, sum(sum(s.size)) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto
  FROM sizes s GROUP BY s.source, s.hash
), edge AS (
  SELECT p.source, arg_min(struct_pack(hash := r.hash, upto := r.upto, n := r.n), r.hash) AS e, any_value(p.target - p.copies * p.source_size) AS need
  FROM plan p JOIN run r ON p.source IS NOT DISTINCT FROM r.source
  WHERE p.target - p.copies * p.source_size > 0 AND p.source_size > 0 AND r.upto >= p.target - p.copies * p.source_size
  GROUP BY p.source
), cut AS (
  SELECT source, CASE WHEN 2 * (need - (e.upto - e.n)) >= e.n THEN e.hash + 1 ELSE e.hash END AS below FROM edge
)
SELECT s.doc_id, s.size, p.source_size, p.target,
       CAST(s.size * (p.copies + CASE WHEN s.hash < coalesce(c.below, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
"""
