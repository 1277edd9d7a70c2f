"""Entity resolution: blocking, scores, and gates on decisions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import indel, jaro_winkler, normalize, token_sort_key, trigrams
from tessera.sources.scratch import materialise

BLOCK_CAP, WINDOW = 500, 10
STRONG, BAND, INDEL = 0.85, 0.80, 0.80


def normalized(names: DataFrame) -> DataFrame:
    """(i, name, norm) of names(i, name); i is unique."""
    return names.select("i", "name", normalize(F.col("name")).alias("norm"))


def block_pairs(keyed: DataFrame, cap: int = BLOCK_CAP) -> DataFrame:
    """Pairs (l, r), l < r, of rows (key, i) that share a key; keys of more than cap rows are passed over.

    The cap is the operator's own rule; blocks are counted, and the large ones left out, before any pair is made.
    """
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n").between(2, cap)).select("key")
    rows = keyed.join(sizes, "key")
    return rows.withColumnRenamed("i", "l").join(rows.withColumnRenamed("i", "r"), "key").where("l < r").select("l", "r")


def token_pairs(norms: DataFrame) -> DataFrame:
    return block_pairs(norms.select(token_sort_key(F.col("norm")).alias("key"), "i")).distinct()


def trigram_pairs(norms: DataFrame) -> DataFrame:
    return block_pairs(norms.select(F.explode(trigrams(F.col("norm"))).alias("key"), "i")).distinct()


def global_rank(rows: DataFrame, *order: str) -> DataFrame:
    """rows with rank from 0 in a total order. Rows are range-partitioned and sorted in place; only the partitions' sizes meet."""
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    starts = F.broadcast(sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")))
    local = F.col("_at").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("_part", part).join(starts, "_part").withColumn("rank", F.col("_start") + local).drop("_part", "_start", "_at")


def neighborhood_pairs(norms: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pairs of rows at most window places apart in the order of names: an equality join on ranks, shifted."""
    ranked = materialise(global_rank(norms.select("norm", "i"), "norm", "i").select("i", "rank"), "ranks")
    ahead = ranked.select(F.col("i").alias("a"), F.explode(F.sequence(F.col("rank") + 1, F.col("rank") + window)).alias("rank"))
    pairs = ahead.join(ranked, "rank").where("a <> i")
    return pairs.select(F.least("a", "i").alias("l"), F.greatest("a", "i").alias("r")).distinct()


def blocked_pairs(norms: DataFrame) -> DataFrame:
    """The distinct pairs of all passes."""
    return token_pairs(norms).unionByName(trigram_pairs(norms)).unionByName(neighborhood_pairs(norms)).distinct()


def preview(norms: DataFrame) -> DataFrame:
    """(measure, comparisons): what each pass would compare. Empty keys count nothing here, though they do form a block."""

    def volume(keys: DataFrame, name: str) -> DataFrame:
        sizes = keys.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c").between(2, BLOCK_CAP))
        return sizes.agg(F.coalesce(F.sum((F.col("c") * (F.col("c") - 1) / 2).cast("long")), F.lit(0)).alias("comparisons")).select(F.lit(name).alias("measure"), "comparisons")

    token = volume(norms.select(token_sort_key(F.col("norm")).alias("key")).where("key <> ''"), "token_sort")
    gram = volume(norms.select(F.explode(trigrams(F.col("norm"))).alias("key")), "trigram")
    n = F.count("*")
    # the sum of min(window, n - pos - 1)
    near = norms.agg(F.when(n > WINDOW, n * WINDOW - F.lit(WINDOW * (WINDOW + 1) // 2)).otherwise((n * (n - 1) / 2).cast("long")).alias("comparisons")).select(F.lit("sorted_neighborhood").alias("measure"), "comparisons")
    each = token.unionByName(gram).unionByName(near)
    return each.unionByName(each.agg(F.sum("comparisons").alias("comparisons")).select(F.lit("total").alias("measure"), "comparisons"))


def candidates(names: DataFrame) -> DataFrame:
    """(l, r, score): pairs whose raw names are alike by Jaro-Winkler, or nearly so and alike by Indel."""
    norms = normalized(names)
    left, right = names.select(F.col("i").alias("l"), F.col("name").alias("ln")), names.select(F.col("i").alias("r"), F.col("name").alias("rn"))
    scored = blocked_pairs(norms).join(left, "l").join(right, "r").withColumn("score", jaro_winkler("ln", "rn")).where(F.col("score") >= BAND)
    # the second score is worked out for the band alone
    strong = scored.where(F.col("score") >= STRONG).select("l", "r", "score")
    weak = scored.where(F.col("score") < STRONG).where(indel("ln", "rn") >= INDEL).select("l", "r", "score")
    return strong.unionByName(weak)


def wilson_lower(p: Column, n: Column, z: float = 1.96) -> Column:
    """The lower Wilson bound of a share p of n; 0 for n = 0."""
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))
    center = share + F.lit(z * z) / (2.0 * n)
    margin = F.lit(z) * F.sqrt(share * (1.0 - share) / n + F.lit(z * z) / (4.0 * n * n))
    return F.when(n > 0, (center - margin) / (1.0 + F.lit(z * z) / n)).otherwise(0.0)


def auto_merge(samples: DataFrame, group: str, gate: float = 0.99) -> DataFrame:
    """(group, n, mean, lower, auto_merge) of outcomes (group, correct)."""
    sums = samples.groupBy(group).agg(F.count("correct").alias("n"), F.avg("correct").alias("mean"))
    return sums.withColumn("lower", wilson_lower(F.col("mean"), F.col("n"))).withColumn("auto_merge", F.col("lower") >= gate)


def in_order(pairs: DataFrame) -> DataFrame:
    """Pairs(l, r, ...) with the lesser name first, each once, by l and then r."""
    rest = [c for c in pairs.columns if c not in ("l", "r")]
    return pairs.select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r"), *rest).dropDuplicates(["l", "r"]).orderBy("l", "r")


#: Clusters of a block of a split group.
BLOCK = 1 << 16


def _dealt(draws: np.ndarray, seed: int, block: int, sizes: list[int]) -> np.ndarray:
    """How many of each resample's draws fall into a block, of blocks of these sizes: halves of the blocks share the draws
    of both binomially, with a generator of their own, so all tasks that ask agree."""
    lo, hi, total = 0, len(sizes), sum(sizes)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = sum(sizes[lo:mid])
        own = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, lo, hi]))).binomial(draws, left / total)
        if block < mid:
            draws, hi, total = own, mid, left
        else:
            draws, lo, total = draws - own, mid, total - left
    return draws


def bootstrap(deltas: DataFrame, group: str, resamples: int = 1000, seed: int = 0, reject_below: float = -0.005, block: int = BLOCK) -> DataFrame:
    """(group, mean, lower, upper, reject) of paired differences (group, cluster, d), by resampling clusters. A group whose
    differences are all null has none: zeros, and no rejection.

    A group of up to block clusters is resampled in one task, in the order of its clusters. A larger one is cut into blocks
    by that order; a resample's draws are dealt over the blocks, each block draws its own, and the sums are added up in
    the order of the blocks. So no task holds more than a block, and the result is the same however rows are partitioned.
    """
    kind = deltas.schema[group].dataType.simpleString()
    rows = deltas.select(F.col(group).alias("_g"), "cluster", F.col("d").cast("double").alias("d"))
    known = global_rank(rows.where("d is not null"), "_g", "cluster", "d")
    sizes = materialise(known.groupBy("_g").agg(F.min("rank").alias("_first"), F.count("*").alias("_n")).withColumn("_blocks", F.ceil(F.col("_n") / block)), "sizes")
    place = F.col("rank") - F.col("_first")
    # nulls are a group too
    placed = known.join(sizes.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h"))).select("_g", "d", "_n", "_blocks", place.alias("_place"), F.floor(place / block).cast("int").alias("_block"))
    placed = materialise(placed, "placed")

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        d = rows.sort_values("_place")["d"].to_numpy(np.float64)
        draw = np.random.default_rng(seed)
        means = np.concatenate([d[draw.integers(0, d.size, size=(1, d.size))].mean(axis=1) for _ in range(resamples)])
        low, high = np.percentile(means, [2.5, 97.5])
        return pd.DataFrame({"_g": [rows["_g"].iloc[0]], "mean": [d.mean()], "lower": [low], "upper": [high]})

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        d, n, k = rows.sort_values("_place")["d"].to_numpy(np.float64), int(rows["_n"].iloc[0]), int(rows["_block"].iloc[0])
        own = [block] * (n // block) + [n % block] * (n % block > 0)
        draws = _dealt(np.full(resamples, n), seed, k, own)
        draw = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, k])))
        return pd.DataFrame({"_g": [rows["_g"].iloc[0]], "_block": [k], "total": [d.sum()], "sums": [[float(d[draw.integers(0, d.size, c)].sum()) for c in draws]]})

    few = placed.where("_blocks = 1").groupBy("_g").applyInPandas(whole, f"_g {kind}, mean double, lower double, upper double")
    parts = placed.where("_blocks > 1").groupBy("_g", "_block").applyInPandas(part, f"_g {kind}, _block int, total double, sums array<double>")
    parts = materialise(parts, "parts").join(sizes.select(F.col("_g").alias("_h"), "_n"), F.col("_g").eqNullSafe(F.col("_h"))).drop("_h")
    in_order = lambda c: F.aggregate(F.array_sort(F.collect_list(F.struct("_block", F.col(c).alias("x")))), F.lit(0.0), lambda a, x: a + x["x"])
    each = parts.select("_g", "_block", "_n", F.posexplode("sums").alias("at", "sum")).groupBy("_g", "at", "_n").agg((in_order("sum") / F.col("_n")).alias("mean"))
    edges = each.groupBy("_g").agg(F.percentile("mean", [0.025, 0.975]).alias("x")).select("_g", F.col("x")[0].alias("lower"), F.col("x")[1].alias("upper"))
    means = parts.groupBy("_g", "_n").agg((in_order("total") / F.col("_n")).alias("mean")).select(F.col("_g").alias("_h"), "mean")
    many = edges.join(means, F.col("_g").eqNullSafe(F.col("_h"))).select("_g", "mean", "lower", "upper")
    none = rows.groupBy("_g").agg(F.count("d").alias("n")).where("n = 0").select("_g", *[F.lit(0.0).alias(c) for c in ("mean", "lower", "upper")])
    found = few.unionByName(many).select("*", (F.col("lower") < reject_below).alias("reject")).unionByName(none.withColumn("reject", F.lit(False)))
    return found.withColumnRenamed("_g", group)


def clerical_sample(items: DataFrame, band: str, pos: str, per_band: int = 150) -> DataFrame:
    """Evenly spaced items of each band, in the order of pos, per_band of them at most; the sample is the operator's purpose.

    Item i of k is the one at place int(i * n / k).
    """
    rows = items.select(F.col(band).alias("_band"), F.col(pos).alias("_pos"), F.struct("*").alias("_item"))
    # places within bands, from the order of all items, so no band is one task's work
    ranked = global_rank(rows, "_band", "_pos")
    sizes = materialise(ranked.groupBy("_band").agg(F.min("rank").alias("_first"), F.count("*").alias("n_available")), "bands").withColumn("k", F.least(F.lit(per_band), F.col("n_available")))
    wanted = sizes.select("_band", "_first", "n_available", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k").cast("long") - 1)).alias("i"))
    place = F.least(F.col("n_available") - 1, F.floor(F.col("i") * (F.col("n_available") / F.col("k")))).cast("long")
    # a rank is one item's, so the bands needn't be compared
    wanted = wanted.select((F.col("_first") + place).alias("_at"), "n_available", "k")
    return ranked.join(wanted, F.col("rank") == F.col("_at")).select("_item.*", "n_available", "k")
