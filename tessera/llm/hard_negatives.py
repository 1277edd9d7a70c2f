"""Hard negatives of labelled vectors: each anchor's integer scores are sorted in full, and its negatives read from there.

1. Vectors become integers; rows that can't be scored are left out.
2. Anchors and rows are dealt into blocks of a bounded number of values, and each pair of an anchor block and a row block is
   one task's work: the anchors are a stated set of queries against all rows.
3. A first pass gives each anchor's best rows of its own label (the positives), block by block, then merged.
4. A second pass sorts an anchor's scores of a block by score and id, looks up each positive's upper limit by bisection,
   and reads on from there to the next rows of another label, as far as the lower limit. What the blocks read is merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common


@dataclass(frozen=True)
class Mining:
    #: Anchors are the rows whose vec_id is divisible by this.
    every: int = 50
    positives: int = 5
    negatives: int = 3
    #: A negative's score is at least and at most this percentage of the positive's.
    lower: int = 50
    upper: int = 95
    #: A component x becomes floor(scale * x).
    scale: int = 256
    #: Labels of rows whose vec_id is divisible by the first become (label + 1) modulo the second; None: no label changes.
    relabel: tuple[int, int] | None = (7, 10)
    #: Vector components of a block of rows, and of a block of anchors: what a task holds.
    row_values: int = 1 << 20
    anchor_values: int = 1 << 18
    #: Scores that a task holds at once.
    scores: int = 1 << 22


def participants(rows: DataFrame, p: Mining) -> DataFrame:
    """(row, vec_id, label, vector) of rows(vec_id, embedding, label) that take part; the vector's components are integers."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    if p.relabel:
        label = F.when(vec_id % p.relabel[0] == 0, (label + 1) % p.relabel[1]).otherwise(label)
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))  # NaN is above infinity
    known = common.slim(rows, "vec_id", "embedding", "label").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return known.select(F.monotonically_increasing_id().alias("row"), vec_id.alias("vec_id"), label.alias("label"), F.transform(values, lambda v: F.floor(v * p.scale)).alias("vector"))


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of integers; those of fewer components than others go on with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    at, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
    n = np.diff(at)
    out = np.zeros((len(n), int(n.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat[at[0] : at[-1]]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exactly; those beyond 64 bits become the greatest or least number that has them."""
    wide = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))
    x, y = a.astype(np.float64), b.astype(np.float64)
    if np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0) * wide < 2.0**53:
        return np.rint(x @ y.T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class _Block:
    """A pair of an anchor block and a row block. Rows are in the order of their ids, so that a stable sort by score keeps it."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, p: Mining):
        self.p = p
        self.anchor, self.anchor_id, self.own = (anchors.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.queries = _matrix(anchors.column("vector"))
        rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.row, self.id, self.label = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.vectors = _matrix(rows.column("vector"))

    def parts(self, anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """An anchor's place, its scores, and the order of these: greatest first, of equal ones the least id."""
        step = max(1, self.p.scores // max(1, len(rows)))
        for k in range(0, len(anchors), step):
            scores = _products(self.queries[anchors[k : k + step]], self.vectors[rows])
            orders = np.argsort(~scores, axis=1, kind="stable")
            yield from zip(anchors[k : k + step].tolist(), scores, orders, strict=True)


_BEST = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("other", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())])
_READ = pa.schema([("anchor", pa.int64()), ("k", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])


def _positives(p: Mining):
    """A block's best rows of each anchor's own label, other than the anchor itself."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in _BEST.names]
        if anchors.num_rows and rows.num_rows:
            b = _Block(anchors, rows, p)
            for label in np.unique(b.own):
                same = np.flatnonzero(b.label == label)
                for a, scores, order in b.parts(np.flatnonzero(b.own == label), same):
                    best = order[: p.positives + 1]
                    best = best[b.row[same[best]] != b.anchor[a]][: p.positives]
                    at = same[best]
                    for x, v in zip(out, (np.full(len(at), b.anchor[a]), np.full(len(at), b.anchor_id[a]), b.row[at], b.id[at], scores[best]), strict=True):
                        x.append(v)
        return pa.table([np.concatenate(x) if x else np.zeros(0, np.int64) for x in out], schema=_BEST)

    return run


def _negatives(p: Mining):
    """A block's first rows of another label within the limits of each of an anchor's positives."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in _READ.names]
        if anchors.num_rows and rows.num_rows:
            b, limits = _Block(anchors, rows, p), anchors.column("positive_scores").to_pylist()
            for a, scores, order in b.parts(np.arange(len(b.anchor)), np.arange(len(b.row))):
                falling = ~scores[order]  # rises
                others = np.flatnonzero(b.label[order] != b.own[a])
                for k, positive in enumerate(limits[a], 1):
                    most, least = p.upper * positive // 100, -(-p.lower * positive // 100)
                    first = np.searchsorted(others, np.searchsorted(falling, ~most, "left"))
                    at = order[others[first : first + p.negatives]]
                    at = at[scores[at] >= least]
                    for x, v in zip(out, ([b.anchor[a]] * len(at), [k] * len(at), b.id[at].tolist(), scores[at].tolist()), strict=True):
                        x += v
        return pa.table([pa.array(x, f.type) for x, f in zip(out, _READ, strict=True)], schema=_READ)

    return run


def mine(rows: DataFrame, p: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of rows(vec_id, embedding, label).

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Of equal scores the least vec_id
    comes first. Rows that repeat a vec_id are rows of their own: each is an anchor, and a positive of the others. A vector of
    fewer components goes on with zeros (an empty one scores 0). A positive of a negative score has no negatives, for its
    limits exclude each other; nor has an anchor without other rows of its label any rows. Components and scores
    beyond 64 bits are the greatest or least number of 64 bits. An empty table gives an empty one. Other columns are not read.
    """
    known = common.materialise(participants(rows, p), "vectors")
    anchor = F.col("vec_id") % p.every == 0
    n, queries, wide = known.agg(F.count("*"), F.count(F.when(anchor, 1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    blocks = lambda count, values: max(1, -(-count // max(1, values // max(1, wide))))
    i, j = blocks(queries, p.anchor_values), blocks(n, p.row_values)
    deal = lambda name, own, by, other, of: [F.pmod(F.xxhash64("row"), F.lit(by)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(of - 1))).alias(other)]  # noqa: E731, ARG005
    cells = known.select("row", "vec_id", "label", "vector", *deal("row", "j", j, "i", i)).groupBy("i", "j")

    def against(queries: DataFrame, run, schema: str) -> DataFrame:
        return queries.select("*", *deal("row", "i", i, "j", j)).groupBy("i", "j").cogroup(cells).applyInArrow(run, schema)

    anchors = known.where(anchor).toDF(*known.columns)  # attributes of its own, apart from the rows'
    best = against(anchors, _positives(p), "anchor long, anchor_id long, other long, other_id long, score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "other_id", "other")
    positives = common.materialise(best.withColumn("k", F.row_number().over(first)).where(F.col("k") <= p.positives), "positives")
    scores = positives.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("k", "score"))).alias("x"))  # p.positives at most
    read = against(anchors.join(scores.select("row", F.transform("x", lambda x: x["score"]).alias("positive_scores")), "row"), _negatives(p), "anchor long, k int, other_id long, score long")
    next_ = Window.partitionBy("anchor", "k").orderBy(F.desc("score"), "other_id")
    ranked = read.withColumn("rank", F.row_number().over(next_)).where(F.col("rank") <= p.negatives)
    own = positives.select("anchor", "k", "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(own, ["anchor", "k"]).select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


MINE_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same, list_dot_product(a.q, r.q)::bigint as score
  from v a join v r on a.vec_id <> r.vec_id
  where a.vec_id % 50 = 0
), p as (
  select * from s where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.other_id as positive_id, (row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id))::int as rank,
  n.other_id as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.anchor_id = p.anchor_id and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""
