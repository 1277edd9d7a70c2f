"""Vectors with int8 and bit twins, upserts, a search in two stages, and an exact search as an extension."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import cosine, to_bits, to_int8
from tessera.sources.scratch import materialise


def twins(vectors: DataFrame) -> DataFrame:
    """(chunk_id, vec, vec_int8, vec_bit)."""
    return vectors.select("chunk_id", "vec", to_int8("vec").alias("vec_int8"), to_bits("vec").alias("vec_bit"))


def upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
    """stored with the rows of new in place of those of the same chunk_id. new has each chunk_id once."""
    return stored.join(new.select("chunk_id"), "chunk_id", "left_anti").unionByName(twins(new))


def nearest(stored: DataFrame, query: list[float], k: int = 10) -> DataFrame:
    """An extension: the k nearest of all vectors by cosine, ties by chunk_id. One scan; each task keeps k rows."""
    asked = F.array(*[F.lit(float(x)) for x in query])
    return stored.select("chunk_id", cosine(F.col("vec"), asked).alias("score")).orderBy(F.desc("score"), "chunk_id").limit(k)


@lru_cache(4)
def _planes(dims: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, bits))


def _codes(vectors: pd.Series, bits: int, seed: int) -> list[bytes | None]:
    """The sides of random planes that vectors lie on, as bits. Vectors of each number of components are multiplied together."""
    out: list[bytes | None] = [None] * len(vectors)
    sizes: dict[int, list[int]] = {}
    for k, v in enumerate(vectors):
        if v is not None and len(v):
            sizes.setdefault(len(v), []).append(k)
    for dims, at in sizes.items():
        sides = np.packbits(np.stack([np.asarray(vectors.iloc[k], np.float64) for k in at]) @ _planes(dims, bits, seed) > 0, axis=1)
        for k, side in zip(at, sides, strict=True):
            out[k] = side.tobytes()
    return out


@dataclass
class BitIndex:
    """An index of vectors by bit codes, and by the segments of these.

    rows(chunk_id, vec, code) has every vector; segments(segment, value, chunk_id) has every vector under each 16 bits of its
    code. Two vectors whose codes differ in fewer than (radius + 1) * segments bits have a segment in which they
    differ by radius at most, so a look at the values that near finds them all.
    """

    rows: DataFrame
    segments: DataFrame
    bits: int = 256
    seed: int = 0
    #: Components of a block of vectors, and codes' pairs that a task compares at once.
    values: int = 1 << 20
    pairs: int = 1 << 22

    @classmethod
    def build(cls, vectors: DataFrame, path: str, bits: int = 256, seed: int = 0) -> BitIndex:
        """Indexes vectors(chunk_id, vec) below path. Null and empty vectors, and those with a null or non-finite component, are left out."""
        values = F.col("vec").cast("array<double>")
        fine = F.forall(values, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf")))) & (F.size(values) > 0)
        coded = vectors.where(F.col("chunk_id").isNotNull() & F.coalesce(fine, F.lit(False))).select("chunk_id", values.alias("vec"))
        coded.withColumn("code", _coder(bits, seed)("vec")).write.parquet(f"{path}/rows")
        spark = vectors.sparkSession
        rows = spark.read.parquet(f"{path}/rows")
        each = rows.select(F.posexplode(_segments(bits)).alias("segment", "value"), "chunk_id")
        each.repartitionByRange("segment", "value", "chunk_id").sortWithinPartitions("segment", "value").write.parquet(f"{path}/segments")
        return cls.load(spark, path, bits, seed)

    @classmethod
    def load(cls, spark: SparkSession, path: str, bits: int = 256, seed: int = 0) -> BitIndex:
        return cls(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/segments"), bits, seed)

    def search(self, queries: DataFrame, k: int = 10, radius: int = 1, z: float = 1.3) -> DataFrame:
        """(query_id, rank, chunk_id, score): about the k nearest of all vectors to each of queries(query_id, vec) by cosine.

        The index gives the vectors near a query's segments, and their k-th best cosine says how many bits a nearer vector's code
        may differ in: the mean for that angle and z deviations, which leaves out one in ten of those that are only just
        nearer. Queries for which the index has looked that far are done; for the others every code is looked at, in
        blocks. Vectors whose codes are within the limit are scored as they are. Ties by chunk_id.
        """
        count = self.bits // 16
        fine = queries.where("query_id is not null and size(vec) > 0").select("query_id", F.col("vec").cast("array<double>").alias("vec"))
        asked = materialise(fine.withColumn("code", _coder(self.bits, self.seed)("vec")), "queries")
        near = [m for m in range(1 << 16) if m.bit_count() <= radius]
        # a query's segments, and all values that differ from theirs by radius bits at most: their number doesn't grow with the rows
        probes = asked.select("query_id", F.posexplode(_segments(self.bits)).alias("segment", "own")).select("query_id", "segment", F.explode(F.array(*[F.lit(m) for m in near])).alias("by"), "own").select("query_id", "segment", F.col("own").bitwiseXOR(F.col("by")).alias("value"))
        met = self.segments.join(probes, ["segment", "value"]).select("query_id", "chunk_id").distinct()
        scored = met.join(self.rows.select("chunk_id", F.col("vec").alias("_v")), "chunk_id").join(asked, "query_id").select("query_id", "chunk_id", cosine(F.col("_v"), F.col("vec")).alias("score"))
        first = materialise(_best(scored.where("score is not null"), k), "met")
        worst = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
        share = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("least")))) / math.pi
        limits = asked.join(worst, "query_id", "left").withColumn("limit", F.when(F.col("least").isNull(), float(self.bits)).otherwise(self.bits * share + z * F.sqrt(self.bits * share * (1 - share))))
        limits = materialise(limits.select("query_id", "vec", "code", "limit"), "limits")
        rest = limits.where(F.col("limit") >= (radius + 1) * count)
        return _best(first.join(limits.where(F.col("limit") < (radius + 1) * count).select("query_id"), "query_id", "left_semi").select("query_id", "chunk_id", "score").unionByName(self._scanned(rest, k)), k)

    def _scanned(self, queries: DataFrame, k: int) -> DataFrame:
        """The best of each block of vectors for each of queries(query_id, vec, code, limit)."""
        wide, n = self.rows.agg(F.coalesce(F.max(F.size("vec")), F.lit(1)), F.count("*")).first()
        asked = queries.count()
        blocks = lambda count: max(1, -(-count * wide // self.values))
        i, j = blocks(asked), blocks(n)
        deal = lambda key, own, by, other, of: [F.pmod(F.xxhash64(key), F.lit(by)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(of - 1))).alias(other)]
        left = queries.select("*", *deal("query_id", "i", i, "j", j)).groupBy("i", "j")
        # rows are dealt by their place, so copies of one vector or id don't meet in a block
        right = self.rows.select("*", *deal(F.monotonically_increasing_id(), "j", j, "i", i)).groupBy("i", "j")
        kinds = queries.schema["query_id"].dataType.simpleString(), self.rows.schema["chunk_id"].dataType.simpleString()
        pairs = self.pairs

        def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if asked.num_rows and rows.num_rows:
                rows = rows.sort_by("chunk_id")
                word = lambda t: np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint64).reshape(t.num_rows, -1)
                own, theirs, ids = word(asked), word(rows), rows.column("chunk_id").to_pylist()
                vectors = [np.asarray(v, np.float64) for v in rows.column("vec").to_pylist()]
                same = len({v.size for v in vectors}) == 1
                whole = np.stack(vectors) if same else None
                limits, names = asked.column("limit").to_numpy(), asked.column("query_id").to_pylist()
                for a in range(0, len(own), max(1, pairs // len(theirs))):
                    part = slice(a, a + max(1, pairs // len(theirs)))
                    bits = np.bitwise_count(own[part, None, :] ^ theirs[None]).sum(2, dtype=np.int32)
                    for q, row in enumerate(bits, a):
                        x = np.asarray(asked.column("vec")[q].as_py(), np.float64)
                        at = np.flatnonzero(row <= limits[q])
                        if not same:
                            at = np.array([r for r in at.tolist() if vectors[r].size == x.size], np.int64)
                        if not at.size or same and whole.shape[1] != x.size:
                            continue
                        y = whole[at] if same else np.stack([vectors[r] for r in at.tolist()])
                        size = np.linalg.norm(y, axis=1) * np.linalg.norm(x)
                        score = np.divide(y @ x, size, out=np.full(len(at), -2.0), where=size > 0)
                        best = np.argsort(-score, kind="stable")[:k]
                        out += [(names[q], ids[at[b]], float(score[b])) for b in best.tolist() if score[b] > -2]
            return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate((asked.schema.field("query_id").type, rows.schema.field("chunk_id").type, pa.float64()))], names=["query_id", "chunk_id", "score"])

        return left.cogroup(right).applyInArrow(run, f"query_id {kinds[0]}, chunk_id {kinds[1]}, score double")


def _coder(bits: int, seed: int):
    @F.pandas_udf("binary")
    def code(vectors: pd.Series) -> pd.Series:
        return pd.Series(_codes(vectors, bits, seed))

    return code


def _segments(bits: int) -> Column:
    """The 16-bit numbers that a code is made of."""
    return F.array(*[F.conv(F.hex(F.substring("code", 2 * s + 1, 2)), 16, 10).cast("int") for s in range(bits // 16)])


def _best(scored: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
    return scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "chunk_id", "score")
