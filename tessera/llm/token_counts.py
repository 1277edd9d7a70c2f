"""Token counts kept as a rollup of deltas: totals by source, language and tokenizer version.

A batch of signed rows (+1 inserts, -1 deletes, both for a revised count) is summed by key and committed under a
batch id by one new version of a log. A batch id that was committed before changes nothing, so a batch may be sent again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.sources.commit_log import CommitLog

KEYS = ["source", "lang", "tokenizer"]
CHANGE = ["doc_id", *KEYS, "n_tokens", "sign"]


def _count(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = common.whole(batch.column(3))
            n = np.zeros(len(texts), np.int64)
            for a, b in common.blocks(texts):
                n[a:b] = [len(encoding.encode_ordinary(t)) for t in texts.slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n)], names=["doc_id", "source", "lang", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, ranks_path: str, pattern: str) -> DataFrame:
    """One row for each document with its number of ids in a byte-level BPE. Null or empty text counts 0."""
    rows = common.slim(docs, "doc_id", "source", "lang", "text").mapInArrow(_count(ranks_path, pattern), "doc_id long, source string, lang string, n_tokens long")
    return rows.withColumn("tokenizer", F.lit(tokenizer))


def count_words(docs: DataFrame, tokenizer: str = "words@1") -> DataFrame:
    """One row for each document with its number of words. Null or empty text counts 0."""
    return common.slim(docs, "doc_id", "source", "lang", "text").select(
        "doc_id", "source", "lang", F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)).cast("long").alias("n_tokens"), F.lit(tokenizer).alias("tokenizer")
    )


def inserts(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(1)).select(*CHANGE)


def deletes(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(-1)).select(*CHANGE)


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts go and the new ones come, under the same or another tokenizer version."""
    return deletes(old).unionByName(inserts(new))


def _summed(rows: DataFrame) -> DataFrame:
    """Deltas of several batches as those of one."""
    sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return sums.select("*", *[F.lit(None).cast("long").alias(c) for c in ("_version", "_at")])


class Rollup:
    """The committed batches below a path in a store that all executors share, for any number of writers: a commit log whose
    transactions are the batch ids, and whose checkpoints sum up the batches before them.

    Null source or language is a key of its own. Repeated change rows each count. An empty batch commits and adds
    nothing. Totals that come back to no documents and no tokens are left out.
    """

    def __init__(self, spark: SparkSession, path: str, checkpoint_every: int = 50):
        schemas = {"deltas": "source string, lang string, tokenizer string, docs long, tokens long"}
        self.log = CommitLog(spark, path, schemas, checkpoint_every, merges={"deltas": _summed})

    def committed(self, batch_id: str) -> bool:
        return self.log.snapshot().applied(batch_id)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """False, and nothing done, if the batch id was committed before, or is by another writer meanwhile."""
        if not batch_id:
            raise ValueError("a batch has an id")
        sign = F.col("sign").cast("long")
        sums = changes.groupBy(*KEYS).agg(F.sum(sign).alias("docs"), F.sum(sign * F.coalesce("n_tokens", F.lit(0))).alias("tokens"))
        return self.log.commit(self.log.snapshot(), {"deltas": sums}, txn=batch_id) is not None

    def totals(self) -> DataFrame:
        rows = self.log.snapshot().table("deltas")
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
