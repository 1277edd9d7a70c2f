"""A corpus pipeline over ``documents``: each stage is one training-data operator, and works on what the one before kept.

Null text: the language stage drops it, for it holds no letter. Repeated rows: the near-duplicate stage keeps the row
of the least doc_id of each group; rows without a doc_id, or with that of another row, come last in their group. An
empty table passes through every stage. Columns that ``documents`` has besides its own stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, language, mixing, near_dedup, piece_bpe, queries, toxicity

#: Documents whose best language has a lower share of the outputs than this are rejected.
LEAST_SHARE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those that no language fits."""
    name, share = out = common.unused(docs, "lang_pred", "share")
    found = language.identify(docs, language.learn(docs, held_out_fold=None), out=out)
    return found.where((found[name] != language.UNKNOWN) & (found[share] >= LEAST_SHARE)).drop(*out)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are predicted to be toxic."""
    model = toxicity.learn(docs, common.table(spark, sf_dir, "labels"), held_out_fold=None)
    share, bad = out = common.unused(docs, "share", "toxic")
    found = toxicity.score(docs, model, out=out)
    return found.where(found[bad] == 0).drop(share, bad)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates."""
    return near_dedup.keep_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops and repeats documents so that the sources come to their target weights."""
    return mixing.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row."""
    return piece_bpe.encode_documents(docs, queries.vocabulary("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("minhash_dedup", minhash_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The classifiers and the piece encoder can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
