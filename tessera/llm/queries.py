"""The registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import alignment, common, hard_negatives, language, licenses, media, mixing, near_dedup, packing, piece_bpe, quality, token_binary, token_counts, toxicity


def vocabulary(name: str) -> str:
    """The default place of a public vocabulary file; the operators take a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version after a load, its revision to another version, and repeats of both."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    words = common.materialise(token_counts.count_words(docs, "words@1"), "words")
    ids = common.materialise(token_counts.count_tokens(docs, "byte_bpe_50k@1", vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), "ids")
    rollup = token_counts.Rollup(spark, common.scratch(spark, "rollup"))
    draft = words.withColumn("tokenizer", F.lit("words@0"))
    load, revision = token_counts.inserts(draft), token_counts.revised(draft, words).unionByName(token_counts.inserts(ids))
    for batch_id, changes in (("load", load), ("load", load), ("revision", revision), ("revision", revision)):
        rollup.commit(batch_id, changes)
    return rollup.totals()


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.scratch(spark, "tokens")
    token_binary.write_token_files(common.table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_binary.token_digests(spark, path)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.slim(common.table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select("doc_id", F.coalesce(common.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(common.table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(common.table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(common.table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.slim(common.table(spark, sf_dir, "documents"), "doc_id", "text")
    found = toxicity.score(docs, toxicity.learn(docs, common.table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(common.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_of_documents(common.table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(common.table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(common.table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")).drop("ids")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(common.table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_token_binary, op3_language_id, op4_sentencepiece, op5_mixing, op6_quality_rules, op7_license_scan, op8_toxicity, op9_media_columns, op10_near_dedup, op11_hard_negatives, op12_packing, op13_alignment)
}

ORACLE_SQL: dict[str, str] = {"op5_mixing": mixing.MIX_SQL, "op6_quality_rules": quality.QUALITY_SQL, "op7_license_scan": licenses.scan_sql(), "op11_hard_negatives": hard_negatives.MINE_SQL}
