"""Columns of documents that have the names of operators' outputs, ids at both ends of their range, hot ids, texts full of matches, and unclosed tags."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import common, language, licenses, media, near_dedup, queries, token_binary, toxicity
from tests.llm import cases

OWN = {"score": 77.0, "lang_pred": "mine", "predicted": 9, "share": "s", "toxic": 5, "_row": 3, "_kept_id": 4, "row": "r", "at": 1, "_at": 2, "_id": 6, "_first": 8, "_rows": 10, "held": 1}
TOP, BOTTOM = 2**63 - 1, -(2**63)


def _texts(n):
    return [f"w{i} " + " ".join(f"t{i}x{j}" for j in range(40)) for i in range(n)]


def _owned(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(v).alias(k) for k, v in OWN.items()], F.concat(F.lit("own "), F.coalesce("text", F.lit("none"))).alias("Score2"))


@pytest.mark.parametrize("ids", ["distinct", "repeated"])
def test_stages_keep_the_values_of_all_columns(spark, sf_dir, ids):
    rows = [(r["doc_id"] if ids == "distinct" else r["doc_id"] // 2, r["text"], r["lang"], r["source"]) for r in common.table(spark, sf_dir, "documents").limit(80).collect()]
    docs = common.materialise(_owned(spark, rows), "owned")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.materialise(stage(spark, docs, sf_dir), name)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        out = docs.collect()
        assert 0 < len(out)
        for r in out:
            assert all(r[k] == v for k, v in OWN.items()) and r["Score2"] == "own " + r["text"]
        wanted = {(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in before.collect()}
        assert {(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in out} <= wanted


def test_classifiers_take_names_that_are_free(spark):
    docs = cases.docs(spark)
    for found, own in ((language.identify(docs, language.LanguageModel.fit([], []), out=("a1", "a2")), {"lang_pred", "score"}), (toxicity.score(docs, toxicity.ToxicityModel.fit([], []), out=("a1", "a2")), {"predicted", "score"})):
        assert found.columns == [*docs.columns, "a1", "a2"] and all(r[c] == 7 for r in found.collect() for c in own)
    assert common.unused(docs, "SIZE", "size", "new") == ["_SIZE", "__size", "new"]


def test_ids_at_both_ends_beside_nulls(spark):
    a, b, c = _texts(3)
    rows = [(TOP, a), (None, a), (BOTTOM, b), (None, b), (None, c), (None, c), (TOP - 1, "other text of its own"), (None, "alone")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((repr(r["doc_id"]), repr(r["component_id"]), r["kept"], r["n_shingles"]) for r in found)
    want = [(TOP, TOP, True, 37), (None, TOP, False, 37), (BOTTOM, BOTTOM, True, 37), (None, BOTTOM, False, 37), (None, None, True, 37), (None, None, False, 37), (TOP - 1, TOP - 1, True, 1), (None, None, True, 1)]
    assert got == sorted((repr(d), repr(x), k, n) for d, x, k, n in want)


@pytest.mark.parametrize("repeated", [False, True])
def test_keep_rows_at_both_ends(spark, repeated):
    a, b, c = _texts(3)
    rows = [(TOP, a, "x", "s"), (0, a, "x", "s"), (BOTTOM, b, "y", None), (5, c, None, "s")] + [(None, b, "z", "s"), (TOP, c, "w", "s"), (None, "alone", "v", "s")] * repeated
    kept = near_dedup.keep_rows(_owned(spark, rows))
    assert sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("0", a), (repr(BOTTOM), b), ("5", c)] + [("None", "alone")] * repeated)
    assert all(r[k] == v for r in kept.collect() for k, v in OWN.items())


def test_hot_ids_are_dealt_over_shards(spark, tmp_path):
    rows = [(None, f"text {i}") for i in range(200)] + [(7, f"text {i}") for i in range(200)] + [(8, "same")] * 200 + [(i, "x") for i in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one shard
    token_binary.write_token_files(docs, str(tmp_path / "t"), queries.vocabulary("byte_bpe_50k.json"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = token_binary.read_token_files(spark, str(tmp_path / "t"))
    shards = [r["count"] for r in files.groupBy("shard").count().collect()]
    assert len(shards) > 2 and max(shards) < 0.6 * len(rows)
    found = token_binary.token_digests(spark, str(tmp_path / "t")).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i) and len(ids) == len(rows)
    assert [r["start"] for r in found] == [sum(x["n_tokens"] for x in found[:k]) for k in range(len(found))]


NOTICE = "Released under the MIT License. SPDX-License-Identifier: Apache-2.0 and this too\n"


def _scan(spark, copies):
    began = time.time()
    found = licenses.scan(spark.createDataFrame([(1, NOTICE * copies)], "doc_id long, text string")).collect()
    return time.time() - began, found


def test_time_in_proportion_to_a_text_full_of_notices(spark):
    _scan(spark, 10)
    few, one = _scan(spark, 2_500)
    many, other = _scan(spark, 10_000)
    assert many < 8 * few and one[0]["licenses"] == other[0]["licenses"] != ""


@pytest.mark.parametrize("copies", [1, 7, 60])
def test_texts_full_of_notices_in_sql(spark, copies):
    rows = [(1, NOTICE * copies), (2, ("word " * 300 + NOTICE) * copies), (3, "".join(NOTICE[k % 40 :] for k in range(copies)))]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    df = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    names = sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, con.sql(f"select {', '.join(names)} from ({licenses.scan_sql()})").fetchall()))


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<title>T<p>a</p>b", ["a", "b"]), ("a <style>x{} y", ["a x{} y"]), ("<noscript>n<div>d</div> e <img src=q> t", ["d", "e", "q", "t"]),
        ("<script>var a='<p>'; </script>ok<script>x", ["okx"]), ("<template>a<template>b</template>c<p>d", ["d"]), ("<template>a<template>b</template>c</template>d", ["d"]),
        ("<title>x</title><p>y", ["y"]), ("<script>x<p>y</script><style>q<script>z", ["qz"]), ("<title>a<style>b<p>c", ["c"]), ("<title>a<title>b</title>c", ["c"]), ("<style>a<title>b", ["ab"]), ("a<noscript>b<img src=q>c<template>d<p>e", ["a", "q", "c", "e"]), ("<TITLE >T<P>a</p>k", ["a", "k"]), ("</title>a</style>", ["a"]), ("<titles>a</titles>", ["a"]),
    ],
)
def test_unclosed_tags_hide_nothing_but_their_own(html, texts):
    assert [x["text"] or x["digest"] for x in media.parse(html)] == texts
