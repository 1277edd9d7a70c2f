import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import licenses, media, mixing, quality, queries
from tests.llm import cases

NATIVE = (queries.op5_mixing, queries.op6_quality_rules, queries.op7_license_scan)


def _same(df, sql, con):
    names = sorted(df.columns)
    found = sorted(map(repr, map(tuple, df.select(*names).collect())))
    wanted = sorted(map(repr, con.sql(f"select {', '.join(names)} from ({sql})").fetchall()))
    assert found == wanted


@pytest.mark.parametrize("query", NATIVE, ids=lambda q: q.__name__)
def test_queries_are_their_sql(spark, sf_dir, duck, query):
    _same(query(spark, sf_dir), queries.ORACLE_SQL[query.__name__], duck)


@pytest.mark.parametrize("query", NATIVE, ids=lambda q: q.__name__)
def test_no_python_on_the_main_path(spark, sf_dir, query):
    plan = query(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.fixture
def odd():
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", cases.ROWS)
    return con


def test_odd_documents_in_sql(spark, odd):
    docs = cases.docs(spark)
    _same(mixing.mix(docs), mixing.MIX_SQL, odd)
    _same(quality.quality(docs), quality.QUALITY_SQL, odd)
    _same(licenses.scan(docs), licenses.scan_sql(), odd)


def test_empty_tables(spark):
    none = cases.empty(spark)
    for f in (mixing.mix, mixing.mixed_rows, quality.quality, licenses.scan, media.media_of_documents):
        assert f(none).collect() == []


def test_mix_comes_near_its_targets(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 13)), None, "abc"[k % 10 // 4]) for k in range(3000)]
    found = mixing.mix(cases.docs(spark, rows)).collect()
    for source in "abc":
        own = [r for r in found if rows[r["doc_id"]][3] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 13
        assert all(r["taken"] <= 3 * r["size"] and r["taken"] % r["size"] == 0 for r in own)
        assert own[0]["target"] <= 3 * own[0]["source_size"]
    assert abs(sum({r["source_size"]: r["target"] for r in found}.values()) - sum(r["size"] for r in found)) < 1e-6
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(cases.docs(spark, rows).repartition(7)).collect()))


def test_mixed_rows_are_whole_rows(spark):
    docs = cases.docs(spark)
    times = {(r["doc_id"], r["size"]): r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["size"]}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got.get(9, 0) == times[9, 30_001] and got.get(7, 0) == 2 * times[7, 1]


def test_lines_that_many_documents_share_go(spark):
    shared = "Subscribe to our newsletter for more stories like this one today"
    own = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    rows = [(k, f"{own(k)}\n{shared if k % 2 else shared.upper()}", None, "host") for k in range(40)]
    rows += [(100 + k, "\n".join([shared] * 8), None, "host") for k in range(2)] + [(200, f"{own(200)}\n{shared}", None, "other")]
    found = {r["doc_id"]: r for r in quality.quality(cases.docs(spark, rows)).collect()}
    assert all(found[k]["kept"] and found[k]["removed_words"] == 11 for k in range(40))
    assert not found[100]["kept"] and found[200]["removed_words"] == 0 and found[200]["kept"]


def test_lines_of_a_host_of_over_a_thousand_documents(spark):
    common = lambda k: f"shared by {20 if k < 20 else 15 if k < 35 else 0} documents"
    rows = [(k, f"own words of document {k}\n{common(k)}", None, "hot") for k in range(1700)]
    con = duckdb.connect()
    con.execute("create table documents as select i as doc_id, 'own words of document ' || i || chr(10) || 'shared by ' || case when i < 20 then 20 when i < 35 then 15 else 0 end || ' documents' as text, 'hot' as source from range(1700) t(i)")
    docs = cases.docs(spark, rows)
    _same(quality.quality(docs), quality.QUALITY_SQL, con)
    found = {r["doc_id"]: r["removed_words"] for r in quality.quality(docs).collect()}
    assert (found[0], found[20], found[35]) == (4, 4, 4)  # a limit of 10, whatever the host's size


def test_repeated_windows(spark):
    texts = {1: "a b c a b c", 2: "a a a a", 3: "a b c d a b c d a", 4: "x y z", 5: "a b c x a b c y", 6: ""}
    rows = spark.createDataFrame(list(texts.items()), "k int, text string").select("k", quality.repeat_words(quality.words_of(F.col("text"))).alias("n")).collect()
    assert {r["k"]: r["n"] for r in rows} == {1: 6, 2: 4, 3: 9, 4: 0, 5: 6, 6: 0}


def test_licence_texts_are_found(spark):
    mit = dict(licenses.TEMPLATES[k] for k in (3,))["MIT"]
    near = mit.replace("Software", "Program", 2)
    rows = [(1, "Hello there my dear old friend\nReleased under the MIT License.\nbye", None, None), (2, mit, None, None), (3, near.replace(". ", ".\n"), None, None), (4, "nothing of the sort here", None, None), (5, "licensed under the apache license version 2 0", None, None)]
    found = {r["doc_id"]: (r["license"], r["n_licenses"]) for r in licenses.scan(cases.docs(spark, rows)).collect()}
    assert found[1] == found[2] == found[3] == ("MIT", 1) and found[4] == (None, 0) and found[5] == ("Apache-2.0", 1)


def _table(rows):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    return con


def test_notices_inside_documents_are_found(spark):
    import textwrap

    texts = {name: text for name, text in licenses.NOTICES if len(text.split()) > 30}
    around = lambda t: "def f(x):\n    return x + 1\n" * 30 + "\n".join(f" * {x}" for x in textwrap.wrap(t, 60)) + "\n" + "and then the story goes on with other words\n" * 30
    rows = [(k, around(t), None, None) for k, t in enumerate(texts.values())]
    rows += [(100, "Here: Released under the MIT License. More words follow in this very line.\nLicensed under CC BY-NC 4.0. So be it, dear reader, for now.", None, None)]
    rows += [(101, "SPDX-License-Identifier: Zlib and so on\nnothing", None, None), (102, None, None, None), (103, "", None, None), (None, "x", None, None), (104, "SPDX-License-Identifier: Apache-2.0", None, None)]
    rows += [(105, around(texts["MIT"]) + around(texts["BSD-3-Clause"]).replace("other words", "more"), None, None), (106, "word " * 400 + texts["Apache-2.0"].replace("License", "Licence", 3), None, None)]
    docs = cases.docs(spark, rows)
    found = {r["doc_id"]: r["licenses"].split(",") if r["licenses"] else [] for r in licenses.scan(docs).collect()}
    assert [found[k] for k in range(len(texts))] == [[name] for name in texts]
    assert set(found[100]) == {"MIT", "CC-BY-NC-4.0"} and found[104] == ["Apache-2.0"]
    assert set(found[105]) == {"MIT", "BSD-3-Clause"} and found[106] == ["Apache-2.0"]
    assert all(found[k] == [] for k in (101, 102, 103, None))
    _same(licenses.scan(docs), licenses.scan_sql(), _table(rows))
    none = licenses.LicenseScan(templates=())
    assert {r["licenses"] for r in licenses.scan(docs, none).collect()} == {""}
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_media_round_trip(spark):
    import hashlib
    import zlib

    found = sorted(media.media_of_documents(cases.docs(spark)).collect(), key=repr)
    assert len(found) == len(cases.ROWS)
    wanted = []
    for doc_id, text, *_ in cases.ROWS:
        raw = (text or "").encode()
        padded = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        stored = f"P5\n192 {len(padded) // 192}\n255\n".encode() + padded
        wanted.append((doc_id, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), media.feature(media.samples_of(stored))))
    assert sorted(repr(tuple(r)[:8]) for r in found) == sorted(map(repr, wanted))
    assert all(r["caption"] == f"The bytes of the text, {r['n_bytes']} of them" and r["position"] == 1 for r in found)


def test_pages_keep_order_positions_and_captions(spark):
    html = "<title>t</title><p>One <b>two</b></p><script>x()</script><figure><img src='sha256:ab' alt='alt'><figcaption>Cap &amp; more</figcaption></figure>three<br>four<img src=\"sha256:cd\" alt=five><p>"
    items = media.parse(html)
    assert [(i["position"], i["kind"], i["text"] or i["digest"], i["caption"]) for i in items] == [(0, "text", "One two", None), (1, "media", "ab", "Cap & more"), (2, "text", "three", None), (3, "text", "four", None), (4, "media", "cd", "five")]
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (1, html)], "page_id long, html string")
    stored = spark.createDataFrame([("ab", 5)], "digest string, media_bytes long")
    rows = media.resolve(media.sequences(pages), stored).collect()
    assert sorted((r["page_id"], r["position"], r["media_bytes"]) for r in rows if r["kind"] == "media") == [(1, 1, 5), (1, 1, 5), (1, 4, None), (1, 4, None)]
    assert media.parse("<figcaption>lost") == [{"position": 0, "kind": "text", "text": "lost", "digest": None, "caption": None, "n_bytes": None}]
