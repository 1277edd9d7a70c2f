import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import entity, ranked


def _plain(docs, queries, k):
    """BM25 of every document, one after another."""
    words = {i: Counter(w for w in t.lower().split()) for i, t in docs}
    n, mean = len(words), sum(sum(c.values()) for c in words.values()) / len(words)
    df = Counter(w for c in words.values() for w in c)
    out = set()
    for q, text in queries:
        scores = Counter()
        for w in set(text.lower().split()):
            for i, c in words.items():
                if c[w]:
                    share = c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
                    scores[i] += round(1000 * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * share)
        out |= {(q, r, i, s) for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k], 1)}
    return out


@pytest.mark.parametrize("first", [1, 50, 10**6])
def test_early_stop_loses_nothing(spark, tmp_path, first):
    r = random.Random(5)
    vocabulary = [f"w{int(r.paretovariate(0.7)) % 300}" for _ in range(3000)]
    docs = [(i, " ".join(["all", *(r.choice(vocabulary) for _ in range(r.randrange(1, 60)))])) for i in range(300)]
    queries = [(1, "w1 w2"), (2, "w77 w77 w5 w120"), (3, "all"), (4, docs[7][1]), (5, "nothing like it"), (6, ""), (7, "w3 all w250")]
    index = ranked.Index.build(spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path / "i"))
    found = index.search(spark.createDataFrame(queries, "query_id long, text string"), 10, first)
    assert {tuple(x) for x in found.collect()} == _plain(docs, queries, 10)


def test_odd_documents_and_fusion(spark, tmp_path):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "a a"), (4, "a b"), (4, "c"), (5, "b " * 500)]
    index = ranked.Index.build(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "i"))
    found = index.search(spark.createDataFrame([(1, "A"), (2, None), (3, "b c zz")], "query_id long, text string"), 2)
    assert [(r["query_id"], r["rank"], r["doc_id"]) for r in found.orderBy("query_id", "rank").collect()] == [(1, 1, 3), (1, 2, 4), (3, 1, 4), (3, 2, 5)]
    none = ranked.Index.build(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "j"))
    assert none.search(spark.createDataFrame([(1, "a")], "query_id long, text string")).collect() == []
    lists = [spark.createDataFrame(x, "query_id long, rank int, doc_id long") for x in ([(1, 1, 10), (1, 2, 11), (1, 101, 12)], [(1, 1, 11), (1, 3, 10)])]
    both = ranked.fused([(lists[0], 1.0), (lists[1], 2.0)]).collect()
    assert [(r["doc_id"], r["rank"]) for r in both] == [(11, 1), (10, 2)]
    assert abs(both[0]["score"] - (1 / 62 + 2 / 61)) < 1e-15


def test_a_split_bootstrap_is_like_the_whole_one(spark):
    rows = spark.range(4000).select(F.lit("g").alias("g"), F.col("id").alias("cluster"), (F.sin(F.col("id") * 1.7) * 0.1 + 0.002).alias("d")).unionByName(spark.range(5).select(F.lit(None).cast("string").alias("g"), F.col("id").alias("cluster"), F.lit(-1.0).alias("d")))
    exact, = entity.bootstrap(rows.where("g = 'g'"), "g", 400).collect()
    split = [{r["g"]: tuple(r)[1:] for r in entity.bootstrap(rows.repartition(n), "g", 400, block=170).collect()} for n in (1, 7)]
    assert split[0] == split[1] and split[0][None] == (-1.0, -1.0, -1.0, True)
    mean, low, high, reject = split[0]["g"]
    assert abs(mean - exact["mean"]) < 1e-12 and reject == exact["reject"]
    width = exact["upper"] - exact["lower"]
    assert abs(low - exact["lower"]) < 0.15 * width and abs(high - exact["upper"]) < 0.15 * width


def test_draws_dealt_over_blocks():
    import numpy as np

    sizes = [10, 10, 10, 3]
    dealt = np.array([entity._dealt(np.full(2000, 33), 7, k, sizes) for k in range(4)])
    assert (dealt.sum(0) == 33).all() and abs(dealt[3].mean() - 3) < 0.2 and abs(dealt[0].var() - 33 * (10 / 33) * (23 / 33)) < 0.8


def test_a_band_of_all_rows_is_not_one_task(spark):
    rows = spark.range(1000).select(F.lit("b").alias("band"), (F.col("id") * 7 % 1000).alias("pos"), F.lit(1).alias("rank"))
    picked = entity.clerical_sample(rows.unionByName(rows.limit(3).withColumn("band", F.lit("c"))), "band", "pos", 30)
    own = sorted(r["pos"] for r in picked.where("band = 'b'").collect())
    assert own == [int(i * (1000 / 30)) for i in range(30)] and picked.columns == ["band", "pos", "rank", "n_available", "k"]
    assert picked.where("band = 'c'").count() == 3
    assert "Window" not in entity.clerical_sample(rows, "band", "pos")._jdf.queryExecution().executedPlan().toString().replace("Window [sum", "")


@pytest.mark.parametrize("held", [10**6, 0])
def test_relation_to_a_target_over_merges(spark, held):
    from tessera.operators.state import target_relation

    r = random.Random(11)
    parents = {k: {r.randrange(max(0, k - 4), k) for _ in range(r.choice([1, 1, 1, 2, 3]))} if k % 13 else set() for k in range(40)}
    commits = spark.createDataFrame([(f"c{k}", f"c{p}" if p is not None else None) for k, own in parents.items() for p in own or [None]], "id string, parent string")
    for built, target in ((1, 12), (12, 1), (14, 25), (13, 25), (27, 38), (30, 39), (5, 5), (20, 21)):
        above, todo = {target}, [target]
        while todo:
            new = parents[todo.pop()] - above
            above |= new
            todo += new
        wanted = "current" if built == target else "behind" if built in above else "unknown"
        assert target_relation(commits, f"c{built}", f"c{target}", held) == wanted
    assert target_relation(commits, "c1", "none", held) == "unknown"


def _nearest(rows, queries, k):
    import numpy as np

    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return {q: [int(ids[j]) for j in np.lexsort((ids, -np.round(x @ (np.array(v) / np.linalg.norm(v)), 12)))[:k]] for q, v in queries}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_two_stages_recall_most_neighbours(spark, sf_dir, sf):
    from tessera.plans.queries import QUERIES

    folder = sf_dir.replace("sf0.001", sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    exact = _nearest(rows, [r for r in rows if r[0] % 100 == 0], 10)
    found = {}
    for r in QUERIES["vec_two_stage"](spark, folder).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["chunk_id"])
    assert found.keys() == exact.keys() and all(len(x) == 10 and x[0] == q for q, x in found.items())
    assert sum(len(set(found[q]) & set(exact[q])) for q in exact) >= 0.9 * 10 * len(exact)


def test_near_vectors_are_found_by_the_index_alone(spark, tmp_path, monkeypatch):
    import numpy as np

    from tessera.operators.vectors import BitIndex

    draw = np.random.default_rng(3)
    centres = draw.standard_normal((20, 32))
    rows = [(k, (centres[k % 20] + 0.03 * draw.standard_normal(32)).tolist()) for k in range(400)] + [(1000 + k, centres[3].tolist()) for k in range(30)]
    odd = [(None, [1.0] * 32), (2000, None), (2001, []), (2002, [float("nan")] * 32), (2003, [1.0, 2.0]), (2004, [0.0] * 32)]
    index = BitIndex.build(spark.createDataFrame(rows + odd, "chunk_id long, vec array<double>"), str(tmp_path / "i"))
    queries = [(k, centres[k].tolist()) for k in range(20)]
    asked = spark.createDataFrame(queries + [(None, [1.0] * 32), (50, None), (51, [])], "query_id long, vec array<double>")
    with monkeypatch.context() as m:
        m.setattr(BitIndex, "_scanned", lambda self, rest, k: rest.where("raise_error('scanned') is null").selectExpr("query_id", "cast(null as bigint) chunk_id", "cast(null as double) score"))
        found = {}
        for r in index.search(asked).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append(r["chunk_id"])
    assert found == _nearest(rows, queries, 10) and found[3] == list(range(1000, 1010))
    # those that the index does not reach, and those of other sizes, by every code
    far = index.search(spark.createDataFrame([(7, [1.0, 1.0]), (8, (-centres[5]).tolist())], "query_id long, vec array<double>"), k=3).orderBy("query_id", "rank").collect()
    assert [r["chunk_id"] for r in far if r["query_id"] == 7] == [2003] and len([r for r in far if r["query_id"] == 8]) == 3


def test_many_queries_are_scored_by_blocks_with_the_same_result(spark, tmp_path, monkeypatch):
    from tessera.operators import ranked

    r = random.Random(5)
    words = [f"w{k}" for k in range(30)]
    rows = [(k, " ".join(r.choices(words, range(30, 0, -1), k=r.randrange(0, 12))) + " all") for k in range(120)] + [(500, "alone"), (501, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = ranked.Index.build(docs, f"{tmp_path}/index")
    queries = docs.where("doc_id % 3 = 0").selectExpr("doc_id AS query_id", "text")
    got = lambda k: sorted(map(tuple, index.search(queries, k).collect()))
    wanted = {k: got(k) for k in (3, 200)}
    monkeypatch.setattr(ranked, "READ", 0)
    monkeypatch.setattr(ranked, "BLOCK", 50)
    monkeypatch.setattr(ranked, "GROUP", 15)
    monkeypatch.setattr(ranked.Index, "_ranked", lambda *a: pytest.fail("sums of queries and documents as rows"))
    assert {k: got(k) for k in (3, 200)} == wanted


def _shuffled(spark):
    """Records that the session's stages have written to shuffles so far."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_postings_of_many_queries_are_not_shuffled(spark, tmp_path, monkeypatch):
    r = random.Random(9)
    rows = [(k, " ".join(r.choices([f"w{j}" for j in range(60)], k=40))) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).localCheckpoint()
    for name, x in (("READ", 0), ("BLOCK", 200), ("GROUP", 8)):
        monkeypatch.setattr(ranked, name, x)
    before = _shuffled(spark)
    found = ranked.Index.build(docs, str(tmp_path / "i")).search(docs.where("doc_id % 50 = 0").selectExpr("doc_id AS query_id", "text"), 5).collect()
    assert _shuffled(spark) - before < sum(len(set(t.split())) for _, t in rows) / 4
    assert {tuple(x) for x in found} == _plain(rows, [x for x in rows if x[0] % 50 == 0], 5)


@pytest.mark.parametrize("idf", [1.0, 900.0, 3e6])
@pytest.mark.parametrize("products", [0.01, 4, 10**9])
def test_scores_of_blocks_are_exact(monkeypatch, idf, products):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(ranked, "PRODUCTS", products)
    monkeypatch.setattr(ranked, "SCORES", 200)
    r = random.Random(3)
    rows = [(k, " ".join(r.choices([f"w{j}" for j in range(25)], range(25, 0, -1), k=r.randrange(0, 20)))) for k in r.sample(range(1000), 90)]
    blocks = list(ranked._packed(40, 10**6)(iter([pa.RecordBatch.from_pylist([{"doc_id": k, "words": t} for k, t in rows])])))
    assert [b.column("n")[0].as_py() for b in blocks] == [40, 40, 10]
    asked = [(q, w) for q in range(9) for w in r.sample([f"w{j}" for j in range(25)], q * 2 + 1)]
    group = ranked._Group.of(pa.table({"query_id": [q for q, _ in asked], "term": [w for _, w in asked], "idf": [idf * (1 + int(w[1:])) for _, w in asked]}))

    class Sent:
        value = group

    words = {k: Counter(t.split()) for k, t in rows}
    for k in (3, 80):
        got = {}
        for b in ranked._best(Sent, 9.5, k)(iter(blocks)):
            for x in b.to_pylist():
                got.setdefault(x["query_id"], []).append((-x["score"], x["doc_id"]))
        for q in range(9):
            scores = {}
            for i, c in words.items():
                for w in (w for p, w in asked if p == q and c[w]):
                    share = c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / 9.5))
                    scores[i] = scores.get(i, 0) + int(np.floor(idf * (1 + int(w[1:])) * share + 0.5))
            assert sorted(got[q])[:k] == sorted((-s, i) for i, s in scores.items())[:k]


def test_the_best_of_blocks_are_bound_by_the_cores(spark, tmp_path, monkeypatch):
    r = random.Random(9)
    rows = [(k, " ".join(r.choices([f"w{j}" for j in range(20)], k=12))) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").localCheckpoint()
    asked = docs.where("doc_id % 50 = 0").selectExpr("doc_id AS query_id", "text")
    monkeypatch.setattr(ranked, "READ", 0)
    monkeypatch.setattr(ranked, "BLOCK", 5)
    index = ranked.Index.build(docs, str(tmp_path / "i"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # a task a block
    try:
        before = _shuffled(spark)
        found = index.search(asked, 5).collect()
        assert _shuffled(spark) - before < 120 * 12 * 5 / 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {tuple(x) for x in found} == _plain(rows, [x for x in rows if x[0] % 50 == 0], 5)
