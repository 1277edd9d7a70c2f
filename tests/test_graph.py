import random
from collections import deque

import pytest

from tessera.operators import graph


@pytest.fixture(scope="module")
def small(spark):
    nodes = spark.createDataFrame([(0, "a", None, "Ambiguous", "f.py"), (1, "b", "t", "Ambiguous", None), (2, "c", "t", None, None)], "ord bigint, id string, type string, label string, source_file string")
    links = spark.createDataFrame([(0, "a", "b", "calls"), (1, "a", "b", "documents"), (2, "b", "c", None)], "ord bigint, source string, target string, kind string")
    return nodes, links


def test_search(small):
    assert [r["id"] for r in graph.search(small[0], "AMBIG").collect()] == ["a", "b"]
    assert [r["id"] for r in graph.search(small[0], "none").collect()] == ["a", "b", "c"]  # null attributes read None
    assert [r["id"] for r in graph.search(small[0], "ambig", limit=1).collect()] == ["a"]
    assert graph.search(small[0], "ß").collect() == []


def test_neighbors(small):
    rows = graph.neighbors(*small, "b", "in").orderBy("position").collect()
    assert [(r["node_id"], r["link_kind"], r["depth"]) for r in rows] == [("a", "calls", 1), ("a", "documents", 1)]
    rows = graph.neighbors(*small, "a", "both", depth=2).orderBy("position").collect()
    assert [(r["node_id"], r["link_ord"], r["depth"]) for r in rows] == [("b", 0, 1), ("b", 1, 1), ("a", 0, 2), ("a", 1, 2), ("c", 2, 2)]
    assert graph.neighbors(*small, "a", limit=1).count() == 1
    with pytest.raises(ValueError):
        graph.neighbors(*small, "zz")


def test_folded_search(spark):
    labels = ["Hauptstraße", "HAUPTSTRASSE", "STRA\u1e9eE", "ﬁle", "oﬃce", "\u212Aelvin", "ſum", "x"]
    nodes = spark.createDataFrame([(k, f"n{k}", t) for k, t in enumerate(labels)], "ord bigint, id string, label string")
    for text in ("strasse", "straße", "SS", "file", "ffi", "kelvin", "sum", "X", "ﬁ", "raße"):
        assert [r["label"] for r in graph.search(nodes, text).collect()] == [t for t in labels if text.casefold() in t.casefold()], text


def _neighbors(edges, start, direction, depth, limit, most):
    """(rows, explored, reason) of a queue of nodes."""
    out = {}
    for k, (s, t) in enumerate(edges):
        if direction != "in":
            out.setdefault(s, []).append((t, k))
        if direction != "out":
            out.setdefault(t, []).append((s, k))
    rows, reason, known, queue = [], None, {start}, deque([(start, 0)])
    while queue and not reason:
        node, level = queue.popleft()
        if level == depth:
            continue
        for t, k in out.get(node, []):
            if len(rows) == most:
                reason = "exploration_limit"
                break
            rows.append((level + 1, t, k))
            if t not in known:
                known.add(t)
                queue.append((t, level + 1))
        if len(rows) > limit:
            break
    return rows[:limit], len(rows), reason or ("record_limit" if len(rows) > limit else None)


def test_neighbors_are_those_of_a_queue(spark, tmp_path):
    draw = random.Random(5)
    names = [f"n{k}" for k in range(9)]
    nodes = spark.createDataFrame([(k, n, None, None) for k, n in enumerate(names)], "ord bigint, id string, type string, label string")
    edges = [(draw.choice(names), draw.choice(names)) for _ in range(30)] + [("n0", "n0"), ("n0", "n1"), ("n0", "n1")]
    links = spark.createDataFrame([(k, s, t, "x") for k, (s, t) in enumerate(edges)], "ord bigint, source string, target string, kind string")
    graph.store(links, str(tmp_path / "links"))
    by_node = graph.stored(spark, str(tmp_path / "links"))
    for direction, depth, limit, most in (("both", 2, 50, 1000), ("out", 2, 5, 1000), ("in", 2, 3, 4), ("both", 1, 2, 1000), ("both", 2, 10, 12), ("out", 1, 50, 1)):
        for form in (links, by_node):
            found = graph.explore(nodes, form, "n0", direction, depth, limit, most)
            rows = [(r["depth"], r["node_id"], r["link_ord"]) for r in found.rows.orderBy("position").collect()]
            assert (rows, found.explored, found.truncation) == _neighbors(edges, "n0", direction, depth, limit, most)


def test_a_start_reaches_the_scan(spark, sf_dir):
    from tessera.plans import trade_graph

    links = trade_graph.stored_links(spark, sf_dir)
    assert trade_graph.stored_links(spark, sf_dir).inputFiles() == links.inputFiles()
    plan = graph._ways(links, "out").where("node = 'order:5'")._jdf.queryExecution().toString()
    assert "Window" not in plan and "EqualTo(node,order:5)" in plan


def test_paths(small):
    found = graph.find_path(*small, "a", "c")
    assert (found.status, found.nodes) == ("ok", ["a", "b", "c"])
    hops = graph.path_hops(small[1], found).orderBy("hop", "ord").collect()
    assert [(h["hop"], h["kind"]) for h in hops] == [(1, "calls"), (1, "documents"), (2, None)]
    assert graph.find_path(*small, "c", "a").status == "no_path"
    assert graph.find_path(*small, "a", "c", max_hops=1).status == "no_path_within_hop_limit"
    assert graph.find_path(*small, "a", "c", max_explored=1).status == "exploration_exhausted"
    assert graph.find_path(*small, "a", "a", max_hops=0).nodes == ["a"]
    assert (found.explored, graph.find_path(*small, "a", "c", max_explored=1).truncation) == (3, "exploration_limit")
    with pytest.raises(ValueError):
        graph.find_path(*small, "a", "zz")


def test_check(spark, small):
    nodes, links = small
    graph.check(nodes, links)
    with pytest.raises(ValueError, match="dangling link"):
        graph.check(nodes.where("id <> 'c'"), links)
    with pytest.raises(ValueError, match="repeated id"):
        graph.check(nodes.unionByName(nodes), links)
    hyper = spark.createDataFrame([(0, ["a", "zz"])], "ord int, nodes array<string>")
    with pytest.raises(ValueError, match="dangling hyperedge"):
        graph.check(nodes, links, hyper)


def _walk(edges, start, target, hops):
    """The path that a queue of nodes finds."""
    out = {}
    for s, t in edges:
        out.setdefault(s, []).append(t)
    queue, before = deque([(start, 0)]), {start: None}
    while queue:
        node, level = queue.popleft()
        if level == hops:
            continue
        for t in out.get(node, []):
            if t not in before:
                before[t] = node
                queue.append((t, level + 1))
            if t == target:
                way = [t]
                while before[way[-1]] is not None:
                    way.append(before[way[-1]])
                return way[::-1]
    return None


def test_paths_are_those_of_a_queue(spark):
    draw = random.Random(2)
    names = [f"n{k}" for k in range(12)]
    nodes = spark.createDataFrame(list(enumerate(names)), "ord bigint, id string")
    for _ in range(4):
        edges = [(draw.choice(names), draw.choice(names)) for _ in range(26)]
        links = spark.createDataFrame([(k, s, t, "x") for k, (s, t) in enumerate(edges)], "ord bigint, source string, target string, kind string")
        start, target = draw.sample(names, 2)
        found = graph.find_path(nodes, links, start, target, max_hops=4)
        assert (found.nodes or None) == _walk(edges, start, target, 4)


def test_rank_stays_with_its_seeds(spark, small):
    rank = {r["id"]: r["score"] for r in graph.rank_nodes(small[1], ["a"], rounds=3).collect()}
    assert rank["a"] > 0 and rank["b"] > rank["c"]


def test_walks_of_the_trade_graph_store_nothing_and_find_its_links(spark, sf_dir, monkeypatch):
    from tessera.plans import trade_graph

    links = trade_graph.links(spark, sf_dir).drop("source_file").persist()
    monkeypatch.setattr(trade_graph.scratch, "once", lambda *a: pytest.fail("all links are stored for one walk"))
    sought = trade_graph.sought_links(spark, sf_dir)
    monkeypatch.setattr(trade_graph, "NAMED", 1)
    rows = lambda df: sorted(map(tuple, df.select("ord", "source", "target", "kind").collect()))
    for bound in (100_000, 3):
        monkeypatch.setattr(trade_graph, "BROADCAST", bound)
        for ids in (["part:11"], ["order:5", "order:6", "supplier:2", "customer:1"], ["nation:3", "region:1", "part:3", "part:4", "x", "order:05", None]):
            for side in ("source", "target"):
                assert rows(sought.find(ids, side)) == rows(links.where(links[side].isin([i for i in ids if i])))
    links.unpersist()
    from tessera.plans.queries import QUERIES

    for name in ("graph_neighbors_both_d1", "graph_neighbors_both_d2", "graph_path_hops", "graph_path_status", "graph_neighbors_bounds"):
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_a_node_may_have_more_links_than_a_walk_looks_at_by_default(spark):
    nodes = spark.createDataFrame([(0, "a", "t", "a"), (1, "b", "t", "b")], "ord long, id string, type string, label string")
    links = spark.range(5).selectExpr("id AS ord", "'a' AS source", "'b' AS target", "'k' AS kind")
    found = graph.explore(nodes, links, "a", limit=5, max_explored=5, bound=5)
    assert (found.explored, found.truncation, found.rows.count()) == (5, None, 5)
    with pytest.raises(ValueError, match="1 to 4"):
        graph.explore(nodes, links, "a", max_explored=5, bound=4)
