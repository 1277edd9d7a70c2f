import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import checks, entity, paging, state, symbols, vectors
from tessera.sources import catalogs, scratch, snapshots
from tessera.streaming import windows


def test_bootstrap_is_that_of_one_draw(spark):
    d = np.random.default_rng(3).normal(size=37)
    rows = spark.createDataFrame([("g", k, float(x)) for k, x in enumerate(d)] + [("h", 1, -1.0)], "grp string, cluster long, d double")
    got = {r["grp"]: r for r in entity.bootstrap(rows, "grp", resamples=200, seed=5).collect()}
    means = d[np.random.default_rng(5).integers(0, 37, size=(200, 37))].mean(axis=1)
    assert np.allclose([got["g"]["lower"], got["g"]["upper"]], np.percentile(means, [2.5, 97.5])) and got["h"]["reject"]


def test_wilson_gate(spark):
    rows = spark.range(380).selectExpr("'a' g", "1.0D correct").unionByName(spark.range(381).selectExpr("'b' g", "1.0D correct"))
    assert {r["g"]: r["auto_merge"] for r in entity.auto_merge(rows, "g").collect()} == {"a": False, "b": True}


def test_large_blocks_are_passed_over(spark):
    keyed = spark.range(501).selectExpr("'big' key", "id i").unionByName(spark.range(3).selectExpr("'small' key", "id i"))
    assert {tuple(r) for r in entity.block_pairs(keyed).collect()} == {(0, 1), (0, 2), (1, 2)}


def test_empty_names_make_a_block_but_no_preview(spark):
    norms = entity.normalized(spark.createDataFrame([(0, "!"), (1, "?"), (2, "ab")], "i long, name string"))
    assert (0, 1) in {tuple(r) for r in entity.token_pairs(norms).collect()}
    assert {r["measure"]: r["comparisons"] for r in entity.preview(norms).collect()}["token_sort"] == 0


def test_a_single_large_hit_is_a_page(spark):
    hits = spark.createDataFrame([(1.0, "x" * 9000, "k"), (0.5, "y", None)], "score double, node_id string, kind string")
    assert [r["position"] for r in paging.page(hits).collect()] == [1]
    assert paging.kind_mix(hits).first()["mix"] == "kx1, unknownx1"


def test_ratchet_status(spark):
    w = spark.createDataFrame([("a",)] * 11, "class string")
    b = spark.createDataFrame([("a", 10)], "class string, n long")
    assert checks.ratchet(w, b).first()["verdict"] == "within"  # 11 is 10 % over
    assert checks.ratchet_status(checks.ratchet(w.unionByName(w.limit(1)), b), True) == "FAIL"
    assert checks.ratchet_status(checks.ratchet(w.limit(0), b), True) == "PASS_WITH_WARNINGS"
    assert checks.ratchet_status(checks.ratchet(w.limit(0), None), False) == "PASS"


def test_tables_in_markdown(spark):
    lines = spark.createDataFrame(list(enumerate(["| a | b |", "|---|:-:|", "| c | d |", "text", "| only |"])), "ord int, value string")
    assert [r["cells"] for r in checks.table_rows(lines, 2).orderBy("ord").collect()] == [["a", "b"], ["c", "d"]]


def test_targets_of_relationships_make_no_node(spark):
    occ = spark.createDataFrame([(0, "p", "local 1", "def"), (1, "p", "s", "def"), (2, "q", "s", "ref")], "ord int, path string, symbol string, role string")
    rel = spark.createDataFrame([("s", "t", "implements")], "owner string, target string, kind string")
    kinds = spark.createDataFrame([], "ord int, symbol string, kind string")
    assert {r["id"] for r in symbols.symbol_nodes(occ, kinds, rel).collect()} == {"s"}
    assert {tuple(r) for r in symbols.symbol_links(occ, rel).collect()} == {("s", "t", "implements")}  # q has no anchor


def test_nearest(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("concat('v', vec_id) chunk_id", "embedding vec")
    first = v.where("chunk_id = 'v3'").first()["vec"]
    best = vectors.nearest(vectors.twins(v), first, k=3).collect()
    assert best[0]["chunk_id"] == "v3" and best[0]["score"] == pytest.approx(1.0)


def test_nearest_are_those_of_brute_force(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(1500, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = vectors.twins(spark.createDataFrame([(f"v{k}", row.tolist()) for k, row in enumerate(x)], "chunk_id string, vec array<float>"))
    for q in (0, 7):
        best = [r["chunk_id"] for r in vectors.nearest(v, x[q].tolist()).collect()]
        assert best == [f"v{k}" for k in np.argsort(-(x.astype(float) @ x[q].astype(float)))[:10]]


def test_aliases_are_followed_to_the_end(spark):
    chain = [(k, f"a{k}", f"a{k + 1}") for k in range(150)] + [(1000, "x0", "x1"), (1001, "x1", "x2"), (1002, "x2", "x1"), (1003, "y", "nowhere"), (1004, "a150", "y"), (1005, "z", "z"), (1, "a7", "nowhere"), (1006, "a7", "a8"), (1007, "q", None)]
    aliases = spark.createDataFrame(chain, "alias_id long, old_curie string, new_curie string")
    known = spark.createDataFrame([(5, "a150"), (6, "w")], "id long, curie string")
    wanted = [("a0", 5), ("a0", 5), ("a85", 5), ("a86", 5), ("a149", 5), ("a150", 5), ("w", 6), ("x0", None), ("x2", None), ("y", None), ("z", None), ("q", None), ("none", None), (None, None)]
    got = state.resolve_aliases(spark.createDataFrame([(c,) for c, _ in wanted], "curie string"), known, aliases).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))
    assert {r["id"] for r in state.resolve_aliases(known.select("curie"), known, aliases.limit(0)).collect()} == {5, 6}


def test_commits_far_behind_their_target(spark):
    line = [(f"c{k}", f"c{k - 1}" if k else None) for k in range(150)]
    side = [("s0", "c20"), ("s1", "s0"), ("c100", "s1"), ("lost", None), ("l1", "l2"), ("l2", "l1"), ("c120", "l1")]
    commits = spark.createDataFrame(line + side, "id string, parent string")
    wanted = {("c0", "c149"): "behind", ("c84", "c149"): "behind", ("s0", "c149"): "behind", ("s0", "c99"): "unknown", ("c149", "c0"): "unknown", ("lost", "c149"): "unknown", ("c3", "l1"): "unknown", ("l2", "c149"): "behind", ("c100", "c149"): "behind", ("c5", "gone"): "unknown", ("gone", "gone"): "current"}
    assert {case: state.target_relation(commits, *case) for case in wanted} == wanted


def test_a_long_history_of_merges_is_contracted_and_not_walked(spark, monkeypatch):
    n = 200
    rows = [(f"o{k}", f"o{k - d}") for k in range(n) for d in ((1, 3) if k % 5 == 0 else (1,)) if k >= d] + [(f"s{k}", f"o{k}") for k in range(n)]
    commits = spark.createDataFrame(rows, "id string, parent string")
    monkeypatch.setattr(state, "scratch", lambda *a: pytest.fail("a walk from merge to merge"))
    cases = [("o0", "o199"), ("o199", "o0"), ("o199", "s199"), ("s0", "o199"), ("o0", "s0"), ("o7", "o7")]
    assert state.target_relations(commits, cases, 20) == ["behind", "unknown", "behind", "unknown", "behind", "current"]
    assert state.target_relation(commits, "o3", "o150", 20) == "behind"


def _graph(spark, n=3):
    nodes = spark.createDataFrame([(k, f"n{k}") for k in range(n)], "ord long, id string")
    return nodes, spark.createDataFrame([(0, "n0", "n1")], "ord long, source string, target string")


def test_snapshots(spark):
    path = scratch.scratch(spark, "snap")
    first = snapshots.write(spark, path, *_graph(spark))
    second = snapshots.write(spark, path, *_graph(spark, 4))
    assert snapshots.pointed(spark, path) == second != first and snapshots.verify(spark, path, first) and snapshots.verify(spark, path, second)
    assert snapshots.open_latest(spark, path).sql("select count(*) from nodes").first()[0] == 4
    with pytest.raises(ValueError):
        snapshots.promote(spark, path, first, "", "PASS")
    with pytest.raises(ValueError):
        snapshots.promote(spark, path, first, "me", "BLOCKED")
    snapshots.promote(spark, path, first, "me", "PASS")
    assert snapshots.open_latest(spark, path, "current").sql("select count(*) from nodes").first()[0] == 3


def test_digests_do_not_depend_on_order(spark):
    nodes = _graph(spark, 50)[0]
    assert snapshots.content_digest(nodes) == snapshots.content_digest(nodes.orderBy(F.desc("ord")).repartition(5))
    assert snapshots.content_digest(nodes) != snapshots.content_digest(nodes.unionByName(nodes.limit(1)))


def test_archives(spark, tmp_path):
    docs = {"enriched/graph.json": b'{"nodes": []}', "a.json": b"{}"}
    digest, raw = catalogs.pack(docs)
    assert (digest, raw) == catalogs.pack(dict(reversed(docs.items())))
    (tmp_path / "x.tar.gz").write_bytes(raw)
    found = catalogs.members(spark, f"file://{tmp_path}/x.tar.gz")
    assert {r["name"]: bytes(r["content"]) for r in found.collect()} == docs
    listed = spark.createDataFrame([("a.json", hashlib.sha256(b"{}").hexdigest()), ("enriched/graph.json", "0"), ("gone", "1")], "name string, sha256 string")
    assert {tuple(r) for r in catalogs.member_faults(found, listed).collect()} == {("enriched/graph.json", "other_content"), ("gone", "missing")}


def _catalog(tmp_path, entries, empty=(), version="v2"):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps({"schema": f"x-catalog/{version}", "status": "complete", "archives": entries, "empty_repositories": [{"repository": e} for e in empty]}))
    return f"file://{path}"


def _entry(name, part=None, repository="o/r"):
    return {"source": {"repository": repository, "head": "a" * 40, **({"slice": part} if part else {})}, "archive": f"{name}.tar.gz", "sha256": "b" * 64, "bytes": 5}


def test_catalogs(spark, tmp_path):
    entries, empty = catalogs.load_catalog(spark, _catalog(tmp_path, [_entry("x", "s1"), _entry("y", "s2")], ["o/e"]))
    assert entries.count() == 2 and empty.count() == 1
    assert catalogs.select_one(entries, "o/r", "s1").first()["archive"] == "x.tar.gz"
    with pytest.raises(ValueError):
        catalogs.select_one(entries, "o/r")
    for bad in ([_entry("x"), _entry("y")], [_entry("x"), _entry("x", "s")], [_entry("x"), _entry("y", "s")], [{**_entry("x"), "bytes": True}], [_entry("x", repository="o/e")]):
        with pytest.raises(ValueError):
            catalogs.load_catalog(spark, _catalog(tmp_path, bad, ["o/e"]))
    with pytest.raises(ValueError):
        catalogs.load_catalog(spark, _catalog(tmp_path, [_entry("x", "s")], version="v1"))
    version, merged = catalogs.merge_catalogs(entries)
    assert version == "v2" and [r["slice"] for r in merged.collect()] == ["s1", "s2"]


def test_strict_json():
    for bad in (b'{"a": 1, "a": 2}', b"[NaN]", b"[" * 60 + b"]" * 60):
        with pytest.raises(ValueError):
            catalogs.strict_json(bad)


def test_graph_documents(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"nodes": [{"id": "a", "x": [1]}, {"id": "b", "label": "B"}], "links": [{"source": "a", "target": "b", "key": 1}], "hyperedges": [{"nodes": ["a", "b"]}]}))
    nodes, links, hyper = catalogs.graph_tables(spark, f"file://{tmp_path}/g.json")
    assert [(r["ord"], r["id"], r["label"]) for r in nodes.orderBy("ord").collect()] == [(0, "a", None), (1, "b", "B")]
    assert links.first()["target"] == "b" and hyper.first()["nodes"] == ["a", "b"]


def test_rule_files_and_folders(spark, tmp_path):
    from tessera.operators import admission

    (tmp_path / "rules").write_text("# note\ninclude *.py\n\n exclude a/* \nother x\n")
    rules = admission.parse_rules(catalogs.text_lines(spark, f"file://{tmp_path}/rules")).orderBy("ord").collect()
    assert [(r["verb"], r["glob"]) for r in rules] == [("include", "*.py"), ("exclude", "a/*")]
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "e" / "f.txt").write_bytes(b"hi")
    row = catalogs.files(spark, f"file://{tmp_path}/d").first()
    assert row["path"].endswith("e/f.txt") and row["bytes"] == 2
    (tmp_path / "t.tsv").write_text("#c\na\tb\n")
    assert [tuple(r) for r in catalogs.manifest_rows(spark, f"file://{tmp_path}/t.tsv", ["x", "y"]).collect()] == [("a", "b")]


def test_fragment_cache_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.py").write_text("def f(): pass\n")
    args = (spark, f"file://{tmp_path}/in", f"file://{tmp_path}/cache", f"file://{tmp_path}/state")
    windows.fill_cache(*args).awaitTermination()
    (tmp_path / "in" / "b.py").write_text("class C: pass\n")
    windows.fill_cache(*args).awaitTermination()
    got = spark.read.parquet(f"file://{tmp_path}/cache")
    assert got.count() == 2 and got.select("key_sha256").distinct().count() == 2


def test_sessions(spark):
    rows = spark.sql("select timestamp(t) ts, 1L user_id from values ('2024-01-01 00:00:00'), ('2024-01-01 00:10:00'), ('2024-01-01 02:00:00') as v(t)")
    assert sorted(r["n"] for r in windows.sessions(rows).collect()) == [1, 2]


def test_symbol_index(spark, tmp_path):
    from tessera.sources import symbol_index

    index = {
        "documents": [
            {"relative_path": "./a.py", "symbols": [{"symbol": "A", "kind": "Class", "relationships": [{"symbol": "Z", "roles": [1, "TypeDefinition"]}]}], "occurrences": [{"symbol": "A", "symbol_roles": 3}, {"symbol": "local 1", "symbol_roles": 1}]},
            {"relative_path": "b.py", "occurrences": [{"symbol": "B", "symbol_roles": ["Definition"]}, {"symbol": "A", "symbol_roles": 0}, {"symbol": "E"}]},
            {"occurrences": [{"symbol": "lost", "symbol_roles": 1}]},
        ],
        "external_symbols": [{"symbol": "E", "kind": "UnspecifiedKind"}, {"symbol": "F", "kind": "Function"}],
    }
    (tmp_path / "index.json").write_text(json.dumps(index))
    occ, rel, kinds = symbol_index.read(spark, f"file://{tmp_path}/index.json")
    assert {tuple(r)[1:] for r in occ.collect()} == {("a.py", "A", "def"), ("a.py", "local 1", "def"), ("b.py", "B", "def"), ("b.py", "A", "ref"), ("b.py", "E", "ref")}
    assert {tuple(r) for r in rel.collect()} == {("A", "Z", "implements"), ("A", "Z", "type-def")}
    assert {tuple(r) for r in symbols.symbol_links(occ, rel).collect()} == {("A", "Z", "implements"), ("A", "Z", "type-def"), ("B", "A", "ref"), ("B", "E", "ref")}
    assert {(r["id"], r["kind"], r["source_file"]) for r in symbols.symbol_nodes(occ, kinds, rel).collect()} == {("A", "class", "a.py"), ("B", "symbol", "b.py"), ("E", "symbol", None), ("F", "function", None)}


def test_tracked_files(spark):
    from tessera.operators import build

    files = spark.createDataFrame([("a",), ("b",)], "path string")
    assert build.tracked_only(files, None).count() == 2
    assert build.tracked_only(files, files.where("path = 'a'")).count() == 1
    nodes = spark.createDataFrame([("x", "A/Secret.py"), ("y", None)], "id string, source_file string")
    assert [r["id"] for r in build.forbidden_sources(nodes, ("secret",)).collect()] == ["x"]


def test_archives_are_what_the_catalogue_says(spark, tmp_path):
    digest, raw = catalogs.pack({"a.json": b"{}"})
    for name in ("x", "y", "z"):
        (tmp_path / f"{name}.tar.gz").write_bytes(raw)
    entries = spark.createDataFrame([("x.tar.gz", digest, len(raw)), ("y.tar.gz", "0", len(raw)), ("z.tar.gz", digest, 1), ("w.tar.gz", digest, 1)], "archive string, sha256 string, bytes long")
    assert {tuple(r) for r in catalogs.verified_archives(spark, entries, f"file://{tmp_path}").collect()} == {("y.tar.gz", "other_content"), ("z.tar.gz", "other_size"), ("w.tar.gz", "missing")}
