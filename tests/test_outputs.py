import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import entity, paging, refresh, state
from tessera.sources import catalogs, outputs, snapshots


def test_new_files_stay(spark, tmp_path):
    path = str(tmp_path / "a" / "plan.json")
    outputs.create_only(spark, path, [b"one", b"two"])
    with pytest.raises(Exception, match="exist"):
        outputs.create_only(spark, path, [b"x"])
    assert outputs.read(spark, path) == b"onetwo" and outputs.read(spark, path + "x") is None

    def broken():
        yield b"half"
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        outputs.create_only(spark, path + ".new", broken())
    assert outputs.read(spark, path + ".new") is None
    outputs.replace(spark, path, [b"three"])
    outputs.replace(spark, path, [b"four"])
    assert outputs.read(spark, path) == b"four"


def test_node_link_document_is_read_back(spark, tmp_path):
    nodes = spark.createDataFrame([(1, "b", "t", 'q"u'), (0, "a", "t", None)], "ord long, id string, type string, label string")
    links = spark.createDataFrame([(1, "b", "a", "y"), (0, "a", "b", "x")], "ord long, source string, target string, kind string")
    path = str(tmp_path / "graph.json")
    outputs.write_node_link(nodes, links, path, built_at_commit="c1")
    doc = json.loads((tmp_path / "graph.json").read_bytes())
    assert doc["built_at_commit"] == "c1" and doc["directed"] is True
    assert [n["id"] for n in doc["nodes"]] == ["a", "b"] and [(e["source"], e["target"]) for e in doc["links"]] == [("a", "b"), ("b", "a")]
    read_nodes, read_links, _ = catalogs.graph_tables(spark, path)
    assert {r["id"] for r in read_nodes.collect()} == {"a", "b"} and read_links.count() == 2


def test_validation_documents(spark, tmp_path):
    folder = str(tmp_path)
    outputs.write_validation(spark, folder, "BLOCKED", {"nodes": 2}, ["dangling: x", "dangling: y"], {"w": 1}, "f1", "t1")
    doc = json.loads((tmp_path / "validation.json").read_text())
    assert doc["fatal_classes"] == ["dangling"] and doc["fatal_count"] == 2 and not (tmp_path / "baseline.json").exists()
    for warnings in ({"w": 1}, {"w": 5}):
        outputs.write_validation(spark, folder, "PASS_WITH_WARNINGS", {"nodes": 2}, [], warnings, "f2", "t2")
    assert json.loads((tmp_path / "baseline.json").read_text()) == {"classes": {"w": 1}}
    assert json.loads((tmp_path / "freshness.json").read_text())["source_fingerprint"] == "f2"


def test_ledger(spark, tmp_path):
    ledger = outputs.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.evidence().collect() == []
    ledger.record("r1", "c", "f1", "valid", "t1", "PASS")
    ledger.record("r1", "c", "f2", "stale", "t1", "BLOCKED", ["x"])
    ledger.record("r2", "d", "f3", "valid", "t0")
    assert [tuple(r) for r in ledger.evidence().collect()] == [("r1", "BLOCKED", ["x"])]
    now = spark.createDataFrame([("c", "f2"), ("d", "f9"), ("e", "f1")], "corpus string, source_fingerprint string")
    found = state.classify(ledger.table("freshness"), "corpus", "checked_utc", "row_id", "source_fingerprint", now)
    assert {tuple(r) for r in found.collect()} == {("c", "valid"), ("d", "stale"), ("e", "unknown")}
    for bad in (("r", "c", "f", "old", "t"), ("r", "c", "f", "valid", "t", "FINE")):
        with pytest.raises(ValueError, match="bad"):
            ledger.record(*bad)


def test_ledger_of_identities(spark, tmp_path):
    ledger = outputs.Ledger(spark, str(tmp_path / "ledger"))
    names = lambda *c: spark.createDataFrame([(x,) for x in c], "curie string")
    assert {tuple(r) for r in ledger.intern(names("c:b#x", "c:a#x", "c:a#x")).collect()} == {(1, "c:a#x"), (2, "c:b#x")}
    assert {tuple(r) for r in ledger.intern(names("c:0#x", "c:b#x")).collect()} == {(1, "c:a#x"), (2, "c:b#x"), (3, "c:0#x")}
    renames = lambda *r: spark.createDataFrame(list(r), "old_curie string, new_curie string, reason string")
    ledger.alias(renames(("c:old#x", "c:older#x", "r"), ("c:older#x", "c:gone#x", "r")))
    ledger.alias(renames(("c:older#x", "c:b#x", "newer")))
    assert {tuple(r) for r in ledger.resolve(names("c:old#x", "c:a#x", "c:none#x")).collect()} == {("c:old#x", 2), ("c:a#x", 1), ("c:none#x", None)}
    for bad in (("c:a#x", "c:a#x", "r"), ("a", "c:a#x", "r"), (None, "c:a#x", "r")):
        with pytest.raises(ValueError, match="alias"):
            ledger.alias(renames(bad))
    with pytest.raises(ValueError, match="curie"):
        ledger.intern(names("plain"))


def _docs(head="h1", **changed):
    sha = "0" * 64
    docs = {
        "enriched/graph.json": {"built_at_commit": head, "directed": True, "nodes": [{"id": "a"}, {"id": "b"}], "links": [{"source": "a", "target": "b"}]},
        "enriched/validation.json": {}, "policy.json": {}, "request.json": {},
        "inventory.json": [{"path": "a.py", "sha256": sha, "coverage": "structural"}], "source.json": {"repository": "r", "head": "h1"},
    }
    return {n: json.dumps(d).encode() for n, d in (docs | changed).items()}


def test_pack_and_pull(spark, tmp_path):
    store = str(tmp_path / "store")
    one = catalogs.pack_graph(spark, store, "r", "h1", _docs())
    assert catalogs.pack_graph(spark, store, "r", "h1", _docs()) == one
    with pytest.raises(ValueError, match="another source"):
        catalogs.pack_graph(spark, store, "r", "h1", _docs("h2"))
    with pytest.raises(ValueError, match="sound"):
        catalogs.pack_graph(spark, store, "r", "h1", _docs(**{"enriched/graph.json": {"built_at_commit": "h1", "directed": True, "nodes": [], "links": [{"source": "a", "target": "b"}]}}))
    with pytest.raises(ValueError, match="wanted"):
        catalogs.pack_graph(spark, store, "r", "h1", {})
    entries = spark.createDataFrame([(one["repository"], one["head"], None, one["archive"], one["sha256"], one["bytes"])], "repository string, head string, slice string, archive string, sha256 string, bytes long")
    copy = str(tmp_path / "copy")
    digest = snapshots.pull(entries, ["r"], store, copy)
    assert catalogs.verified_archives(spark, entries, copy).collect() == [] and outputs.read(spark, f"{copy}/upstream").decode() == digest
    with pytest.raises(ValueError, match="already"):
        snapshots.pull(entries, ["r"], store, copy)
    with pytest.raises(ValueError, match="not in the catalogue"):
        snapshots.pull(entries, ["s"], store, copy + "2")
    (tmp_path / "store" / f".{one['archive']}.crc").unlink()
    (tmp_path / "store" / one["archive"]).write_bytes(b"other")
    with pytest.raises(ValueError, match="other content"):
        snapshots.pull(entries, ["r"], store, copy + "2")


def test_unchanged_builds(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, blob_oid string")
    none = spark.createDataFrame([], "path string, reason string")
    ids = {"commit": "c", "runtime": "r"}
    assert refresh.unchanged(ids, dict(ids), files, files, none, none)
    assert not refresh.unchanged(ids, ids | {"commit": "d"}, files, files, none, none)
    assert not refresh.unchanged(ids | {"runtime": None}, ids | {"runtime": None}, files, files, none, none)
    assert not refresh.unchanged(ids, ids, files, files.where("path = 'a'"), none, none)
    assert not refresh.unchanged(ids, ids, files, files, none, spark.createDataFrame([("c", "symlink")], "path string, reason string"))


def test_rejected_reuse_is_tried_once_more(spark):
    files = spark.createDataFrame([("a", "k1"), ("b", "k2")], "path string, key_sha256 string")
    cache = spark.createDataFrame([("a", "k1", "old")], "path string, key_sha256 string, value string")
    extract = lambda f: f.select("path", F.lit("new").alias("value"))
    rows = lambda df: {tuple(r) for r in df.collect()}
    fine = refresh.extract_with_reuse(files, cache, extract, lambda df: True)
    assert rows(fine.fragments) == {("a", "old"), ("b", "new")} and rows(fine.to_store) == {("b", "new")} and fine.attempts == 1
    again = refresh.extract_with_reuse(files, cache, extract, lambda df: not df.where("value = 'old'").take(1))
    assert rows(again.fragments) == {("a", "new"), ("b", "new")} and rows(again.to_store) == set() and (again.attempts, again.reason) == (2, "reuse_rejected")
    for c in (cache, cache.limit(0)):
        with pytest.raises(ValueError, match="not accepted"):
            refresh.extract_with_reuse(files, c, extract, lambda df: False)


def test_tasks_stop():
    heads = iter(["h1", "h1", "h1", "h2"])
    tasks = lambda: refresh.refresh_tasks(lambda: next(heads), lambda: 1, lambda x: x + 1, lambda x: x)
    assert [s for _, s in refresh.run_tasks(tasks())] == ["completed"] * 5
    assert refresh.run_tasks(tasks())[3:] == [("resample", "deferred"), ("pack", "not_begun")]
    assert [s for _, s in refresh.run_tasks([("a", lambda: "completed"), ("b", lambda: 1 / 0), ("c", lambda: "completed")])] == ["completed", "unknown", "not_begun"]
    seen = []
    assert [s for _, s in refresh.run_tasks([("a", lambda: seen.append(1) or "completed"), ("b", lambda: "completed"), ("c", lambda: "completed")], lambda: bool(seen))] == ["completed", "cancelled", "not_begun"]


def test_answers_in_a_budget():
    draw = random.Random(1)
    for _ in range(200):
        answer = {"status": "ok", "repository": "r" * draw.randint(1, 60), "validation_coverage": {"x": "y" * draw.randint(0, 300)}, "hints": ["h" * 40], "truncation_reason": None, "results": [{"id": "é" * draw.randint(0, 30)} for _ in range(draw.randint(0, 12))]}
        budget, rest = draw.randint(150, 1200), dict(answer, results=list(answer["results"]))
        size = lambda a: len(json.dumps(a, separators=(",", ":"))) + 1
        while size(rest) > budget and rest["results"]:
            rest["results"].pop()
            rest["truncation_reason"] = "byte_budget"
        if size(rest) > budget:
            rest |= {"validation_coverage": {"status": "omitted_for_byte_budget"}, "hints": ["Metadata omitted to fit byte budget."], "truncation_reason": "byte_budget"}
        if size(rest) > budget:
            rest["repository"] = None
        assert json.loads(paging.bounded_answer(answer, budget)) == rest


def test_cache_statistics_and_empty_groups(spark):
    cache = spark.createDataFrame([("abc",), ("é",)], "payload string")
    for outcomes, quota, status in ((["hit", "miss", "stored"], 100, "ok"), (["full"], 100, "full"), (["hit"], 5, "full"), (["corrupt", "full"], 100, "corrupt"), ([], 100, "ok")):
        row = state.cache_stats(spark.createDataFrame([(o,) for o in outcomes], "outcome string"), cache, quota).first()
        assert (row["status"], row["bytes_used"], row["hit"]) == (status, 5, outcomes.count("hit"))
    deltas = spark.createDataFrame([("a", 1, None), ("b", 1, -1.0), ("b", 2, -1.0)], "g string, cluster int, d double")
    assert {tuple(r) for r in entity.bootstrap(deltas, "g", 20).collect()} == {("a", 0.0, 0.0, 0.0, False), ("b", -1.0, -1.0, -1.0, True)}
    pairs = spark.createDataFrame([("b", "a", 1), ("a", "b", 1), ("a", "a2", 2)], "l string, r string, n int")
    assert [tuple(r) for r in entity.in_order(pairs).collect()] == [("a", "a2", 2), ("a", "b", 1)]


def test_a_pointer_is_always_there(spark, tmp_path):
    path = str(tmp_path / "s")
    for name in ("one", "two"):
        snapshots.point(spark, path, "latest", name)
        assert snapshots.pointed(spark, path) == name
    assert [p.name for p in (tmp_path / "s").iterdir() if not p.name.startswith(".")] == ["_latest"]
    with pytest.raises(FileNotFoundError):
        snapshots.pointed(spark, path, "current")


def test_large_archives_are_digested_as_streams(spark, tmp_path, monkeypatch):
    import hashlib

    sizes = {"a.tar.gz": 10, "b.tar.gz": 3_000_000, "c.tar.gz": 2_000_000}
    for name, n in sizes.items():
        (tmp_path / name).write_bytes(name.encode() * (n // 8))
    digest = lambda name: hashlib.sha256((tmp_path / name).read_bytes()).hexdigest()
    rows = [(name, digest(name) if name != "c.tar.gz" else "0" * 64, (tmp_path / name).stat().st_size) for name in sizes] + [("d.tar.gz", "0" * 64, 1)]
    entries = spark.createDataFrame(rows, "archive string, sha256 string, bytes long")
    wanted = {("c.tar.gz", "other_content"), ("d.tar.gz", "missing")}
    assert {tuple(r) for r in catalogs.verified_archives(spark, entries, str(tmp_path)).collect()} == wanted
    monkeypatch.setattr(catalogs, "WHOLE_BYTES", 1000)
    assert {tuple(r) for r in catalogs.verified_archives(spark, entries, str(tmp_path)).collect()} == wanted


def test_trusted_digests_and_staged_contents(spark):
    import hashlib

    files = spark.createDataFrame([("o1", b"a"), ("o2", b"b"), ("o2", b"b"), (None, b"c")], "blob_oid string, content binary")
    known = spark.createDataFrame([(2, "o1", "late"), (1, "o1", "trusted"), (1, "o9", "other")], "ord int, blob_oid string, sha256 string")
    own = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((r["blob_oid"] or "", r["sha256"]) for r in state.trusted_digest(files, known).collect()) == [("", own(b"c")), ("o1", "trusted"), ("o2", own(b"b")), ("o2", own(b"b"))]
    wanted = spark.createDataFrame([("p", own(b"a")), ("q", own(b"b")), ("r", own(b"c"))], "path string, sha256 string")
    contents = spark.createDataFrame([("p", own(b"a"), b"a"), ("q", own(b"b"), b"x"), ("z", own(b"c"), b"c")], "path string, sha256 string, content binary")
    assert {(r["path"], r["content"] and bytes(r["content"])) for r in catalogs.staged(wanted, contents).collect()} == {("p", b"a"), ("q", None), ("r", None)}


def test_candidate_paths_and_canonical_links(spark):
    from tessera.operators import resolve

    refs = spark.createDataFrame([(["a", "b"],), (["b"],), ([],), (None,)], "candidates array<string>")
    assert {r["path"] for r in resolve.candidate_paths(refs).collect()} == {"a", "b"}
    links = spark.createDataFrame([("f", "s", "t", "x", 5), ("f", "s", "t", "x", 2), ("f", "a", "t", "x", 9), ("e", "z", "t", "y", 7), ("f", "s", "t", "y", 1)], "source_file string, source string, target string, type string, ord long")
    assert [tuple(r) for r in resolve.canonical_links(links).collect()] == [("e", "z", "t", "y", 7), ("f", "a", "t", "x", 9), ("f", "s", "t", "x", 2), ("f", "s", "t", "y", 1)]


def test_a_snapshot_broadcasts_nothing_by_the_size_of_its_files(spark, tmp_path):
    from tessera.sources import snapshots

    nodes = spark.range(10).selectExpr("concat('n', id) AS id", "'t' AS type")
    links = spark.range(10).selectExpr("concat('n', id) AS source", "concat('n', id) AS target")
    snapshots.write(spark, str(tmp_path), nodes, links)
    joined = snapshots.open_latest(spark, str(tmp_path)).sql("SELECT n.type, count(*) AS n FROM edges l JOIN nodes n ON n.id = l.target GROUP BY n.type")
    assert "Broadcast" not in joined._jdf.queryExecution().sparkPlan().toString() and [tuple(r) for r in joined.collect()] == [("t", 10)]
