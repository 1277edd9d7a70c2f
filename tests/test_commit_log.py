import threading
import time

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import CURIE  # noqa: F401
from tessera.sources import outputs
from tessera.sources.commit_log import CommitLog, Conflict

SCHEMAS = {"deltas": "k string, n long", "notes": "t string"}


def _log(spark, path, **more):
    return CommitLog(spark, str(path), SCHEMAS, **more)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _both(*work):
    """Runs functions in threads that start together; gives what they raise."""
    gate, raised = threading.Barrier(len(work)), []

    def run(f):
        gate.wait()
        try:
            f()
        except Exception as e:  # noqa: BLE001
            raised.append(e)

    threads = [threading.Thread(target=run, args=(f,)) for f in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return raised


def test_a_file_is_made_once(spark, tmp_path):
    path = f"file://{tmp_path}/a/b.json"
    won = []
    assert _both(*[lambda k=k: won.append(k) if outputs.put_if_absent(spark, path, b"%d" % k * 9) else None for k in range(8)]) == []
    assert len(won) == 1 and outputs.read(spark, path) == b"%d" % won[0] * 9
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["b.json"]


def test_versions_follow_one_another(spark, tmp_path):
    log = _log(spark, tmp_path / "t")
    empty = log.snapshot()
    assert empty.version == -1 and empty.table("deltas").collect() == []
    assert log.commit(empty, rows={"deltas": [("a", 1)], "notes": [("x",)]}, sums={"n": 1}) == 0
    frame = spark.createDataFrame([("b", 2), ("a", 3)], "k string, n long").coalesce(1)
    assert log.commit(log.snapshot(), {"deltas": frame}, sums=lambda written: {"n": written["deltas"]}) == 1
    # a writer that saw an older snapshot takes the next number if nothing conflicts
    assert log.commit(empty, rows={"deltas": [("c", 4)]}) == 2
    with pytest.raises(Conflict):
        log.commit(empty, {"deltas": frame}, conflicts=lambda c: c.adds_to("deltas"))
    now = log.snapshot()
    assert now.version == 2 and now.sums == {"n": 3}
    assert [tuple(r)[:2] for r in now.table("deltas").orderBy("_version", "_at").collect()] == [("a", 1), ("b", 2), ("a", 3), ("c", 4)]
    assert _rows(log.snapshot(0).table("deltas").select("k", "n")) == [("a", 1)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1  # what the conflict wrote is gone


def test_a_batch_counts_once(spark, tmp_path):
    log, raised = _log(spark, tmp_path / "t", checkpoint_every=4), []
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    for _ in range(3):
        raised += _both(*[lambda b=b: _log(spark, tmp_path / "t", checkpoint_every=4).commit(log.snapshot(), {"deltas": frame}, txn=f"batch {b % 3}") for b in range(6)])
    assert raised == []
    assert _rows(log.snapshot().table("deltas").groupBy("k").agg(F.sum("n"), F.count("*"))) == [("a", 3, 3), ("b", 6, 3)]
    log.checkpoint()
    assert log.snapshot().applied("batch 1") and not log.snapshot().applied("batch 9")
    assert log.commit(log.snapshot(), rows={"notes": [("y",)]}, txn="batch 1") is None


def test_a_crash_between_data_and_log_shows_nothing(spark, tmp_path, monkeypatch):
    log = _log(spark, tmp_path / "t")
    log.commit(log.snapshot(), rows={"deltas": [("a", 1)]})
    frame = spark.createDataFrame([("b", 2)], "k string, n long")
    with monkeypatch.context() as m:
        m.setattr(outputs, "put_if_absent", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.commit(log.snapshot(), {"deltas": frame})
    assert _rows(log.snapshot().table("deltas").select("k", "n")) == [("a", 1)]
    assert log.commit(log.snapshot(), {"deltas": frame}) == 1
    assert log.vacuum(0) == []
    gone = log.vacuum(int(time.time() * 1000) + 60_000)
    assert len(gone) == 1 and gone[0].startswith("data/")
    assert _rows(log.snapshot().table("deltas").select("k", "n")) == [("a", 1), ("b", 2)]


def test_a_thousand_commits_compact_without_changed_totals(spark, tmp_path):
    path = tmp_path / "t"
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n")).withColumns({"_version": F.lit(0).cast("long"), "_at": F.lit(0).cast("long")})
    log = _log(spark, path, checkpoint_every=10**9)
    seen = log.snapshot()
    for k in range(1000):
        seen.version = log.commit(seen, rows={"deltas": [(f"k{k % 7}", k)]}, sums={"n": 1}, txn=str(k))
    wanted = sorted((f"k{j}", sum(range(j, 1000, 7))) for j in range(7))
    totals = lambda s: _rows(s.table("deltas").groupBy("k").agg(F.sum("n")))
    assert totals(log.snapshot()) == wanted
    compact = _log(spark, path, checkpoint_every=10**9, merges={"deltas": merge})
    assert compact.checkpoint() == 999
    now = compact.snapshot()
    assert totals(now) == wanted and now.sums == {"n": 1000} and now.table("deltas").count() == 7 and now.applied("517")
    assert compact.commit(now, rows={"deltas": [("k0", 5)]}, txn="more") == 1000
    compact.checkpoint()
    gone = compact.vacuum(int(time.time() * 1000) + 60_000)
    assert len([g for g in gone if g.startswith("log/")]) == 1001 and any(g.startswith("checkpoints/") for g in gone)
    assert totals(compact.snapshot()) == [("k0", wanted[0][1] + 5), *wanted[1:]]
    with pytest.raises(ValueError, match="passed"):
        compact.snapshot(3)


def _curies(spark, ids):
    return spark.createDataFrame([(f"corp:a/b{i}.py#f{i}-function",) for i in ids], "curie string")


def test_two_writers_intern_and_record(spark, tmp_path):
    path = str(tmp_path / "ledger")
    work = [lambda a=a: outputs.Ledger(spark.newSession(), path).intern(_curies(spark.newSession(), range(a, a + 40))) for a in (0, 20, 10)]
    work += [lambda k=k: [outputs.Ledger(spark.newSession(), path).record(f"run {k} {j}", "c", "f", "valid", f"t{j}", "PASS", ["x"] * k) for j in range(6)] for k in range(2)]
    assert _both(*work) == []
    ledger = outputs.Ledger(spark, path)
    ids = ledger.table("ids").collect()
    assert sorted(r["id"] for r in ids) == list(range(1, 61)) and len({r["curie"] for r in ids}) == 60
    again = {r["curie"]: r["id"] for r in ledger.intern(_curies(spark, range(30, 70))).collect()}
    assert all(again[r["curie"]] == r["id"] for r in ids) and sorted(again.values()) == list(range(1, 71))
    assert ledger.table("freshness").count() == 12 == ledger.evidence().count()


def _payloads(spark, items):
    rows = spark.createDataFrame([(f"{k:064d}", p) for k, p in items], "key_sha256 string, payload string")
    return rows.withColumn("payload_sha256", F.sha2("payload", 256))


def test_payloads_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "cache")
    store = outputs.FragmentStore(spark, path, 60)
    outcomes = lambda s, items: {int(r["key_sha256"]): r["outcome"] for r in s.put(_payloads(spark, items)).collect()}
    assert outcomes(store, [(1, "one"), (2, "two")]) == {1: "stored", 2: "stored"}
    assert outcomes(outputs.FragmentStore(spark, path, 60), [(1, "one"), (2, "other"), (3, "x" * 50), (4, "y" * 9)]) == {1: "exists_verified", 2: "exists_conflict", 3: "stored", 4: "full"}
    bad = _payloads(spark, [(7, "z")]).withColumn("payload_sha256", F.lit("0" * 64))
    assert [r["outcome"] for r in store.put(bad).collect()] == ["error"]
    assert store.put(_payloads(spark, [(1, "one")]).where("false")).collect() == []
    assert {int(r["key_sha256"]): r["payload"] for r in store.table().collect()} == {1: "one", 2: "two", 3: "x" * 50}
    found = []
    work = [lambda k=k: found.append(outcomes(outputs.FragmentStore(spark, path, 10**6), [(10, f"by {k}"), (20 + k, "own")])) for k in range(3)]
    assert _both(*work) == []
    assert sorted(f[10] for f in found) == ["exists_conflict", "exists_conflict", "stored"] and all(f[20 + k] == "stored" for f in found for k in range(3) if 20 + k in f)
    assert store.table().where("payload like 'by%'").count() == 1
