import gzip
import io
import json
import random
import tarfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.sources import catalogs, json_stream

values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda v: st.lists(v, max_size=4) | st.dictionaries(st.text(), v, max_size=4), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(doc=st.dictionaries(st.text(), values, max_size=6), indent=st.sampled_from([None, 1]), ascii_only=st.booleans())
def test_a_document_in_pieces_is_the_document(doc, indent, ascii_only):
    text = json.dumps(doc, indent=indent, ensure_ascii=ascii_only) + "\n"
    rows = [("d", len(text.encode()), p) for p in text.split("}")]
    back = {k: [] for k, v in doc.items() if v == []}
    for field, k, value in json_stream.walk(json_stream._pieces(iter(rows))):
        if k is None:
            back[field] = json.loads(value)
        else:
            back.setdefault(field, []).append(json.loads(value))
            assert len(back[field]) == k + 1
    assert back == doc


@pytest.mark.parametrize("bad", ["", "[]", "{", '{"a": [1, 2', '{"a": [1 2]}', '{"a": NaN}', '{"a": 1, "a": 2}', '{"a": 1} x', '{"a": {"b": 1}', '{"a": [1,]}', "{1: 2}"])
def test_faulty_documents_raise(bad):
    with pytest.raises(ValueError):
        list(json_stream.walk(json_stream._pieces(iter([("d", len(bad.encode()), p) for p in (bad[:-1] if bad.endswith("}") else bad).split("}")]))))


def test_documents_of_many_splits(spark, tmp_path):
    rng, docs = random.Random(3), {}
    for name in ("one", "two", "three"):
        nodes = [{"id": f"n{k}", "label": 'a}b{"\\' * rng.randrange(4), "more": {"x": [k, {"y": "é}"}]}} for k in range(2_000)]
        docs[name] = {"directed": name != "two", "graph": {"hyperedges": [{"nodes": ["n1", name]}]}, "nodes": nodes, "links": [{"source": "n0", "target": f"n{k}"} for k in range(50)], "built_at_commit": "c1"}
        (tmp_path / f"{name}.json").write_text(json.dumps(docs[name], indent=1 if name == "three" else None))
    with gzip.open(tmp_path / "four.json.gz", "wt") as f:
        json.dump(docs["one"], f)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        nodes, links, hyper = catalogs.graph_tables(spark, f"file://{tmp_path}/*.json*")
        faults = {(r["graph"].rsplit("/", 1)[-1], r["fault"]) for r in catalogs.graph_faults(spark, f"file://{tmp_path}/*.json", "c2").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    docs["four"] = docs["one"]
    assert nodes.count() == 8_000 and links.count() == 200
    for r in nodes.select("graph", "ord", "id", "label", "attrs").collect():
        assert (r["id"], r["label"]) == tuple(docs[r["graph"].rsplit("/", 1)[-1].split(".")[0]]["nodes"][r["ord"]][k] for k in ("id", "label"))
    assert sorted(r["nodes"][1] for r in hyper.collect()) == ["one", "one", "three", "two"]
    assert faults == {(f"{n}.json", "other_head") for n in ("one", "two", "three")} | {("two.json", "not_directed")}


def test_archives_are_unpacked_as_streams(spark, tmp_path):
    rng, wanted = random.Random(5), {}
    for archive in ("a", "b", "empty"):
        with tarfile.open(tmp_path / f"{archive}.tar.gz", "w:gz") as tar:
            for k, size in enumerate((0, 1, 511, 512, 70_000, 300_000) if archive != "empty" else ()):
                raw = rng.randbytes(size) if k % 2 else b"\n\r\n" * (size // 3)
                info = tarfile.TarInfo(f"m/{k}")
                info.size = len(raw)
                tar.addfile(info, io.BytesIO(raw))
                wanted[f"{archive}.tar.gz", info.name] = raw
    found = catalogs.members(spark, f"file://{tmp_path}").collect()
    assert {(r["archive"], r["name"]): bytes(r["content"]) for r in found} == wanted and len(found) == len(wanted)
    with tarfile.open(tmp_path / "bad.tar.gz", "w:gz") as tar:
        tar.addfile(tarfile.TarInfo("../x"), io.BytesIO(b""))
    with pytest.raises(Exception, match="unsafe member"):
        catalogs.members(spark, f"file://{tmp_path}/bad.tar.gz").collect()
