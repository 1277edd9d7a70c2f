import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import numbers, text


def test_globs():
    import fnmatch
    import re

    for glob in ("*.py", "a?c", "x/*/y", "[ab]*", "[!ab]*", "a.b+c", "*[[]*", "**"):
        for path in ("a.py", "abc", "x/y/z/y", "bx", "cx", "a.b+c", "aXb+c", "q[z", "line\nbreak.py"):
            assert bool(re.match(text.glob_regex(glob), path)) == fnmatch.fnmatchcase(path, glob), (glob, path)


def _jaro_winkler(a, b):
    """By the definition, one pair at a time."""
    if not a and not b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = set(), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in used and b[j] == c:
                used.add(j)
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(left, [b[j] for j in sorted(used)], strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def _indel(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        last = row
        row = [0]
        for j, d in enumerate(b, 1):
            row.append(last[j - 1] + 1 if c == d else max(last[j], row[-1]))
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


WORDS = st.lists(st.tuples(st.text("abcé日 ", max_size=12), st.text("abcé日 ", max_size=12)), min_size=1, max_size=20)


@settings(max_examples=60, deadline=None)
@given(WORDS)
def test_similarities(pairs):
    left, right = map(list, zip(*pairs, strict=True))
    assert np.allclose(text.jaro_winkler_many(left, right), [_jaro_winkler(a, b) for a, b in pairs], atol=1e-12)
    assert np.allclose(text.indel_many(left, right), [_indel(a, b) for a, b in pairs], atol=1e-12)


def test_casefold_and_normalize(spark):
    rows = spark.createDataFrame([("Straße",), (None,), ("ΣΑΣ",)], "t string")
    assert [r[0] for r in rows.select(text.casefold("t")).collect()] == ["strasse", None, "σασ"]
    rows = spark.createDataFrame([("  É-Cole  d'été_1! ",)], "t string")
    assert rows.select(text.normalize(F.col("t"))).first()[0] == "é cole d été_1"


def test_costs_are_exact(spark):
    row = spark.range(1).select(numbers.cost(F.lit(1234567), F.lit(1), "0.000001", "0.1").alias("c"), numbers.planned_tokens(F.lit(10).cast("long"), 150).alias("a"), numbers.planned_tokens(F.lit(7).cast("long"), 150).alias("b")).first()
    assert str(row["c"]) == "0.000002" and row["a"] + row["b"] == 8


def test_vectors(spark):
    v = [float(x) for x in np.random.default_rng(1).normal(size=64).astype(np.float32)]
    rows = spark.createDataFrame([(v,), ([0.0] * 64,), (None,)], "v array<float>").select(numbers.to_int8("v").alias("q"), numbers.to_bits("v").alias("b")).collect()
    scale = np.float32(np.abs(np.float32(v)).max()) / np.float32(127)
    assert rows[0]["q"] == np.clip(np.rint(np.float32(v) / scale), -127, 127).astype(int).tolist() and rows[1]["q"] == [0] * 64 and rows[2]["q"] is None
    assert bytes(rows[0]["b"]) == np.packbits(np.float32(v) > 0).tobytes()


def test_git_blob_ids(spark):
    row = spark.createDataFrame([(bytearray(b"hello\n"),)], "c binary").select(numbers.git_blob_id(F.col("c"))).first()
    assert row[0] == "ce013625030ba8dba906f756967f9e9ca394464a"


def test_canonical_records():
    assert numbers.canonical({"b": None, "a": "é/\""}) == '{"a":"\\u00e9/\\"","b":null}'


def test_sha256_object_ids(spark):
    import hashlib

    from tessera.sources import catalogs

    body = b"hello\n"
    ids = [h(b"blob 6\0" + body).hexdigest() for h in (hashlib.sha1, hashlib.sha256)]
    blobs = spark.createDataFrame([(i, 6, bytearray(body)) for i in (*ids, "0" * 64, "0" * 40)], "blob_oid string, bytes long, content binary")
    assert {r["blob_oid"] for r in catalogs.blob_faults(blobs).collect()} == {"0" * 64, "0" * 40}


def test_scores_and_json_are_those_of_python(spark):
    import base64
    import json
    import random

    draw = random.Random(4)
    values = [0.0, -0.0, 0.5, 1.0, 2.5e-06, 3.5e-06, 0.0000005, 0.0000015, 1.0000005, 2.0000015, 0.0078125, 0.0234375, 1e-05, 0.00012, 1e-4, 1e7, 123456789.5, 1e15, 1e16, 1.5e22, 1e-7, 12345.678901234567]
    values += [draw.choice([-1, 1]) * round(draw.random() * 10 ** draw.randint(-6, 6), draw.randint(5, 8)) for _ in range(3000)] + [k / 128 for k in range(200)] + [(2 * k + 1) * 5e-7 for k in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", numbers.score_6(F.col("v")).alias("r"), numbers.json_number(F.col("v")).alias("t")).collect()
    for r in rows:
        assert repr(r["r"]) == repr(round(r["v"], 6)) and r["t"] == json.dumps(r["v"]), r
    ids = ["a", 'q"u\\o', "é😀\n\t\x01\x7f", "", "/b c", None]
    found = spark.createDataFrame([(i, 0.25) for i in ids], "i string, s double").select("i", numbers.ascii_json(F.col("i")).alias("j"), numbers.encode_cursor(F.col("s"), F.col("i")).alias("c")).withColumn("d", numbers.decode_cursor(F.col("c"))).collect()
    for r in found:
        if r["i"] is not None:
            assert r["j"] == json.dumps(r["i"])
            assert r["c"] == base64.urlsafe_b64encode(json.dumps([0.25, r["i"]], separators=(",", ":")).encode()).decode().rstrip("=")
            assert (r["d"]["score"], r["d"]["node_id"]) == (0.25, r["i"])
