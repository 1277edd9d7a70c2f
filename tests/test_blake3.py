"""Digests against the algorithm's published test vectors, whose inputs are the bytes 0 to 250 over and over, and against a chunk at a time."""

import random

import pytest

from tessera.functions import blake3

VECTORS = {
    0: "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262",
    1: "2d3adedff11b61f14c886e35afa036736dcd87a74d27b5c1510225d0f592e213",
    1024: "42214739f095a406f3fc83deb889744ac00df831c10daa55189b5d121c855af7",
    1025: "d00278ae47eb27b34faecf67b4fe263f82d5412916c1ffd97c8cb7fb814b8444",
    2048: "e776b6028c7cd22a4d0ba182a8bf62205d2ef576467e838ed6f2529b85fba24a",
}


def _input(n):
    return (bytes(range(251)) * (n // 251 + 1))[:n]


# a plain version: one node at a time, the tree by its left halves
IV = [0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19]
M = 0xFFFFFFFF


def _node(cv, block, counter, length, flags):
    w = [int.from_bytes(block[4 * k : 4 * k + 4].ljust(4, b"\0"), "little") for k in range(16)]
    v = [*cv, *IV[:4], counter & M, counter >> 32, length, flags]
    turn = lambda x, n: (x >> n | x << 32 - n) & M
    for _ in range(7):
        for k, (a, b, c, d) in enumerate([(0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15), (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14)]):
            for x, r, s in ((w[2 * k], 16, 12), (w[2 * k + 1], 8, 7)):
                v[a] = (v[a] + v[b] + x) & M
                v[d] = turn(v[d] ^ v[a], r)
                v[c] = (v[c] + v[d]) & M
                v[b] = turn(v[b] ^ v[c], s)
        w = [w[k] for k in (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)]
    return [v[k] ^ v[k + 8] for k in range(8)]


def _tree(data, first, root):
    if len(data) <= 1024:
        cv, blocks = IV, [data[k : k + 64] for k in range(0, len(data), 64)] or [b""]
        for k, b in enumerate(blocks):
            cv = _node(cv, b, first, len(b), (k == 0) + 2 * (k == len(blocks) - 1) + 8 * (root and k == len(blocks) - 1))
        return cv
    half = 1024
    while 2 * half < len(data):
        half *= 2
    both = _tree(data[:half], first, False) + _tree(data[half:], first + half // 1024, False)
    return _node(IV, b"".join(x.to_bytes(4, "little") for x in both), 0, 64, 4 + 8 * root)


def _plain(data):
    return b"".join(x.to_bytes(4, "little") for x in _tree(data, 0, True)).hex()


def test_published_vectors():
    assert {n: d.hex() for n, d in zip(VECTORS, blake3.digests([_input(n) for n in VECTORS]), strict=True)} == VECTORS


def test_all_lengths():
    r = random.Random(4)
    rows = [_input(n) for n in [2, 63, 64, 65, 127, 128, 1023, 2049, 3072, 3073, 4096, 5121, 7168, 8193, 31744, 100_000]] + [r.randbytes(r.randrange(9000)) for _ in range(12)]
    assert [d.hex() for d in blake3.digests(rows)] == [_plain(x) for x in rows]
    assert blake3.digests([]) == []


@pytest.mark.parametrize("at_once", [1 << 22, 3000])
def test_column(spark, monkeypatch, at_once):
    monkeypatch.setattr(blake3, "AT_ONCE", at_once)
    rows = [(k, _input(n) if n is not None else None) for k, n in enumerate([0, None, 1, 1025, 2048, 5000, 1024, None])]
    found = spark.createDataFrame(rows, "k int, content binary").select("k", blake3.blake3("content").alias("d")).collect()
    assert {r["k"]: r["d"] for r in found} == {k: None if c is None else _plain(c) for k, c in rows}
