import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import common, packing, queries
from tessera.llm.packing import Packing, Piece, Windows, merged
from tests.llm import cases

PATH = queries.vocabulary("word_bpe_49k.json")


def _check(rows, wanted, p=Packing()):
    """Each id in one piece, pieces gapless within their sequence, little padding. wanted: the ids of each document."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(np.array(r["ids"], "<u4")) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
    found = {}
    for doc_id, pieces in docs.items():
        pieces.sort(key=lambda r: r["start"])
        assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
        found[doc_id] = [i for r in pieces for i in r["ids"]]
        assert {r["doc_tokens"] for r in pieces} == {len(found[doc_id])}
    assert found == wanted
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
        n = sum(r["length"] for r in pieces)
        assert n <= p.size and (p.size - n < p.least or n & (n - 1) == 0)
        padding += p.size - n if n & (n - 1) else 0
    assert padding <= 0.01 * sum(map(len, wanted.values()))
    return sequences


def _library(docs):
    library = Tokenizer.from_file(PATH)
    return {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_packs_every_id_once(spark, sf_dir, partitions):
    docs = common.table(spark, sf_dir, "documents").repartition(partitions)
    rows = packing.pack(docs, PATH).collect()
    _check(rows, _library(docs))
    assert len(rows) < 2.5 * docs.count() + sum(len(x) for x in _library(docs).values()) / 1000


def test_query_drops_the_ids_alone(spark, sf_dir):
    found = queries.op12_packing(spark, sf_dir)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.agg({"length": "sum"}).first()[0] == sum(map(len, _library(common.table(spark, sf_dir, "documents")).values()))


def test_odd_rows(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(cases.ROWS)] + [(50, "<|startoftext|>a<|endoftext|>", "en", "web"), (51, "ΑΣ é don't\x0bstop \r\n\n  12", "en", None)]
    docs = cases.docs(spark, rows)
    _check(packing.pack(docs, PATH).collect(), _library(docs))
    assert packing.pack(cases.empty(spark), PATH).collect() == []
    # rows without a doc_id, or of one that repeats, are documents of their own
    found = packing.pack(cases.docs(spark), PATH)
    assert found.where("doc_id is null").agg({"length": "sum"}).first()[0] == len(_library(cases.docs(spark))[None])
    assert found.where("doc_id = 7 and start = 0").count() == 2


def _pieces(r, n, size):
    return [Piece(k, 0, m, np.full(m, k, np.int32)) for k, m in enumerate(r.choice([1, 2, 30, size // 3, size - 1, size, 3 * size + 7]) + r.randrange(3) for _ in range(n))]


@pytest.mark.parametrize("seed", range(6))
def test_bounded_windows(seed):
    r = random.Random(seed)
    p = Packing(size=r.choice([8, 100, 2048]), windows=r.choice([1, 3, 32]), least=r.choice([1, 5]))
    full = []
    windows = Windows(p, full.append)
    pieces = _pieces(r, 300, p.size)
    for x in pieces:
        windows.add(x)
        assert len(windows.held) == len(windows.free) <= p.windows
    assert all(p.size - p.least < sum(len(x.ids) for x in w) <= p.size for w in full)
    sequences = full + merged(list(windows.held.values()), p)
    assert sum(len(x.ids) for s in sequences for x in s) == sum(len(x.ids) for x in pieces)
    for s in sequences:
        n = sum(len(x.ids) for x in s)
        assert p.size - n < p.least or n & (n - 1) == 0
    assert merged([], p) == []


def test_best_fit():
    full = []
    windows = Windows(Packing(size=10, windows=2, least=2), full.append)
    for k, n in enumerate((6, 7, 3, 4, 5)):
        windows.add(Piece(k, 0, n, np.full(n, k, np.int32)))
    # 3 goes to 7 and 4 to 6, though both fit either; 5 opens a window
    assert [[x.doc_id for x in s] for s in full] == [[1, 2], [0, 3]] and [x.doc_id for w in windows.held.values() for x in w] == [4]
