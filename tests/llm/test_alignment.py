import collections
import hashlib
import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import alignment, common, queries
from tests.llm import cases

A, B = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


def _plain(rows):
    """The query's rows of (doc_id, text), by the libraries and by comparing all byte ranges of a document's tokens."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    spell_a = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for doc_id, text in rows:
        sides, want = [], (" " + (text or "")).encode()
        for ids, spell in ((a.encode(" " + (text or ""), add_special_tokens=False).ids, spell_a), (b.encode(text or ""), spell_b)):
            at, own = 0, []
            for i in ids:
                n = len(spell(i))
                own.append((i, at, at + n))
                at += n
            sides.append(own if text and b"".join(map(spell, ids)) == want else None)
        if None in sides:
            found.append((doc_id, [], [], [], ""))
            continue
        x, y = sides
        links = [(i, j) for i, s, e in x for j, t, f in y if s < f and t < e]
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups = [(",".join(str(i) for i, _, e in x if lo < e <= hi), ",".join(str(i) for i, _, e in y if lo < e <= hi)) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        found.append((doc_id, x, y, links, ";".join(f"{p}|{q}" for p, q in groups)))
    docs = collections.Counter(k for _, _, _, links, _ in found for k in set(links))
    most = collections.defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    return sorted(
        (repr(doc_id), len(x), len(y), text.count("|") if x else 0, len(links), sum(docs[k] == most[k[0]] for k in links), sum(docs[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if x else "")
        for doc_id, x, y, links, text in found
    )


def _aligned(docs):
    return sorted((repr(r["doc_id"]), *tuple(r)[1:]) for r in alignment.align_documents(docs, A, B).collect())


def test_whole_table(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").where("length(text) < 6000 or length(text) > 15000")
    found = _aligned(docs)
    assert found == _plain([(r["doc_id"], r["text"]) for r in docs.collect()]) and len(found) > 150


def test_query(spark, sf_dir):
    found = queries.op13_alignment(spark, sf_dir)
    assert found.columns == ["doc_id", *alignment.SUMS, "n_best", "count_sum", "groups_sha256"]
    assert found.count() == common.table(spark, sf_dir, "documents").count()


ODD = [" ", "\n", "  ", "▁", "▁a", "the", " the", "The", "'s", "''", "12", "3,4", "日本語", "\U0001f600", "\xe9", "é", "\xa0", "\x00", "\t", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "xxxxxxxxxxxx", "...", "﻿", "\x85", "　", "\xd7", "\xf7", "\xdf"]


def test_odd_texts(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice(ODD) for _ in range(r.randrange(14))), None, None) for i in range(700)]
    assert _aligned(cases.docs(spark, rows)) == _plain([x[:2] for x in rows])


def test_odd_rows(spark):
    rows = [x if x[0] != 9 else (9, "word " * 900 + "x" * 400, None, None) for x in cases.ROWS]
    assert _aligned(cases.docs(spark, rows).repartition(3)) == _plain([x[:2] for x in rows])
    assert alignment.align_documents(cases.empty(spark), A, B).collect() == []


def test_long_texts(spark):
    """Texts beyond a block, and one long stretch whose groups have many tokens, in time."""
    rows = [(1, "word " * 400_000, None, None), (2, "a日" * 20_000, None, None), (3, "\x01" * 30_000, None, None)]
    found = {r["doc_id"]: r for r in alignment.align_documents(cases.docs(spark, rows), A, B).collect()}
    assert found[1]["n_a"] == 400_001 and found[1]["n_groups"] == found[1]["n_links"] - (found[1]["n_a"] + found[1]["n_b"] - 2 * found[1]["n_groups"])
    assert found[2]["n_a"] > 30_000 < found[3]["n_a"]


@pytest.mark.parametrize("seed", range(3))
def test_links_of_any_units(spark, seed):
    """Units of any lengths, one of them a single group of many tokens, against all pairs of their ranges."""
    r = random.Random(seed)

    def split(n):
        ends = sorted({n, *(r.randrange(1, n) for _ in range(r.randrange(n)))}) if n > 1 else [n]
        return [y - x for x, y in zip([0, *ends], ends, strict=False)]

    rows = [(k, "u", split(n), split(n)) for k, n in enumerate(r.randrange(1, 30) for _ in range(60))] + [(99, "u", [2] * 500, [1] + [2] * 499 + [1])]
    key = ["u", "name"]
    units = spark.createDataFrame(rows, "u long, name string, a_sizes array<int>, b_sizes array<int>")
    found = {x["u"]: x for x in alignment.groups(alignment.links(units, key), key).collect()}
    assert len(found) == len(rows)
    for k, _, a, b in rows:
        x, y = ([(sum(side[:i]), sum(side[: i + 1])) for i in range(len(side))] for side in (a, b))
        assert [tuple(p) for p in found[k]["links"]] == sorted((i, j) for i, (s, e) in enumerate(x) for j, (t, f) in enumerate(y) if s < f and t < e)
        cuts = sorted({e for _, e in x} & {e for _, e in y})
        assert [tuple(g) for g in found[k]["groups"]] == [tuple(sum(lo < e <= hi for _, e in side) for side in (x, y)) for lo, hi in zip([0, *cuts], cuts, strict=False)]
