import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import common, near_dedup, shingles
from tests.llm import cases

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute(rows, percent=85):
    """doc_id: (size, component) of rows (doc_id, text); the rows of one id must be of one set."""
    sets = {i: _set(t) for i, t in rows}
    comp = {i: i for i in sets}

    def top(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def _found(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def _family(seed, count, words=90):
    """Near copies of one text, by few changed words to many, in a chain and around it."""
    draw = random.Random(seed)
    base = ["w%d" % draw.randint(0, 10**6) for _ in range(words)]
    out = []
    for k in range(count):
        w = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3, 4, 6, 9])):
            w[draw.randrange(words)] = "n%d" % draw.randint(0, 10**6)
        out.append(" ".join(w))
        if k % 5 == 0:
            base = w
    return out


@pytest.mark.parametrize("p", [near_dedup.NearDedup(), near_dedup.NearDedup(chunk_docs=8, unit=30), near_dedup.NearDedup(chunk_docs=16, broadcast_ids=0)])
def test_groups_are_those_of_all_pairs(spark, p):
    draw = random.Random(9)
    texts = [t for s in range(4) for t in _family(s, 45)] + [" ".join("u%d" % draw.randint(0, 99) for _ in range(draw.randint(1, 30))) for _ in range(80)]
    texts += texts[:30] + [None, "", "a", "A", "a b", "b a"]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    found = _found(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), p))
    assert found == {(i, n, c, i == c) for i, (n, c) in _brute(rows).items()}


def test_odd_documents(spark):
    found = near_dedup.near_duplicates(cases.docs(spark))
    rows = [(i, t) for i, t, *_ in cases.ROWS if i is not None]
    assert _found(found) == {(i, n, c, i == c) for i, (n, c) in _brute(rows).items()} | {(None, 1, None, True)}
    assert found.count() == len(cases.ROWS)
    assert near_dedup.near_duplicates(cases.empty(spark)).collect() == []
    kept = near_dedup.keep_rows(cases.docs(spark))
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 9, 10, 11, None} and set(kept.columns) == set(cases.docs(spark).columns)


def test_rows_without_a_doc_id_have_a_group(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(5, text(1)), (None, text(1)), (None, text(1) + " more"), (None, text(2)), (None, text(2) + " more"), (None, text(2)), (None, text(3)), (None, None), (None, ""), (7, text(4))]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, [
        (5, 36, 5, True), (None, 36, 5, False), (None, 37, 5, False), (None, 36, None, True), (None, 37, None, False), (None, 36, None, False), (None, 36, None, True), (None, 0, None, True), (None, 0, None, True), (7, 36, 7, True),
    ]))


@pytest.mark.parametrize("n", [1024, 4096])
def test_patterns_of_letters_are_told_apart(spark, n):
    a, b = cases.thue_morse(n)
    around = "one two three four five six seven eight nine ten "
    rows = [(0, a), (1, b), (2, around + a), (3, around + b), (4, f"{a} {b} {a} {a} {b}"), (5, f"{b} {a} {a} {b} {a}"), (6, a)]
    found = _found(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == {(i, k, c, i == c) for i, (k, c) in _brute(rows).items()}


def _prefix_join(rows, percent=85):
    """Components by an exact prefix join: of two sets that are so alike, the rarest shingles hold a common one."""
    sets = {i: _set(t) for i, t in rows}
    often = collections.Counter(x for s in sets.values() for x in s)
    comp, seen = {i: i for i in sets}, collections.defaultdict(list)

    def top(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in sorted(sets, key=lambda i: (len(sets[i]), i)):
        own = sorted(sets[i], key=lambda x: (often[x], x))
        near = {j for x in own[: len(own) - -(-percent * len(own) // 100) + 1] for j in seen[x]}
        for j in near:
            if top(i) != top(j) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = top(i), top(j)
                comp[max(x, y)] = min(x, y)
        for x in own[: len(own) - -(-percent * len(own) // 100) + 1]:
            seen[x].append(i)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_whole_table_is_that_of_an_exact_prefix_join(spark, sf_dir):
    """Recall is 1: no document of the table is in another group."""
    docs = common.table(spark, sf_dir.replace("0.001", "0.01"), "documents").select("doc_id", "text")
    wanted = _prefix_join([tuple(r) for r in docs.collect()])
    assert _found(near_dedup.near_duplicates(docs)) == {(i, n, c, i == c) for i, (n, c) in wanted.items()}
    assert any(c != i for i, (_, c) in wanted.items())


def test_rows_are_kept_by_row(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(1)), (None, text(2)), (None, text(3)), (None, text(3) + " more"), (None, text(1)), (4, text(4)), (4, text(5)), (4, text(1)), (4, text(4)), (6, text(6)), (None, "")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, extra int")
    kept = near_dedup.keep_rows(docs)
    assert kept.columns == docs.columns
    found = sorted((r["text"], r["doc_id"] is None) for r in kept.collect())
    same = [t for t, _ in found if t in (text(3), text(3) + " more")]
    assert len(same) == 1 and found == sorted([(text(1), False), (text(2), True), (same[0], True), (text(4), False), (text(5), False), (text(6), False), ("", True)])
    whole = docs.where("doc_id in (1, 6)")
    assert sorted(r["text"] for r in near_dedup.keep_rows(whole).collect()) == [text(1), text(6)]


def test_shingles_are_sets_of_five_words():
    texts = ["a b c d e f", "A b\tC d e f a b c d e", "x", "", "one two three four", "one  two three four", "four three two one", "日本 語 é b c d", " lead a b c d"]
    own = shingles.sets(common.whole(pa.array(texts)))
    assert [len(s) for s in own] == [len(_set(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(np.intersect1d(own[i], own[j])) == len(_set(a) & _set(b))


def test_estimates_are_near_the_truth():
    draw = np.random.default_rng(4)
    for share in (0.0, 0.3, 0.6, 0.85, 0.95):
        both = draw.integers(1, 2**63, int(1000 * share), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, draw.integers(1, 2**63, (1000 - len(both)) // 2, dtype=np.uint64)])) for _ in range(2))
        true = len(both) / (len(a) + len(b) - len(both))
        equal = (shingles.registers(a, 2000) == shingles.registers(b, 2000)).sum()
        got = shingles.corrected(np.array([equal]), 2000, np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(got - true) < 5 * np.sqrt(0.25 / 2000)


def test_chance_is_that_of_disjoint_sets():
    draw = np.random.default_rng(6)
    a, b = draw.integers(1, 2**63, 3, dtype=np.uint64), draw.integers(1, 2**63, 3, dtype=np.uint64)
    equal = np.mean([(shingles.registers(a + np.uint64(k), 4000) == shingles.registers(b + np.uint64(k), 4000)).mean() for k in range(20)])
    assert abs(equal - shingles.chance(3, 3)) < 5e-4
