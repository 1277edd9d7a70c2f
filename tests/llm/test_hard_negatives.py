import math
import random

import pytest

from tessera.llm import hard_negatives
from tessera.llm.hard_negatives import Mining

SCHEMA = "vec_id long, embedding array<double>, label int, score int, row int, k string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, 5, 6, "x") for r in rows], SCHEMA)


def _plain(rows, p=Mining()):
    """One anchor after another, by sorting all rows; as the rows of mine()."""
    known = []
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        known.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * v) for v in x]))
    out = []
    for k, (a, label, x) in enumerate(known):
        if a % p.every:
            continue
        scored = sorted((-sum(u * v for u, v in zip(x, y, strict=False)), b, m) for j, (b, m, y) in enumerate(known) if j != k)
        for s, b, _ in [r for r in scored if r[2] == label][: p.positives]:
            fit = [(-t, c) for t, c, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, b, rank, c, -s, t) for rank, (t, c) in enumerate(fit[: p.negatives], 1)]
    return sorted(out)


def _mined(df):
    return sorted(tuple(r) for r in df.collect())


def _random(n, seed, dims=6):
    r = random.Random(seed)
    return [(i, [round(4 * r.gauss(0.3, 1)) / 4 for _ in range(dims)], r.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("p", [Mining(), Mining(row_values=150, anchor_values=12, scores=7)])
def test_same_as_one_anchor_after_another(spark, p):
    rows = _random(260, 1)
    found = _mined(hard_negatives.mine(_table(spark, rows), p))
    assert found == _plain(rows) and len(found) > 20


def test_registered_query_whole_table(spark, sf_dir):
    from tessera.llm import common, queries

    rows = [tuple(r) for r in common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect()]
    assert _mined(queries.op11_hard_negatives(spark, sf_dir)) == _plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (50, [1.0, 0.25], 1), (100, None, 1), (150, [1.0, None], 1), (200, [nan, 1.0], 1), (250, [-inf, 1.0], 2),
        (None, [1.0, 1.0], 1), (300, [1.0, 1.0], None), (350, [], 2), (1, [1.0, 0.5, 9.0], 1), (2, [0.7], 3), (3, [0.7, 0.0], 3),
        (4, [0.7, 0.0], 4), (400, [-1.0, -1.0], 8), (5, [0.7, 0.0], 3), (6, [0.9, 0.5], 2), (-50, [0.9, 0.4], 2), (8, [0.5, 0.5], 1),
    ]
    assert _mined(hard_negatives.mine(_table(spark, rows))) == _plain(rows)
    assert hard_negatives.mine(_table(spark, rows).where("vec_id < -99")).collect() == []
    assert hard_negatives.mine(_table(spark, [(0, [1.0], 1)])).collect() == []


def test_rows_that_repeat_an_id_are_rows_of_their_own(spark):
    rows = [(50, [1.0, 0.5], 1), (50, [1.0, 0.5], 1), (3, [0.7, 0.0], 3), (3, [0.7, 0.0], 3)]
    assert _mined(hard_negatives.mine(_table(spark, rows))) == _plain(rows)


def test_great_components_are_exact(spark):
    rows = [(0, [3e6, 1.0], 2), (1, [3e6, 3.0], 1), (2, [2e6, 1.5], 2), (3, [2.5e6, 2.5], 2), (5, [1e7, 0.1], 1), (6, [1.6e6, 7.0], 4)]
    found = _mined(hard_negatives.mine(_table(spark, [(50 * i, x, m) for i, x, m in rows])))
    assert found == _plain([(50 * i, x, m) for i, x, m in rows]) and found
    assert len(hard_negatives.mine(_table(spark, [(50, [1e300], 1), (51, [1e300], 1), (52, [1e299], 2)])).collect()) == 0
