"""Hard negatives against all products in plain Python."""

import math
import random

import numpy as np
import pytest

from blockstrata.llm.hard_negatives import AnchorTables, bit_planes, mine_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, q string, anchor_id string, rank int, score double, n long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3, 0.5, 1) for r in rows], SCHEMA)


def brute(rows, every, positives, negatives, low, high, scale):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label, [math.floor(scale * x) for x in v])
        best[i] = min(best.get(i, own), own)
    out = set()
    for a, (label, q) in best.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, own) for i, (own, p) in best.items() if i != a)
        for minus, i, own in [s for s in scored if s[2] == label][:positives]:
            good = [(-m, j) for m, j, other in scored if other != label and low * -minus <= 100 * -m <= high * -minus]
            out |= {(a, i, k + 1, j, -minus, s) for k, (s, j) in enumerate(good[:negatives])}
    return out


def mined(df, **kinds):
    got = [tuple(r) for r in mine_negatives(df, **kinds).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("dims,spread", [(1, 3.0), (8, 1.0), (19, 0.3), (64, 0.2), (5, 4000.0)])
def test_scores_are_exact(dims, spread):
    rng = np.random.default_rng(dims)
    values = np.floor(rng.normal(0, spread, (70, dims)) * 256).astype(np.int64)
    tables = AnchorTables(values[:9], [np.arange(4), np.arange(4, 9)])
    planes = bit_planes(values)
    rows = np.arange(3, 70)
    for chunk, members in enumerate(tables.chunks):
        assert (tables.scores(chunk, planes, rows) == values[rows] @ values[members].T).all()


def test_against_all_products(spark):
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 1) for _ in range(11)] for _ in range(4)]
    rows = []
    for i in range(-20, 420):
        label = rnd.choice([0, 0, 0, 1, 2, 9])
        v = [c * 0.3 + rnd.gauss(0, 0.5) for c in centres[label % 4]]
        rows.append((i, label, v if i % 5 else [round(x) / 2 for x in v]))
    rows += [(1000, 1, [0.5] * 11)] * 3 + [(1001 + k, 1, [0.5] * 11) for k in range(30)]  # one vector many times
    rows += [(1000, 0, [0.5] * 11), (7, 2, [9.0] * 11), (7, 1, [0.1] * 11)]  # an id on different rows
    rows += [(2000, None, [1.0] * 11), (2001, 1, None), (None, 1, [1.0] * 11), (2050, 1, [1.0, None]), (2100, 1, [math.nan] * 11),
             (2150, 2, [math.inf] * 11), (2200, 1, []), (2250, 3, [1.0, 2.0]), (2300, 3, [0.25] * 13)]
    for every in (50, 1):  # 1: more anchors than one pass takes
        got = mined(table(spark, rows), every=every, table_bytes=1)
        assert got == brute(rows, every, 5, 3, 50, 95, 256)
        assert got


def test_few_rows_and_other_bands(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.8, 0.0]), (3, 2, [0.8, 1.0]), (50, 5, [-1.0, 0.0])]
    assert mined(table(spark, rows)) == brute(rows, 50, 5, 3, 50, 95, 256) == {(0, 1, 1, 2, 65536, 52224), (0, 1, 2, 3, 65536, 52224)}
    wide = {"every": 1, "positives": 2, "negatives": 1, "low": -200, "high": 100}
    assert mined(table(spark, rows), **wide) == brute(rows, 1, 2, 1, -200, 100, 256)


def test_nothing_to_mine(spark):
    assert mined(table(spark, [])) == set()
    assert mined(table(spark, [(1, 1, [1.0]), (2, 1, [1.0])])) == set()
    assert mined(table(spark, [(0, 1, [1.0])])) == set()
