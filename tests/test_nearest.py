import random

import numpy as np
import pyarrow as pa
import pytest

from blockstrata.operators import envelope, nearest
from blockstrata.operators.nearest import nearest_points, nearest_valid


def check(spark, dims, queries, points):
    q = spark.createDataFrame(queries, ", ".join(d + " int" for d in dims))
    p = spark.createDataFrame([(*pt, i) for i, pt in enumerate(points)], ", ".join(d + " int" for d in dims) + ", v int")
    got = {tuple(r[d] for d in dims): (r["v"], r["d2"]) for r in nearest_points(q, p, dims, ["v"]).collect()}
    assert len(got) == len(set(queries))
    for one in queries:
        want = min((sum((a - b) ** 2 for a, b in zip(one, pt)), pt, i) for i, pt in enumerate(points))
        assert got[one] == (want[2], want[0]), one


def test_plane(spark):
    rng = random.Random(3)
    points = sorted({(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(80)})
    queries = sorted({(rng.randrange(-80, 80), rng.randrange(-80, 80)) for _ in range(300)})
    check(spark, ["x", "z"], queries, points)


def test_space_with_far_points(spark):
    rng = random.Random(4)
    points = sorted({(rng.randrange(0, 30), rng.randrange(0, 12), rng.randrange(0, 30)) for _ in range(60)} | {(900, 5, -700)})
    queries = sorted({(rng.randrange(-20, 60), rng.randrange(0, 12), rng.randrange(-20, 60)) for _ in range(150)}
                     | {(700, 3, -600), (-400, 2, 300)})
    check(spark, ["x", "y", "z"], queries, points)


def test_no_points_gives_nulls(spark):
    q = spark.createDataFrame([(1, 2)], "x int, z int")
    p = spark.createDataFrame([], "x int, z int, v int")
    assert nearest_points(q, p, ["x", "z"], ["v"]).first()["v"] is None


def test_holes_are_filled_and_marked(spark):
    g = spark.createDataFrame([(x, z, None if (x, z) == (1, 1) else 10 * x + z) for x in range(3) for z in range(3)],
                              "x int, z int, height int")
    rows = {(r["x"], r["z"]): (r["height"], r["valid"]) for r in nearest_valid(g).collect()}
    assert rows[(1, 1)] == (1, False) and rows[(2, 2)] == (22, True)


@pytest.mark.parametrize("share", [0.02, 0.5, 1.0])
def test_holes_take_the_closest_cell(spark, share):
    rng = random.Random(9)
    cells = {(x, z): rng.randrange(1000) if rng.random() < share else None for x in range(-20, 21) for z in range(-15, 18)}
    if share == 0.5:
        cells |= {(x, z): None for x in range(-10, 11) for z in range(-9, 9)}
    g = spark.createDataFrame([(x, z, h) for (x, z), h in cells.items()], "x int, z int, height int")
    got = {(r["x"], r["z"]): (r["height"], r["valid"]) for r in nearest_valid(g).collect()}
    points = [(p, h) for p, h in cells.items() if h is not None]
    for (x, z), h in cells.items():
        want = min(((px - x) ** 2 + (pz - z) ** 2, px, pz, v) for (px, pz), v in points)[3]
        assert got[x, z] == (want, h is not None)


def test_no_valid_cell_gives_nulls(spark):
    g = spark.createDataFrame([(x, 0, None) for x in range(3)], "x int, z int, height int")
    assert [tuple(r) for r in nearest_valid(g).orderBy("x").collect()] == [(x, 0, None, False) for x in range(3)]


def test_near_points_need_no_envelopes(monkeypatch):
    rng = np.random.default_rng(5)
    points = np.argwhere(rng.random((40, 8, 40)) < 0.1)
    queries = np.argwhere(rng.random((40, 8, 40)) < 0.2) + (0, 0, 1)
    queries = queries[rng.permutation(len(queries))]
    want = envelope.nearest_by_envelopes(queries, points)
    assert (envelope.nearest_in_box(queries, points) == want).all()

    def refuse(*_):
        raise AssertionError("whole block searched")
    d2 = ((queries - points[want]) ** 2).sum(axis=1)
    monkeypatch.setattr(envelope, "lower_envelope", refuse)
    near = d2 <= envelope.NEAR ** 2
    assert (envelope.nearest_in_box(queries[near], points) == want[near]).all()


def test_work_of_a_hole_is_its_own_distance(monkeypatch):
    """One wide hole beside thousands of single ones: only its cells look far."""
    n, looked, where = 40_000, [], np.where
    z = np.arange(n)
    valid = (z % 2 == 0) & ((z < 20_000) | (z > 20_400))
    table = pa.table({"x": pa.array(np.zeros(n), pa.int32()), "z": pa.array(z, pa.int32()), "valid": valid,
                      "source": pa.array(np.zeros(n), pa.int32(), mask=~valid), "height": pa.array(z, pa.int32(), mask=~valid)})
    monkeypatch.setattr(nearest.np, "where", lambda c, *rest: looked.append(len(c)) or where(c, *rest))
    out = nearest._along_columns("height")(table)
    assert sum(looked) < 100 * n
    got = dict(zip(out.column("z").to_pylist(), out.column("height").to_pylist()))
    assert got[1] == 0 and got[20_100] == 19_998 and got[20_399] == 20_402 and len(got) == n - valid.sum()
