"""Component shapes, the contraction beyond the size check, and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from blockstrata.operators import components as K
from blockstrata.operators.objects import component_composition


def cells(spark, points):
    return spark.createDataFrame(sorted(set(points)), "x int, y int, z int")


def sizes(df):
    return sorted(r["count"] for r in df.groupBy("component").count().collect())


SHELL = [(x, y, z) for x in range(5) for y in range(5) for z in range(5) if 0 in (x, y, z) or 4 in (x, y, z)]
SHAPES = {
    "two blobs": ([(x, 0, 0) for x in (0, 1, 2, 10, 11)], [2, 3]),
    "diagonal": ([(0, 0, 0), (1, 1, 0)], [1, 1]),
    "u": ([(0, 0, 0), (0, 1, 0), (0, 2, 0), (1, 0, 0), (2, 0, 0), (2, 1, 0), (2, 2, 0)], [7]),
    "ring": ([(x, 0, z) for x in range(3) for z in range(3) if (x, z) != (1, 1)], [8]),
    "l": ([(0, 0, 0), (1, 0, 0), (1, 1, 0), (1, 1, 1), (1, 2, 1), (1, 2, 2)], [6]),
    "shell": (SHELL, [98]),
    "negative coordinates": ([(0, 1, -225), (1, 0, 0), (300, 0, 300)], [1, 1, 1]),
    "across blocks": ([(x, 0, 0) for x in range(-200, 200)], [400]),
    "across squares": ([(x, 0, z) for x in range(-1100, 2200) for z in (0,)] + [(5, 0, z) for z in range(1, 1100)], [3300 + 1099]),
    "only across squares": ([(1023, 0, 5), (1024, 0, 5), (1023, 0, 1030), (1024, 0, 1030)], [2, 2]),
    "below zero": ([(0, -1, 0), (0, 511, -1), (0, 511, 0), (0, 0, 1)], [1, 1, 2]),
    "ends of the range": ([(63, -1024, 5), (64, 1023, 4), (0, 1023, 0), (0, -1024, 1)], [1, 1, 1, 1]),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(spark, name):
    points, want = SHAPES[name]
    assert sizes(K.connected_components(cells(spark, points))) == want


def test_corners_across_blocks_with_all_neighbours(spark):
    points = [(63, 0, 5), (64, 511, 4), (63, 1023, 63), (64, 1023, 64), (127, -1024, 64), (128, -1023, 65)]
    assert sizes(K.connected_components(cells(spark, points), K.HALF_26)) == [1, 1, 2, 2]


def test_out_of_range_is_an_error(spark):
    with pytest.raises(Exception, match="out of range"):
        K.connected_components(cells(spark, [(0, 1024, 0)])).collect()


def test_pitch(spark):
    points = [(0, 0, 0), (1, 0, 0), (8, 0, 0), (9, 0, 0)]
    got = K.components_on_lattice(cells(spark, points), pitch=2)
    assert sizes(got) == [2, 2]


def brute(points, offsets):
    parent = {p: p for p in points}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for p in points:
        for o in offsets:
            q = tuple(a + b for a, b in zip(p, o))
            if q in parent:
                parent[find(p)] = find(q)
    count = {}
    for p in points:
        count[find(p)] = count.get(find(p), 0) + 1
    return sorted(count.values())


@pytest.mark.parametrize("few", [0, K.FEW])
@pytest.mark.parametrize("offsets", [K.FACES_3D, K.HALF_26])
def test_against_brute_force(spark, offsets, few, monkeypatch):
    monkeypatch.setattr(K, "FEW", few)
    rng = random.Random(7)
    n, span = (2600, 10) if offsets is K.HALF_26 else (5200, 10)
    points = {(rng.randrange(-span * 7, span * 7), rng.randrange(4), rng.randrange(-span, span)) for _ in range(n)}
    got = K.connected_components(cells(spark, points), offsets)
    assert sizes(got) == brute(points, offsets)


def test_hub_graph_contracts(spark, monkeypatch):
    monkeypatch.setattr(K, "FEW", 0)
    """A star whose centre has a third of all edges, and a long path."""
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(800)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["comp"] for r in K.contract_stars(df).collect()}
    assert len(got) == 399 + 800
    assert {v for k, v in got.items() if k < 1000} == {0}
    assert {v for k, v in got.items() if k >= 1000} == {1000}


def test_yaw_follows_the_long_axis(spark):
    def yaw(points):
        df = cells(spark, points).withColumn("component", F.lit(0)).withColumn("label", F.lit("PROP"))
        return component_composition(df).first()["yaw_deg"]

    assert yaw([(0, 0, z) for z in range(6)]) == 0.0
    assert yaw([(x, 0, 0) for x in range(6)]) == 90.0
    assert yaw([(i, 0, i) for i in range(6)]) == 45.0
    assert yaw([(-i, 0, i) for i in range(6)]) == -45.0
    assert yaw([(0, 0, 0), (1, 0, 0), (2, 0, 0)]) == 0.0
