"""Packed words, raster blocks and packs against plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from blockstrata.operators import masks as K
from blockstrata.operators import mesh as M
from blockstrata.operators import neighbors as N
from blockstrata.operators import rasters as R
from blockstrata.operators import stencils as S

STEPS = {"xm": (-1, 0, 0), "xp": (1, 0, 0), "ym": (0, -1, 0), "yp": (0, 1, 0), "zm": (0, 0, -1), "zp": (0, 0, 1)}


def some_cells(seed=1, n=4000):
    rnd = random.Random(seed)
    cells = {(rnd.randrange(-20, 20), rnd.randrange(-3, 6), rnd.randrange(-9, 9)) for _ in range(n)}
    return cells | {(x, 70, z) for x in (-17, -16, -1, 0, 15, 16) for z in (-5, -4, -1, 0, 3, 4)} | {(10 ** 6 + 15, 5, -10 ** 6), (10 ** 6 + 16, 5, -10 ** 6)}


def flags(cells, at):
    return tuple(tuple(a + b for a, b in zip(at, STEPS[f])) in cells for f in K.FLAGS)


def test_flags_of_cells_at_every_border(spark):
    cells = some_cells()
    df = spark.createDataFrame([(*c, "n") for c in cells], "x int, y int, z int, bit string")
    got = {(r["x"], r["y"], r["z"]): tuple(r[f] for f in K.FLAGS) for r in K.with_flags(df).collect()}
    assert got == {c: flags(cells, c) for c in cells}
    assert {(r["x"], r["y"], r["z"]): r["occupied"] for r in N.six_neighbor_occupancy(df).collect()} == {c: sum(flags(cells, c)) for c in cells}
    pairs = sorted((r["x"], r["y"], r["z"], r["axis"]) for r in N.face_neighbors(df).collect())
    assert pairs == sorted((*c, a) for c in cells for a, f in zip("xyz", flags(cells, c)[1::2]) if f)
    faces = sum(6 - sum(flags(cells, c)) for c in cells)
    assert tuple(N.exposed_faces(df).first()) == (len(cells), faces, 2 * faces, 6 * len(cells), 12 * len(cells))


def test_words_hold_their_cells_and_nulls_stay_open(spark):
    cells = some_cells(2)
    df = spark.createDataFrame(list(cells) * 2 + [(None, 1, 1), (1, None, 1)], "x int, y int, z int")
    words = K.packed_words(df)
    assert {tuple(r) for r in K.cells_of(words).collect()} == cells
    odd = [r for r in K.with_flags(df).collect() if r["x"] is None or r["y"] is None]
    assert len(odd) == 2 and not any(r[f] for r in odd for f in K.FLAGS)
    assert N.exposed_faces(df.limit(0)).first()["solid"] == 0 and K.with_flags(df.limit(0)).collect() == []


def test_one_shuffle_of_voxels_and_no_sort(spark):
    df = spark.createDataFrame(list(some_cells(3)), "x int, y int, z int")
    plan = N.exposed_faces(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_faces_of_members_only(spark):
    cells = sorted(some_cells(4))
    members = cells[::3]
    df = spark.createDataFrame([(*c, 7, "m") for c in members], "x int, y int, z int, object_id long, material string")
    got = sorted(tuple(r) for r in M.exposed_face_rows(df, spark.createDataFrame(cells, "x int, y int, z int")).select("axis", "sign", "plane", "row", "col").collect())
    want = []
    for c in members:
        at = dict(zip("xyz", c))
        for f, open_ in zip(K.FLAGS, flags(set(cells), c)):
            if not open_:
                a, b = M.OTHER[f[0]]
                want.append((f[0], 1 if f[1] == "p" else -1, at[f[0]] + (f[1] == "p"), at[a], at[b]))
    assert got == sorted(want)


def grid_of(spark, values, x0=-70, z0=5):
    rows = [(x0 + i, z0 + j, float(v), f"c{i}") for (i, j), v in np.ndenumerate(values)]
    return spark.createDataFrame(rows, "x int, z int, height double, label string")


def array_of(df, column, shape, x0=-70, z0=5):
    out = np.full(shape, np.nan)
    for r in df.collect():
        assert r["label"] == f"c{r['x'] - x0}"
        out[r["x"] - x0, r["z"] - z0] = r[column]
    return out


def test_blocks_give_what_one_array_gives(spark):
    """Sweeps over squares of 8 columns agree with the same sweeps over all cells."""
    v = np.cumsum(np.random.default_rng(1).normal(0, 2, (45, 23)), axis=0)
    df, mask, weights = grid_of(spark, v), np.ones_like(v, dtype=bool), S.gaussian_weights(0.9)
    got = R.on_blocks(df, ["height"], {"a": "double"}, 4, lambda m, a: [R.gauss(a, m, weights)], block=8)
    assert np.allclose(array_of(got, "a", v.shape), R.gauss(v, mask, weights), atol=1e-12)
    got = R.on_blocks(df, ["height"], {"a": "double", "edge": "boolean"}, 6, lambda m, a: [S._diffused(a, m, 1.4, 3, 0.2), R.moved(m, 0, 1, False)], block=8)
    assert np.allclose(array_of(got, "a", v.shape), S._diffused(v, mask, 1.4, 3, 0.2), atol=1e-12)
    assert (array_of(got, "edge", v.shape)[-1] == 0).all()
    padded = np.pad(v, 4, mode="edge")
    rows = sum(w * padded[i:i + v.shape[0], 4:-4] for i, w in enumerate(weights))
    rows = np.pad(rows, ((0, 0), (4, 4)), mode="edge")
    assert np.allclose(R.gauss(v, mask, weights), sum(w * rows[:, i:i + v.shape[1]] for i, w in enumerate(weights)))


def test_far_apart_builds_cost_their_squares(spark):
    df = spark.createDataFrame([(0, 0, 3), (-1_000_000, 5, 4), (1_000_000, 900_000, 9)], "x int, z int, height int")
    grid = R.occupied_grid(df)
    assert grid.count() == 3 * 64 * 64
    smooth = S.edge_preserving_smooth(grid.fillna(1, ["height"]).withColumn("smooth", F.lit("old")))
    got = {(r["x"], r["z"]): r["smooth"] for r in smooth.where("height > 1").collect()}
    assert len(got) == 3 and all(1 < s < 9 for s in got.values())


def test_holes_and_nulls_end_a_line(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (1, 0, None), (2, 0, 5.0), (4, 0, 9.0)], "x int, z int, height double")
    got = {r["x"]: r["smooth"] for r in S.gaussian_smooth(df, 1.0).collect()}
    assert got[1] is None and all(abs(got[x] - v) < 1e-12 for x, v in ((0, 1.0), (2, 5.0), (4, 9.0)))
    assert S.gaussian_smooth(df.limit(0), 1.0).collect() == []
    near = {r["x"]: (r["spread"], r["edge"]) for r in N.neighborhood_range(df.fillna(1.0), "height", 1, -99).collect()}
    assert near[2] == (104, True)
