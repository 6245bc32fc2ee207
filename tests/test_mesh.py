import random

import pytest
from pyspark.sql import functions as F

from blockstrata.operators import mesh as M
from blockstrata.operators import stencils as S


def members(spark, points, material=lambda p: "stone"):
    return spark.createDataFrame([(*p, 1, material(p)) for p in sorted(points)],
                                 "x int, y int, z int, object_id int, material string")


def quads(spark, points, cap=4, material=lambda p: "stone", occupied=None):
    m = members(spark, points, material)
    occ = members(spark, occupied) if occupied else m
    return M.greedy_quads(M.exposed_face_rows(m, occ), cap)


def cube(n, at=0):
    return [(x + at, y + at, z + at) for x in range(n) for y in range(n) for z in range(n)]


CASES = [("one voxel", cube(1), 6, 6), ("cube", cube(4), 6, 96), ("two voxels", [(0, 0, 0), (1, 0, 0)], 6, 10),
         ("hollow", [p for p in cube(3, -1) if p != (0, 0, 0)], 12, 60)]


@pytest.mark.parametrize("name,points,count,area", CASES)
def test_counts_and_area(spark, name, points, count, area):
    q = quads(spark, points)
    assert q.count() == count
    v = M.volume_from_quads(q).first()
    assert (v["area"], v["volume"]) == (area, len(points))


def test_cap_and_materials(spark):
    bar = [(x, 0, 0) for x in range(7)]
    counts = [quads(spark, bar, cap).count() for cap in (1, 2, 4, 8)]
    assert counts == sorted(counts, reverse=True) and counts[-1] == 6
    mixed = quads(spark, bar[:5], 8, lambda p: "iron" if p[0] == 2 else "stone")
    cover = mixed.filter("material = 'iron'").agg(F.sum(M.quad_area())).first()[0]
    assert cover == 4


def test_neighbours_of_any_kind_hide_faces(spark):
    assert quads(spark, [(0, 0, 0)], occupied=[(0, 0, 0), (0, -1, 0)]).count() == 5


def test_corners_wind_around_the_outward_normal(spark):
    rng = random.Random(5)
    points = {(rng.randrange(4), rng.randrange(4), rng.randrange(4)) for _ in range(30)}
    corners = M.mesh_quads(quads(spark, points)).collect()
    by_quad = {}
    for r in corners:
        key = (r["axis"], r["sign"], r["plane"], r["r0"], r["c0"], r["r1"], r["c1"])
        by_quad.setdefault(key, {})[r["corner"]] = r
    for q in by_quad.values():
        a, b, c = ([q[i][k] for k in ("ux", "uy", "uz")] for i in range(3))
        u, v = [y - x for x, y in zip(a, b)], [y - x for x, y in zip(a, c)]
        cross = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
        normal = [q[0][k] for k in ("nx", "ny", "nz")]
        assert sum(x * y for x, y in zip(cross, normal)) > 0
        assert sum(abs(x) for x, n in zip(cross, normal) if n == 0) == 0
        assert {(r["u"], r["v"]) for r in q.values()} >= {(0, 0)}


def grid(spark, w, d, height=lambda x, z: 0):
    return spark.createDataFrame([(x, z, float(height(x, z))) for x in range(w) for z in range(d)], "x int, z int, height double")


@pytest.mark.parametrize("w,d,q,v", [(3, 3, 4, 9), (100, 100, 9801, 10000)])
def test_pond_sizes(spark, w, d, q, v):
    mesh = M.liquid_mesh(grid(spark, w, d).select("x", "z"))
    assert mesh.count() == q
    ids = mesh.select(F.explode(F.array("v0", "v1", "v2", "v3")).alias("i")).agg(F.countDistinct("i"), F.max("i")).first()
    assert tuple(ids) == (v, v - 1)


def test_isolated_columns_give_no_quads(spark):
    df = spark.createDataFrame([(0, 0), (2, 0), (0, 2)], "x int, z int")
    assert M.liquid_quads(df).count() == 0


def test_repair_turns_triangles_up(spark):
    tris = M.heightfield_mesh(grid(spark, 6, 6, lambda x, z: (x * 7 + z * 3) % 5))
    stats = M.mesh_stats(M.repair_mesh(tris)).first()
    assert stats["down_facing"] == 0 and stats["degenerate"] == 0 and stats["triangles"] == 50


def test_blur_keeps_constants_and_mass_of_weights(spark):
    flat = S.gaussian_smooth(grid(spark, 9, 9, lambda x, z: 4), 1.4)
    assert flat.agg(F.max(F.abs(F.col("smooth") - 4.0))).first()[0] < 1e-9
    line = S.perona_malik(grid(spark, 8, 8, lambda x, z: 3 * x), 1.0, sweeps=1)
    inner = line.filter("x BETWEEN 2 AND 5").agg(F.max(F.abs(F.col("diffused") - F.col("height")))).first()[0]
    assert inner < 1e-9
