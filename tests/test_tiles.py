import pytest
from pyspark.sql import functions as F

from blockstrata.operators import objects as O
from blockstrata.operators import tiles as T


def extents(spark, *sizes):
    return spark.createDataFrame([(i, w, d) for i, (w, d) in enumerate(sizes)], "extent_id int, width int, depth int")


@pytest.mark.parametrize("total,n,widths", [(100, 5, {20}), (1040, 6, {173, 174})])
def test_axis_split_is_balanced(spark, total, n, widths):
    rows = T.axis_split(extents(spark, (total, 1)), "width", n).orderBy("no").collect()
    assert len(rows) == n and rows[0]["start"] == 0 and rows[-1]["end"] == total
    assert {r["end"] - r["start"] for r in rows} == widths
    assert all(a["end"] == b["start"] for a, b in zip(rows, rows[1:]))


# width, depth, section, components
PLANS = [(90, 130, 15, 54), (240, 346, 15, 384), (512, 512, 31, 289), (256, 256, 15, 324), (720, 1040, 63, 204)]


def test_component_plans(spark):
    got = {(r["width"], r["depth"]): (r["section"], r["cx"] * r["cy"])
           for r in T.plan_tile_components(extents(spark, *[p[:2] for p in PLANS])).collect()}
    assert got == {(w, d): (s, n) for w, d, s, n in PLANS}


def test_tile_grid(spark):
    e = extents(spark, (720, 1040))
    assert T.plan_tile_grid(e, 768).first()["tiles"] == 2
    assert T.plan_tile_grid(e, 0).first()["tiles"] == 1


def test_height_codes(spark):
    df = spark.createDataFrame([(0,), (32768,), (65535,)], "v int")
    got = [r[0] for r in df.orderBy("v").select(T.decode_height(F.col("v"), 100.0, 0.0)).collect()]
    assert got == [-25600.0, 0.0, 25599.21875]
    h = spark.range(0, 200).select((F.col("id") / 1.7).alias("h"))
    code = T.encode_height(F.col("h"), 0.0, 120.0)
    back = T.decode_height(code, T.z_scale_cm(120.0), T.z_offset_cm(0.0, 120.0)) / 100
    # half a code step, plus the one step by which 512 scale units exceed 65535 codes
    assert h.agg(F.max(F.abs(back - F.col("h")))).first()[0] <= 1.5 * 120 / 65535


def ramp(spark, n):
    return spark.createDataFrame([(x, z, x) for x in range(n) for z in range(n)], "x int, z int, height int")


def one_tile(spark, n, size):
    return spark.createDataFrame([("a", 0, 0, n, n, size, size)],
                                 "tile string, x0 int, z0 int, width int, depth int, size_x int, size_y int")


def test_resample_uses_every_source_cell_in_order(spark):
    line = [r["h"] for r in T.resample_to_grid(one_tile(spark, 20, 32), ramp(spark, 20)).filter("row = 0").orderBy("col").collect()]
    assert line[0] == 0 and line == sorted(line) and set(line) == {float(i) for i in range(20)}


def test_resample_refuses_a_smaller_grid(spark):
    with pytest.raises(Exception, match="smaller than the field"):
        T.resample_to_grid(one_tile(spark, 20, 16), ramp(spark, 20)).collect()


def test_overlap_tiles_cover(spark):
    for total in (50, 64, 65, 200, 333):
        rows = T.overlap_tiles(extents(spark, (total, 1)), "width", 64, 8).orderBy("start").collect()
        covered = set()
        for r in rows:
            covered |= set(range(r["start"], r["end"]))
        assert covered == set(range(total))


def test_ground_plane_of_a_slope(spark):
    g = spark.createDataFrame([(x, z, 5 + 0.2 * x + 0.35 * z) for x in range(-20, 21) for z in range(-20, 21)],
                              "x int, z int, height double")
    o = spark.createDataFrame([(1, 3.7, -4.2)], "component int, cx double, cz double")
    p = O.pose_from_normal(O.ground_plane(o, g)).first()
    assert abs(p["slope_x"] - 0.2) < 1e-9 and abs(p["slope_z"] - 0.35) < 1e-9
    assert abs(p["ground_y"] - (5 + 0.2 * 3 + 0.35 * -4)) < 1e-9 and p["normal_y"] > 0


def test_spawn_sightline_is_blocked_by_a_wall(spark):
    rows = [(x, z, 4) for x in range(0, 60) for z in range(-3, 4)]
    tops = spark.createDataFrame([(x, z, 20 if x == 31 else t) for x, z, t in rows], "x int, z int, top int")
    cand = spark.createDataFrame([(15, 0, 4, 40.0, 0.0, 40.0, True), (45, 0, 4, 40.0, 0.0, 40.0, True)],
                                 "x int, z int, top int, dx double, dz double, dist double, ok_field boolean")
    seen = {r["x"]: r["ok_sight"] for r in O.sightline(cand, tops).collect()}
    assert seen == {15: False, 45: True}


def test_extents_beyond_the_limit_have_a_reason(spark):
    big = 64 * 127
    rows = {r["width"]: r for r in T.plan_tile_components(extents(spark, (big, 200), (big + 1, 200), (700, 700))).collect()}
    assert (rows[big]["section"], rows[big]["cx"], rows[big]["reason"]) == (127, 64, None)
    assert (rows[big + 1]["section"], rows[big + 1]["cx"], rows[big + 1]["err_x"]) == (None, None, None) and "64" in rows[big + 1]["reason"]
    assert rows[700]["reason"] is None
    lines = T.grid_candidates(extents(spark, (big + 1, 5)), most=64).collect()
    assert len(lines) == 1 and lines[0]["section"] is None and "64" in lines[0]["reason"]
    assert T.plan_tile_components(extents(spark, (big + 1, 200)), most=100).first()["cx"] == 65
    grids = {r["width"]: r["tiles"] for r in T.plan_tile_grid(extents(spark, (big * 3, 1000), (5 * 10 ** 6, 1000)), 10 ** 4).collect()}
    assert grids[big * 3] == 3 and grids[5 * 10 ** 6] is None
