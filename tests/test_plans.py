"""Plans whose cost has to follow the rows, not the planner's guess of them."""

from blockstrata.operators import assets as A
from blockstrata.operators import columns as L
from blockstrata.operators import mesh as M
from blockstrata.operators import nearest
from blockstrata.operators import objects as O
from blockstrata.operators import tiles as T
from blockstrata.session import cut_lineage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def grid(spark):
    return spark.createDataFrame([(x, z, x + z) for x in range(4) for z in range(3)], "x int, z int, height int")


def test_rows_of_a_grid_are_filled_by_growing_frames_only(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(nearest, "cut_lineage", lambda df: seen.append(df) or df)
    nearest.nearest_valid(grid(spark))
    assert "Window" in plan(seen[0]) and "unboundedfollowing" not in plan(seen[0])


def test_grids_are_not_sent_to_every_worker(spark):
    g = cut_lineage(grid(spark))  # a stored table, small as a file
    bounds = spark.createDataFrame([(0, 3, 0, 2)], "min_x int, max_x int, min_z int, max_z int")
    tiles = spark.createDataFrame([("a", 0, 0, 4, 3, 8, 8)], "tile string, x0 int, z0 int, width int, depth int, size_x int, size_y int")
    for df in (L.on_full_grid(g, bounds), T.resample_to_grid(tiles, g)):
        assert "SortMergeJoin" in plan(df) and "BroadcastHashJoin" not in plan(df)
    assert T.resample_to_grid(tiles, g).count() == 64


def test_chains_are_not_sent_to_every_worker(spark):
    models = spark.createDataFrame([(i, i // 2 if i else None, {"k": str(i)}, 1) for i in range(8)], "node int, up int, textures map<string,string>, depth int")
    models = cut_lineage(models)
    stacked = A._stack(models, models)
    assert "SortMergeJoin" in plan(stacked) and "BroadcastHashJoin" not in plan(stacked)


def test_the_layout_is_sent_not_the_corners(spark):
    corners = spark.createDataFrame([("stone", 0, 1, 0, 1, 0, 0)], "material string, r0 int, r1 int, c0 int, c1 int, u int, v int")
    layout = spark.createDataFrame(M.atlas_layout() * 50, M.LAYOUT_SCHEMA)
    assert "BuildRight" in plan(M.atlas_uv(corners, layout))


def test_extents_of_one_partition_are_dealt_out(spark):
    extents = spark.createDataFrame([(i, 90 + i, 200) for i in range(64)], "extent_id int, width int, depth int").coalesce(1)
    assert T.grid_candidates(extents).rdd.getNumPartitions() > 2


def test_no_seats_are_counted_as_none(spark):
    row = O.seating_stats(spark.createDataFrame([], "drop double")).first()
    assert (row["objects"], row["mean_abs"]) == (0, None)
