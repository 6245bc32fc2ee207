"""Objects: groups of connected voxels with class, extent, pose and seat."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules
from ..session import cut_lineage
from . import components as K
from . import rasters
from .census import n_rows
from .nearest import nearest_points
from .neighbors import neighborhood_range
from .ranking import percentile_of, sorted_counts, weighted_mean
from .columns import spread
from .voxels import corners, filter_labels, floor_div


def extents():
    return [f(c).alias(f"{n}_{c}") for c in ("x", "y", "z") for f, n in ((F.min, "min"), (F.max, "max"))]


def object_class(veg_frac, struct_frac, height, footprint):
    plant = F.when(height >= 4, "tree").otherwise("plant")
    built = F.when((footprint >= 25) & (height >= 3), "building").otherwise("structure")
    return (F.when(veg_frac > 0.55, plant).when(struct_frac > 0.5, built)
            .when(veg_frac > 0.2, plant).otherwise("prop"))


def component_composition(members: DataFrame) -> DataFrame:
    """Voxels, label shares, size and class per component. One aggregation
    without Python; partial sums absorb components of any size."""
    def share(label):
        return (F.count_if(F.col("label") == label) / F.count(F.lit(1)))

    g = members.groupBy("component").agg(
        n_rows("voxels"), share("VEGETATION").alias("veg"), share("STRUCTURE").alias("struct"),
        share("GLASS").alias("glass"), share("PROP").alias("prop"), *extents(),
        *[F.sum(c).alias("sum_" + c) for c in "xyz"],
        *[F.sum(F.col(a).cast("bigint") * F.col(b)).alias(a + b) for a, b in ("xx", "zz", "xz")])
    height = F.col("max_y") - F.col("min_y") + 1
    footprint = (F.col("max_x") - F.col("min_x") + 1) * (F.col("max_z") - F.col("min_z") + 1)
    return (g.withColumn("height", height).withColumn("footprint", footprint)
            .withColumn("class", object_class(F.col("veg"), F.col("struct"), F.col("height"), F.col("footprint")))
            .withColumn("yaw_deg", principal_yaw()))


def principal_yaw():
    """Direction of the long footprint axis in (-90, 90], from exact integer
    moments; 0 for fewer than four voxels or a footprint without a long axis."""
    n = F.col("voxels")

    def moment(ab, a, b):
        return (n * F.col(ab) - F.col("sum_" + a) * F.col("sum_" + b)).cast("double")

    cxx, czz, cxz = moment("xx", "x", "x"), moment("zz", "z", "z"), moment("xz", "x", "z")
    angle = F.degrees(0.5 * F.atan2(2.0 * cxz, czz - cxx))
    angle = F.when(angle <= -90, angle + 180).otherwise(angle)
    round_ = (n < 4) | ((cxz == 0) & (czz == cxx))
    return F.when(round_, 0.0).otherwise(F.round(angle, 2))


def component_drop_stats(composition: DataFrame, min_blocks=12, max_blocks=20000) -> DataFrame:
    small, large = F.col("voxels") < min_blocks, F.col("voxels") > max_blocks
    return composition.agg(
        n_rows("components_seen"), F.count_if(small).alias("dropped_small"),
        F.count_if(large).alias("dropped_large"),
        F.sum(F.when(large, F.col("voxels")).otherwise(0)).alias("dropped_large_voxels"))


def object_components(solid: DataFrame, labels=V.OBJECT_LABELS, pitch=1, offsets=K.FACES_3D) -> DataFrame:
    return K.components_on_lattice(filter_labels(solid, wanted=labels), pitch, offsets)


def _on_patches(objects, grid, radius, height, schema, emit):
    """``emit(components, dx, dz, heights)`` for the objects of each raster block:
    heights is objects x cells of a patch, NaN where the grid has none. Grid
    cells move once, with a halo; nothing is repeated per object."""
    R = rasters
    homes = objects.select("component", F.col("cx").cast("int").alias("px"), F.col("cz").cast("int").alias("pz"))
    homes = homes.withColumns({"bx": floor_div(F.col("px"), R.BLOCK), "bz": floor_div(F.col("pz"), R.BLOCK)})
    cells = R.with_halo(grid.select("x", "z", F.col(height).cast("double").alias("h")), radius)

    def run(key, asked, held):
        if not asked.num_rows or not held.num_rows:
            return emit(asked.column("component").slice(0, 0), *np.zeros((2, 1), dtype=np.int64), np.zeros((0, 1)))
        bx, bz = (k.as_py() * R.BLOCK - radius for k in key)
        side = R.BLOCK + 2 * radius
        h = np.full((side, side), np.nan)
        h[held.column("x").to_numpy() - bx, held.column("z").to_numpy() - bz] = held.column("h").to_numpy()
        dx, dz = (d.ravel() - radius for d in np.indices((2 * radius + 1,) * 2))
        at = asked.column("px").to_numpy() - bx, asked.column("pz").to_numpy() - bz
        return emit(asked.column("component"), dx, dz, h[at[0][:, None] + dx, at[1][:, None] + dz])
    schema = f"component {homes.schema['component'].dataType.simpleString()}, {schema}"
    return spread(homes, "bx", "bz").groupBy("bx", "bz").cogroup(spread(cells, "bx", "bz").groupBy("bx", "bz")).applyInArrow(run, schema)


def patch_join(objects: DataFrame, grid: DataFrame, radius=6, height="height") -> DataFrame:
    """Grid cells within ``radius`` of each object on both axes, as offsets."""
    def emit(components, dx, dz, h):
        i, k = np.nonzero(~np.isnan(h))
        return pa.table({"component": components.take(pa.array(i)), "dx": pa.array(dx[k], pa.int32()), "dz": pa.array(dz[k], pa.int32()), "h": pa.array(h[i, k])})
    return _on_patches(objects, grid, radius, height, "dx int, dz int, h double", emit)


PATCH_SUMS = ["n", "sx", "sz", "sxx", "szz", "sxz", "sh", "sxh", "szh", "wx", "wz"]


def patch_sums(objects: DataFrame, grid: DataFrame, radius=6, height="height") -> DataFrame:
    """Moments of each object's patch: cells, sums of offsets and heights and of their products, and its widths."""
    def emit(components, dx, dz, h):
        held = ~np.isnan(h)
        rows = np.flatnonzero(held.any(axis=1))
        held, h = held[rows], np.where(held, h, 0.0)[rows]
        one = held.astype(np.float64)
        sums = [one.sum(axis=1), one @ dx, one @ dz, one @ (dx * dx), one @ (dz * dz), one @ (dx * dz), h.sum(axis=1), h @ dx, h @ dz]
        wide = [np.where(held, d, -radius).max(axis=1, initial=-radius) - np.where(held, d, radius).min(axis=1, initial=radius) for d in (dx, dz)]
        return pa.table({"component": components.take(pa.array(rows))} | {n: pa.array(np.asarray(v, dtype=np.float64)) for n, v in zip(PATCH_SUMS, sums + wide)})
    return _on_patches(objects, grid, radius, height, ", ".join(f"{n} double" for n in PATCH_SUMS), emit)


def ground_plane(objects: DataFrame, grid: DataFrame, radius=6, height="height") -> DataFrame:
    """Least-squares plane through the grid cells around each object.

    Coordinates are taken relative to the object, so the sums stay small and
    the plane's value at the object is its constant term. Objects whose patch
    is narrower than two cells get no row.
    """
    m = patch_sums(objects, grid, radius, height).filter("wx >= 1 AND wz >= 1")

    def c(ab, a, b):
        return F.col(ab) - F.col(a) * F.col(b) / F.col("n")

    cxx, czz, cxz = c("sxx", "sx", "sx"), c("szz", "sz", "sz"), c("sxz", "sx", "sz")
    cxh, czh = c("sxh", "sx", "sh"), c("szh", "sz", "sh")
    det = cxx * czz - cxz * cxz
    m = (m.withColumn("slope_x", (cxh * czz - czh * cxz) / det)
         .withColumn("slope_z", (czh * cxx - cxh * cxz) / det)
         .withColumn("ground_y", (F.col("sh") - F.col("slope_x") * F.col("sx")
                                  - F.col("slope_z") * F.col("sz")) / F.col("n")))
    ln = F.sqrt(F.col("slope_x") * F.col("slope_x") + F.col("slope_z") * F.col("slope_z") + 1.0)
    return m.select("component", "slope_x", "slope_z", "ground_y",
                    (-F.col("slope_x") / ln).alias("normal_x"), (1.0 / ln).alias("normal_y"),
                    (-F.col("slope_z") / ln).alias("normal_z"), (-1.0 / ln).alias("normal_down"))


def pose_from_normal(df: DataFrame) -> DataFrame:
    """Tilt about both ground axes from the upward normal, in degrees."""
    return df.withColumn("tilt_x", F.degrees(F.atan2(-F.col("normal_z"), F.col("normal_y")))) \
             .withColumn("tilt_z", F.degrees(F.atan2(F.col("normal_x"), F.col("normal_y"))))


def extract_instances(solid: DataFrame, grid: DataFrame, min_blocks=12, max_blocks=None) -> DataFrame:
    """Placed objects: class, centre, yaw and rest on the local ground."""
    comp = component_composition(object_components(solid)) \
        .filter((F.col("voxels") >= min_blocks) & (F.lit(max_blocks is None) | (F.col("voxels") <= F.lit(max_blocks)))) \
        .withColumn("cx", F.col("sum_x") / F.col("voxels")).withColumn("cz", F.col("sum_z") / F.col("voxels")) \
        .withColumn("cy", F.col("sum_y") / F.col("voxels"))
    placed = pose_from_normal(comp.join(ground_plane(comp, grid), "component", "left"))
    return placed.withColumn("ground_y", F.coalesce("ground_y", F.col("min_y").cast("double"))) \
        .withColumn("tilt_x", F.coalesce("tilt_x", F.lit(0.0))) \
        .withColumn("tilt_z", F.coalesce("tilt_z", F.lit(0.0)))


def model_recipe(objects: DataFrame) -> DataFrame:
    """Stand-in shape of each object, sized by its height and footprint."""
    def pick(i):
        table = {k: v[i] for k, v in V.RECIPES.items()}
        return F.coalesce(rules.literal_map(table)[F.col("class")], F.lit(table["unknown"]).cast("string"))

    def at_least_one(c):
        return F.greatest(F.col(c), F.lit(1))

    return (objects.withColumn("primitive", pick(0))
            .withColumn("height_cm", at_least_one("height") * V.BLOCK_CM)
            .withColumn("radius_cm", F.sqrt(at_least_one("footprint")) * V.BLOCK_CM * 0.75)
            .withColumn("asset", F.concat_ws(":", F.lit("builtin"), "class", "primitive")))


def instance_scale(recipes: DataFrame) -> DataFrame:
    width = 2.0 * F.col("radius_cm") / 100.0
    side = F.when(F.col("primitive") == "box", F.greatest(F.lit(0.2), width)) \
        .otherwise(F.greatest(F.lit(0.1), width))
    return recipes.withColumn("scale_xy", side) \
        .withColumn("scale_z", F.greatest(F.lit(0.1), F.col("height_cm") / 100.0))


# fixed values: draw distances in cm, start and end per object class
CULL_BANDS = {"tree": (30000, 42000), "building": (40000, 55000), "structure": (20000, 30000),
              "plant": (6000, 9000), "prop": (10000, 14000)}
CULL_DEFAULT = (12000, 16000)


def cull_band(df: DataFrame) -> DataFrame:
    def pick(i):
        return F.coalesce(rules.literal_map({k: v[i] for k, v in CULL_BANDS.items()})[F.col("class")].cast("int"),
                          F.lit(CULL_DEFAULT[i]))
    return df.withColumn("cull_start", pick(0)).withColumn("cull_end", pick(1))


def asset_tokens(files: DataFrame) -> DataFrame:
    """First file, in name order, of every word in a model file name."""
    stem = F.lower(F.regexp_extract("file", r"^(.*)\.[^.]*$", 1))
    ext = F.lower(F.regexp_extract("file", r"(\.[^.]*)$", 1))
    words = files.filter(ext.isin(V.ASSET_EXTENSIONS)) \
        .select("file", F.explode(F.split(F.replace(stem, F.lit("-"), F.lit("_")), "_")).alias("token"))
    return words.filter("token <> ''").groupBy("token").agg(F.min("file").alias("asset"))


def asset_token_match(objects: DataFrame, files: DataFrame) -> DataFrame:
    classes = objects.select(F.col("class").alias("token")).distinct()
    # at most one row per class is left, however many files there are
    known = asset_tokens(files).join(classes, "token", "left_semi")
    return objects.join(known, objects["class"] == known["token"], "left").drop("token")


# --- buildings and trees ----------------------------------------------------

def column_tops(solid: DataFrame, grid: DataFrame) -> DataFrame:
    """Top height, top role and highest terrain of every grid cell, -1 for none."""
    cols = solid.groupBy("x", "z").agg(
        F.max("y").alias("top"), F.max_by("role", "y").alias("top_role"),
        F.max(F.when(F.col("role") == "terrain", F.col("y"))).alias("terrain_top"))
    return grid.join(cols, ["x", "z"], "left").select(
        "x", "z", F.coalesce("top", F.lit(-1)).alias("top"), F.coalesce("top_role", F.lit("empty")).alias("top_role"),
        F.coalesce("terrain_top", F.lit(-1)).alias("terrain_top"))


def flatness(tops: DataFrame) -> DataFrame:
    g = neighborhood_range(tops, "top", 2, -99)
    return g.withColumn("flat", (F.col("top_role") == "structure") & (F.col("spread") <= 1))


def terrain_height(tops: DataFrame, pave_max_above=2) -> DataFrame:
    """Highest ground per column; flat paving close above it counts as ground."""
    g = flatness(tops)
    paved = F.col("flat") & (F.col("terrain_top") >= 0) & (F.col("top") > F.col("terrain_top")) \
        & (F.col("top") <= F.col("terrain_top") + pave_max_above)
    return g.withColumn("terrain_h", F.when(paved, F.col("top")).otherwise(F.col("terrain_top")))


def wall_core(solid: DataFrame, terrain: DataFrame, wall_rise=3) -> DataFrame:
    """Object voxels that stand clear of the ground in their column."""
    objects = solid.filter(F.col("role").isin("structure", "detail"))
    return objects.join(terrain.select("x", "z", "terrain_h"), ["x", "z"]) \
        .filter(F.col("y") > F.col("terrain_h") + wall_rise).drop("terrain_h")


def nearest_core_label(voxels: DataFrame, core: DataFrame) -> DataFrame:
    """Every voxel takes the component of the closest core voxel."""
    rest = cut_lineage(voxels.join(core, ["x", "y", "z"], "left_anti"))
    grown = nearest_points(rest, core, ["x", "y", "z"], ["component"])
    return core.select("x", "y", "z", "component").unionByName(grown.select("x", "y", "z", "component"))


def segment_buildings(solid: DataFrame, terrain: DataFrame, wall_rise=3) -> DataFrame:
    """Building of every structure and detail voxel: (x, y, z, component)."""
    core = cut_lineage(K.connected_components(wall_core(solid, terrain, wall_rise), K.FACES_3D))
    objects = solid.filter(F.col("role").isin("structure", "detail")).select("x", "y", "z")
    return nearest_core_label(objects, core)


def object_summary(members: DataFrame, min_blocks=1) -> DataFrame:
    """Blocks, box, rounded-down middle, centroid and top of each object."""
    g = members.groupBy("component").agg(n_rows("blocks"), *extents(),
                                         *[F.round(F.avg(c), 6).alias("mean_" + c) for c in "xyz"])
    for c in "xyz":
        g = g.withColumn("centre_" + c, F.floor((F.col("min_" + c) + F.col("max_" + c)) / 2).cast("int"))
    return g.filter(F.col("blocks") >= min_blocks)


def segment_trees(solid: DataFrame, min_blocks=12) -> DataFrame:
    plants = solid.filter("role = 'vegetation'")
    return object_summary(K.connected_components(plants, K.HALF_26), min_blocks)


def fill_ratio(members: DataFrame) -> DataFrame:
    s = object_summary(members)
    box = None
    for c in "xyz":
        side = F.col("max_" + c) - F.col("min_" + c) + 1
        box = side if box is None else box * side
    return s.select("component", "blocks", F.round(F.col("blocks") / box, 6).alias("fill"))


def sample_height_at(objects: DataFrame, grid: DataFrame, bounds: DataFrame, height="smooth") -> DataFrame:
    """Ground height at each object's middle, clamped into the grid."""
    x0, x1, z0, z1 = corners(bounds)
    at = objects.withColumn("x", F.least(F.greatest("centre_x", x0), x1)) \
                .withColumn("z", F.least(F.greatest("centre_z", z0), z1))
    return at.join(grid.select("x", "z", F.col(height).alias("ground_y")), ["x", "z"]) \
        .withColumn("drop", F.col("min_y") - F.col("ground_y")).drop("x", "z")


def detail_components(solid: DataFrame) -> DataFrame:
    """Detail voxels with their component, each with the kind of its block."""
    kinds = solid.filter("role = 'detail'").select("name").distinct() \
        .withColumn("kind", rules.detail_kind(F.col("name")))
    detail = solid.filter("role = 'detail'").join(kinds, "name")
    return detail.join(K.connected_components(detail, K.FACES_3D), ["x", "y", "z"])


def mode_per_group(df: DataFrame, group, value, alias) -> DataFrame:
    """Commonest value per group; of equal ones the smallest."""
    counted = df.groupBy(group, value).agg(n_rows("k"))
    return counted.groupBy(group).agg(
        F.min_by(value, F.struct(-F.col("k"), F.col(value))).alias(alias), F.sum("k").alias("blocks"))


def detail_library(detail: DataFrame) -> DataFrame:
    per = mode_per_group(detail, "component", "kind", "kind")
    return per.groupBy("kind").agg(n_rows("components"), F.sum("blocks").alias("blocks"))


def building_of_detail(detail: DataFrame, buildings: DataFrame) -> DataFrame:
    owned = detail.select("x", "y", "z", F.col("component").alias("detail_id")) \
        .join(buildings.withColumnRenamed("component", "building"), ["x", "y", "z"])
    return mode_per_group(owned, "detail_id", "building", "building")


def partition_accounting(members: DataFrame, solid: DataFrame, min_blocks=40) -> DataFrame:
    """Do labelled blocks equal blocks in kept buildings plus fragments?"""
    per = members.join(solid.select("x", "y", "z", "role"), ["x", "y", "z"]).groupBy("component").agg(
        n_rows("blocks"), F.count_if(F.col("role") == "structure").alias("s"),
        F.count_if(F.col("role") == "detail").alias("d"))
    kept = F.col("blocks") >= min_blocks

    def total(c, cond):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))

    return per.agg(F.sum("blocks").alias("labelled"), total("blocks", kept).alias("in_buildings"),
                   total("s", kept).alias("structure"), total("d", kept).alias("detail"),
                   total("blocks", ~kept).alias("unclaimed"), F.count_if(~kept).alias("fragments")) \
        .withColumn("adds_up", (F.col("labelled") == F.col("in_buildings") + F.col("unclaimed"))
                    & (F.col("in_buildings") == F.col("structure") + F.col("detail")))


def seating_stats(seats: DataFrame) -> DataFrame:
    d = seats.select(F.abs("drop").cast("double").alias("d"))
    return sorted_counts(d, "d").agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("objects"), F.round(weighted_mean("d"), 6).alias("mean_abs"),
        F.round(percentile_of("d", 0.95), 6).alias("p95_abs"), F.round(F.max("d"), 6).alias("max_abs"))


# --- spawn search -----------------------------------------------------------

def spawn_candidates(solid: DataFrame, grid: DataFrame, center: DataFrame) -> DataFrame:
    """Every inner grid cell with the outcome of each test, first to last."""
    from .neighbors import box_max
    bit = F.expr("shiftleft(1L, least(y, 62))")
    cols = solid.groupBy("x", "z").agg(
        F.max("y").alias("top"), F.bit_or(bit).alias("levels"),
        F.max(F.col("name").endswith("_wool").cast("int")).alias("wool"))
    g = grid.join(cols, ["x", "z"], "left").fillna({"top": -1, "levels": 0, "wool": 0})
    g = neighborhood_range(g, "top", 2, -99).drop("spread")
    g = box_max(g, "levels", 2, "near_levels", F.bit_or)
    g = box_max(g, "wool", 16, "near_wool")
    skirt = F.expr("shiftright(near_levels, top + 1) & 3")
    g = g.withColumn("ok_ground", ~F.col("edge") & F.col("top").between(2, 12))
    g = g.withColumn("ok_headroom", F.col("ok_ground") & (skirt == 0))
    # nothing lies above the topmost voxel of a column
    g = g.withColumn("ok_sky", F.col("ok_headroom"))
    g = g.withColumn("ok_field", F.col("ok_sky") & (F.col("near_wool") == 1))
    at = center.select(F.struct("build_x", "build_z")).scalar()
    bx, bz = at["build_x"], at["build_z"]
    g = g.withColumn("dx", bx - F.col("x")).withColumn("dz", bz - F.col("z"))
    dist = F.greatest(F.sqrt(F.col("dx") * F.col("dx") + F.col("dz") * F.col("dz")), F.lit(1.0))
    return g.withColumn("dist", dist).select(
        "x", "z", "top", "dx", "dz", "dist", "ok_ground", "ok_headroom", "ok_sky", "ok_field")


def sightline(candidates: DataFrame, tops: DataFrame) -> DataFrame:
    """Candidates from which the target is in view at head height. The walk
    towards it in steps of two cells ends where the grid ends."""
    steps = (candidates.filter("ok_field")
             .withColumn("step", F.explode(F.sequence(F.lit(2), F.lit(30), F.lit(2))))
             .withColumn("sx", F.rint(F.col("x") + F.col("dx") / F.col("dist") * F.col("step")).cast("int"))
             .withColumn("sz", F.rint(F.col("z") + F.col("dz") / F.col("dist") * F.col("step")).cast("int")))
    seen = tops.select(F.col("x").alias("sx"), F.col("z").alias("sz"), F.col("top").alias("seen_top"))
    walked = steps.join(seen, ["sx", "sz"], "left")
    never = F.lit(1000)
    ends = walked.groupBy("x", "z").agg(
        F.min(F.when(F.col("seen_top").isNull(), F.col("step"))).alias("out"),
        F.min(F.when(F.col("seen_top") > F.col("top") + 2, F.col("step"))).alias("blocked"))
    clear = ends.filter(F.coalesce("blocked", never) >= F.coalesce("out", never)).select("x", "z")
    return candidates.join(clear.withColumn("ok_sight", F.lit(True)), ["x", "z"], "left") \
        .withColumn("ok_sight", F.coalesce("ok_sight", F.lit(False)))


def spawn_search(candidates: DataFrame) -> DataFrame:
    """Funnel counts and the best cell with its heading."""
    t = F.col("top")
    score = F.round(-F.abs(t - 4) * 2.0 - F.abs(F.col("dist") - 140.0) * 0.05 - F.abs(t - 4), 9)
    best = F.min_by(F.struct("x", "z", "top", "dx", "dz", "dist"),
                    F.when(F.col("ok_sight"), F.struct(-score, F.col("x"), F.col("z")))).alias("b")
    names = ["ground", "headroom", "sky", "field", "sight"]
    return candidates.agg(*[F.count_if("ok_" + n).alias(n) for n in names], best).select(
        *names, F.col("b.x").alias("spawn_x"), F.col("b.z").alias("spawn_z"), F.col("b.top").alias("surface_y"),
        F.round(F.degrees(F.atan2("b.dz", "b.dx")), 1).alias("yaw"), F.round("b.dist", 1).alias("distance"))


def surface_asof(columns: DataFrame, solid: DataFrame, max_down=3) -> DataFrame:
    """Family of the highest voxel at or at most max_down below the surface."""
    near = columns.select("x", "z", "h").join(solid.select("x", "y", "z", "family"), ["x", "z"]) \
        .filter(F.col("y").between(F.col("h") - max_down, F.col("h"))) \
        .groupBy("x", "z").agg(F.max_by("family", "y").alias("family"))
    return columns.join(near, ["x", "z"], "left").withColumn("family", F.coalesce("family", F.lit("other")))
