"""Counts, extents and shares over voxel tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules
from .ranking import top_per_group
from .voxels import corners, floor_div, with_chunk


def n_rows(name="n"):
    return F.count(F.lit(1)).alias(name)


def block_state_histogram(named: DataFrame) -> DataFrame:
    return named.groupBy("dim", "name", "properties").agg(n_rows())


def dimension_stats(named: DataFrame) -> DataFrame:
    """One row per dimension. Distinct counts run on pre-grouped keys."""
    counts = (named.groupBy("dim").agg(
        n_rows("non_air"), F.min("x").alias("min_x"), F.max("x").alias("max_x"),
        F.min("y").alias("min_y"), F.max("y").alias("max_y"),
        F.min("z").alias("min_z"), F.max("z").alias("max_z")))
    places = (with_chunk(named).withColumn("sy", floor_div(F.col("y"), 16))
              .groupBy("dim", "cx", "cz").agg(F.countDistinct("sy").alias("s")))
    chunks = places.groupBy("dim").agg(
        n_rows("chunks"), F.sum("s").alias("sections"),
        F.countDistinct(floor_div(F.col("cx"), 32), floor_div(F.col("cz"), 32)).alias("regions"))
    states = (named.groupBy("dim", "name", "properties").agg(n_rows("_"))
              .groupBy("dim").agg(F.countDistinct("name").alias("block_types"),
                                  n_rows("block_states")))
    return counts.join(chunks, "dim").join(states, "dim")


def world_rollup(named: DataFrame, bytes_per_voxel=4) -> DataFrame:
    return (named.rollup("dim").agg(n_rows("voxels"))
            .select(F.coalesce("dim", F.lit("total")).alias("dim"), "voxels",
                    (F.col("voxels") * bytes_per_voxel).alias("est_bytes")))


def error_sample(errors: DataFrame, per_region=5, per_dim=20) -> DataFrame:
    """Error count per dimension with a few samples of each region."""
    few = top_per_group(errors, ["dim", "region"], ["seq"], per_region).drop("rank")
    sample = top_per_group(few, ["dim"], ["region", "seq"], per_dim)
    total = errors.groupBy("dim").agg(n_rows("errors"))
    return sample.join(total, "dim")


def world_bounds(df: DataFrame, by=()) -> DataFrame:
    return df.groupBy(*by).agg(*[f(c).alias(f"{n}_{c}") for c in ("x", "y", "z")
                                 for f, n in ((F.min, "min"), (F.max, "max"))])


def biome_histogram(chunks: DataFrame, top=None) -> DataFrame:
    """Ids in ``biomes`` arrays with their counts, or the ``top`` commonest."""
    out = chunks.select(F.explode("biomes").alias("biome")).groupBy("biome").agg(n_rows())
    return out if top is None else out.orderBy(F.desc("n"), "biome").limit(top)


def label_histogram(df: DataFrame, by="label") -> DataFrame:
    return df.groupBy(by).agg(n_rows())


def share_of(df: DataFrame, key, weight=None) -> DataFrame:
    """Weighted count per key with its share of the total."""
    w = F.col(weight) if weight else F.lit(1)
    grouped = df.groupBy(key).agg(F.sum(w).cast("bigint").alias("n"))
    total = grouped.select(F.sum("n")).scalar()
    return grouped.withColumn("share", F.round(F.col("n") / total, 6))


def dominant_properties(states: DataFrame) -> DataFrame:
    """Commonest property text per name; of equal ones the smallest text."""
    counted = states.groupBy("name", "properties").agg(n_rows())
    return counted.groupBy("name").agg(
        F.min_by("properties", F.struct(-F.col("n"), F.col("properties"))).alias("properties"),
        F.max("n").alias("n"))


def cell_buckets(named: DataFrame, cell=512) -> DataFrame:
    return (named.withColumn("cell_x", floor_div(F.col("x"), cell))
            .withColumn("cell_z", floor_div(F.col("z"), cell))
            .groupBy("cell_x", "cell_z", "name").agg(n_rows()))


def bucket_summary(buckets: DataFrame, cap=500_000) -> DataFrame:
    """Cells in use, their extent, groups, instances and component counts."""
    parts = F.ceil(F.col("n") / cap)
    cells = buckets.groupBy("cell_x", "cell_z").agg(
        n_rows("g"), F.sum("n").alias("i"), F.sum(parts).alias("c"))
    return cells.agg(
        n_rows("cells"),
        (F.max("cell_x") - F.min("cell_x") + 1).alias("extent_x"),
        (F.max("cell_z") - F.min("cell_z") + 1).alias("extent_z"),
        F.sum("g").alias("groups"), F.sum("i").alias("instances"),
        F.sum("c").alias("components"))


def column_classes(columns: DataFrame) -> DataFrame:
    """Counts of solid, built and natural columns from their top block."""
    return columns.agg(n_rows("solid"), F.count_if("built").alias("built"),
                       F.count_if("natural").alias("natural")) \
        .withColumn("built_pct", F.round(100.0 * F.col("built")
                                         / F.greatest(F.col("solid"), F.lit(1)), 6))


def cell_density(mask: DataFrame, bounds, cell=32) -> DataFrame:
    """True cells per full cell x cell square; remainders at the far edge are
    left out. ``bounds`` is the one-row extent of the whole grid."""
    x0, x1, z0, z1 = corners(bounds)
    return (mask.withColumn("cell_x", F.floor((F.col("x") - x0) / cell).cast("int"))
            .withColumn("cell_z", F.floor((F.col("z") - z0) / cell).cast("int"))
            .filter((F.col("cell_x") < F.floor((x1 - x0 + 1) / cell))
                    & (F.col("cell_z") < F.floor((z1 - z0 + 1) / cell)))
            .groupBy("cell_x", "cell_z").agg(n_rows())
            .withColumn("fraction", F.col("n") / float(cell * cell)))


def density_diagnostics(density: DataFrame, threshold=0.10) -> DataFrame:
    # a cell holds few distinct counts, so the percentile reads counted values
    counted = density.groupBy("fraction").agg(n_rows("k"))
    return counted.agg(
        F.sum("k").alias("cells_nonzero"), F.round(F.max("fraction"), 6).alias("frac_max"),
        F.round(F.percentile("fraction", F.lit(0.99), F.col("k")), 6).alias("frac_p99"),
        F.round(F.percentile("fraction", F.lit(0.95), F.col("k")), 6).alias("frac_p95"),
        F.sum(F.when(F.col("fraction") >= threshold, F.col("k")).otherwise(0))
        .alias("cells_over_threshold"))


def landmark_group(name):
    bare = rules.strip_ns(name)
    out = None
    for group, names in V.LANDMARK_GROUPS.items():
        hit = bare.isin(names)
        out = F.when(hit, group) if out is None else out.when(hit, group)
    return out


def landmark_groups(named: DataFrame) -> DataFrame:
    """Extent, truncated centroid and commonest names of each material group."""
    placed = named.withColumn("grp", landmark_group(F.col("name"))).filter("grp is not null")
    per_name = placed.groupBy("grp", "name").agg(
        n_rows(), *[F.sum(c).alias(f"sum_{c}") for c in "xyz"],
        *[F.min(c).alias(f"min_{c}") for c in "xyz"],
        *[F.max(c).alias(f"max_{c}") for c in "xyz"])
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("name"))))
    mix = F.array_join(F.transform(F.slice(order, 1, 6),
                                   lambda e: F.concat_ws("=", e["name"], -e["k"])), ",")
    return per_name.groupBy("grp").agg(
        F.sum("n").alias("n"),
        *[(F.sum(f"sum_{c}") / F.sum("n")).cast("int").alias(f"centre_{c}") for c in "xyz"],
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in "xyz"],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in "xyz"],
        mix.alias("mix"))


def landmark_blobs(named: DataFrame, blob=8, top=8, origin=(0, 0)) -> DataFrame:
    """Largest clusters of each material group on a coarse grid."""
    placed = named.withColumn("grp", landmark_group(F.col("name"))).filter("grp is not null")
    blobs = (placed.withColumn("bx", floor_div(F.col("x") - origin[0], blob))
             .withColumn("bz", floor_div(F.col("z") - origin[1], blob))
             .groupBy("grp", "bx", "bz")
             .agg(n_rows(), *[F.avg(c).cast("int").alias(f"mean_{c}") for c in "xyz"],
                  F.max("y").alias("top_y"),
                  (F.max("x") - F.min("x")).alias("span_x"),
                  (F.max("z") - F.min("z")).alias("span_z")))
    return top_per_group(blobs, ["grp"], [F.desc("n"), "bx", "bz"], top)


def building_mass_center_exact(named: DataFrame) -> DataFrame:
    bare = rules.strip_ns(F.col("name"))
    return named.filter(bare.isin(V.LANDMARK_GROUPS["building"])).agg(
        n_rows(), F.avg("x").alias("build_x"), F.avg("z").alias("build_z"))


def building_mass_center(named: DataFrame) -> DataFrame:
    return building_mass_center_exact(named).select(
        "n", F.round("build_x", 6).alias("build_x"), F.round("build_z", 6).alias("build_z"))


def map_symbols(named: DataFrame) -> DataFrame:
    """Map symbol of every block name; the rule runs once per name."""
    symbol = rules.literal_map(V.FAMILY_SYMBOLS)[rules.material_family(F.col("name"))]
    return named.select("name").distinct() \
        .withColumn("symbol", F.coalesce(symbol, F.lit("#")))


def cell_role_mode(named: DataFrame, step=12, origin=(0, 0)) -> DataFrame:
    """Commonest map symbol per cell; ground cover only where nothing else is.
    Of equal symbols the smallest wins."""
    per_name = (named.withColumn("i", floor_div(F.col("x") - origin[0], step))
                .withColumn("j", floor_div(F.col("z") - origin[1], step))
                .groupBy("i", "j", "name").agg(n_rows(), F.max("y").alias("y")))
    counted = (per_name.join(map_symbols(named), "name")
               .groupBy("i", "j", "symbol").agg(F.sum("n").alias("n"), F.max("y").alias("y")))
    rank = F.struct(F.col("symbol").isin("G", "#").cast("int"), -F.col("n"), F.col("symbol"))
    return counted.groupBy("i", "j").agg(F.min_by("symbol", rank).alias("symbol"),
                                         F.max("y").alias("top_y"))


def ascii_map_rows(cells: DataFrame) -> DataFrame:
    """One text line per i, from the lowest j of the map to the highest; cells
    without a symbol show a dot. The line is built from at most one entry per
    cell of the row."""
    ends = cells.agg(F.struct(F.min("j").alias("low"), F.max("j").alias("high"))).scalar()
    row = cells.groupBy("i").agg(F.map_from_entries(
        F.collect_list(F.struct("j", "symbol"))).alias("m")).withColumn("ends", ends)
    return row.select("i", F.array_join(F.transform(
        F.sequence("ends.low", "ends.high"),
        lambda j: F.coalesce(F.col("m")[j], F.lit("."))), "").alias("line"))


def colour_legend(top_blocks: DataFrame) -> DataFrame:
    """Columns per map colour with its commonest block, share and block list."""
    rgb = rules.block_rgb(F.col("name"))
    named = top_blocks.groupBy("name").agg(n_rows()).withColumn("c", rgb)
    total = named.select(F.sum("n")).scalar()
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("name"))))
    return (named.groupBy(F.col("c.r").alias("r"), F.col("c.g").alias("g"), F.col("c.b").alias("b"))
            .agg(F.sum("n").alias("n"), order.alias("o"))
            .select("r", "g", "b", "n", F.get("o", 0)["name"].alias("colour_name"),
                    F.array_join(F.transform("o", lambda e: e["name"]), ",").alias("blocks"),
                    F.round(F.col("n") / total, 6).alias("share")))


def radius_composition(columns: DataFrame, x, z, radius) -> DataFrame:
    near = columns.filter((F.col("x") - x) * (F.col("x") - x)
                          + (F.col("z") - z) * (F.col("z") - z) <= radius * radius)
    return share_of(near, "family")


def union_part_results(parts) -> DataFrame:
    """Merge partial counts and bounds of several regions."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("name").agg(F.sum("n").alias("n"), F.min("min_y").alias("min_y"),
                                   F.max("max_y").alias("max_y"))
