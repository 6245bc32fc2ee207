"""Voxel tables: words, coordinates, filters and palette joins.

A voxel table has one row per block: x, y, z and palette_id. A palette table
has one row per block state: palette_id, name, properties.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules


def floor_div(col, size):
    """Cell number that rounds down for negative coordinates as well."""
    return F.floor(col / size).cast("int")


def corners(bounds: DataFrame):
    """min_x, max_x, min_z, max_z of a one-row extent, as one subquery."""
    box = bounds.select(F.struct("min_x", "max_x", "min_z", "max_z")).scalar()
    return [box[c] for c in ("min_x", "max_x", "min_z", "max_z")]


def with_chunk(df: DataFrame) -> DataFrame:
    return df.withColumn("cx", floor_div(F.col("x"), 16)) \
             .withColumn("cz", floor_div(F.col("z"), 16))


def voxel_word_fields(df: DataFrame, word="word") -> DataFrame:
    w = F.col(word).cast("bigint")

    def field(shift, mask):
        return F.shiftrightunsigned(w, shift).bitwiseAND(mask).cast("int")

    return (df.withColumn("dx", field(0, 15)).withColumn("dz", field(4, 15))
            .withColumn("y", field(8, V.MAX_VOXEL_Y))
            .withColumn("local_index", field(17, V.MAX_LOCAL_INDEX)))


def pack_voxel_word(df: DataFrame) -> DataFrame:
    """Add ``word``; rows whose fields do not fit get null and ``overflow``."""
    over = ~(F.col("y").between(0, V.MAX_VOXEL_Y)
             & F.col("local_index").between(0, V.MAX_LOCAL_INDEX))

    def big(c):
        return F.col(c).cast("bigint")

    word = (big("dx").bitwiseOR(F.shiftleft(big("dz"), 4))
            .bitwiseOR(F.shiftleft(big("y"), 8))
            .bitwiseOR(F.shiftleft(big("local_index"), 17)))
    return df.withColumn("overflow", over).withColumn("word", F.when(~over, word))


def world_coords(df: DataFrame) -> DataFrame:
    return df.withColumn("x", F.col("cx") * 16 + F.col("dx")) \
             .withColumn("z", F.col("cz") * 16 + F.col("dz"))


def air_ids(palette: DataFrame) -> DataFrame:
    return palette.filter(F.col("name").isin(V.AIR_NAMES)).select("palette_id")


def drop_air(voxels: DataFrame, palette: DataFrame) -> DataFrame:
    return voxels.join(air_ids(palette), "palette_id", "left_anti")


def clip_bbox(df: DataFrame, x=None, y=None, z=None) -> DataFrame:
    for name, span in (("x", x), ("y", y), ("z", z)):
        if span is not None:
            df = df.filter(F.col(name).between(*span))
    return df


def prune_chunks(df: DataFrame, x, z) -> DataFrame:
    """Keep rows of chunks that overlap the box. The bounds are compared with cx
    and cz as they are, so a stored table with these columns skips row groups,
    and one laid out by region (rx, rz, see write_voxels) skips whole files."""
    for axis, (low, high) in (("x", x), ("z", z)):
        df = df.filter(F.col("c" + axis).between(low // 16, high // 16))
        if "r" + axis in df.columns:
            df = df.filter(F.col("r" + axis).between(low // 512, high // 512))
    return df


def snap_region_to_chunks(regions: DataFrame, pad_chunks=8) -> DataFrame:
    def low(c):
        return (F.floor(F.col(c) / 16) - pad_chunks).cast("int")

    def high(c):
        return (F.ceil(F.col(c) / 16) + pad_chunks).cast("int")

    return (regions.withColumn("cx0", low("x0")).withColumn("cz0", low("z0"))
            .withColumn("cx1", high("x1")).withColumn("cz1", high("z1")))


def filter_labels(df: DataFrame, wanted=None, never=None) -> DataFrame:
    if wanted is not None:
        df = df.filter(F.col("label").isin(list(wanted)))
    if never is not None:
        df = df.filter(~F.col("label").isin(list(never)))
    return df


def split_mapped(named: DataFrame, manifest_names: DataFrame):
    """Voxels whose name has a manifest entry, and the names without one."""
    mapped = named.join(manifest_names, "name", "left_semi")
    unmapped = (named.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
                .join(manifest_names, "name", "left_anti"))
    return mapped, unmapped


def to_engine_coords(df: DataFrame, y="y", z_offset_cm=0.0, cell=512) -> DataFrame:
    """Centimetres in both axis orders, relative to a cell, and mirrored."""
    cm = V.BLOCK_CM
    return (df.withColumn("ux", F.col("x") * cm).withColumn("uy", F.col("z") * cm)
            .withColumn("uz", F.col(y) * cm + z_offset_cm)
            .withColumn("flat_x", F.col("x") * cm).withColumn("flat_y", F.col(y) * cm)
            .withColumn("flat_z", F.col("z") * cm)
            .withColumn("rel_x", (F.col("x") - floor_div(F.col("x"), cell) * cell) * cm + cm / 2)
            .withColumn("rel_z", (F.col("z") - floor_div(F.col("z"), cell) * cell) * cm + cm / 2)
            .withColumn("mirrored_y", F.col("z") * -cm))


def column_legality(df: DataFrame, sections_per_component=1) -> DataFrame:
    """Is size_x by size_y a whole positive number of sections on both axes?"""
    q = F.col("section_size") * sections_per_component

    def whole(c):
        n = F.col(c) - 1
        return (F.pmod(n, q) == 0) & (F.floor(n / q) > 0)

    return df.withColumn("legal", whole("size_x") & whole("size_y"))


def classify_palette(palette: DataFrame) -> DataFrame:
    """Run every name rule once per block state."""
    name = F.col("name")
    label = rules.waterlogged_override(rules.semantic_label(name), F.col("properties"))
    return (palette.withColumn("label", label).withColumn("role", rules.role(name))
            .withColumn("family", rules.atlas_family(name))
            .withColumn("built", rules.man_made(name))
            .withColumn("natural", rules.natural(name)))


def lookup_palette(voxels: DataFrame, palette: DataFrame) -> DataFrame:
    """Join voxels to (classified) block states. The palette is small in every
    known world, but its size is left to the planner to check, not assumed."""
    return voxels.join(palette, "palette_id")


def solid_voxels(voxels: DataFrame, palette: DataFrame) -> DataFrame:
    """Non-air voxels with name, properties, label, role and family."""
    states = classify_palette(palette.filter(~F.col("name").isin(V.AIR_NAMES)))
    return lookup_palette(voxels, states)


def palette_index_of(names: DataFrame, palette: DataFrame) -> DataFrame:
    first = palette.groupBy("name").agg(F.min("palette_id").alias("palette_id"))
    return names.join(first, "name", "left")


def build_chunk_palettes(voxels: DataFrame) -> DataFrame:
    """Sorted distinct global ids of each chunk: the chunk's local palette."""
    return (with_chunk(voxels).groupBy("cx", "cz")
            .agg(F.array_sort(F.collect_set("palette_id")).alias("local_to_global")))


def chunk_local_to_global(df: DataFrame, index="local_index") -> DataFrame:
    return df.withColumn("palette_id", F.get("local_to_global", F.col(index)))


def export_sample(df: DataFrame, n_regions: int) -> DataFrame:
    """Voxels of the first n regions in (rx, rz) order."""
    placed = df.withColumn("rx", floor_div(F.col("x"), 512)) \
               .withColumn("rz", floor_div(F.col("z"), 512))
    first = placed.select("rx", "rz").distinct().orderBy("rx", "rz").limit(n_regions)
    return placed.join(first, ["rx", "rz"], "left_semi")
