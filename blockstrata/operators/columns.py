"""Column tables: one row per (x, z) taken from the voxels above it.

``max_by`` runs as partial and final aggregation, so a column of any height
moves one row per task to the shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .census import n_rows
from .voxels import filter_labels

PAYLOAD = ["name", "label", "role", "family", "built", "natural"]


def top_voxel_per_column(named: DataFrame, payload=PAYLOAD) -> DataFrame:
    top = named.groupBy("x", "z").agg(F.max_by(F.struct("y", *payload), "y").alias("top"))
    return top.select("x", "z", "top.*")


def full_grid(bounds: DataFrame) -> DataFrame:
    """Every (x, z) inside a one-row extent. The x values are spread over all
    tasks before each grows its line of cells."""
    lines = bounds.select(F.explode(F.sequence("min_x", "max_x")).alias("x"), "min_z", "max_z")
    return spread(lines, "x").select("x", F.explode(F.sequence("min_z", "max_z")).alias("z"))


def spread(df: DataFrame, *keys) -> DataFrame:
    """Repartition a short table that is about to grow; the explicit number
    keeps adaptive execution from merging the small partitions again."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def on_full_grid(columns: DataFrame, bounds: DataFrame) -> DataFrame:
    return full_grid(bounds).join(columns.hint("merge"), ["x", "z"], "left")  # as large as the world


def surface_columns(named: DataFrame, labels=None) -> DataFrame:
    """Topmost ground voxel per column; height is its upper face.

    Without labels every label but air, liquids and bedrock is ground."""
    ground = (filter_labels(named, wanted=labels) if labels
              else filter_labels(named, never=V.NEVER_GROUND_LABELS))
    return ground.groupBy("x", "z").agg(
        (F.max("y") + 1).alias("height"), F.max_by("label", "y").alias("label"))


def liquid_columns(named: DataFrame) -> DataFrame:
    wet = filter_labels(named, wanted=["WATER", "LAVA"])
    return wet.groupBy("x", "z").agg(
        (F.max("y") + 1).alias("height"),
        (F.max_by("label", "y") == "LAVA").alias("is_lava"))


def height_above_ground(named: DataFrame, ground: DataFrame, high_y: int) -> DataFrame:
    """Median height over the ground per name. Heights are counted first, so
    the percentile reads one row per (name, height), not one per voxel."""
    seen = named.join(ground, ["x", "z"]) \
        .groupBy("name", (F.col("y") - F.col("ground_y")).alias("above"), (F.col("y") > high_y).alias("high")) \
        .agg(n_rows("k"))
    return seen.groupBy("name").agg(
        F.sum("k").alias("n"),
        F.percentile("above", F.lit(0.5), F.col("k")).alias("median_above"),
        F.round(F.sum(F.when(F.col("high"), F.col("k")).otherwise(0)) / F.sum("k"), 6).alias("share_high"))


def sea_level(surface: DataFrame, bins=64) -> DataFrame:
    """Modal height of a liquid surface (64 equal bins, last one closed)."""
    lo, hi = surface.select(F.min("height")).scalar(), surface.select(F.max("height")).scalar()
    counted = surface.groupBy("height").agg(n_rows("k"))
    wide = F.when(lo == hi, 1.0).otherwise((hi - lo).cast("double"))
    start = F.when(lo == hi, lo - 0.5).otherwise(lo.cast("double"))
    step = wide / bins
    b = F.least(F.floor((F.col("height") - start) / step), F.lit(bins - 1))
    binned = counted.withColumn("bin", b).withColumn("start", start).withColumn("step", step) \
        .groupBy("bin", "start", "step").agg(
            F.sum("k").alias("k"), F.min("height").alias("lo"), F.max("height").alias("hi"),
            F.sum(F.col("k") * F.col("height")).alias("total"))
    edge = F.min_by(F.col("start") + F.col("bin") * F.col("step"), F.struct(-F.col("k"), F.col("bin")))
    return binned.agg(
        F.sum("k").alias("columns"), F.round(edge, 6).alias("sea_level_blocks"),
        F.round(edge * V.BLOCK_CM, 6).alias("sea_level_cm"),
        F.min("lo").alias("min_blocks"), F.max("hi").alias("max_blocks"),
        F.round(F.sum("total") / F.sum("k") * V.BLOCK_CM, 6).alias("mean_cm")) \
        .withColumn("has_water", F.col("columns").isNotNull())
