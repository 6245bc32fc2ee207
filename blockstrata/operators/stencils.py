"""Smoothing and gradients on (x, z) grids.

All run on raster blocks with a halo (see rasters): however many sweeps an
operator has, its cells move in one shuffle.
"""

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rasters as R
from .ranking import percentile_of, sorted_counts, weighted_mean


def row():
    return Window.partitionBy("z").orderBy("x")


def column():
    return Window.partitionBy("x").orderBy("z")


def gaussian_weights(sigma):
    radius = int(4 * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [w / sum(raw) for w in raw]


def gaussian_smooth(grid: DataFrame, sigma, value="height", out="smooth") -> DataFrame:
    """Weighted mean; beyond the end of a line its end value repeats."""
    weights = gaussian_weights(sigma)
    return R.on_blocks(grid, [value], {out: "double"}, len(weights) // 2, lambda mask, a: [R.gauss(a, mask, weights)])


def _diffused(a, mask, sigma, sweeps, step):
    s = max(sigma, 1e-6)

    def flux(g):
        return g / (1.0 + (g / s) * (g / s))
    for _ in range(sweeps):
        along = [R.gradient(flux(R.gradient(a, mask, axis)), mask, axis) for axis in (0, 1)]
        a = a + step * (along[0] + along[1])
    return a


def perona_malik(grid: DataFrame, sigma, value="height", out="diffused", sweeps=3, step=0.2) -> DataFrame:
    """Diffusion that slows down where the surface is steep. A sweep reaches two cells far."""
    return R.on_blocks(grid, [value], {out: "double"}, 2 * sweeps, lambda mask, a: [_diffused(a, mask, sigma, sweeps, step)])


def edge_preserving_smooth(grid: DataFrame, sigma=1.4, edge_preserve=0.6, value="height", sweeps=3, step=0.2) -> DataFrame:
    """Weighted mean of a blur and a diffusion."""
    weights = gaussian_weights(sigma)

    def run(mask, a):
        return [(1.0 - edge_preserve) * R.gauss(a, mask, weights) + edge_preserve * _diffused(a, mask, sigma, sweeps, step)]
    return R.on_blocks(grid, [value], {"smooth": "double"}, max(len(weights) // 2, 2 * sweeps), run)


def destair(grid: DataFrame, sigma_xy=2.0, sigma_z=0.6, passes=1, value="height") -> DataFrame:
    """Wide blur, light blur, then a pull to the mean by the share of holes.
    ``valid`` tells measured cells from filled ones."""
    blurs = [gaussian_weights(sigma_xy)] * max(1, passes) + [gaussian_weights(sigma_z)]

    def run(mask, a):
        for weights in blurs:
            a = R.gauss(a, mask, weights)
        return [a]
    out = R.on_blocks(grid, [value], {"_s": "double"}, sum(len(w) // 2 for w in blurs), run)
    mean = out.select(F.avg("_s")).scalar()
    share = 0.65 * grid.select(F.avg(F.col("valid").cast("double"))).scalar() + 0.35
    return out.withColumn("smooth", F.col("_s") * share + mean * (1.0 - share)).drop("_s")


def flat_restore_smooth(grid: DataFrame, sigma=0.9, flat_restore=0.85, value="height") -> DataFrame:
    """Blur, but keep most of the original where its 3 x 3 square is flat."""
    if sigma <= 0:
        return grid.withColumn("smooth", F.col(value).cast("double"))
    weights = gaussian_weights(sigma)

    def run(mask, a):
        smooth, ends = R.gauss(a, mask, weights), []
        for pick in (np.fmax, np.fmin):
            ends.append(R.extreme(R.extreme(a, mask, 1, 0, pick), mask, 1, 1, pick))
        return [np.where(ends[0] - ends[1] <= 1.0, a * flat_restore + smooth * (1.0 - flat_restore), smooth)]
    return R.on_blocks(grid, [value], {"smooth": "double"}, max(1, len(weights) // 2), run)


def height_gradient_normals(grid: DataFrame, value="height", step_cm=100.0) -> DataFrame:
    """Unit surface normal and unit tangent along x, Z up."""
    g = R.on_blocks(grid, [value], {"_dx": "double", "_dz": "double"}, 1,
                    lambda mask, a: [R.gradient(a, mask, axis) / step_cm for axis in (0, 1)])
    ln = F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dz") * F.col("_dz") + 1.0)
    lt = F.sqrt(F.col("_dx") * F.col("_dx") + 1.0)
    return (g.withColumn("nx", -F.col("_dx") / ln).withColumn("ny", -F.col("_dz") / ln)
            .withColumn("nz", 1.0 / ln).withColumn("tx", 1.0 / lt).withColumn("ty", F.lit(0.0))
            .withColumn("tz", -F.col("_dx") / lt).drop("_dx", "_dz"))


def smoothing_error(grid: DataFrame, before="height", after="smooth") -> DataFrame:
    d = F.abs(F.col(after) - F.col(before)).cast("double")
    far = F.sum(F.when(F.col("d") > 1.0, F.col("k")).otherwise(0))
    return sorted_counts(grid.select(d.alias("d")), "d").agg(
        F.round(weighted_mean("d"), 6).alias("mean_abs"), F.round(percentile_of("d", 0.95), 6).alias("p95_abs"),
        F.round(F.max("d"), 6).alias("max_abs"), far.alias("moved"),
        F.round(100.0 * far / F.sum("k"), 6).alias("moved_pct"))
