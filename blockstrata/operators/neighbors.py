"""Neighbour tests on sparse voxels and dense grids.

Face neighbours of voxels are shifts of packed words (see masks).
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rasters as R
from .masks import FLAGS, cells_of, is_set, neighbour_words, open_faces, with_flags

AXES = "xyz"


def with_face_flags(voxels: DataFrame) -> DataFrame:
    """Add xm, xp, ym, yp, zm, zp: is that neighbour occupied?"""
    return with_flags(voxels)


def occupied_count(flag=F.col):
    return sum((flag(f).cast("int") for f in FLAGS[1:]), flag(FLAGS[0]).cast("int"))


def face_neighbors(voxels: DataFrame) -> DataFrame:
    """One row per pair of face-adjacent voxels: the lower voxel and the axis."""
    axes = F.filter(F.array(*[F.when(is_set(a + "p"), F.lit(a)) for a in AXES]),
                    lambda a: a.isNotNull())
    cells = cells_of(neighbour_words(voxels), axes.alias("axes"))
    return cells.select("x", "y", "z", F.explode("axes").alias("axis"))


def six_neighbor_occupancy(voxels: DataFrame) -> DataFrame:
    """Occupied neighbours of each voxel."""
    return cells_of(neighbour_words(voxels), occupied_count(is_set).alias("occupied"))


def exposed_faces(voxels: DataFrame) -> DataFrame:
    """Boundary faces of the whole set and the cost without culling, counted on words."""
    counts = neighbour_words(voxels).agg(
        F.coalesce(F.sum(F.bit_count("own")), F.lit(0)).alias("solid"), F.sum(open_faces()).alias("faces"))
    return counts.select("solid", "faces", (F.col("faces") * 2).alias("triangles"),
                         (F.col("solid") * 6).alias("naive_faces"),
                         (F.col("solid") * 12).alias("naive_triangles"))


def enclosed_filter(voxels: DataFrame) -> DataFrame:
    """Voxels with at least one open face."""
    return with_face_flags(voxels).filter(occupied_count() < 6).drop(*FLAGS)


def box_max(grid: DataFrame, value, r, out, agg=F.max) -> DataFrame:
    """Aggregate over the (2r+1) square around each cell of a dense grid, as
    one pass along x and one along z. ``agg`` must be associative and
    idempotent, such as max, min or bit_or."""
    across = Window.partitionBy("z").orderBy("x").rowsBetween(-r, r)
    along = Window.partitionBy("x").orderBy("z").rowsBetween(-r, r)
    return grid.withColumn(out, agg(value).over(across)).withColumn(out, agg(out).over(along))


def neighborhood_range(grid: DataFrame, value="top", r=2, outside=-99) -> DataFrame:
    """Largest absolute step from each cell to its (2r+1) square; cells beyond
    the grid count as ``outside``."""
    def run(mask, a):
        high, low = (R.extreme(R.extreme(a, mask, r, 0, pick), np.ones_like(mask), r, 1, pick) for pick in (np.fmax, np.fmin))
        whole = mask
        for axis in (0, 1):
            whole = np.logical_and.reduce([whole] + [R.moved(whole, axis, k, False) for d in range(1, r + 1) for k in (-d, d)])
        low = np.where(whole, low, np.fmin(low, outside))
        return [np.fmax(high - a, a - low), ~whole]
    return R.on_blocks(grid, [value], {"spread": "int", "edge": "boolean"}, r, run)
