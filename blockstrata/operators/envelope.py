"""Exact nearest points inside blocks by separable lower envelopes.

The squared distance to the nearest point is found along z, then y, then x. For
a line of cells whose costs so far are known, every cell offers a parabola; the
lowest parabola at each place (their lower envelope) is found in one pass over
the line, for all lines of a block at once. Work is linear in the cells of a
block, however far its points are. Of equally close points the one with the
smallest x, then y, then z wins. Queries with a point within ``NEAR`` are answered
before that, by looking at the places around them from near to far, ``LOOKS`` times
the cells of the block at most.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import spread
from .voxels import floor_div

BLOCK, HALO = 64, 32
NONE = np.int64(1 << 40)
NEAR, LOOKS = 8, 4
# steps to the places within NEAR in the order of preference
STEPS = np.indices((2 * NEAR + 1,) * 3).reshape(3, -1).T - NEAR
STEPS = STEPS[(STEPS ** 2).sum(axis=1) <= NEAR * NEAR]
STEPS = STEPS[np.argsort((STEPS ** 2).sum(axis=1), kind="stable")]


def lower_envelope(cost, targets):
    """Index of the best cell of each line for each target place; -1 for lines without one.

    ``cost``: cells x lines, NONE where a cell offers nothing. ``targets``:
    rising places. Best: least cost + (place - index) ** 2, then the smallest index.
    """
    n, lines = cost.shape
    top = np.full(lines, -1)
    cell, begin = np.zeros((n, lines), dtype=np.int32), np.full((n + 1, lines), np.inf)
    for q in range(n):
        todo = np.flatnonzero(cost[q] < NONE)
        while len(todo):
            k = top[todo]
            p = cell[np.maximum(k, 0), todo].astype(np.int64)
            with np.errstate(divide="ignore", invalid="ignore"):
                s = ((cost[q, todo] + q * q) - (cost[p, todo] + p * p)) / (2.0 * (q - p))
            s[k < 0] = -np.inf
            pop = (k >= 0) & (s <= begin[np.maximum(k, 0), todo])
            done, at = todo[~pop], k[~pop] + 1
            top[done] = at
            cell[at, done], begin[at, done] = q, s[~pop]
            begin[at + 1, done] = np.inf
            top[todo[pop]] -= 1
            todo = todo[pop]
    out, j, every = np.full((len(targets), lines), -1, dtype=np.int32), np.zeros(lines, dtype=np.int64), np.arange(lines)
    some = top >= 0
    for i, t in enumerate(targets):
        while True:
            further = some & (j < top) & (begin[np.minimum(j + 1, n), every] < t)
            if not further.any():
                break
            j[further] += 1
        out[i] = np.where(some, cell[np.minimum(j, n - 1), every], -1)
    return out


def nearest_along_z(held, low, high):
    """Index of the nearest held cell along the last axis for each place low .. high - 1; -1 without one."""
    n = held.shape[2]
    index = np.arange(n, dtype=np.int32)
    before = np.maximum.accumulate(np.where(held, index, -1), axis=2)
    after = np.minimum.accumulate(np.where(held, index, n)[:, :, ::-1], axis=2)[:, :, ::-1]
    before, after, place = before[:, :, low:high], after[:, :, low:high], index[low:high]
    closer = (after < n) & ((before < 0) | (after - place < place - before))
    return np.where(closer, after, before)


def nearest_in_box(queries, points):
    """For each query (x, y, z) the number of its nearest point, points distinct; both as int64 arrays."""
    low = np.minimum(queries.min(axis=0), points.min(axis=0)) - NEAR
    size = np.maximum(queries.max(axis=0), points.max(axis=0)) + NEAR - low + 1
    number = np.full(size.prod(), -1, dtype=np.int32)
    number[np.ravel_multi_index((points - low).T, size)] = np.arange(len(points))
    at = np.ravel_multi_index((queries - low).T, size)
    best, todo = np.full(len(queries), -1), np.arange(len(queries))
    looks = 0
    for step in STEPS @ np.array([size[1] * size[2], size[2], 1]):
        looks += len(todo)
        if looks > LOOKS * len(number):
            break
        found = number[at[todo] + step]
        best[todo] = found
        todo = todo[found < 0]
        if not len(todo):
            return best
    best[todo] = nearest_by_envelopes(queries[todo], points)
    return best


def nearest_by_envelopes(queries, points):
    """The same by lower envelopes along z, y and x."""
    low = np.minimum(queries.min(axis=0), points.min(axis=0))
    size = np.maximum(queries.max(axis=0), points.max(axis=0)) - low + 1
    q, p = queries - low, points - low
    (qx0, qy0, qz0), (qx1, qy1, qz1) = q.min(axis=0), q.max(axis=0) + 1
    held = np.zeros(size, dtype=bool)
    held[tuple(p.T)] = True
    best_z = nearest_along_z(held, qz0, qz1)
    cost = np.where(best_z >= 0, (best_z.astype(np.int64) - np.arange(qz0, qz1)) ** 2, NONE)
    nx, ny, nz = cost.shape
    lines = cost.transpose(1, 0, 2).reshape(ny, nx * nz)
    best_y = lower_envelope(lines, np.arange(qy0, qy1))
    way = np.where(best_y >= 0, np.take_along_axis(lines, np.maximum(best_y, 0), axis=0) + (best_y - np.arange(qy0, qy1)[:, None]).astype(np.int64) ** 2, NONE)
    best_y, lines = best_y.reshape(-1, nx, nz), way.reshape(-1, nx, nz).transpose(1, 0, 2).reshape(nx, -1)
    best_x = lower_envelope(lines, np.arange(qx0, qx1)).reshape(qx1 - qx0, qy1 - qy0, nz)
    x, y, z = q[:, 0] - qx0, q[:, 1] - qy0, q[:, 2] - qz0
    at_x = best_x[x, y, z]
    at_y = best_y[y, at_x, z]
    at_z = best_z[at_x, at_y, z]
    number = np.zeros(size, dtype=np.int64)
    number[tuple(p.T)] = np.arange(len(p))
    return number[at_x, at_y, at_z]


def nearest_in_blocks(queries: DataFrame, points: DataFrame, dims, values, block=BLOCK, halo=HALO) -> DataFrame:
    """Nearest points of the queries of each block among those in the block and
    around it: q-coordinates, best (d2, values), settled.

    ``queries``: distinct rows of q + dims. ``points``: dims and values, one row
    for each place. A query is settled if no point outside the halo can be as
    close; others may have a null best."""
    names = ["x", "y", "z"]
    there = lambda prefix: [(F.col(prefix + d) if d in dims else F.lit(0)).cast("bigint").alias(prefix + d) for d in names]
    homes = queries.select(*there("q"), floor_div(F.col("qx"), block).alias("bx"), floor_div(F.col("qz"), block).alias("bz"))
    near = points.select(*[(F.col(d) if d in dims else F.lit(0)).cast("bigint").alias(d) for d in names], F.struct(*values).alias("v"))
    for axis in "xz":
        around = F.array_distinct(F.array(*[floor_div(F.col(axis) + d, block) for d in (-halo, 0, halo)]))
        near = near.withColumn("b" + axis, F.explode(around))
    kind = near.schema["v"].dataType.simpleString()

    def run(key, asked, offered):
        bx, bz = (k.as_py() for k in key)
        q = np.stack([asked.column("q" + d).to_numpy() for d in names], axis=1) if asked.num_rows else np.zeros((0, 3), dtype=np.int64)
        out = {"q" + d: pa.array(q[:, i], pa.int64()) for i, d in enumerate(names)}
        if not len(q) or not offered.num_rows:
            return pa.table(out | {"d2": pa.nulls(len(q), pa.int64()), "v": pa.nulls(len(q), offered.schema.field("v").type), "settled": pa.array(np.zeros(len(q), dtype=bool))})
        p = np.stack([offered.column(d).to_numpy() for d in names], axis=1)
        best = nearest_in_box(q, p)
        d2 = ((q - p[best]) ** 2).sum(axis=1)
        x, z = q[:, 0] - bx * block, q[:, 2] - bz * block
        reach = np.minimum.reduce([x + halo + 1, block + halo - x, z + halo + 1, block + halo - z])
        taken = offered.column("v").combine_chunks().take(pa.array(best))
        return pa.table(out | {"d2": pa.array(d2), "v": taken, "settled": pa.array(d2 < reach * reach)})
    found = spread(homes, "bx", "bz").groupBy("bx", "bz").cogroup(spread(near, "bx", "bz").groupBy("bx", "bz")).applyInArrow(
        run, f"qx bigint, qy bigint, qz bigint, d2 bigint, v {kind}, settled boolean")
    ends = [F.col("q" + d).cast(queries.schema["q" + d].dataType).alias("q" + d) for d in dims]
    return found.select(*ends, F.struct("d2", *["v." + v for v in values]).alias("best"), "settled")
