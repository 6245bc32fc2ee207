"""Exact nearest neighbour on integer coordinates.

Queries are first answered inside blocks with a halo, by lower envelopes (see
envelope). What a block cannot settle goes on in rounds of growing buckets: a
round looks from each occupied query cell at the occupied point cells around it;
bounds on the distance between two cells leave only the cells that can hold a
winner, and only their points are joined. A round settles every query whose best
distance is no larger than the bucket; the rest goes on with buckets four times
as wide. In these rounds a point between two points of a line on every axis can
win no query, and is left out.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .envelope import HALO, nearest_in_blocks
from .voxels import floor_div


# further than any two cells
FAR = 1 << 28
# columns whose holes are filled together
COLUMNS = 16


def _bucket(dims, size, prefix):
    return [F.floor(F.col(d) / size).alias(prefix + d) for d in dims]


def _around(df, dims):
    """Bucket of the row and the buckets next to it, in every direction."""
    for d in dims:
        df = df.withColumn("b" + d, F.explode(F.array(*[F.col("k" + d) + o for o in (-1, 0, 1)])))
    return df.drop(*["k" + d for d in dims])


def _outer(points: DataFrame, dims) -> DataFrame:
    """Points with a free place beside them on some axis; from any of the others
    a step towards a query reaches a closer point."""
    for d in dims:
        line = Window.partitionBy(*[o for o in dims if o != d]).orderBy(d)
        points = points.withColumn("_" + d, F.coalesce((F.lag(d).over(line) == F.col(d) - 1) & (F.lead(d).over(line) == F.col(d) + 1), F.lit(False)))
    inner = reduce(lambda a, b: a & b, [F.col("_" + d) for d in dims])
    return points.filter(~inner).drop(*["_" + d for d in dims])


def nearest_points(queries: DataFrame, points: DataFrame, dims, values) -> DataFrame:
    """For each distinct query position the values of the closest point.

    Of equally close points the one with the smallest coordinates wins. Gives
    the query coordinates, the values and ``d2``, the squared distance. Both
    inputs are read more than once, so pass stored tables. Points are taken as
    one per place, with x and z among their ``dims``.
    """
    keys = ["q" + d for d in dims]
    pts = points.select(*dims, *values)
    left = queries.select(*[F.col(d).alias("q" + d) for d in dims]).distinct()
    if pts.isEmpty():
        return left.select(*[F.col("q" + d).alias(d) for d in dims],
                           *[F.lit(None).cast(pts.schema[v].dataType).alias(v) for v in values],
                           F.lit(None).cast("bigint").alias("d2"))
    d2 = reduce(lambda a, b: a + b, [(F.col("q" + d).cast("bigint") - F.col(d))
                                     * (F.col("q" + d).cast("bigint") - F.col(d)) for d in dims])
    best = F.min_by(F.struct(d2.alias("d2"), *values), F.struct(d2, *dims)).alias("best")
    first = cut_lineage(nearest_in_blocks(left, pts.dropDuplicates(list(dims)), dims, values))
    done, left = [first.filter("settled").select(*keys, "best")], first.filter("NOT settled").select(*keys)
    unit, wide, outer = HALO, 4 * HALO, None
    while not left.isEmpty():
        if outer is None:
            outer = cut_lineage(_outer(pts, dims))
        ratio = wide // unit
        home, there = ["c" + d for d in dims], ["s" + d for d in dims]
        placed = left.select(*keys, *[F.floor(F.col("q" + d) / unit).alias("c" + d) for d in dims])
        asked = _around(placed.select(*home).distinct().select(
            "*", *[F.floor(F.col("c" + d) / ratio).alias("k" + d) for d in dims]), dims)
        held = outer.select(*_bucket(dims, unit, "s")).distinct() \
            .select("*", *[F.floor(F.col("s" + d) / ratio).alias("b" + d) for d in dims])
        apart = [F.abs(F.col("s" + d) - F.col("c" + d)) for d in dims]
        least = [F.greatest((k - 1) * unit + 1, F.lit(0)) for k in apart]
        most = [(k + 1) * unit - 1 for k in apart]

        def square(parts):
            return reduce(lambda x, y: x + y, [p * p for p in parts])

        # at most 12 cells per axis, so the list of a query cell is bounded
        near = asked.join(held, ["b" + d for d in dims]).groupBy(*home).agg(
            F.min(square(most)).alias("ub"),
            F.collect_list(F.struct(square(least).alias("lb"), *there)).alias("cand"))
        near = near.select(*home, "ub", F.explode("cand").alias("c")) \
            .filter(F.col("c.lb") <= F.col("ub")).select(*home, *["c." + c for c in there])
        found = placed.join(near, home).join(outer.select("*", *_bucket(dims, unit, "s")), there)
        round_best = found.groupBy(*keys).agg(best)
        settled = cut_lineage(round_best.filter(F.col("best.d2") <= wide * wide))
        done.append(settled)
        left = cut_lineage(left.join(settled.select(*keys), keys, "left_anti"))
        unit, wide = wide, wide * 4
    out = reduce(DataFrame.unionByName, done) if done else None
    if out is None:
        return pts.limit(0).select(*dims, *values, F.lit(0).cast("bigint").alias("d2"))
    return out.select(*[F.col("q" + d).alias(d) for d in dims],
                      *[F.col("best." + v).alias(v) for v in values], F.col("best.d2").alias("d2"))


def _along_columns(value):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x, z, valid = (table.column(c).to_numpy() for c in ("x", "z", "valid"))
        held = table.column("source").is_valid().to_numpy()
        x0, z0 = x.min(), z.min()
        shape = x.max() - x0 + 1, z.max() - z0 + 1
        at = (x - x0) * np.int64(shape[1]) + z - z0
        # cells of the columns, one after the other; those without a candidate are never the closest
        far = np.full(shape[0] * shape[1], FAR)
        source, place = np.zeros(len(far), dtype=np.int64), np.full(len(far), -1)
        source[at[held]] = table.column("source").drop_null().to_numpy()
        far[at[held]] = np.abs(source[at[held]] - x[held])
        place[at[held]] = np.flatnonzero(held)
        open_ = at[~valid]
        best = np.stack([far[open_] ** 2, source[open_], open_])
        # a hole is looked at until no row further away can be as close
        todo = np.arange(len(open_) if held.any() else 0)
        for step in range(1, shape[1]):
            todo = todo[best[0, todo] >= step * step]
            if not len(todo):
                break
            now, row = best[:, todo], open_[todo] % shape[1]
            for there in (-step, step):
                inside = (row + there >= 0) & (row + there < shape[1])
                cell = np.where(inside, open_[todo] + there, 0)
                d2 = np.where(inside, far[cell] ** 2 + step * step, FAR ** 2)
                less = (d2 < now[0]) | (d2 == now[0]) & ((source[cell] < now[1]) | (source[cell] == now[1]) & (cell < now[2]))
                now = np.where(less, np.stack([d2, source[cell], cell]), now)
            best[:, todo] = now
        take = place[best[2]] if len(open_) else np.zeros(0, dtype=np.int64)
        values = table.column(value).take(pa.array(take, pa.int64(), mask=(take < 0) | (best[0] >= FAR ** 2)))
        return pa.table({"x": pa.array(open_ // shape[1] + x0, pa.int32()), "z": pa.array(open_ % shape[1] + z0, pa.int32()), value: values})
    return run


def nearest_valid(grid: DataFrame, value="height") -> DataFrame:
    """Fill null cells of a grid with the value of the nearest valid cell; of
    equally close ones that with the smallest (x, z).

    Two passes: along each row by windows every cell finds the closest valid
    cell to either side, then along each column every hole takes the best row.
    The work of a hole is the distance of its value, and no group holds more
    than ``COLUMNS`` columns.
    """
    row = Window.partitionBy("z").orderBy("x")
    here = F.when(F.col(value).isNotNull(), F.struct(F.col("x").alias("source"), F.col(value)))
    before = F.last(here, ignorenulls=True).over(row)
    # Backwards, as a frame that ends with the row grows by one row at a time; one that begins with it is read anew for every row.
    after = F.last(here, ignorenulls=True).over(Window.partitionBy("z").orderBy(F.desc("x")))
    both = grid.select("x", "z", value, before.alias("before"), after.alias("after"))
    closer = F.col("before").isNull() | (F.col("after.source") - F.col("x") < F.col("x") - F.col("before.source"))
    best = F.when(F.col("after").isNotNull() & closer, F.col("after")).otherwise(F.col("before"))
    both = cut_lineage(both.select("x", "z", F.col(value).isNotNull().alias("valid"), best.alias("best")))
    holes = both.groupBy("x").agg(F.count_if(~F.col("valid")).alias("n")).filter("n > 0").select("x")
    rows = both.join(holes, "x", "left_semi").select(
        F.col("x").cast("int"), F.col("z").cast("int"), "valid", F.col("best.source").cast("int").alias("source"), F.col("best." + value).alias(value))
    kind = grid.schema[value].dataType.simpleString()
    filled = rows.groupBy(floor_div(F.col("x"), COLUMNS)).applyInArrow(_along_columns(value), f"x int, z int, {value} {kind}")
    ends = [F.col(c).cast(grid.schema[c].dataType).alias(c) for c in ("x", "z")]
    return both.filter("valid").select(*ends, F.col("best." + value).alias(value), F.lit(True).alias("valid")).unionByName(
        filled.select(*ends, value, F.lit(False).alias("valid")))
