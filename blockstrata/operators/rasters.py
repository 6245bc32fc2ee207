"""Column grids as raster blocks with a halo.

A grid (x, z, values) is cut into squares of ``BLOCK`` columns; only squares
that hold a cell exist. Every cell also goes to the squares whose halo it lies
in, in one shuffle, so a task sees its square and all that its cells depend on
as NumPy arrays and may run any number of sweeps. Where a neighbour is missing
the grid ends: smoothing repeats the end value there, gradients are one-sided.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import spread
from .voxels import floor_div

BLOCK = 128


def occupied_grid(columns: DataFrame, block=64) -> DataFrame:
    """Every (x, z) of the squares that hold a column, with its row or nulls.

    The cost is that of the squares, however far apart they lie."""
    squares = columns.select(floor_div(F.col("x"), block).alias("bx"), floor_div(F.col("z"), block).alias("bz")).distinct()
    side = F.sequence(F.lit(0), F.lit(block - 1))
    cells = squares.withColumn("i", F.explode(side)).withColumn("j", F.explode(side)).select(
        (F.col("bx") * block + F.col("i")).cast("int").alias("x"), (F.col("bz") * block + F.col("j")).cast("int").alias("z"))
    return cells.join(columns, ["x", "z"], "left")


def with_halo(grid: DataFrame, halo: int, block=BLOCK) -> DataFrame:
    """Each cell once for every square (bx, bz) that needs it."""
    for axis in "xz":
        near = F.array_distinct(F.array(*[floor_div(F.col(axis) + d, block) for d in (-halo, 0, halo)]))
        grid = grid.withColumn("b" + axis, F.explode(near))
    return grid


def on_blocks(grid: DataFrame, inputs, outputs: dict, halo: int, fn, block=BLOCK) -> DataFrame:
    """Add columns that ``fn`` computes on arrays of whole squares.

    ``fn(mask, *arrays)`` gets the cells that exist and the ``inputs`` as float
    arrays (a cell with a null input does not exist) and returns one array per
    output. ``outputs``: name to Spark type. ``halo`` is how far a result may
    depend on other cells, over all sweeps together.
    """
    block = max(block, halo)
    names = [f"_in{i}" for i in range(len(inputs))]
    rows = grid.withColumns({n: F.col(c).cast("double") for n, c in zip(names, inputs)}).drop(*outputs)
    kinds = {"double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop(*names).schema] + [f"`{n}` {t}" for n, t in outputs.items()])

    def run(key, table):
        bx, bz = (k.as_py() for k in key)
        table = table.drop_columns(["bx", "bz"])
        x, z = (table.column(c).to_numpy() for c in "xz")
        at = x - x.min(), z - z.min()
        shape = at[0].max() + 1, at[1].max() + 1
        arrays, mask = [], np.zeros(shape, dtype=bool)
        mask[at] = True
        for c in names:
            a = np.full(shape, np.nan)
            a[at] = table.column(c).to_numpy()
            arrays.append(a)
            mask &= ~np.isnan(a)
        found = fn(mask, *arrays)
        own = (x // block == bx) & (z // block == bz)
        out = table.drop_columns(names).filter(pa.array(own))
        here = tuple(a[own] for a in at)
        for (name, kind), a in zip(outputs.items(), found):
            values = a[here]
            values = values.astype(np.int32) if kind == "int" else values
            out = out.append_column(name, pa.array(values, kinds[kind], mask=~mask[here]))
        return out
    return spread(with_halo(rows, halo, block), "bx", "bz").groupBy("bx", "bz").applyInArrow(run, schema)


def moved(a, axis, step, fill):
    """The value ``step`` cells further along an axis; ``fill`` beyond the array."""
    out = np.full_like(a, fill)
    n = a.shape[axis]
    if abs(step) < n:
        there = [slice(None)] * 2
        here = [slice(None)] * 2
        there[axis] = slice(max(step, 0), n + min(step, 0))
        here[axis] = slice(max(-step, 0), n + min(-step, 0))
        out[tuple(here)] = a[tuple(there)]
    return out


def blur(a, mask, weights, axis):
    """Weighted sum along an axis; beyond the last cell of a line its value repeats."""
    r = len(weights) // 2
    total, ends, alive = a * weights[r], [a, a], [mask, mask]
    for k in range(1, r + 1):
        for i, step in enumerate((-k, k)):
            alive[i] = alive[i] & moved(mask, axis, step, False)
            ends[i] = np.where(alive[i], moved(a, axis, step, np.nan), ends[i])
            total = total + ends[i] * weights[r - k if i == 0 else r + k]
    return total


def gauss(a, mask, weights):
    return blur(blur(a, mask, weights, 0), mask, weights, 1)


def gradient(a, mask, axis):
    """Central difference, one-sided at the ends, 0 for a lone cell."""
    before, after = moved(a, axis, -1, np.nan), moved(a, axis, 1, np.nan)
    has = moved(mask, axis, -1, False), moved(mask, axis, 1, False)
    return np.where(has[0] & has[1], (after - before) / 2.0, np.where(has[1], after - a, np.where(has[0], a - before, 0.0)))


def extreme(a, mask, radius, axis, pick):
    """Highest (np.fmax) or lowest (np.fmin) value within ``radius`` along an axis."""
    a = np.where(mask, a, np.nan)
    out = a
    for k in range(1, radius + 1):
        out = pick(out, pick(moved(a, axis, -k, np.nan), moved(a, axis, k, np.nan)))
    return out
