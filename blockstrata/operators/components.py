"""Connected components of cells on an integer lattice.

Cells are first joined inside blocks of 64 x 64 columns, each block in one
task with a bounded number of cells. Links across block borders are joined
inside squares of 16 x 16 blocks in the same way; what crosses the borders of
squares is a much smaller graph, which alternating large and small stars
contract whatever its size. As soon as no more than ``FEW`` links are left, one
task joins them; their count is checked, and the result is the same.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .columns import spread
from .voxels import corners, floor_div

BLOCK = 64
SQUARE = 16 * BLOCK
FEW = 1_000_000
FACES_2D = [(1, 0, 0), (0, 0, 1)]
FACES_3D = [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
HALF_26 = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)
           if (dx, dy, dz) > (0, 0, 0)]
# x and z lie in -SHIFT .. SHIFT - 1, y in -SHIFT_Y .. SHIFT_Y - 1
SHIFT, SHIFT_Y = 1 << 25, 1 << 10


def in_range(x, y, z):
    return (x.between(-SHIFT, SHIFT - 1) & z.between(-SHIFT, SHIFT - 1)
            & y.between(-SHIFT_Y, SHIFT_Y - 1))


def cell_key(x, y, z):
    """One number per cell, ordered by x, then z, then y. A cell out of range is an error."""
    x, y, z = [F.col(c).cast("bigint") if isinstance(c, str) else c for c in (x, y, z)]
    key = (x + SHIFT) * (1 << 37) + (z + SHIFT) * (1 << 11) + y + SHIFT_Y
    return F.when(in_range(x, y, z), key).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("cell out of range:"), x, y, z)).cast("bigint"))


def square_of(key):
    """The square of SQUARE x SQUARE columns that holds a cell key."""
    x = F.shiftright(key, 37) - SHIFT
    z = F.shiftright(key, 11).bitwiseAND((1 << 26) - 1) - SHIFT
    return F.struct(F.floor(x / SQUARE).alias("sx"), F.floor(z / SQUARE).alias("sz"))


def _smallest_label(n, a, b):
    """Smallest index reachable from each of n nodes over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def _join_inside_block(offsets):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("key", ignore_index=True)
        at = cells[["x", "y", "z"]].to_numpy()
        at = at - at.min(axis=0) + 1
        volume = np.full(at.max(axis=0) + 2, -1)
        volume[tuple(at.T)] = np.arange(len(cells))
        near = [volume[tuple((at + o).T)] for o in np.array(offsets)]
        a = np.concatenate([np.flatnonzero(v >= 0) for v in near])
        b = np.concatenate([v[v >= 0] for v in near])
        cells["root"] = cells["key"].to_numpy()[_smallest_label(len(cells), a, b)]
        return cells[["x", "y", "z", "key", "root"]]
    return run


def _join_links(links: pd.DataFrame) -> pd.DataFrame:
    nodes, pos = np.unique(links[["u", "v"]].to_numpy(), return_inverse=True)
    pos = pos.reshape(-1, 2)
    label = _smallest_label(len(nodes), pos[:, 0], pos[:, 1])
    return pd.DataFrame({"node": nodes, "comp": nodes[label]})


def _join_few(links: DataFrame) -> DataFrame:
    """Roots over at most FEW links (u, v), in one task."""
    return links.select("u", "v", F.lit(0).alias("all")).groupBy("all").applyInPandas(_join_links, "node bigint, comp bigint")


def salted_join(big: DataFrame, small: DataFrame, key: str, spread: str, salts=16) -> DataFrame:
    """Join in which rows of a hot key on the big side go to several tasks.
    The small side has one row per key and is repeated once per salt."""
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def contract_stars(edges: DataFrame) -> DataFrame:
    """Root of every node that has an edge: (node, comp), root = smallest node."""
    def both(e):
        return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def stamp(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    edges = cut_lineage(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = stamp(edges)
    while seen[0]:
        if seen[0] <= FEW:
            return _join_few(edges)
        near = both(edges)
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = salted_join(near.filter("v > u"), low, "u", "v") \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, low, "u", "v")
        edges = cut_lineage(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(low.select("u", F.col("m").alias("v")))
                            .filter("u <> v").distinct())
        now = stamp(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def contract(links: DataFrame) -> DataFrame:
    """Root of every cell key that has a link: (node, comp), root = smallest key."""
    links = cut_lineage(links)
    if links.count() <= FEW:
        return _join_few(links)
    links = links.withColumn("square", square_of(F.col("u"))).withColumn("other", square_of(F.col("v")))
    inside = links.filter("square = other").groupBy("square").applyInPandas(_join_links, "node bigint, comp bigint")
    inside = cut_lineage(inside)
    across = links.filter("square <> other").select("u", "v")
    for end in ("u", "v"):
        named = inside.select(F.col("node").alias(end), F.col("comp").alias("root"))
        across = across.join(named, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    outside = contract_stars(across)
    last = outside.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    joined = inside.join(last, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
    # roots of squares without a link inside their own square
    return joined.unionByName(outside.join(inside.select("node"), "node", "left_anti"))


def connected_components(cells: DataFrame, offsets=FACES_3D) -> DataFrame:
    """Add ``component``, the smallest cell key in the component, to x, y, z."""
    keyed = cells.select("x", "y", "z").distinct().withColumn("key", cell_key("x", "y", "z"))
    keyed = keyed.withColumn("bx", floor_div(F.col("x"), BLOCK)).withColumn("bz", floor_div(F.col("z"), BLOCK))
    # few bytes but much work per block: keep the blocks spread out
    local = cut_lineage(spread(keyed, "bx", "bz").groupBy("bx", "bz").applyInPandas(
        _join_inside_block(offsets), "x int, y int, z int, key bigint, root bigint"))
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).alias("d" + c) for v, c in zip(o, "xyz")])
                                for o in offsets])).alias("o")
    moved = local.select("root", "x", "y", "z", steps) \
        .select(F.col("root").alias("u"), *[c for a in "xyz" for c in (F.col(a), (F.col(a) + F.col("o.d" + a)).alias("n" + a))])
    crosses = None
    for c in "xz":
        leaves = floor_div(F.col(c), BLOCK) != floor_div(F.col("n" + c), BLOCK)
        crosses = leaves if crosses is None else crosses | leaves
    ends = [F.col(c).cast("bigint") for c in ("nx", "ny", "nz")]
    # a place outside the range holds no cell
    border = moved.filter(crosses & in_range(*ends)).select("u", cell_key(*ends).alias("key"))
    links = border.join(local.select("key", F.col("root").alias("v")), "key").select("u", "v").distinct()
    roots = contract(links)
    # a root covers at most one block of cells, so no key is hot here
    return (local.join(roots, local["root"] == roots["node"], "left")
            .select("x", "y", "z", F.coalesce("comp", "root").alias("component")))


def components_on_lattice(voxels: DataFrame, pitch=1, offsets=FACES_3D) -> DataFrame:
    """Components of voxels grouped to cells of ``pitch`` blocks."""
    if pitch == 1:
        return voxels.join(connected_components(voxels, offsets), ["x", "y", "z"])
    cell = [floor_div(F.col(c), pitch).alias(c) for c in "xyz"]
    labelled = connected_components(voxels.select(*cell), offsets)
    placed = voxels.select("*", *[floor_div(F.col(c), pitch).alias("c" + c) for c in "xyz"])
    return placed.join(labelled.select(*[F.col(c).alias("c" + c) for c in "xyz"], "component"),
                       ["cx", "cy", "cz"]).drop("cx", "cy", "cz")


def components_2d(cells: DataFrame) -> DataFrame:
    flat = cells.select(F.col("cell_x").alias("x"), F.lit(0).alias("y"), F.col("cell_z").alias("z"))
    return connected_components(flat, FACES_2D).select(
        F.col("x").alias("cell_x"), F.col("z").alias("cell_z"), "component")


def find_built_region(density: DataFrame, bounds: DataFrame, cell=32, threshold=0.10,
                      min_cells=4, largest=None) -> DataFrame:
    """Box around the connected groups of dense cells, or the ``largest`` of them."""
    seed = density.filter(F.col("fraction") >= threshold)
    labelled = components_2d(seed)
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") >= min_cells)
    if largest is not None:
        sizes = sizes.orderBy(F.desc("n"), "component").limit(largest)
    kept = labelled.join(sizes.select("component"), "component", "left_semi")
    x0, x1, z0, z1 = corners(bounds)
    total = F.floor((x1 - x0 + 1) / cell) * F.floor((z1 - z0 + 1) / cell)
    return kept.agg(
        (F.min("cell_x") * cell).alias("x0"), ((F.max("cell_x") + 1) * cell).alias("x1"),
        (F.min("cell_z") * cell).alias("z0"), ((F.max("cell_z") + 1) * cell).alias("z1"),
        F.count(F.lit(1)).alias("cells")).select(
            "*", (x0 + F.col("x0")).alias("world_x0"), (x0 + F.col("x1") - 1).alias("world_x1"),
            (z0 + F.col("z0")).alias("world_z0"), (z0 + F.col("z1") - 1).alias("world_z1"),
            F.when(F.col("cells") > 0, F.round(F.col("cells") / total, 6)).alias("built_fraction"))
