"""Faces, merged quads, triangles and their checks.

A face lies in a plane across one axis; row and col are its coordinates on
the other two axes in x, y, z order.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .census import n_rows
from .masks import with_flags
from .ranking import global_row_number
from .stencils import column, row
from .voxels import corners

OTHER = {"x": ("y", "z"), "y": ("x", "z"), "z": ("x", "y")}
# +1 where (row axis, col axis, face axis) is an even permutation of x, y, z
PARITY = {"x": 1, "y": -1, "z": 1}
FACE_KEYS = ["object_id", "axis", "sign", "plane"]


def exposed_face_rows(members: DataFrame, occupied: DataFrame) -> DataFrame:
    """One row per face of a member voxel whose neighbour is empty for all."""
    faces = []
    for axis, (a, b) in OTHER.items():
        for flag, sign in (("m", -1), ("p", 1)):
            at = F.struct(F.lit(axis).alias("axis"), F.lit(sign).alias("sign"),
                          (F.col(axis) + int(sign > 0)).alias("plane"),
                          F.col(a).alias("row"), F.col(b).alias("col"))
            faces.append(F.when(~F.col(axis + flag), at))
    open_faces = F.filter(F.array(*faces), lambda f: f.isNotNull())
    return with_flags(members, occupied).select("object_id", "material", F.explode(open_faces).alias("f")) \
        .select("object_id", "material", "f.*")


def _place(keys, at):
    """Place 0.. of a row in its stretch of consecutive values, by windows that
    all use one sort: a window of the stretch itself would sort once more."""
    line = Window.partitionBy(*keys).orderBy(at)
    begins = F.coalesce(F.col(at) - F.lag(at).over(line) != 1, F.lit(True))
    return F.col(at) - F.max(F.when(begins, F.col(at))).over(line.rowsBetween(Window.unboundedPreceding, 0))


def horizontal_runs(faces: DataFrame, cap=4, cap_columns=True) -> DataFrame:
    """Longest stretches of one material along each row: c0 up to c1."""
    keys = FACE_KEYS + ["row", "material"]
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("col"))
    runs = faces.withColumn("_island", F.col("col") - at)
    if not cap_columns:
        return runs.groupBy(*keys, "_island").agg(F.min("col").alias("c0"),
                                                  (F.max("col") + 1).alias("c1")).drop("_island")
    return runs.withColumn("_part", F.floor(_place(keys, "col") / cap)) \
        .groupBy(*keys, "_island", "_part") \
        .agg(F.min("col").alias("c0"), (F.max("col") + 1).alias("c1")).drop("_island", "_part")


def greedy_quads(faces: DataFrame, cap=4, cap_columns=True) -> DataFrame:
    """Merge equal runs of consecutive rows, at most ``cap`` rows each."""
    keys = FACE_KEYS + ["material", "c0", "c1"]
    runs = horizontal_runs(faces, cap, cap_columns)
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("row"))
    runs = runs.withColumn("_island", F.col("row") - at)
    return runs.withColumn("_part", F.floor(_place(keys, "row") / cap)).groupBy(*keys, "_island", "_part") \
        .agg(F.min("row").alias("r0"), (F.max("row") + 1).alias("r1")).drop("_island", "_part")


def quad_area():
    return (F.col("r1") - F.col("r0")) * (F.col("c1") - F.col("c0"))


def mesh_quads(quads: DataFrame) -> DataFrame:
    """Four corners per quad in engine centimetres, with block-unit uv and
    outward normal. Engine axes are (x, z, y), a mirror of the block axes, so
    corner order is reversed once more; uv stays with its corner."""
    parity = F.when(F.col("axis") == "y", -1).otherwise(1)
    corner = F.col("corner")
    out = quads.withColumn("corner", F.explode(F.array(*map(F.lit, range(4))))) \
        .withColumn("_i", F.when(parity * F.col("sign") > 0, 3 - corner).otherwise((corner + 1) % 4))
    # corners 0 to 3 lie at (r0, c0), (r1, c0), (r1, c1), (r0, c1); arrays of them would make the code of a task too long to be compiled
    far_r, far_c = F.col("_i").isin(1, 2), F.col("_i") >= 2
    out = out.withColumn("_r", F.when(far_r, F.col("r1")).otherwise(F.col("r0"))).withColumn("_c", F.when(far_c, F.col("c1")).otherwise(F.col("c0")))
    x = F.when(F.col("axis") == "x", F.col("plane")).otherwise(F.col("_r"))
    y = F.when(F.col("axis") == "y", F.col("plane")).when(F.col("axis") == "x", F.col("_r")).otherwise(F.col("_c"))
    z = F.when(F.col("axis") == "z", F.col("plane")).otherwise(F.col("_c"))
    cm = V.BLOCK_CM
    for name, axis in (("nx", "x"), ("ny", "z"), ("nz", "y")):
        out = out.withColumn(name, F.when(F.col("axis") == axis, F.col("sign")).otherwise(0))
    return (out.withColumn("ux", x * cm).withColumn("uy", z * cm).withColumn("uz", y * cm)
            .withColumn("u", F.when(far_r, F.col("r1") - F.col("r0")).otherwise(0))
            .withColumn("v", F.when(far_c, F.col("c1") - F.col("c0")).otherwise(0)).drop("_r", "_c", "_i"))


def atlas_layout(families=V.ATLAS_FAMILIES, tile=V.ATLAS_TILE, cols=V.ATLAS_COLS, pad=V.ATLAS_PAD):
    """Cell of every family: index, column, row, pixel box and uv box. Rows are
    rounded up to a power of two; the first row is at the bottom in uv."""
    cell, rows = tile + 2 * pad, 1
    while rows * cols < len(families):
        rows *= 2
    w, h = float(cols * cell), float(rows * cell)
    out = []
    for i, f in enumerate(families):
        x, y = (i % cols) * cell + pad, (rows - 1 - i // cols) * cell + pad
        out.append((f, i, i % cols, i // cols, x, y, x + tile, y + tile,
                    x / w, y / h, (x + tile) / w, (y + tile) / h))
    return out


LAYOUT_SCHEMA = ("family string, idx int, col int, row int, px0 int, py0 int, px1 int, py1 int, "
                 "u0 double, v0 double, u1 double, v1 double")


def atlas_uv(corners: DataFrame, layout: DataFrame) -> DataFrame:
    """Stretch each quad over the atlas cell of its base family."""
    from ..functions import rules
    # A row for each of the fixed families; without the hint the planner may send the corners round instead.
    cells = F.broadcast(layout.select(F.col("family").alias("base"), "u0", "v0", "u1", "v1"))
    w, h = F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0")
    return (corners.withColumn("base", rules.base_family(F.col("material"))).join(cells, "base")
            .withColumn("atlas_u", F.col("u0") + F.col("u") / w * (F.col("u1") - F.col("u0")))
            .withColumn("atlas_v", F.col("v0") + F.col("v") / h * (F.col("v1") - F.col("v0")))
            .drop("u0", "v0", "u1", "v1"))


def volume_from_quads(quads: DataFrame) -> DataFrame:
    """Enclosed volume and outer area per object (divergence theorem)."""
    part = F.when(F.col("axis") == "x", F.col("sign") * quad_area() * F.col("plane")).otherwise(0)
    return quads.groupBy("object_id").agg(F.sum(part).alias("volume"), F.sum(quad_area()).alias("area"))


def quad_bbox(quads: DataFrame) -> DataFrame:
    def end(axis, side):
        r, c = ("r0", "c0") if side == 0 else ("r1", "c1")
        along = F.when(F.col("axis") == axis, F.col("plane"))
        for a, (ra, ca) in OTHER.items():
            if ra == axis:
                along = F.coalesce(along, F.when(F.col("axis") == a, F.col(r)))
            if ca == axis:
                along = F.coalesce(along, F.when(F.col("axis") == a, F.col(c)))
        return along
    return quads.groupBy("object_id").agg(
        *[F.min(end(a, 0)).alias("mesh_min_" + a) for a in "xyz"],
        *[F.max(end(a, 1)).alias("mesh_max_" + a) for a in "xyz"])


def bbox_check(quads: DataFrame, members: DataFrame) -> DataFrame:
    """Does the mesh fill exactly the half-open box of the object's voxels?"""
    boxes = members.groupBy("object_id").agg(
        *[F.min(a).alias("min_" + a) for a in "xyz"], *[(F.max(a) + 1).alias("max_" + a) for a in "xyz"])
    same = F.lit(True)
    for a in "xyz":
        same = same & (F.col("mesh_min_" + a) == F.col("min_" + a)) & (F.col("mesh_max_" + a) == F.col("max_" + a))
    return boxes.join(quad_bbox(quads), "object_id", "left") \
        .select("object_id", F.coalesce(same, F.lit(False)).alias("matches"))


def mesh_reduction(quads: DataFrame, members: DataFrame) -> DataFrame:
    per = quads.groupBy("object_id", "material").agg(n_rows("q"), F.sum(quad_area()).alias("a"))
    sums = per.groupBy("object_id").agg(
        F.sum("q").alias("quads"), n_rows("materials"),
        F.min_by("material", F.struct(-F.col("q"), F.col("material"))).alias("dominant"),
        F.round(F.sum("a") / F.sum("q"), 2).alias("mean_extent"))
    blocks = members.groupBy("object_id").agg(n_rows("blocks"))
    return sums.join(blocks, "object_id").withColumn("triangles", F.col("quads") * 2) \
        .withColumn("reduction", F.round(F.col("blocks") * 12 / (F.col("quads") * 2), 2))


# --- height field triangles --------------------------------------------------

def _with_corners(grid: DataFrame, value) -> DataFrame:
    """Heights of the cell's square: h00, h10 (next x), h01 (next z), h11."""
    g = grid.select("x", "z", F.col(value).cast("double").alias("h00"))
    g = g.withColumn("h10", F.lead("h00").over(row())).withColumn("x1", F.lead("x").over(row()))
    return (g.withColumn("h01", F.lead("h00").over(column())).withColumn("h11", F.lead("h10").over(column()))
            .withColumn("z1", F.lead("z").over(column())).filter("x1 IS NOT NULL AND z1 IS NOT NULL"))


def _point(x, h, z):
    cm = V.BLOCK_CM
    return F.struct((F.col(x) * cm).alias("x"), (F.col(h) * cm).alias("y"), (F.col(z) * cm).alias("z"))


def heightfield_mesh(grid: DataFrame, value="height") -> DataFrame:
    """Two triangles (a, b, c) per square, cut along the flatter diagonal."""
    g = _with_corners(grid, value)
    p00, p10, p01, p11 = _point("x", "h00", "z"), _point("x1", "h10", "z"), \
        _point("x", "h01", "z1"), _point("x1", "h11", "z1")
    flip = F.abs(F.col("h01") - F.col("h10")) < F.abs(F.col("h00") - F.col("h11"))

    def tri(a, b, c):
        return F.struct(a.alias("a"), b.alias("b"), c.alias("c"))

    pair = F.when(flip, F.array(tri(p00, p01, p11), tri(p00, p11, p10))) \
        .otherwise(F.array(tri(p00, p01, p10), tri(p01, p11, p10)))
    return g.select("x", "z", F.posexplode(pair).alias("t", "tri")).select("x", "z", "t", "tri.*")


def strided_mesh(grid: DataFrame, bounds: DataFrame, stride: int) -> DataFrame:
    """Every stride-th row and column and the last ones."""
    x0, x1, z0, z1 = corners(bounds)
    for c, lo, hi in (("x", x0, x1), ("z", z0, z1)):
        grid = grid.filter((F.pmod(F.col(c) - lo, F.lit(stride)) == 0) | (F.col(c) == hi))
    return grid


def with_normal(tris: DataFrame) -> DataFrame:
    def d(p, c):
        return F.col(f"{p}.{c}") - F.col(f"a.{c}")
    return (tris.withColumn("nx", d("b", "y") * d("c", "z") - d("b", "z") * d("c", "y"))
            .withColumn("ny", d("b", "z") * d("c", "x") - d("b", "x") * d("c", "z"))
            .withColumn("nz", d("b", "x") * d("c", "y") - d("b", "y") * d("c", "x")))


def normal_length():
    return F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz"))


def mesh_stats(tris: DataFrame) -> DataFrame:
    t = with_normal(tris).withColumn("len", normal_length())
    up = F.col("ny") / F.greatest(F.col("len"), F.lit(1e-12))
    bad = F.lit(False)
    for p in "abc":
        for c in "xyz":
            bad = bad | F.isnan(f"{p}.{c}")
    return t.agg(
        n_rows("triangles"), F.count_if(F.col("len") * 0.5 <= 1e-9).alias("degenerate"),
        F.count_if(up < -1e-6).alias("down_facing"), F.count_if(up > 1e-6).alias("up_facing"),
        F.round(F.sum(F.col("len") * 0.5), 2).alias("area_cm2"),
        F.min(F.least("a.y", "b.y", "c.y")).alias("y_min_cm"), F.max(F.greatest("a.y", "b.y", "c.y")).alias("y_max_cm"),
        F.count_if(bad).alias("nan"))


def repair_mesh(tris: DataFrame) -> DataFrame:
    """Drop triangles without area and turn the rest to face up."""
    t = with_normal(tris).filter(normal_length() > 1e-9)
    down = F.col("ny") < 0
    return t.withColumn("_b", F.when(down, F.col("c")).otherwise(F.col("b"))) \
        .withColumn("_c", F.when(down, F.col("b")).otherwise(F.col("c"))) \
        .select(*[c for c in tris.columns if c not in ("b", "c")], F.col("_b").alias("b"), F.col("_c").alias("c"))


def vertex_normals(tris: DataFrame) -> DataFrame:
    """Area-weighted unit normal per vertex; zero sums stay zero."""
    spread = with_normal(tris).select(F.explode(F.array("a", "b", "c")).alias("p"), "nx", "ny", "nz")
    sums = spread.groupBy("p").agg(*[F.sum(c).alias(c) for c in ("nx", "ny", "nz")])
    ln = F.when(normal_length() == 0, 1.0).otherwise(normal_length())
    return sums.select("p.x", "p.y", "p.z", *[(F.col(c) / ln).alias(c) for c in ("nx", "ny", "nz")])


def winding_sample(tris: DataFrame, terrain=True) -> DataFrame:
    """Facing of all triangles, seen along the height axis, with the verdict
    for their kind of mesh."""
    ny = with_normal(tris)
    flat = F.abs("ny") < 1e-4
    g = ny.agg(n_rows("sampled"), F.count_if(~flat & (F.col("ny") > 0)).alias("front"),
               F.count_if(~flat & (F.col("ny") < 0)).alias("back"), F.count_if(flat).alias("degenerate"))
    pct = 100.0 * F.col("front") / F.col("sampled")
    good = (pct >= 95.0) if terrain else ((pct >= 20.0) & (F.col("degenerate") == 0))
    return g.withColumn("front_pct", F.round(pct, 6)).withColumn("ok", good)


def tangent_basis(vertices: DataFrame) -> DataFrame:
    """Unit normal (up if zero) and a unit tangent square to it (forward if
    none), with the count-worthy flag ``usable``."""
    n2 = F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz")
    v = vertices.withColumn("usable", n2 > 0.5).withColumn("_l", F.sqrt(n2))
    zero = F.col("_l") < 1e-8
    v = (v.withColumn("nx", F.when(zero, 0.0).otherwise(F.col("nx") / F.col("_l")))
         .withColumn("ny", F.when(zero, 0.0).otherwise(F.col("ny") / F.col("_l")))
         .withColumn("nz", F.when(zero, 1.0).otherwise(F.col("nz") / F.col("_l"))))
    dot = F.col("tx") * F.col("nx") + F.col("ty") * F.col("ny") + F.col("tz") * F.col("nz")
    v = v.withColumn("_d", dot)
    for c in "xyz":
        v = v.withColumn("t" + c, F.col("t" + c) - F.col("n" + c) * F.col("_d"))
    v = v.withColumn("_l", F.sqrt(F.col("tx") * F.col("tx") + F.col("ty") * F.col("ty") + F.col("tz") * F.col("tz")))
    for c, forward in (("tx", 1.0), ("ty", 0.0), ("tz", 0.0)):
        v = v.withColumn(c, F.when(F.col("_l") < 1e-8, forward).otherwise(F.col(c) / F.col("_l")))
    return v.drop("_l", "_d")


# --- liquid surface ----------------------------------------------------------

def liquid_quads(liquid: DataFrame) -> DataFrame:
    """Squares whose four corner columns all hold liquid."""
    pairs = liquid.select("x", "z").withColumn("right", F.lead("x").over(row())) \
        .filter(F.col("right") == F.col("x") + 1).drop("right")
    return pairs.withColumn("below", F.lead("z").over(column())) \
        .filter(F.col("below") == F.col("z") + 1).drop("below")


def liquid_mesh(liquid: DataFrame) -> DataFrame:
    """Quads with compact vertex numbers 0.., counted over used corners only."""
    quads = liquid_quads(liquid)
    corners = quads.select(F.col("x").alias("qx"), F.col("z").alias("qz"), F.posexplode(F.array(
        *[F.struct((F.col("x") + dx).alias("x"), (F.col("z") + dz).alias("z"))
          for dx, dz in ((0, 0), (0, 1), (1, 1), (1, 0))])).alias("corner", "p")).select("qx", "qz", "corner", "p.*")
    ids = global_row_number(corners.select("x", "z").distinct(), ["z", "x"], "vertex")
    named = corners.join(ids, ["x", "z"])
    return named.groupBy("qx", "qz").agg(
        *[F.max(F.when(F.col("corner") == i, F.col("vertex"))).alias(f"v{i}") for i in range(4)])


def quads_by_family(grid: DataFrame, bounds: DataFrame, tile=128) -> DataFrame:
    """Terrain squares, tiles and triangles per surface family."""
    x0, x1, z0, z1 = corners(bounds)
    for c, lo, hi in (("x", x0, x1), ("z", z0, z1)):
        local = F.col(c) - lo
        # the last row of every tile, and of the grid, opens no square
        grid = grid.filter((F.pmod(local, F.lit(tile)) != tile - 1) & (F.col(c) < hi)) \
            .withColumn("t" + c, F.floor(local / tile))
    per = grid.groupBy("family", "tx", "tz").agg(n_rows("q"))
    return per.groupBy("family").agg(F.sum("q").alias("quads"), n_rows("tiles")) \
        .withColumn("triangles", F.col("quads") * 2)
