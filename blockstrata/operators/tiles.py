"""Tiling, resampling and height encoding of grids."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .census import n_rows
from .columns import spread
from .stencils import column, row
from .voxels import corners

# fixed values of the planner
MAX_PER_AXIS, MAX_TOTAL, TOLERANCE = 64, 1024, 0.06


def overlap_tiles(extents: DataFrame, total, tile=64, overlap=8) -> DataFrame:
    """Windows that cover [0, total) with halos, and the core each one owns."""
    t, stride = F.col(total), tile - overlap
    starts = F.sequence(F.lit(0), F.greatest(t - tile, F.lit(0)), F.lit(stride))
    starts = F.when(t <= tile, F.array(F.lit(0))).when(
        F.element_at(starts, -1) + tile < t, F.concat(starts, F.array(t - tile))).otherwise(starts)
    out = extents.withColumn("_s", starts).select("*", F.posexplode("_s").alias("tile_no", "start"))
    out = out.withColumn("_last", F.col("tile_no") == F.size("_s") - 1) \
        .withColumn("end", F.least(F.col("start") + tile, t))
    cs = F.col("start") + F.when(F.col("tile_no") > 0, overlap).otherwise(0)
    ce = F.col("end") - F.when(F.col("_last"), 0).otherwise(overlap)
    return out.withColumn("core_start", F.when(ce <= cs, F.col("start")).otherwise(cs)) \
        .withColumn("core_end", F.when(ce <= cs, F.col("end")).otherwise(ce)).drop("_s", "_last")


def exact_tiles(extents: DataFrame, total, tile) -> DataFrame:
    """Windows of one width that cover [0, total) once; the last may be short."""
    starts = F.sequence(F.lit(0), F.col(total) - 1, F.lit(tile))
    return extents.select("*", F.posexplode(starts).alias("tile_no", "start")) \
        .withColumn("end", F.least(F.col("start") + tile, F.col(total)))


def axis_split(extents: DataFrame, total, n, prefix="") -> DataFrame:
    """n windows over [0, total) whose widths differ by at most one."""
    n = F.col(n) if isinstance(n, str) else F.lit(n)
    base, rem = F.floor(F.col(total) / n).cast("int"), F.pmod(F.col(total), n)
    i = F.col(prefix + "no")
    return (extents.withColumn(prefix + "no", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn(prefix + "start", (i * base + F.least(i, rem)).cast("int"))
            .withColumn(prefix + "end", ((i + 1) * base + F.least(i + 1, rem)).cast("int"))
            .filter(F.col(prefix + "end") > F.col(prefix + "start")))


def _fit(w: Column, h: Column, s: Column, cx: Column, cy: Column) -> Column:
    """Rank of a cx by cy grid of sections over a w by h extent; less is better."""
    cm = V.BLOCK_CM
    err_x, err_y = cx * s * cm - w * cm, cy * s * cm - h * cm
    rel = F.greatest(err_x / F.greatest(F.lit(1.0), w * cm), err_y / F.greatest(F.lit(1.0), h * cm))
    return F.struct(
        F.round(F.greatest(F.lit(0.0), rel - TOLERANCE), 12).alias("over"),
        F.greatest(F.lit(0), cx * cy - MAX_TOTAL).alias("over_count"), (cx * cy).alias("count"),
        (err_x + err_y).alias("err"), F.round(F.abs(F.ln(cx / cy)), 12).alias("skew"),
        s.alias("section"), cx.alias("cx"), cy.alias("cy"), err_x.alias("err_x"), err_y.alias("err_y"))


def _too_large(w, h, most):
    """Even the largest sections need more than ``most`` on an axis."""
    return F.ceil(F.greatest(w, h) / max(V.SECTION_SIZES)) > most


def _reason(most):
    return F.lit(f"needs more than {most} sections on an axis")


def grid_candidates(extents: DataFrame, w="width", h="depth", most=MAX_PER_AXIS) -> DataFrame:
    """Every section grid in the search range that covers each extent, with at
    most ``most`` sections on an axis. An extent that none covers has one row
    with nulls and a ``reason``."""
    # Each extent grows to thousands of rows, so they are dealt out first.
    sized = spread(extents, *extents.columns).withColumn("section", F.explode(F.array(*map(F.lit, V.SECTION_SIZES))))
    nx, ny = [F.greatest(F.lit(1), F.ceil(F.col(c) / F.col("section")).cast("int")) for c in (w, h)]
    slack = F.greatest(F.lit(2), (F.floor(most / F.greatest(nx, ny)) + 1).cast("int"))
    sized = sized.filter((nx <= most) & (ny <= most))
    found = (sized.withColumn("cx", F.explode(F.sequence(nx, F.least(F.lit(most), nx + slack))))
             .withColumn("cy", F.explode(F.sequence(ny, F.least(F.lit(most), ny + slack)))).withColumn("reason", F.lit(None).cast("string")))
    none = F.lit(None).cast("int")
    large = extents.filter(_too_large(F.col(w), F.col(h), most)).withColumns({"section": none, "cx": none, "cy": none, "reason": _reason(most)})
    return found.unionByName(large)


def candidate_rank(candidates: DataFrame, group, w="width", h="depth") -> DataFrame:
    """Best candidate per extent."""
    fit = _fit(F.col(w), F.col(h), F.col("section"), F.col("cx"), F.col("cy"))
    return candidates.withColumn("fit", fit).groupBy(group).agg(F.min("fit").alias("fit")).select(group, "fit.*")


def best_components(w: Column, h: Column, most=MAX_PER_AXIS) -> Column:
    """Best section grid for an extent, without a shuffle; null where none fits.

    A larger count on either axis never lowers any part of the rank and always
    raises the count, so the smallest covering grid of each section size is
    the only candidate that can win.
    """
    fits = F.transform(F.array(*map(F.lit, V.SECTION_SIZES)), lambda s: _fit(
        w, h, s, F.greatest(F.lit(1), F.ceil(w / s).cast("int")), F.greatest(F.lit(1), F.ceil(h / s).cast("int"))))
    fits = F.filter(fits, lambda f: (f["cx"] <= most) & (f["cy"] <= most))
    return F.array_min(fits)


def plan_tile_components(extents: DataFrame, w="width", h="depth", most=MAX_PER_AXIS) -> DataFrame:
    """Best section grid of each extent; nulls and a ``reason`` where none fits."""
    best = extents.withColumn("best", best_components(F.col(w), F.col(h), most))
    return best.select(*extents.columns, F.col("best.section").alias("section"), F.col("best.cx").alias("cx"),
                       F.col("best.cy").alias("cy"),
                       (F.col("best.cx") * F.col("best.section") + 1).alias("size_x"),
                       (F.col("best.cy") * F.col("best.section") + 1).alias("size_y"),
                       F.col("best.err_x").alias("err_x"), F.col("best.err_y").alias("err_y"),
                       F.when(F.col("best").isNull(), _reason(most)).alias("reason"))


def plan_tile_grid(extents: DataFrame, max_tile_blocks: int, search=8, w="width", h="depth") -> DataFrame:
    """Tiles per axis: the fewest at or above the size limit whose tiles need a
    section at most one step finer than the whole; else the most below it. An
    extent too large to be one tile takes any section; null if no split fits."""
    if not max_tile_blocks:
        return extents.withColumn("tiles", F.lit(1))
    sizes = F.array(*map(F.lit, V.SECTION_SIZES))

    def need(c):
        return F.greatest(F.lit(1), F.ceil(F.col(c) / max_tile_blocks).cast("int"))

    e = extents.withColumn("_min", F.greatest(need(w), need(h)))
    base = best_components(F.col(w), F.col(h))["section"]
    step = F.greatest(F.lit(0), (F.array_position(sizes, F.coalesce(base, F.lit(V.SECTION_SIZES[0]))) - 2).cast("int"))
    e = e.withColumn("_allowed", F.get(sizes, step)) \
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_min"), F.lit(search)))))
    e = e.withColumn("_w", F.array(F.floor(F.col(w) / F.col("n")), F.ceil(F.col(w) / F.col("n")))) \
         .withColumn("_h", F.array(F.floor(F.col(h) / F.col("n")), F.ceil(F.col(h) / F.col("n"))))
    found = [best_components(F.get("_w", i), F.get("_h", j))["section"] for i in (0, 1) for j in (0, 1)]
    fit = reduce(lambda a, b: a & b, [f.isNotNull() & (f >= F.col("_allowed")) for f in found])
    ok = e.filter(fit)
    above = F.min(F.when(F.col("n") >= F.col("_min"), F.col("n")))
    below = F.max(F.when(F.col("n") < F.col("_min"), F.col("n")))
    picked = ok.groupBy(*extents.columns).agg(F.coalesce(above, below).alias("tiles"))
    return extents.join(picked, extents.columns, "left").withColumn("tiles", F.coalesce("tiles", F.when(base.isNotNull(), 1)))


# --- height codes ------------------------------------------------------------

def encode_height(h: Column, y_min, y_span) -> Column:
    norm = (h - y_min) / y_span
    return F.least(F.greatest(F.rint(norm * 65535.0), F.lit(0.0)), F.lit(65535.0)).cast("int")


def z_scale_cm(y_span):
    return y_span * V.BLOCK_CM / 512.0


def z_offset_cm(y_min, y_span):
    return y_min * V.BLOCK_CM + z_scale_cm(y_span) * 256.0


def decode_height(v: Column, scale_cm, offset_cm) -> Column:
    """Height in centimetres of a stored 16-bit sample."""
    return offset_cm + (v - 32768.0) / 128.0 * scale_cm


def normalize_u16(h: Column, lo, hi) -> Column:
    hi = F.when(hi <= lo, lo + 1.0).otherwise(hi)
    return F.least(F.greatest((h - lo) / (hi - lo) * 65535.0, F.lit(0.0)), F.lit(65535.0)).cast("int")


# --- resampling --------------------------------------------------------------

def resample_to_grid(tiles: DataFrame, grid: DataFrame, value="height") -> DataFrame:
    """Samples of each tile on its vertex grid, from the nearest source cell.

    tiles: tile, x0, z0 (world cell of the corner), width, depth, size_x,
    size_y. Tiles whose vertex grid is smaller than the source are refused.
    """
    checked = tiles.withColumn("size_x", F.when(F.col("size_x") < F.col("width"), F.raise_error(
        F.lit("vertex grid smaller than the field"))).otherwise(F.col("size_x"))) \
        .withColumn("size_y", F.when(F.col("size_y") < F.col("depth"), F.raise_error(
            F.lit("vertex grid smaller than the field"))).otherwise(F.col("size_y")))
    rows = checked.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("size_y") - 1)))
    samples = (spread(rows, "tile", "row").withColumn("col", F.explode(F.sequence(F.lit(0), F.col("size_x") - 1))))

    def source(i, n, size):
        at = F.rint(F.col(i) * (F.col(n).cast("double") / F.col(size))).cast("int")
        return F.least(F.greatest(at, F.lit(0)), F.col(n) - 1)

    samples = samples.withColumn("x", F.col("x0") + source("col", "width", "size_x")) \
                     .withColumn("z", F.col("z0") + source("row", "depth", "size_y"))
    # Both sides grow with the world; the planner takes rows that come from few tiles for few rows.
    return samples.join(grid.select("x", "z", F.col(value).cast("double").alias("h")).hint("merge"), ["x", "z"]) \
        .select("tile", "row", "col", "h")


def upsample_grid(grid: DataFrame, bounds: DataFrame, factor=4, value="height") -> DataFrame:
    """Bilinear grid of ``factor`` times the cells per axis, ends aligned. Each
    source cell emits the samples that fall into it, so nothing is joined."""
    x0, x1, z0, z1 = corners(bounds)
    w, d = x1 - x0 + 1, z1 - z0 + 1
    g = grid.select((F.col("x") - x0).alias("x"), (F.col("z") - z0).alias("z"), F.col(value).cast("double").alias("h00"))
    g = g.withColumn("h10", F.coalesce(F.lead("h00").over(row()), "h00"))
    g = g.withColumn("h01", F.coalesce(F.lead("h00").over(column()), "h00")) \
         .withColumn("h11", F.coalesce(F.lead("h10").over(column()), "h10")) \
         .withColumn("_w", w).withColumn("_d", d)

    def first(i, n):
        """First output index at or after source index i: ceil(i (f n - 1) / (n - 1))."""
        return F.expr(f"({i} * ({factor} * {n} - 1) + {n} - 2) div greatest({n} - 1, 1)")

    def span(i, n):
        last = F.expr(f"CASE WHEN {i} = {n} - 1 THEN {factor} * {n} - 1 ELSE "
                      f"(({i} + 1) * ({factor} * {n} - 1) + {n} - 2) div greatest({n} - 1, 1) - 1 END")
        return F.filter(F.sequence(first(i, n), F.greatest(last, first(i, n))), lambda u: u <= last)

    g = g.withColumn("u", F.explode(span("x", "_w"))).withColumn("v", F.explode(span("z", "_d")))

    def part(u, i, n):
        return F.expr(f"{u} * ({n} - 1) / ({factor} * {n} - 1.0D) - {i}")

    fx, fz = part("u", "x", "_w"), part("v", "z", "_d")
    h = (F.col("h00") * (1 - fx) + F.col("h10") * fx) * (1 - fz) + (F.col("h01") * (1 - fx) + F.col("h11") * fx) * fz
    return g.select(F.col("u").cast("int").alias("u"), F.col("v").cast("int").alias("v"), h.alias("h"))


def world_tiles(bounds: DataFrame, tiles_x: int, tiles_z: int) -> DataFrame:
    """Balanced disjoint tiles over the grid with their planned vertex grids."""
    one = bounds.select("min_x", "min_z", (F.col("max_x") - F.col("min_x") + 1).alias("w"),
                        (F.col("max_z") - F.col("min_z") + 1).alias("d"))
    t = axis_split(axis_split(one, "d", tiles_z, "z"), "w", tiles_x, "x")
    t = t.select(F.format_string("%02d_%02d", "zno", "xno").alias("tile"), "zno", "xno",
                 (F.col("min_x") + F.col("xstart")).alias("x0"), (F.col("min_z") + F.col("zstart")).alias("z0"),
                 (F.col("xend") - F.col("xstart")).alias("width"), (F.col("zend") - F.col("zstart")).alias("depth"))
    planned = plan_tile_components(t)
    # A tile without a plan would lose its samples, so it is an error here.
    section = F.when(F.col("reason").isNull(), F.col("section")).otherwise(
        F.raise_error(F.concat(F.lit("ask for more tiles: "), "tile", F.lit(" "), "reason")).cast("int"))
    return planned.withColumn("section", section).drop("reason")


def export_tiles(grid: DataFrame, bounds: DataFrame, tiles_x: int, tiles_z: int, y_min, y_span, value="height"):
    """Tile table and encoded samples of a filled height grid."""
    tiles = world_tiles(bounds, tiles_x, tiles_z)
    samples = resample_to_grid(tiles, grid, value).withColumn("v", encode_height(F.col("h"), y_min, y_span))
    return tiles, samples


def tile_totals(tiles: DataFrame) -> DataFrame:
    return tiles.agg(n_rows("tiles"), F.sum("cx").alias("sum_cx"), F.sum("cy").alias("sum_cy"),
                     F.sum(F.col("cx") * F.col("cy")).alias("components"),
                     F.max("err_x").alias("max_err_x"), F.max("err_y").alias("max_err_y"))


def mosaic_tiles(tiles: DataFrame, samples: DataFrame, scale_cm, offset_cm, stride=1) -> DataFrame:
    """Samples of all tiles, or every ``stride``-th, on one grid in world
    centimetres; where tiles overlap the later one counts."""
    cm = V.BLOCK_CM
    s = samples.filter((F.col("row") % stride == 0) & (F.col("col") % stride == 0)) \
        .join(tiles.select("tile", "x0", "z0", F.struct("zno", "xno").alias("place")), "tile")
    return (s.withColumn("key_x", (F.col("x0") * cm + F.col("col") * cm).cast("int"))
            .withColumn("key_y", (F.col("z0") * cm + F.col("row") * cm).cast("int"))
            .groupBy("key_x", "key_y")
            .agg(F.max_by(decode_height(F.col("v"), scale_cm, offset_cm), "place").alias("z_cm")))


def tile_partition_check(tiles: DataFrame, bounds: DataFrame) -> DataFrame:
    """Tiles that start at the wrong edge, leave a gap, overlap or stop short."""
    from pyspark.sql import Window
    x0, x1, z0, z1 = corners(bounds)
    in_row, in_col = Window.partitionBy("zno").orderBy("xno"), Window.partitionBy("xno").orderBy("zno")
    want_x = F.coalesce(F.lag(F.col("x0") + F.col("width")).over(in_row), x0)
    want_z = F.coalesce(F.lag(F.col("z0") + F.col("depth")).over(in_col), z0)
    last_x, last_z = F.lead("x0").over(in_row).isNull(), F.lead("z0").over(in_col).isNull()
    ok = (F.col("x0") == want_x) & (F.col("z0") == want_z) \
        & (~last_x | (F.col("x0") + F.col("width") == x1 + 1)) & (~last_z | (F.col("z0") + F.col("depth") == z1 + 1))
    return tiles.withColumn("ok", ok).select("tile", "ok")


def height_range_check(tiles: DataFrame, samples: DataFrame, y_min, y_span, scale_cm, offset_cm) -> DataFrame:
    """Are the samples of each tile inside the recorded height range?"""
    s = samples.join(tiles.select("tile"), "tile")
    y = decode_height(F.col("v"), scale_cm, offset_cm) / V.BLOCK_CM
    g = s.groupBy("tile").agg(F.round(F.min(y), 6).alias("lo"), F.round(F.max(y), 6).alias("hi"))
    slack = F.greatest(F.lit(0.5), 0.02 * y_span)
    return g.withColumn("ok", (F.col("lo") >= y_min - slack) & (F.col("hi") <= y_min + y_span + slack))


# fixed values: colour ramp stops, equally spaced, red green blue
RAMP = [(0.00, 0.16, 0.38), (0.28, 0.48, 0.35), (0.55, 0.62, 0.36),
        (0.74, 0.64, 0.44), (0.88, 0.85, 0.78), (1.00, 1.00, 1.00)]


def ramp_colour(t: Column, channel: int) -> Column:
    """Linear colour ramp over t in 0..1, as 0..255."""
    stops = F.array(*[F.lit(s[channel]) for s in RAMP])
    at = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0)) * (len(RAMP) - 1)
    i = F.least(F.floor(at), F.lit(len(RAMP) - 2)).cast("int")
    lo, hi = F.get(stops, i), F.get(stops, i + 1)
    return F.floor(F.round((lo + (hi - lo) * (at - i)) * 255, 9)).cast("int")


def blend_weight(i: Column, total: Column, ramp: Column) -> Column:
    """Raised-cosine weight of place i in a window: 0 at the ends, 1 inside."""
    r = F.when(total > 3, F.least(ramp, F.floor(total / 2).cast("int"))).otherwise(1)

    def rise(k):
        return F.when(k >= r, 1.0).when(r <= 1, 0.0).otherwise(
            0.5 * (1.0 - F.cos(F.lit(3.141592653589793) * k / (r - 1))))

    return F.least(rise(i), rise(total - 1 - i))
