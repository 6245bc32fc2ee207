"""Measurements over pixel tables: image_id, px_row, px_col, r, g, b."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import colours as L
from .census import n_rows
from .columns import spread


def rgb():
    return F.col("r"), F.col("g"), F.col("b")


def image_region_stats(pixels: DataFrame, regions) -> DataFrame:
    """Mean colour and luma spread per named box (name, x0, y0, x1, y1)."""
    boxes = F.array(*[F.struct(F.lit(n).alias("region"), *[F.lit(v).alias(k) for k, v in zip(("x0", "y0", "x1", "y1"), box)])
                      for n, *box in regions])
    inside = F.filter(boxes, lambda b: (F.col("px_col") >= b["x0"]) & (F.col("px_col") < b["x1"])
                      & (F.col("px_row") >= b["y0"]) & (F.col("px_row") < b["y1"]))
    p = pixels.withColumn("luma", L.luma(*rgb())).withColumn("box", F.explode(inside)).withColumn("region", F.col("box.region"))
    return p.groupBy("image_id", "region").agg(
        *[F.round(F.avg(c), 1).alias("mean_" + c) for c in "rgb"],
        F.round(F.avg("luma"), 2).alias("mean_luma"), F.round(F.stddev_pop("luma"), 2).alias("std_luma"))


def local_std(pixels: DataFrame, block=8) -> DataFrame:
    """Mean luma spread of whole block x block tiles; of the image if it has none."""
    p = pixels.withColumn("luma", L.luma(*rgb()))
    size = p.groupBy("image_id").agg((F.max("px_row") + 1).alias("h"), (F.max("px_col") + 1).alias("w"),
                                     F.stddev_pop("luma").alias("whole"))
    tiles = (p.join(size, "image_id")
             .filter((F.col("px_row") < F.floor(F.col("h") / block) * block) & (F.col("px_col") < F.floor(F.col("w") / block) * block))
             .groupBy("image_id", F.floor(F.col("px_row") / block), F.floor(F.col("px_col") / block))
             .agg(F.stddev_pop("luma").alias("s")))
    means = tiles.groupBy("image_id").agg(F.avg("s").alias("s"))
    return size.join(means, "image_id", "left").select("image_id", F.round(F.coalesce("s", "whole"), 6).alias("local_std"))


def _lines():
    return (Window.partitionBy("image_id", "px_row").orderBy("px_col"),
            Window.partitionBy("image_id", "px_col").orderBy("px_row"))


def gradient_energy(pixels: DataFrame) -> DataFrame:
    across, down = _lines()
    p = pixels.withColumn("l", L.luma(*rgb()))
    p = p.withColumn("dx", F.abs(F.lead("l").over(across) - F.col("l"))).withColumn("dy", F.abs(F.lead("l").over(down) - F.col("l")))
    return p.groupBy("image_id").agg(F.round(F.avg("dx") + F.avg("dy"), 6).alias("energy"))


def laplacian_energy(pixels: DataFrame) -> DataFrame:
    across, down = _lines()
    p = pixels.withColumn("l", L.luma(*rgb()))
    p = p.withColumn("h", F.lag("l").over(across) + F.lead("l").over(across))
    p = p.withColumn("v", F.lag("l").over(down) + F.lead("l").over(down))
    return p.groupBy("image_id").agg(F.round(F.avg(F.abs(4.0 * F.col("l") - F.col("h") - F.col("v"))), 6).alias("energy"))


def colour_clusters(pixels: DataFrame, bits=5, top=5) -> DataFrame:
    """Commonest quantised colours with their share of the image, and how many
    colours hold more than one percent. Equal counts rank by larger code."""
    drop = 8 - bits
    code = None
    for c in "rgb":
        part = F.shiftright(c, drop)
        code = part if code is None else F.shiftleft(code, bits).bitwiseOR(part)
    counted = pixels.groupBy("image_id", code.alias("code")).agg(n_rows())
    all_of = Window.partitionBy("image_id")
    ranked = counted.withColumn("total", F.sum("n").over(all_of)) \
        .withColumn("rank", F.row_number().over(all_of.orderBy(F.desc("n"), F.desc("code")))) \
        .withColumn("over_1pct", F.sum((F.col("n") > F.col("total") * 0.01).cast("int")).over(all_of))
    half, mask = 1 << (drop - 1), (1 << bits) - 1

    def centre(shift):
        return F.shiftleft(F.shiftright("code", shift).bitwiseAND(mask), drop) + half

    return ranked.filter(F.col("rank") <= top).select(
        "image_id", "rank", centre(2 * bits).alias("r"), centre(bits).alias("g"), centre(0).alias("b"),
        F.round(F.col("n") / F.col("total"), 4).alias("share"), "over_1pct")


def frame_census(pixels: DataFrame, step=1) -> DataFrame:
    """Mean colour and shares of dark, sky, lit and green pixels on a grid of
    every step-th pixel, with the number of distinct coarse colours."""
    r, g, b = rgb()
    lum = L.luma(r, g, b)
    dark, sky = lum < 24, (b > r + 25) & (b > 90)
    p = pixels.filter((F.col("px_row") % step == 0) & (F.col("px_col") % step == 0))

    def pct(cond):
        return F.round(100.0 * F.avg(cond.cast("double")), 6)

    return p.groupBy("image_id").agg(
        *[F.floor(F.avg(c)).cast("int").alias("mean_" + c) for c in "rgb"], pct(dark).alias("dark_pct"),
        pct(~dark & sky).alias("sky_pct"), pct(~dark & ~sky & (lum > 45)).alias("lit_pct"),
        pct((g > r) & (g > b)).alias("green_pct"),
        F.size(F.collect_set(F.floor(r / 24) * 121 + F.floor(g / 24) * 11 + F.floor(b / 24))).cast("bigint").alias("distinct"))


def local_contrast(pixels: DataFrame) -> DataFrame:
    """Mean step between neighbouring grey pixels in the lower band."""
    size = pixels.groupBy("image_id").agg((F.max("px_row") + 1).alias("h"), (F.max("px_col") + 1).alias("w"))

    def cut(share, n):
        return F.floor(F.round(share * F.col(n), 9))

    band = pixels.join(size, "image_id").filter(
        (F.col("px_col") >= cut(0.08, "w")) & (F.col("px_col") < cut(0.94, "w"))
        & (F.col("px_row") >= cut(0.72, "h")) & (F.col("px_row") < cut(0.97, "h"))) \
        .withColumn("grey", L.luma_8bit(*rgb()))
    across = Window.partitionBy("image_id", "px_row").orderBy("px_col")
    band = band.withColumn("step", F.abs(F.lead("grey").over(across) - F.col("grey")))
    used = ((F.col("px_row") - cut(0.72, "h")) % 3 == 0) & ((F.col("px_col") - cut(0.08, "w")) % 2 == 0)
    return band.groupBy("image_id").agg(
        F.round(F.coalesce(F.avg(F.when(used, F.col("step"))), F.lit(0.0)), 6).alias("contrast"),
        F.min("grey").alias("lo"), F.max("grey").alias("hi"))


def alpha_stats(pixels: DataFrame, alpha="a") -> DataFrame:
    def share(cond):
        return F.round(F.avg(cond.cast("double")), 6)
    a = F.col(alpha)
    return pixels.groupBy("image_id").agg(n_rows("total"), share(a == 0).alias("frac_0"),
                                          share(a == 255).alias("frac_opaque"), share(a != 0).alias("opaque_frac"))


def cell_means(pixels: DataFrame, cell: int, want, tolerance=6) -> DataFrame:
    """Mean colour per square cell with red minus blue, saturation and whether
    every channel is close to the wanted colour."""
    means = pixels.groupBy("image_id", F.floor(F.col("px_col") / cell).cast("int").alias("cell_x"),
                           F.floor(F.col("px_row") / cell).cast("int").alias("cell_y")) \
        .agg(*[F.avg(c).alias(c) for c in "rgb"])
    ok = None
    for c, v in zip("rgb", want):
        near = F.abs(F.col(c) - v) <= tolerance
        ok = near if ok is None else ok & near
    return means.select("image_id", "cell_x", "cell_y", *[F.round(c, 6).alias("mean_" + c) for c in "rgb"],
                        F.round(F.col("r") - F.col("b"), 6).alias("red_minus_blue"),
                        F.round(L.saturation(*rgb()), 6).alias("saturation"), ok.alias("ok"))


def gained(value, gain):
    return F.least(F.greatest(F.rint(value * gain), F.lit(0.0)), F.lit(255.0))


def clip_share(pixels: DataFrame, gains) -> DataFrame:
    """Share of pixels with a channel at the top after a gain, and the spread
    that each channel keeps."""
    out = [gained(F.col(c), g) for c, g in zip("rgb", gains)]
    hit = (out[0] >= 255) | (out[1] >= 255) | (out[2] >= 255)
    return pixels.groupBy("image_id").agg(
        F.round(100.0 * F.avg(hit.cast("double")), 6).alias("clip_pct"),
        *[F.round(F.stddev_pop(o), 6).alias("std_" + c) for o, c in zip(out, "rgb")])


def channel_histograms(pixels: DataFrame) -> DataFrame:
    """At most 256 counted values per image and channel, as an array."""
    tall = pixels.select("image_id", F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("v"))
                                                         for c in "rgb"])).alias("e"))
    counted = tall.groupBy("image_id", "e.channel", "e.v").agg(n_rows("k"))
    hists = counted.groupBy("image_id", "channel").agg(
        F.array_sort(F.collect_list(F.struct("v", "k"))).alias("hist"), F.sum("k").alias("total"))
    # few bytes but much work per row follows
    return spread(hists, "image_id", "channel")


def mean_after_gain(hist, total, gain):
    return F.aggregate(hist, F.lit(0.0), lambda acc, e: acc + gained(e["v"], gain) * e["k"]) / total


def solve_gain(pixels: DataFrame, targets, lo=0.05, hi=8.0, rounds=40) -> DataFrame:
    """Gain per channel whose clipped mean comes closest to the target, by
    halving the interval a fixed number of times."""
    h = channel_histograms(pixels)
    target = F.lit(None).cast("double")
    for c, v in zip("rgb", targets):
        target = F.when(F.col("channel") == c, float(v)).otherwise(target)
    h = h.withColumn("target", target)
    start = F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(1.0).alias("best"), F.lit(1e300).alias("err"))

    def halve(state, _):
        mid = (state["lo"] + state["hi"]) / 2.0
        got = mean_after_gain(F.col("hist"), F.col("total"), mid)
        err = F.abs(got - F.col("target"))
        low = got < F.col("target")
        return F.struct(F.when(low, mid).otherwise(state["lo"]).alias("lo"), F.when(low, state["hi"]).otherwise(mid).alias("hi"),
                        F.when(err < state["err"], mid).otherwise(state["best"]).alias("best"),
                        F.least(err, state["err"]).alias("err"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, halve)
    return h.withColumn("s", done).select("image_id", "channel", F.round("s.best", 6).alias("gain"), F.round("s.err", 6).alias("error"))


def bake_gain(pixels: DataFrame, target) -> DataFrame:
    """Gain to a target colour per image, the mean it really gives, and how far
    that is from the target."""
    h = channel_histograms(pixels)
    want = F.lit(None).cast("double")
    for c, v in zip("rgb", target):
        want = F.when(F.col("channel") == c, float(v)).otherwise(want)
    mean = F.aggregate("hist", F.lit(0.0), lambda acc, e: acc + e["v"] * e["k"]) / F.col("total")
    h = h.withColumn("gain", want / mean)
    h = h.withColumn("real", mean_after_gain(F.col("hist"), F.col("total"), F.col("gain")))
    wide = h.groupBy("image_id").agg(*[F.max(F.when(F.col("channel") == c, F.col(k))).alias(f"{k}_{c}")
                                       for k in ("gain", "real") for c in "rgb"])
    for i, v in enumerate(L.rgb_to_lab(*[F.round("real_" + c, 3) for c in "rgb"])):
        wide = wide.withColumn(f"lab1_{i}", v)
    for i, v in enumerate(L.rgb_to_lab(*[F.lit(float(v)) for v in target])):
        wide = wide.withColumn(f"lab2_{i}", v)
    wide = L.with_ciede2000(wide, [f"lab1_{i}" for i in range(3)], [f"lab2_{i}" for i in range(3)])
    return wide.select("image_id", *[F.round("gain_" + c, 4).alias("gain_" + c) for c in "rgb"],
                       *[F.round("real_" + c, 3).alias("real_" + c) for c in "rgb"], F.round("de2000", 4).alias("de2000"))


def seam_metrics(pixels: DataFrame, baseline=64) -> DataFrame:
    """Step across the wrapped edges against a step inside the image."""
    size = pixels.groupBy("image_id").agg(F.max("px_row").alias("h"), F.max("px_col").alias("w"))
    p = pixels.join(size, "image_id")

    def seam(axis, other, last):
        on_edge = p.filter((F.col(axis) == 0) | (F.col(axis) == last))
        pair = on_edge.groupBy("image_id", other).agg(
            *[F.abs(F.max(F.when(F.col(axis) == 0, F.col(c))) - F.max(F.when(F.col(axis) == last, F.col(c)))).alias(c) for c in "rgb"])
        return pair.groupBy("image_id").agg(F.round(F.avg((F.col("r") + F.col("g") + F.col("b")) / 3.0), 6).alias("d"))

    h = seam("px_col", "px_row", F.col("w")).withColumnRenamed("d", "wrap_h")
    v = seam("px_row", "px_col", F.col("h")).withColumnRenamed("d", "wrap_v")
    base = seam("px_col", "px_row", F.lit(baseline)).withColumnRenamed("d", "baseline")
    return h.join(v, "image_id").join(base, "image_id")


def image_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Largest channel step per pixel of image pairs; ``pair`` names a pair. A
    pixel that only one image has makes the pair a size mismatch."""
    b = right.select("pair", "px_row", "px_col", *[F.col(c).alias(c + "2") for c in "rgb"])
    both = left.join(b, ["pair", "px_row", "px_col"], "full")
    d = F.greatest(*[F.abs(F.col(c) - F.col(c + "2")) for c in "rgb"])
    both = both.withColumn("d", F.when(F.col("r").isNotNull() & F.col("r2").isNotNull(), d))
    return both.groupBy("pair").agg(
        F.count_if(F.col("d").isNull()).alias("unmatched"), F.max("d").alias("max"), F.round(F.avg("d"), 4).alias("mean"),
        F.count_if(F.col("d") > 0).alias("changed"), F.count_if(F.col("d") > 8).alias("over_8"),
        n_rows("total"), F.round(100.0 * F.count_if(F.col("d") > 8) / F.count(F.lit(1)), 4).alias("pct_over_8"))
