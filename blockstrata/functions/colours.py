"""Colour maths as column expressions, channels 0..255."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .rules import any_token, literal_map, strip_ns


def luma(r, g, b) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def luma_8bit(r, g, b) -> Column:
    """Luma as an 8-bit grey image stores it."""
    return F.shiftright(r * 19595 + g * 38470 + b * 7471 + 32768, 16)


def saturation(r, g, b) -> Column:
    hi = F.greatest(r, g, b)
    return F.when(hi <= 0, 0.0).otherwise((hi - F.least(r, g, b)) / hi)


def srgb_to_linear(c) -> Column:
    v = c / 255.0
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def hex_to_linear(text) -> Column:
    body = F.regexp_replace(text, "^#+", "")
    return F.array(*[srgb_to_linear(F.conv(F.substring(body, i, 2), 16, 10).cast("double")) for i in (1, 3, 5)])


# fixed values: linear RGB to XYZ, white point
XYZ = [(0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041)]
WHITE = (0.95047, 1.00000, 1.08883)


def rgb_to_lab(r, g, b):
    """Columns L, a, b of the CIE Lab colour."""
    lin = [srgb_to_linear(c) for c in (r, g, b)]
    f = []
    for row, white in zip(XYZ, WHITE):
        t = (lin[0] * row[0] + lin[1] * row[1] + lin[2] * row[2]) / white
        f.append(F.when(t > 216.0 / 24389.0, F.cbrt(t)).otherwise((t * (24389.0 / 27.0) + 16.0) / 116.0))
    return 116.0 * f[1] - 16.0, 500.0 * (f[0] - f[1]), 200.0 * (f[1] - f[2])


def with_ciede2000(df, lab1, lab2, out="de2000"):
    """CIEDE2000 difference of two Lab colours given by column names. The steps
    are kept as helper columns, so no expression is repeated in the plan."""
    (l1, a1, b1), (l2, a2, b2) = [[F.col(c) for c in lab] for lab in (lab1, lab2)]

    helpers = []

    def add(name, value):
        nonlocal df
        helpers.append("_de2000_" + name)
        df = df.withColumn(helpers[-1], value)
        return F.col(helpers[-1])

    def hypot(x, y):
        return F.sqrt(x * x + y * y)

    mean_c = add("c7", F.pow((hypot(a1, b1) + hypot(a2, b2)) / 2.0, F.lit(7)))
    grow = add("g", 1.5 - 0.5 * F.sqrt(mean_c / (mean_c + 25.0 ** 7)))
    p1, p2 = add("p1", a1 * grow), add("p2", a2 * grow)
    c1, c2 = add("c1", hypot(p1, b1)), add("c2", hypot(p2, b2))

    def hue(name, y, x):
        h = add(name, F.degrees(F.atan2(y, x)))
        return add(name + "w", F.when(h < 0, h + 360.0).otherwise(h))

    h1, h2 = hue("h1", b1, p1), hue("h2", b2, p2)
    grey = c1 * c2 == 0
    turn = add("t", h2 - h1)
    dh = add("dh", F.when(grey, 0.0).when(turn > 180, turn - 360).when(turn < -180, turn + 360).otherwise(turn))
    d_hue = add("dhue", 2.0 * F.sqrt(c1 * c2) * F.sin(F.radians(dh) / 2.0))
    total = add("s", h1 + h2)
    mean_h = add("mh", F.when(grey, total).when(F.abs(h1 - h2) <= 180, total / 2)
                 .when(total < 360, (total + 360) / 2).otherwise((total - 360) / 2))
    mean_l, mean_cp = add("ml", (l1 + l2) / 2), add("mc", (c1 + c2) / 2)

    def wave(factor, k, shift):
        return factor * F.cos(F.radians(k * mean_h + shift))

    t = add("T", 1.0 - wave(0.17, 1.0, -30.0) + wave(0.24, 2.0, 0.0) + wave(0.32, 3.0, 6.0) - wave(0.20, 4.0, -63.0))
    off = add("o", (mean_l - 50.0) * (mean_l - 50.0))
    sl = 1.0 + 0.015 * off / F.sqrt(20.0 + off)
    sc, sh = 1.0 + 0.045 * mean_cp, 1.0 + 0.015 * mean_cp * t
    m7 = add("m7", F.pow(mean_cp, F.lit(7)))
    bell = (mean_h - 275.0) / 25.0
    rt = -F.sin(F.radians(60.0 * F.exp(-(bell * bell)))) * 2.0 * F.sqrt(m7 / (m7 + 25.0 ** 7))
    x, y, z = add("x", (l2 - l1) / sl), add("y", (c2 - c1) / sc), add("z", d_hue / sh)
    df = df.withColumn(out, F.sqrt(x * x + y * y + z * z + rt * y * z))
    return df.drop(*helpers)


def alpha_from_black(r, g, b, lo, hi) -> Column:
    """Opacity of a picture that lost it over a black ground."""
    share = (F.greatest(r, g, b) - lo) / float(hi - lo)
    return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * 255.0).cast("int")


def guess_colour(name) -> Column:
    """Placeholder colour as array of three 0..1 channels."""
    n = strip_ns(name)
    words = literal_map({k: "/".join(map(str, v)) for k, v in V.WORD_COLOURS.items()})
    special = literal_map({k: "/".join(map(str, v)) for k, v in V.PLACEHOLDER_COLOURS.items()})
    known = F.filter(F.split(n, "_"), lambda t: F.map_contains_key(words, t))
    last = F.get(F.reverse(known), 0)
    keys = F.split(F.lit(" ".join(V.PLACEHOLDER_COLOURS)), " ")
    prefix = F.get(F.filter(keys, lambda k: F.startswith(n, k)), 0)
    whole = F.coalesce(words[n], special[n])
    text = F.coalesce(whole, words[last], special[prefix], F.lit("/".join(map(str, V.NO_COLOUR))))
    darker = whole.isNull() & last.isNotNull() & any_token(n, V.DARKENED_TOKENS)
    return F.transform(F.split(text, "/"), lambda c: c.cast("double") * F.when(darker, V.DARKEN).otherwise(1.0))


def adapter_tier(name, vram_mb) -> Column:
    """Quality tier of a graphics adapter, null when nothing is known of it."""
    low = F.lower(name)

    def has(tokens):
        hit = F.lit(False)
        for t in tokens:
            hit = hit | F.contains(low, F.lit(t))
        return hit

    def at_least(mb, yes, no):
        return F.when(vram_mb.isNull() | (vram_mb >= mb), yes).otherwise(no)

    return (F.when(has(V.ADAPTER_HIGH), at_least(8000, "Epic", "High"))
            .when(has(V.ADAPTER_MID), at_least(6000, "High", "Medium"))
            .when(has(V.ADAPTER_SHARED), F.when(vram_mb >= 7000, "Medium").otherwise("Low"))
            .when(has(V.ADAPTER_MAKERS), F.when(vram_mb >= 12000, "Epic").when(vram_mb >= 8000, "High")
                  .otherwise("Medium")))


def index_tier(cpu, gpu) -> Column:
    i, (low, mid, high) = F.least(cpu, gpu), V.TIER_INDEX
    return F.when(i < low, "Low").when(i < mid, "Medium").when(i < high, "High").otherwise("Epic")
