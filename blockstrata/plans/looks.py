"""Queries over names, colours and pixels."""

from pyspark.sql import functions as F

from ..functions import colours as K
from ..functions import fixed_values as V
from ..functions import rules
from ..operators import census as C
from ..operators import pixels as P
from . import rule_sql as R
from .registry import query
from .spatial import r6

N = R.bare("name")
NAMES = ("names", "SELECT DISTINCT name FROM blocks")


def names(w):
    return w.blocks().select("name").distinct()


def name_rule(key, sql, column, out=None):
    """Register a rule over every distinct block name."""
    out = out or key

    @query(key, f"SELECT name, {sql} AS {out} FROM names", ["blocks"], [NAMES])
    def _(w):
        return names(w).withColumn(out, column(F.col("name")))


name_rule("strip_ns", N, rules.strip_ns, "bare_name")
name_rule("sanitize", "'MC_' || CASE WHEN replace(name, 'minecraft:', '') = '' THEN 'Unnamed' ELSE "
          "regexp_replace(replace(name, 'minecraft:', ''), '[^A-Za-z0-9_]', '_', 'g') END", rules.sanitize, "safe_name")
name_rule("semantic_label", R.semantic_label("name"), rules.semantic_label)
name_rule("role", R.role("name"), rules.role)
name_rule("material_family", R.material_family("name"), rules.material_family)
name_rule("colour_variant", R.colour_variant("name"), rules.colour_variant)
name_rule("family_key", R.family_key("name"), rules.family_key)
name_rule("atlas_family", R.atlas_family("name"), rules.atlas_family)
name_rule("detail_kind", R.first_token(N, V.DETAIL_KIND_RULES, "trim"), rules.detail_kind)
name_rule("man_made", R.has_any("lower(name)", V.MAN_MADE_TOKENS), rules.man_made)
name_rule("natural", R.has_any("lower(name)", V.NATURAL_TOKENS), rules.natural)
name_rule("alpha_mode", R.alpha_mode("name"), rules.alpha_mode)
name_rule("emissive", R.emissive_colour("name"), rules.emissive_colour)
name_rule("shape_hint", f"CASE WHEN {R.has_any(N, V.NON_CUBE_TOKENS)} THEN 'non_cube' END", rules.shape_hint)
DYE_END = "_(" + "|".join(V.DYES) + ")$"


@query("base_family", f"""SELECT DISTINCT slot, CASE WHEN slot IN ({R.quoted(V.ATLAS_FAMILIES)}) THEN slot
   WHEN regexp_replace(slot, '{DYE_END}', '') IN ({R.quoted(V.ATLAS_FAMILIES)}) THEN regexp_replace(slot, '{DYE_END}', '') ELSE slot END AS base
  FROM (SELECT {R.atlas_family('name')} AS slot FROM names)""", ["blocks"], [NAMES])
def _(w):
    return names(w).select(rules.atlas_family(F.col("name")).alias("slot")).distinct() \
        .withColumn("base", rules.base_family(F.col("slot")))


@query("waterlogged_override", f"""SELECT name, properties, CASE WHEN list_contains(string_split(properties, ';'), 'waterlogged=true')
   AND label <> 'WATER' THEN 'PROP' ELSE label END AS label FROM (SELECT DISTINCT name, properties, {R.semantic_label('name')} AS label FROM blocks)""",
       ["blocks"])
def _(w):
    states = w.blocks().select("name", "properties").distinct()
    return states.withColumn("label", rules.waterlogged_override(rules.semantic_label(F.col("name")), F.col("properties")))


@query("parse_properties", """SELECT block_id, properties, len(string_split(properties, '=')) - 1 AS n, coalesce(regexp_extract(properties, 'waterlogged=([a-z]*)', 1), '') AS wet
  FROM blocks""", ["blocks"])
def _(w):
    m = rules.parse_properties(F.col("properties"))
    return w.blocks().select("block_id", "properties", F.size(m).cast("bigint").alias("n"),
                             F.coalesce(m["waterlogged"], F.lit("")).alias("wet"))


@query("props_key", "SELECT block_id, properties AS key FROM blocks", ["blocks"])
def _(w):
    back = F.map_from_entries(F.reverse(F.map_entries(rules.parse_properties(F.col("properties")))))
    return w.blocks().select("block_id", rules.props_key(back).alias("key"))


STEPS = R.block_rgb_steps("name")


@query("block_rgb", f"""SELECT name, rgb >> 16 AS r, (rgb >> 8) & 255 AS g, rgb & 255 AS b, source FROM (
  SELECT name, coalesce({', '.join(STEPS.values())}) AS rgb, CASE {' '.join(f"WHEN ({s}) IS NOT NULL THEN '{k}'" for k, s in STEPS.items())} END AS source
  FROM names)""", ["blocks"], [NAMES])
def _(w):
    return names(w).withColumn("c", rules.block_rgb(F.col("name"))).select("name", "c.*")


@query("material_fallback_lookup", f"""SELECT source, count(*) AS n FROM (
  SELECT name, CASE {' '.join(f"WHEN ({s}) IS NOT NULL THEN '{k}'" for k, s in STEPS.items())} END AS source FROM blocks) GROUP BY source""", ["blocks"])
def _(w):
    colour = names(w).withColumn("c", rules.block_rgb(F.col("name"))).select("name", "c.source")
    return w.blocks().join(colour, "name").groupBy("source").agg(C.n_rows())


def guess_sql():
    words, special = V.WORD_COLOURS, V.PLACEHOLDER_COLOURS
    text = lambda t: {k: "/".join(map(str, v)) for k, v in t.items()}
    last = (f"list_extract(list_reverse(list_filter(string_split({N}, '_'), lambda t: t IN ({R.quoted(words)}))), 1)")
    first = "CASE " + " ".join(f"WHEN starts_with({N}, '{k}') THEN '{k}'" for k in special) + " END"
    whole = f"coalesce({R.lookup(N, text(words))}, {R.lookup(N, text(special))})"
    return f"""SELECT name, round(CAST(string_split(t, '/')[1] AS DOUBLE) * k, 6) AS r, round(CAST(string_split(t, '/')[2] AS DOUBLE) * k, 6) AS g,
      round(CAST(string_split(t, '/')[3] AS DOUBLE) * k, 6) AS b FROM (SELECT name,
       coalesce({whole}, {R.lookup(last, text(words))}, {R.lookup(first, text(special))}, '{"/".join(map(str, V.NO_COLOUR))}') AS t,
       CASE WHEN {whole} IS NULL AND {last} IS NOT NULL AND {R.has_any(N, V.DARKENED_TOKENS)} THEN 0.94::DOUBLE ELSE 1 END AS k FROM names)"""


@query("guess_colour", guess_sql(), ["blocks"], [NAMES])
def _(w):
    c = names(w).withColumn("c", K.guess_colour(F.col("name")))
    return c.select("name", *[F.round(F.get("c", i), 6).alias(ch) for i, ch in enumerate("rgb")])


DEVICES = """SELECT c_custkey AS device_id, CASE c_custkey % 9 WHEN 0 THEN 'NVIDIA GeForce RTX 4080' WHEN 1 THEN 'AMD Radeon RX 5000'
  WHEN 2 THEN 'Intel(R) UHD Graphics 620' WHEN 3 THEN 'NVIDIA Titan' WHEN 4 THEN 'Quadro P2000' WHEN 5 THEN 'Apple M1'
  WHEN 6 THEN 'Mystery Card' WHEN 7 THEN 'Intel Arc A5' ELSE 'GeForce GTX 1080' END AS adapter,
 CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(abs(c_acctbal) * 1.5 AS INT) END AS vram, abs(c_acctbal) / 10 AS cpu, c_custkey % 500 AS gpu FROM {customer}"""


def has_sql(tokens):
    return "(" + " OR ".join(f"contains(lower(adapter), '{t}')" for t in tokens) + ")"


@query("device_tier", f"""SELECT device_id, CASE WHEN {has_sql(V.ADAPTER_HIGH)} THEN CASE WHEN vram IS NULL OR vram >= 8000 THEN 'Epic' ELSE 'High' END
   WHEN {has_sql(V.ADAPTER_MID)} THEN CASE WHEN vram IS NULL OR vram >= 6000 THEN 'High' ELSE 'Medium' END
   WHEN {has_sql(V.ADAPTER_SHARED)} THEN CASE WHEN vram >= 7000 THEN 'Medium' ELSE 'Low' END
   WHEN {has_sql(V.ADAPTER_MAKERS)} THEN CASE WHEN vram >= 12000 THEN 'Epic' WHEN vram >= 8000 THEN 'High' ELSE 'Medium' END END AS adapter_tier,
  CASE WHEN least(cpu, gpu) < 30 THEN 'Low' WHEN least(cpu, gpu) < 120 THEN 'Medium' WHEN least(cpu, gpu) < 400 THEN 'High' ELSE 'Epic' END AS index_tier
  FROM ({DEVICES.replace('{customer}', 'customer').replace('CAST(abs(c_acctbal) * 1.5 AS INT)', 'CAST(trunc(abs(c_acctbal) * 1.5) AS INT)')})""")
def _(w):
    d = w._sql(DEVICES, "customer")
    return d.select("device_id", K.adapter_tier(F.col("adapter"), F.col("vram")).alias("adapter_tier"),
                    K.index_tier(F.col("cpu"), F.col("gpu")).alias("index_tier"))


# --- colour maths ------------------------------------------------------------

PX = ["pixels"]


@query("luma", "SELECT image_id, px_row, px_col, round(0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b, 6) AS luma FROM pixels", PX)
def _(w):
    return w.pixels().select("image_id", "px_row", "px_col", F.round(K.luma(*P.rgb()), 6).alias("luma"))


@query("saturation", """SELECT image_id, px_row, px_col, round(CASE WHEN greatest(r, g, b) <= 0 THEN 0.0::DOUBLE
  ELSE (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) END, 6) AS saturation FROM pixels""", PX)
def _(w):
    return w.pixels().select("image_id", "px_row", "px_col", F.round(K.saturation(*P.rgb()), 6).alias("saturation"))


def lin_sql(c):
    return f"CASE WHEN {c} / 255.0::DOUBLE <= 0.04045 THEN {c} / 255.0::DOUBLE / 12.92::DOUBLE ELSE pow(({c} / 255.0::DOUBLE + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) END"


LIN = ("lin", f"SELECT *, {lin_sql('r')} AS lr, {lin_sql('g')} AS lg, {lin_sql('b')} AS lb FROM pixels")
LAB = [LIN, ("xyz", "SELECT *, " + ", ".join(
    f"(lr * {m[0]!r}::DOUBLE + lg * {m[1]!r}::DOUBLE + lb * {m[2]!r}::DOUBLE) / {v!r}::DOUBLE AS {n}" for m, v, n in zip(K.XYZ, K.WHITE, ("tx", "ty", "tz"))) + " FROM lin"),
       ("fxyz", "SELECT *, " + ", ".join(
           f"CASE WHEN {t} > 216.0::DOUBLE / 24389 THEN cbrt({t}) ELSE ({t} * (24389.0::DOUBLE / 27) + 16) / 116 END AS f{t}" for t in ("tx", "ty", "tz")) + " FROM xyz"),
       ("lab", "SELECT *, 116 * fty - 16 AS cl, 500 * (ftx - fty) AS ca, 200 * (fty - ftz) AS cb FROM fxyz")]


@query("srgb_to_linear", "SELECT image_id, px_row, px_col, round(lr, 6) AS lr, round(lg, 6) AS lg, round(lb, 6) AS lb FROM lin", PX, [LIN])
def _(w):
    return w.pixels().select("image_id", "px_row", "px_col", *[F.round(K.srgb_to_linear(F.col(c)), 6).alias("l" + c) for c in "rgb"])


@query("hex_to_linear", "SELECT image_id, px_row, px_col, round(lr, 6) AS lr, round(lg, 6) AS lg, round(lb, 6) AS lb FROM lin", PX, [LIN])
def _(w):
    p = w.pixels().withColumn("c", K.hex_to_linear(F.format_string("#%02x%02x%02x", "r", "g", "b")))
    return p.select("image_id", "px_row", "px_col", *[F.round(F.get("c", i), 6).alias("l" + c) for i, c in enumerate("rgb")])


@query("rgb_to_lab", "SELECT image_id, px_row, px_col, round(cl, 5) + 0.0::DOUBLE AS cl, round(ca, 5) + 0.0::DOUBLE AS ca, round(cb, 5) + 0.0::DOUBLE AS cb FROM lab", PX, LAB)
def _(w):
    lab = K.rgb_to_lab(*P.rgb())
    return w.pixels().select("image_id", "px_row", "px_col", *[(F.round(v, 5) + F.lit(0.0)).alias(n) for v, n in zip(lab, ("cl", "ca", "cb"))])


DE_STEPS = [
    ("d1", "SELECT *, pow((sqrt(a1 * a1 + b1 * b1) + sqrt(a2 * a2 + b2 * b2)) / 2, 7) AS c7 FROM {src}"),
    ("d2", "SELECT *, a1 * (1 + 0.5 * (1 - sqrt(c7 / (c7 + pow(25.0, 7))))) AS p1, a2 * (1 + 0.5 * (1 - sqrt(c7 / (c7 + pow(25.0, 7))))) AS p2 FROM d1"),
    ("d3", "SELECT *, sqrt(p1 * p1 + b1 * b1) AS q1, sqrt(p2 * p2 + b2 * b2) AS q2, degrees(atan2(b1, p1)) AS g1, degrees(atan2(b2, p2)) AS g2 FROM d2"),
    ("d4", "SELECT *, CASE WHEN g1 < 0 THEN g1 + 360 ELSE g1 END AS h1, CASE WHEN g2 < 0 THEN g2 + 360 ELSE g2 END AS h2 FROM d3"),
    ("d5", """SELECT *, CASE WHEN q1 * q2 = 0 THEN 0 WHEN h2 - h1 > 180 THEN h2 - h1 - 360 WHEN h2 - h1 < -180 THEN h2 - h1 + 360 ELSE h2 - h1 END AS dh,
      CASE WHEN q1 * q2 = 0 THEN h1 + h2 WHEN abs(h1 - h2) <= 180 THEN (h1 + h2) / 2 WHEN h1 + h2 < 360 THEN (h1 + h2 + 360) / 2 ELSE (h1 + h2 - 360) / 2 END AS hm,
      (l1 + l2) / 2 AS lm, (q1 + q2) / 2 AS qm FROM d4"""),
    ("d6", """SELECT *, 1 - 0.17::DOUBLE * cos(radians(hm - 30)) + 0.24::DOUBLE * cos(radians(2 * hm)) + 0.32::DOUBLE * cos(radians(3 * hm + 6)) - 0.20::DOUBLE * cos(radians(4 * hm - 63)) AS tt FROM d5"""),
    ("d7", """SELECT *, (l2 - l1) / (1 + 0.015::DOUBLE * pow(lm - 50, 2) / sqrt(20 + pow(lm - 50, 2))) AS ex, (q2 - q1) / (1 + 0.045::DOUBLE * qm) AS ey,
      2 * sqrt(q1 * q2) * sin(radians(dh) / 2) / (1 + 0.015::DOUBLE * qm * tt) AS ez,
      -sin(radians(2 * 30 * exp(-pow((hm - 275) / 25, 2)))) * 2 * sqrt(pow(qm, 7) / (pow(qm, 7) + pow(25.0, 7))) AS rt FROM d6"""),
    ("de", "SELECT *, sqrt(ex * ex + ey * ey + ez * ez + rt * ey * ez) AS de2000 FROM d7"),
]


def de_views(src):
    return [(n, t.replace("{src}", src)) for n, t in DE_STEPS]


@query("ciede2000", "SELECT image_id, px_row, px_col, round(de2000, 4) + 0.0::DOUBLE AS de2000 FROM de", PX, LAB + [
    ("pairs", """SELECT a.image_id, a.px_row, a.px_col, a.cl AS l1, a.ca AS a1, a.cb AS b1, b.cl AS l2, b.ca AS a2, b.cb AS b2
      FROM lab a JOIN lab b ON b.image_id = a.image_id AND b.px_row = a.px_row AND b.px_col = a.px_col + 1""")] + de_views("pairs"))
def _(w):
    lab = w.pixels()
    for n, v in zip(("l1", "a1", "b1"), K.rgb_to_lab(*P.rgb())):
        lab = lab.withColumn(n, v)
    lab = lab.select("image_id", "px_row", "px_col", "l1", "a1", "b1")
    nxt = lab.select("image_id", "px_row", (F.col("px_col") - 1).alias("px_col"), F.col("l1").alias("l2"), F.col("a1").alias("a2"), F.col("b1").alias("b2"))
    d = K.with_ciede2000(lab.join(nxt, ["image_id", "px_row", "px_col"]), ["l1", "a1", "b1"], ["l2", "a2", "b2"])
    return d.select("image_id", "px_row", "px_col", (F.round("de2000", 4) + F.lit(0.0)).alias("de2000"))


@query("alpha_from_black", "SELECT image_id, px_row, px_col, CAST(floor(least(greatest((greatest(r, g, b) - 8) / 56.0::DOUBLE, 0), 1) * 255) AS INT) AS alpha FROM pixels", PX)
def _(w):
    return w.pixels().select("image_id", "px_row", "px_col", K.alpha_from_black(*P.rgb(), 8, 64).alias("alpha"))


# --- pixels ------------------------------------------------------------------

LUM = ("lum", "SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS l FROM pixels")
ACROSS, DOWN = "PARTITION BY image_id, px_row ORDER BY px_col", "PARTITION BY image_id, px_col ORDER BY px_row"


@query("image_region_stats", """SELECT image_id, region, round(avg(r), 1) AS mean_r, round(avg(g), 1) AS mean_g, round(avg(b), 1) AS mean_b,
   round(avg(l), 2) AS mean_luma, round(stddev_pop(l), 2) AS std_luma FROM lum, (VALUES ('whole', 0, 0, 8, 8), ('sky', 1, 0, 7, 3)) AS t(region, x0, y0, x1, y1)
  WHERE px_col >= x0 AND px_col < x1 AND px_row >= y0 AND px_row < y1 GROUP BY 1, 2""", PX, [LUM])
def _(w):
    return P.image_region_stats(w.pixels(), [("whole", 0, 0, 8, 8), ("sky", 1, 0, 7, 3)])


@query("local_std", "SELECT image_id, round(avg(s), 6) AS local_std FROM (SELECT image_id, stddev_pop(l) AS s FROM lum GROUP BY image_id, px_row // 4, px_col // 4) GROUP BY image_id", PX, [LUM])
def _(w):
    return P.local_std(w.pixels(), 4)


@query("gradient_energy", f"""SELECT image_id, round(avg(dx) + avg(dy), 6) AS energy FROM (SELECT image_id, abs(lead(l) OVER ({ACROSS}) - l) AS dx,
  abs(lead(l) OVER ({DOWN}) - l) AS dy FROM lum) GROUP BY image_id""", PX, [LUM])
def _(w):
    return P.gradient_energy(w.pixels())


@query("laplacian_energy", f"""SELECT image_id, round(avg(abs(4.0::DOUBLE * l - (a + b) - (c + d))), 6) AS energy FROM (SELECT image_id, l, lag(l) OVER ({ACROSS}) AS a, lead(l) OVER ({ACROSS}) AS b,
  lag(l) OVER ({DOWN}) AS c, lead(l) OVER ({DOWN}) AS d FROM lum) GROUP BY image_id""", PX, [LUM])
def _(w):
    return P.laplacian_energy(w.pixels())


@query("colour_clusters", """SELECT image_id, rank, ((code >> 10) & 31) * 8 + 4 AS r, ((code >> 5) & 31) * 8 + 4 AS g, (code & 31) * 8 + 4 AS b, round(n / total, 4) AS share, over_1pct FROM (
   SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY n DESC, code DESC) AS rank, count(*) FILTER (n > total * 0.01) OVER (PARTITION BY image_id) AS over_1pct FROM (
    SELECT *, sum(n) OVER (PARTITION BY image_id) AS total FROM (SELECT image_id, (r >> 3) * 1024 + (g >> 3) * 32 + (b >> 3) AS code, count(*) AS n FROM pixels GROUP BY 1, 2))) WHERE rank <= 5""", PX)
def _(w):
    return P.colour_clusters(w.pixels())


@query("frame_census", """SELECT image_id, CAST(floor(avg(r)) AS INT) AS mean_r, CAST(floor(avg(g)) AS INT) AS mean_g, CAST(floor(avg(b)) AS INT) AS mean_b,
   round(100.0::DOUBLE * count(*) FILTER (l < 24) / count(*), 6) AS dark_pct, round(100.0::DOUBLE * count(*) FILTER (l >= 24 AND b > r + 25 AND b > 90) / count(*), 6) AS sky_pct,
   round(100.0::DOUBLE * count(*) FILTER (l > 45 AND NOT (b > r + 25 AND b > 90)) / count(*), 6) AS lit_pct, round(100.0::DOUBLE * count(*) FILTER (g > r AND g > b) / count(*), 6) AS green_pct,
   count(DISTINCT (r // 24, g // 24, b // 24)) AS distinct FROM lum GROUP BY image_id""", PX, [LUM])
def _(w):
    return P.frame_census(w.pixels(), 1)


@query("local_contrast", f"""SELECT image_id, round(coalesce(avg(step) FILTER ((px_row - 5) % 3 = 0 AND px_col % 2 = 0), 0), 6) AS contrast, min(grey) AS lo, max(grey) AS hi FROM (
  SELECT *, abs(lead(grey) OVER ({ACROSS}) - grey) AS step FROM (SELECT *, (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 AS grey FROM pixels
   WHERE px_col < 7 AND px_row >= 5 AND px_row < 7)) GROUP BY image_id""", PX)
def _(w):
    return P.local_contrast(w.pixels())


@query("alpha_stats", """SELECT image_id, count(*) AS total, round(avg(CASE WHEN a = 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS frac_0,
  round(avg(CASE WHEN a = 255 THEN 1.0::DOUBLE ELSE 0 END), 6) AS frac_opaque, round(avg(CASE WHEN a <> 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS opaque_frac
  FROM (SELECT *, CAST(floor(least(greatest((greatest(r, g, b) - 8) / 56.0::DOUBLE, 0), 1) * 255) AS INT) AS a FROM pixels) GROUP BY image_id""", PX)
def _(w):
    return P.alpha_stats(w.pixels().withColumn("a", K.alpha_from_black(*P.rgb(), 8, 64)))


@query("cell_means", """SELECT image_id, cell_x, cell_y, round(r, 6) AS mean_r, round(g, 6) AS mean_g, round(b, 6) AS mean_b, round(r - b, 6) + 0.0::DOUBLE AS red_minus_blue,
   round((greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b), 6) AS saturation, abs(r - 120) <= 30 AND abs(g - 125) <= 30 AND abs(b - 128) <= 30 AS ok
  FROM (SELECT image_id, px_col // 4 AS cell_x, px_row // 4 AS cell_y, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM pixels GROUP BY 1, 2, 3)""", PX)
def _(w):
    out = P.cell_means(w.pixels(), 4, (120, 125, 128), 30)
    return out.withColumn("red_minus_blue", F.col("red_minus_blue") + F.lit(0.0))


def g_sql(v, gain):
    return f"least(greatest(round_even({v} * {gain}, 0), 0), 255)"


@query("clip_share", f"""SELECT image_id, round(100.0::DOUBLE * count(*) FILTER (r1 >= 255 OR g1 >= 255 OR b1 >= 255) / count(*), 6) AS clip_pct,
   round(stddev_pop(r1), 6) AS std_r, round(stddev_pop(g1), 6) AS std_g, round(stddev_pop(b1), 6) AS std_b
  FROM (SELECT image_id, {g_sql('r', '1.3::DOUBLE')} AS r1, {g_sql('g', '0.7::DOUBLE')} AS g1, {g_sql('b', '2.0::DOUBLE')} AS b1 FROM pixels) GROUP BY image_id""", PX)
def _(w):
    return P.clip_share(w.pixels(), (1.3, 0.7, 2.0))


HIST = [("tall", "SELECT image_id, 'r' AS channel, r AS v FROM pixels UNION ALL SELECT image_id, 'g', g FROM pixels UNION ALL SELECT image_id, 'b', b FROM pixels"),
        ("hist", """SELECT image_id, channel, list({'v': v, 'k': k} ORDER BY v) AS h, CAST(sum(k) AS BIGINT) AS total, CASE channel WHEN 'r' THEN 110.0::DOUBLE WHEN 'g' THEN 90.0::DOUBLE ELSE 140.0::DOUBLE END AS target
          FROM (SELECT image_id, channel, v, count(*) AS k FROM tall GROUP BY 1, 2, 3) GROUP BY 1, 2""")]
MEAN = f"list_sum(list_transform(h, lambda e: {g_sql('e.v', '{gain}')} * e.k)) / total"


@query("solve_gain", "SELECT image_id, channel, round(best, 6) AS gain, round(err, 6) AS error FROM halving WHERE i = 40", PX, HIST + [
    ("halving", f"""SELECT image_id, channel, h, total, target, 0 AS i, 0.05::DOUBLE AS lo, 8.0::DOUBLE AS hi, 1.0::DOUBLE AS best, 1e300::DOUBLE AS err FROM hist
      UNION ALL SELECT image_id, channel, h, total, target, i + 1, CASE WHEN got < target THEN (lo + hi) / 2 ELSE lo END, CASE WHEN got < target THEN hi ELSE (lo + hi) / 2 END,
       CASE WHEN abs(got - target) < err THEN (lo + hi) / 2 ELSE best END, least(err, abs(got - target))
      FROM (SELECT *, {MEAN.replace('{gain}', '((lo + hi) / 2)')} AS got FROM halving WHERE i < 40)""")])
def _(w):
    return P.solve_gain(w.pixels(), (110, 90, 140))


TARGET = (112, 185, 25)


def lab_of(prefix, cols, out, src):
    """Views that add the Lab colour of three channel columns."""
    r, g, b = cols
    return [(out + "_l", f"SELECT *, {lin_sql(r)} AS lr, {lin_sql(g)} AS lg, {lin_sql(b)} AS lb FROM {src}"),
            (out + "_t", "SELECT *, " + ", ".join(
                f"(lr * {m[0]!r}::DOUBLE + lg * {m[1]!r}::DOUBLE + lb * {m[2]!r}::DOUBLE) / {v!r}::DOUBLE AS {n}" for m, v, n in zip(K.XYZ, K.WHITE, ("tx", "ty", "tz"))) + f" FROM {out}_l"),
            (out + "_f", "SELECT *, " + ", ".join(
                f"CASE WHEN {t} > 216.0::DOUBLE / 24389 THEN cbrt({t}) ELSE ({t} * (24389.0::DOUBLE / 27) + 16) / 116 END AS f{t}" for t in ("tx", "ty", "tz")) + f" FROM {out}_t"),
            (out, f"SELECT * EXCLUDE (lr, lg, lb, tx, ty, tz, ftx, fty, ftz), 116 * fty - 16 AS l{prefix}, 500 * (ftx - fty) AS a{prefix}, 200 * (fty - ftz) AS b{prefix} FROM {out}_f")]


@query("bake_gain", """SELECT image_id, round(gr, 4) AS gain_r, round(gg, 4) AS gain_g, round(gb, 4) AS gain_b, cr AS real_r, cg AS real_g, cbl AS real_b,
  round(de2000, 4) AS de2000 FROM de""", PX, HIST + [
    ("gains", f"SELECT *, CASE channel WHEN 'r' THEN {TARGET[0]} WHEN 'g' THEN {TARGET[1]} ELSE {TARGET[2]} END / (list_sum(list_transform(h, lambda e: e.v * e.k)) / total::DOUBLE) AS gain FROM hist"),
    ("wide", f"""SELECT image_id, max(gain) FILTER (channel = 'r') AS gr, max(gain) FILTER (channel = 'g') AS gg, max(gain) FILTER (channel = 'b') AS gb,
      round(max(real) FILTER (channel = 'r'), 3) AS cr, round(max(real) FILTER (channel = 'g'), 3) AS cg, round(max(real) FILTER (channel = 'b'), 3) AS cbl,
      {TARGET[0]}.0::DOUBLE AS wr, {TARGET[1]}.0::DOUBLE AS wg, {TARGET[2]}.0::DOUBLE AS wb FROM (SELECT *, {MEAN.replace('{gain}', 'gain')} AS real FROM gains) GROUP BY image_id""")]
       + lab_of("1", ("cr", "cg", "cbl"), "lab1", "wide") + lab_of("2", ("wr", "wg", "wb"), "lab2", "lab1") + de_views("lab2"))
def _(w):
    return P.bake_gain(w.pixels(), TARGET)


@query("seam_metrics", """SELECT image_id, round(avg(d) FILTER (kind = 'h'), 6) AS wrap_h, round(avg(d) FILTER (kind = 'v'), 6) AS wrap_v, round(avg(d) FILTER (kind = 'b'), 6) AS baseline FROM (
   SELECT a.image_id, 'h' AS kind, (abs(a.r - b.r) + abs(a.g - b.g) + abs(a.b - b.b)) / 3.0::DOUBLE AS d FROM pixels a JOIN pixels b USING (image_id, px_row) WHERE a.px_col = 0 AND b.px_col = 7
   UNION ALL SELECT a.image_id, 'b', (abs(a.r - b.r) + abs(a.g - b.g) + abs(a.b - b.b)) / 3.0::DOUBLE FROM pixels a JOIN pixels b USING (image_id, px_row) WHERE a.px_col = 0 AND b.px_col = 4
   UNION ALL SELECT a.image_id, 'v', (abs(a.r - b.r) + abs(a.g - b.g) + abs(a.b - b.b)) / 3.0::DOUBLE FROM pixels a JOIN pixels b USING (image_id, px_col) WHERE a.px_row = 0 AND b.px_row = 7) GROUP BY image_id""", PX)
def _(w):
    return P.seam_metrics(w.pixels(), 4)


@query("image_diff", """SELECT pair, count(*) FILTER (d IS NULL) AS unmatched, max(d) AS max, round(avg(d), 4) AS mean, count(*) FILTER (d > 0) AS changed,
   count(*) FILTER (d > 8) AS over_8, count(*) AS total, round(100.0::DOUBLE * count(*) FILTER (d > 8) / count(*), 4) AS pct_over_8 FROM (
   SELECT coalesce(a.image_id, b.image_id - 1) AS pair, greatest(abs(a.r - b.r), abs(a.g - b.g), abs(a.b - b.b)) AS d
   FROM (SELECT * FROM pixels WHERE image_id % 2 = 0) a FULL JOIN (SELECT * FROM pixels WHERE image_id % 2 = 1) b
   ON b.image_id = a.image_id + 1 AND b.px_row = a.px_row AND b.px_col = a.px_col) GROUP BY pair""", PX)
def _(w):
    px = w.pixels()
    left = px.filter("image_id % 2 = 0").withColumnRenamed("image_id", "pair")
    right = px.filter("image_id % 2 = 1").withColumn("pair", F.col("image_id") - 1)
    return P.image_diff(left, right)
