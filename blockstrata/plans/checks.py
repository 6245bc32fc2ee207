"""Queries over assets, telemetry and data quality."""

from pyspark.sql import functions as F

from ..fixture_bytes import scratch
from ..functions import fixed_values as V
from ..functions import rules
from ..operators import assets as A
from ..operators import census as C
from ..operators import objects as O
from ..operators import quality as Q
from ..operators import voxels as X
from ..operators.mesh import heightfield_mesh
from ..operators.tiles import world_tiles
from ..session import cut_lineage
from ..sources.derived import Kept, kept_table
from ..streaming import frames as T
from . import rule_sql as R
from .geometry import TILES
from .registry import query
from .spatial import GRID, HMV, OBJ_COMP, SOLID, filled
from .tables import DIMS

# --- models ------------------------------------------------------------------

MODELS = """SELECT node, parent, CASE node % 3 WHEN 0 THEN map_from_arrays(array('all', 'k' || node % 5), array('block/m' || node % 11, '#all'))
  WHEN 1 THEN map_from_arrays(array('k' || node % 5), array('minecraft:block/t' || node % 7)) ELSE map_from_arrays(array('side'), array('#k' || node % 5)) END AS textures FROM ({parents})"""
MODELS_SQL = """SELECT node, parent, CASE node % 3 WHEN 0 THEN MAP {'all': 'block/m' || node % 11, 'k' || node % 5: '#all'}
  WHEN 1 THEN MAP {'k' || node % 5: 'minecraft:block/t' || node % 7} ELSE MAP {'side': '#k' || node % 5} END AS textures FROM parents"""


def models(w):
    from ..fixtures import PARENTS
    return w._sql(MODELS.replace("{parents}", PARENTS), "customer")


CHAIN = [("models", MODELS_SQL), ("up", """SELECT node, node AS at, 0 AS d FROM models UNION ALL
   SELECT u.node, m.parent, d + 1 FROM up u JOIN models m ON m.node = u.at WHERE m.parent IS NOT NULL AND d < 60"""),
         ("entries", """SELECT u.node, d, unnest(map_keys(textures)) AS k, unnest(map_values(textures)) AS v FROM up u JOIN models m ON m.node = u.at"""),
         ("resolved", "SELECT node, k, arg_min(v, d) AS v FROM entries GROUP BY node, k")]


@query("parent_chain", """SELECT node, string_agg(k || '=' || v, ';' ORDER BY k) AS textures, (SELECT count(*) FROM up WHERE up.node = r.node) AS depth
  FROM resolved r GROUP BY node""", ["parents"], CHAIN)
def _(w):
    c = A.parent_chain(models(w))
    return c.select("node", rules.props_key(F.col("textures")).alias("textures"), F.col("depth").cast("bigint").alias("depth"))


DEREF = CHAIN + [("hops", """SELECT node, 'k' || node % 5 AS k, v, 0 AS i FROM resolved WHERE k = 'side'
   UNION ALL SELECT h.node, h.k, r.v, i + 1 FROM hops h LEFT JOIN resolved r ON r.node = h.node AND r.k = substring(h.v, 2) WHERE starts_with(h.v, '#') AND i < 60"""),
                 ("ends", "SELECT node, arg_max(v, i) AS v, max(i) AS i FROM (SELECT node, coalesce(v, '?') AS v, i FROM hops) GROUP BY node")]


@query("texture_deref", """SELECT node, CASE WHEN v = '?' OR starts_with(v, '#') THEN NULL ELSE regexp_replace(regexp_replace(v, '^[^:]*:', ''), '^block/', '') || '.png' END AS file FROM ends""",
       ["parents"], DEREF)
def _(w):
    c = A.parent_chain(models(w)).filter(F.map_contains_key("textures", F.lit("side")))
    return c.select("node", A.texture_file(A.texture_deref(F.col("textures")["side"], F.col("textures"))).alias("file"))


VARIANTS = """SELECT name, variant, min(model) AS model FROM (SELECT name, CASE block_id % 4 WHEN 0 THEN properties WHEN 1 THEN 'snowy=false' WHEN 2 THEN 'axis=y,lit=0' ELSE 'powered=true' END AS variant,
  concat('block/v', CAST(block_id % 13 AS STRING)) AS model FROM ({blocks})) AS t GROUP BY name, variant"""


@query("variant_rank", """SELECT name, b.variant AS variant, b.model AS model FROM (SELECT name, arg_min({'variant': variant, 'model': model}, (
   CASE WHEN variant = properties AND properties <> '' THEN 0 WHEN variant = '' THEN 1 WHEN contains(lower(variant), '=false') OR contains(lower(variant), '=0') THEN 2 ELSE 3 END,
   length(variant), variant)) AS b FROM variants LEFT JOIN (SELECT name, arg_min(properties, (-n, properties)) AS properties FROM
    (SELECT name, properties, count(*) AS n FROM blocks GROUP BY 1, 2) GROUP BY name) USING (name) GROUP BY name)""", ["blocks"],
       [("variants", VARIANTS.replace("({blocks})", "blocks"))])
def _(w):
    from ..fixtures import BLOCKS
    v = w._sql(VARIANTS.replace("{blocks}", BLOCKS), "part")
    return A.variant_rank(v, C.dominant_properties(w.blocks()).select("name", "properties"))


ELEMENTS = """SELECT node, CASE pos % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'down' ELSE 'north' END AS direction, depth, is_full, pos, concat('t', CAST(pos AS STRING)) AS texture
  FROM (SELECT l_partkey AS node, l_orderkey * 8 + l_linenumber AS pos, CAST(l_quantity AS INT) % 3 AS depth, l_suppkey % 2 = 0 AS is_full FROM {lineitem}) AS e"""


@query("element_face_priority", f"SELECT node, direction, arg_min(texture, (depth, CASE WHEN is_full THEN 0 ELSE 1 END, pos)) AS texture FROM ({ELEMENTS.replace('{lineitem}', 'lineitem')}) GROUP BY 1, 2")
def _(w):
    return A.element_face_priority(w._sql(ELEMENTS, "lineitem"))


# texture files: some own names, some sides; faces from every third block's model
FILES = """SELECT DISTINCT concat(regexp_replace(name, '^[^:]*:', ''), CASE block_id % 4 WHEN 0 THEN '' WHEN 1 THEN '_top' WHEN 2 THEN '_side' ELSE '_bottom' END, '.png') AS file
  FROM ({blocks}) AS b WHERE block_id % 5 < 3"""
FACED = """SELECT name, regexp_replace(name, '^[^:]*:', '') AS short, max(CASE WHEN block_id % 7 = 0 THEN 'm_top.png' END) AS top,
  max(CASE WHEN block_id % 7 = 1 THEN 'm_side.png' END) AS side, max(CASE WHEN block_id % 11 = 2 THEN 'm_bottom.png' END) AS bottom,
  max(CASE WHEN block_id % 7 = 3 THEN 'particle.png' END) AS particle FROM ({blocks}) AS b GROUP BY name"""
TEX = [("files", FILES.replace("({blocks})", "blocks")), ("faced", FACED.replace("({blocks})", "blocks")),
       ("tex", """SELECT name, CASE WHEN f IS NOT NULL THEN 'model' WHEN particle IS NOT NULL THEN 'model-textures' WHEN own OR t OR s OR b THEN 'heuristic' ELSE 'placeholder' END AS source,
   CASE WHEN f IS NOT NULL THEN coalesce(top, bottom, f) WHEN particle IS NOT NULL THEN particle WHEN own THEN o WHEN t THEN short || '_top.png' ELSE o END AS top_tex,
   CASE WHEN f IS NOT NULL THEN coalesce(side, f) WHEN particle IS NOT NULL THEN particle WHEN own THEN o WHEN s THEN short || '_side.png' WHEN t THEN short || '_top.png' ELSE o END AS side_tex,
   CASE WHEN f IS NOT NULL THEN coalesce(bottom, top, f) WHEN particle IS NOT NULL THEN particle WHEN own THEN o WHEN b THEN short || '_bottom.png' WHEN t THEN short || '_top.png' ELSE o END AS bottom_tex
  FROM (SELECT *, coalesce(top, side, bottom) AS f, short || '.png' AS o, short || '.png' IN (SELECT file FROM files) AS own, short || '_top.png' IN (SELECT file FROM files) AS t,
   short || '_side.png' IN (SELECT file FROM files) AS s, short || '_bottom.png' IN (SELECT file FROM files) AS b FROM faced)"""),
       ("entries2", f"""SELECT *, {R.alpha_mode('name')} AS alpha_mode, {R.emissive_colour('name')} AS emissive_colour,
   contains(top_tex, 'ore') OR contains(side_tex, 'ore') OR contains(bottom_tex, 'ore') AS animated FROM tex""")]


def block_files(w):
    from ..fixtures import BLOCKS
    return w._sql(FILES.replace("{blocks}", BLOCKS), "part")


def manifest(w):
    from ..fixtures import BLOCKS
    m = A.texture_fallback(w._sql(FACED.replace("{blocks}", BLOCKS), "part"), block_files(w))
    tex = m.select(F.explode(F.array("top_tex", "side_tex", "bottom_tex")).alias("file")).distinct()
    return A.with_looks(m, tex.filter(F.contains("file", F.lit("ore"))))


@query("texture_fallback", "SELECT * FROM tex", ["blocks"], TEX)
def _(w):
    return manifest(w).select("name", "source", "top_tex", "side_tex", "bottom_tex")


@query("animated", "SELECT name, animated FROM entries2", ["blocks"], TEX)
def _(w):
    return manifest(w).select("name", "animated")


@query("manifest_report", """SELECT count(*) AS entries, count(*) FILTER (alpha_mode = 'opaque') AS opaque, count(*) FILTER (alpha_mode = 'masked') AS masked,
  count(*) FILTER (alpha_mode = 'transparent') AS transparent, count(*) FILTER (emissive_colour IS NOT NULL) AS emissive, count(*) FILTER (source = 'placeholder') AS placeholder,
  count(*) FILTER ({}) AS non_cube, count(*) FILTER (animated) AS animated, count(*) FILTER (source = 'model') AS from_model,
  count(*) FILTER (source = 'heuristic') AS from_heuristic FROM entries2""".format(R.has_any(R.bare("name"), V.NON_CUBE_TOKENS)),
       ["blocks"], TEX)
def _(w):
    return A.manifest_report(manifest(w))


@query("manifest_constraints", """SELECT rule, severity, count(*) AS n FROM (
   SELECT 'missing_file' AS rule, 'error' AS severity FROM entries2 WHERE top_tex NOT IN (SELECT file FROM files) OR side_tex NOT IN (SELECT file FROM files) OR bottom_tex NOT IN (SELECT file FROM files)
   UNION ALL SELECT 'repeated_name', 'error' FROM entries2 WHERE emissive_colour IS NOT NULL
   UNION ALL SELECT 'glow_without_colour', 'warning' FROM entries2 WHERE emissive_colour IS NOT NULL AND contains(name, 'lantern')
   UNION ALL SELECT 'uncovered', 'error' FROM (SELECT DISTINCT name FROM solid) WHERE name NOT IN (SELECT name FROM entries2)
   UNION ALL SELECT 'golden', 'error' FROM entries2 WHERE source = 'model' AND top_tex <> side_tex) GROUP BY 1, 2""", ["blocks", "solid"], TEX)
def _(w):
    m = cut_lineage(manifest(w))
    lamps = F.col("emissive") & F.contains("name", F.lit("lantern"))
    # glowing entries appear twice, one copy of each lantern without its colour
    twice = m.filter("emissive").withColumn("emissive_colour", F.when(~lamps, F.col("emissive_colour")))
    golden = m.filter("source = 'model'").select("name", F.col("top_tex").alias("want_top"), F.col("top_tex").alias("want_side"),
                                                 F.col("bottom_tex").alias("want_bottom")).distinct()
    bad = Q.manifest_constraints(m.unionByName(twice), block_files(w), w.solid().select("name").distinct(), golden)
    golden_once = bad.filter("rule = 'golden'").distinct()
    return bad.filter("rule <> 'golden'").unionByName(golden_once).groupBy("rule", "severity").agg(C.n_rows())


# --- telemetry ---------------------------------------------------------------

WINDOWS = ("stats", """SELECT event_type, start, list_sort(list(ms)) AS s FROM (
   SELECT event_type, value AS ms, time_bucket(INTERVAL 1 day, ts) AS start, row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL 1 day, ts) ORDER BY ts DESC, value DESC) AS k
   FROM events) GROUP BY 1, 2""")


@query("frame_time_windows", """SELECT event_type, CAST(epoch(start) AS BIGINT) AS start, CAST(len(s) AS INT) AS n, s[1] AS min_ms, s[len(s) // 2 + 1] AS p50_ms,
   s[CAST(floor(len(s) * 0.95) AS INT) + 1] AS p95_ms, s[len(s)] AS max_ms, round(list_sum(s) / len(s), 9) AS mean_ms,
   CASE WHEN len(s) < 8 THEN 'too-few-samples' WHEN s[len(s) // 2 + 1] > 33 THEN 'plateau'
    WHEN s[CAST(floor(len(s) * 0.95) AS INT) + 1] > 50 AND s[len(s) // 2 + 1] <= 20 THEN 'spikes' ELSE 'ok' END AS class FROM stats""", [], [WINDOWS])
def _(w):
    f = w.table("events").select("event_type", "ts", F.col("value").alias("ms"))
    out = T.frame_time_windows(f, "event_type", "1 day")
    return out.withColumn("mean_ms", F.round("mean_ms", 9)).withColumn("start", F.unix_timestamp("start"))


@query("scan_kv_log", """SELECT source_id, line_no, CAST(line_no % 2 AS INT) AS vox, CAST(source_id % 2 AS INT) AS struct FROM (
  SELECT source_id, max(line_no) AS line_no FROM kv_log GROUP BY source_id)""", ["kv_log"])
def _(w):
    return T.scan_kv_log(w.kv_log()).select("source_id", "line_no", F.col("spec")["vox"].alias("vox"), F.col("spec")["struct"].alias("struct"))


STREAM_SQL = WINDOWS[1].replace("FROM events) GROUP BY", "FROM events) WHERE k <= 2048 AND epoch(start) + 86400 < (SELECT epoch(max(ts)) - 10 FROM events) GROUP BY")


def run_stream(w, df, name):
    """Run a stream over what is there, into files, and read them back."""
    out, marks = scratch(w.spark, name), scratch(w.spark, name + "-marks")
    q = df.writeStream.format("parquet").option("checkpointLocation", marks).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return w.spark.read.schema(df.schema).parquet(out)


@query("stream_frame_time_windows", """SELECT event_type AS key, CAST(epoch(start) AS BIGINT) AS start, CAST(len(s) AS INT) AS n, s[1] AS min_ms, s[len(s) // 2 + 1] AS p50_ms,
   s[CAST(floor(len(s) * 0.95) AS INT) + 1] AS p95_ms, s[len(s)] AS max_ms FROM stats""", [], [("stats", STREAM_SQL)])
def _(w):
    stream = w.spark.readStream.schema(w.table("events").schema).option("pathGlobFilter", "events.parquet").parquet(w.sf_dir) \
        .select("event_type", "ts", F.col("value").alias("ms"))
    out = run_stream(w, T.stream_frame_time_windows(stream, "event_type", 86400), "frames")
    return out.select("key", F.unix_timestamp("start").alias("start"), "n", "min_ms", "p50_ms", "p95_ms", "max_ms")


@query("log_tail", "SELECT CAST(line_no % 2 AS INT) AS vox, CAST(source_id % 2 AS INT) AS struct, count(*) AS n FROM kv_log GROUP BY 1, 2", ["kv_log"])
def _(w):
    folder = scratch(w.spark, "log")
    w.kv_log().select(F.col("line").alias("value")).write.text(folder)
    back = run_stream(w, T.log_tail(w.spark, folder), "tail")
    return back.groupBy(F.col("spec")["vox"].alias("vox"), F.col("spec")["struct"].alias("struct")).agg(C.n_rows())


# --- quality -----------------------------------------------------------------

@query("reconcile_counts", """SELECT name, n - (n + CASE WHEN length(name) % 3 = 0 THEN 1 ELSE 0 END) AS diff_n, 0 AS diff_min_y,
   CASE WHEN name = 'minecraft:sand' THEN 'not_recorded' WHEN length(name) % 3 = 0 THEN 'mismatch' ELSE 'ok' END AS state FROM (
   SELECT name, count(*) AS n FROM solid GROUP BY name) WHERE name <> 'minecraft:sand'
  UNION ALL SELECT 'minecraft:sand', NULL, NULL, 'not_recorded'""", SOLID)
def _(w):
    m = w.solid().groupBy("name").agg(C.n_rows(), F.min("y").alias("min_y"))
    r = m.filter("name <> 'minecraft:sand'").withColumn("n", F.col("n") + F.when(F.length("name") % 3 == 0, 1).otherwise(0))
    return Q.reconcile_counts(m, r, "name", ["n", "min_y"])


@query("family_name_consistency", f"""SELECT name, family, n, want FROM (SELECT name, CASE WHEN palette_id % 5 = 0 THEN 'other' ELSE {R.atlas_family('name')} END AS family, count(*) AS n,
  any_value({R.atlas_family('name')}) AS want FROM solid GROUP BY 1, 2) WHERE family IS DISTINCT FROM want""", SOLID)
def _(w):
    pairs = w.solid().withColumn("family", F.when(F.col("palette_id") % 5 == 0, "other").otherwise(F.col("family")))
    return Q.family_name_consistency(pairs, rules.atlas_family)


@query("degenerate_output_check", """SELECT (SELECT count(*) FROM tiles) AS tiles, CAST(0 AS BIGINT) AS nan,
   (SELECT CAST((max(x) - min(x)) AS BIGINT) * (max(z) - min(z)) * 2 FROM hm) AS triangles,
  (SELECT count(DISTINCT component) FROM comp) AS objects, '' AS problems, TRUE AS ok""", GRID, HMV + OBJ_COMP + TILES)
def _(w):
    h = filled(w)
    solid = w.stored_solid()

    def rows(df, n=F.count(F.lit(1))):
        return df.select(n).scalar()

    report = h.agg(F.count_if(F.isnan(F.col("height").cast("double"))).alias("nan")).select(
        rows(world_tiles(C.world_bounds(solid), 3, 2)).alias("tiles"), "nan", rows(heightfield_mesh(h)).alias("triangles"),
        rows(O.object_components(solid), F.count_distinct("component")).alias("objects"))
    return Q.degenerate_output_check(report)


@query("deterministic_rerun", """SELECT count(*) AS first_rows, TRUE AS same_rows, TRUE AS same_digest, TRUE AS no_time_columns FROM comp""", SOLID, OBJ_COMP)
def _(w):
    runs = [O.object_components(w.solid()).select("x", "y", "z", "component") for _ in range(2)]
    return Q.deterministic_rerun(*runs)


def dim_stamps(df):
    """Stamp of each dimension's voxels."""
    per = df.groupBy(F.col("dim").alias("input")).agg(F.sum(F.xxhash64("x", "y", "z", "palette_id").cast("decimal(38,0)")).cast("string").alias("stamp"))
    return {r["input"]: r["stamp"] for r in per.collect()}


@query("input_stamp", """SELECT dim AS input, dim <> 'nether' AS reusable FROM (SELECT DISTINCT dim FROM dimmed) UNION ALL SELECT 'gone', FALSE""", SOLID, [DIMS])
def _(w):
    now = dim_stamps(w.dim_solid())
    kept = Kept(w.spark, scratch(w.spark, "kept"))
    kept.build(w.dim_solid().groupBy("dim").agg(C.n_rows()), {k: "old" if k == "nether" else v for k, v in now.items()} | {"gone": "x"})
    return kept.agreement(now)


@query("kept_tables", """SELECT run, run = 2 AS reused, dim, count(*) AS voxels FROM dimmed, (SELECT unnest([1, 2, 3]) AS run) WHERE run < 3 OR dim <> 'nether' GROUP BY run, dim""",
       SOLID, [DIMS])
def _(w):
    folder, out = scratch(w.spark, "kept"), None
    solid = w.dim_solid()
    for run, df in ((1, solid), (2, solid), (3, solid.filter("dim <> 'nether'"))):
        stamps = dim_stamps(df)
        reused = Kept(w.spark, folder).reusable(stamps)
        table = kept_table(w.spark, folder, stamps, lambda: df.groupBy("dim").agg(C.n_rows("voxels")))
        rows = table.select(F.lit(run).alias("run"), F.lit(reused).alias("reused"), "dim", "voxels")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("offset_contiguity", """SELECT file, seq, CASE WHEN seq > 0 AND lag(bump) OVER (PARTITION BY file ORDER BY seq) <> bump THEN bump - lag(bump) OVER (PARTITION BY file ORDER BY seq)
   WHEN seq > 0 THEN 0 END AS gap, seq = 0 OR lag(bump) OVER (PARTITION BY file ORDER BY seq) = bump AS ok FROM (
   SELECT cz AS file, row_number() OVER (PARTITION BY cz ORDER BY cx) - 1 AS seq, CASE WHEN row_number() OVER (PARTITION BY cz ORDER BY cx) > 3 THEN 8 ELSE 0 END AS bump
   FROM (SELECT DISTINCT CAST(floor(x / 16) AS INT) AS cx, CAST(floor(z / 16) AS INT) AS cz FROM solid))""", SOLID)
def _(w):
    from pyspark.sql import Window
    per = X.with_chunk(w.solid()).groupBy("cx", "cz").agg(C.n_rows("voxel_count"))
    by = Window.partitionBy("cz").orderBy("cx")
    c = (per.withColumn("seq", (F.row_number().over(by) - 1).cast("bigint"))
         .withColumn("before", F.coalesce(F.sum("voxel_count").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("voxel_offset", F.col("before") * 4 + 64 + F.when(F.col("seq") >= 3, 8).otherwise(0)))
    return Q.offset_contiguity(c.withColumnRenamed("cz", "file")).select("file", "seq", "gap", "ok")
