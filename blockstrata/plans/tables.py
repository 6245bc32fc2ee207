"""Queries over voxel tables: words, filters, joins, counts, top lists, sets."""

from pyspark.sql import functions as F

from ..fixtures import DIM
from ..functions import fixed_values as V
from ..functions import rules
from ..operators import census as C
from ..operators import voxels as X
from ..operators.columns import top_voxel_per_column
from ..operators.ranking import global_row_number, top_per_group
from ..session import cut_lineage
from ..sources import text as T
from . import rule_sql as R
from .registry import query

CX, CZ = "CAST(floor(x / 16) AS INT)", "CAST(floor(z / 16) AS INT)"
TOP = ("top", "SELECT x, z, max(y) AS y, arg_max(name, y) AS name, arg_max(family, y) AS family "
              "FROM solid GROUP BY x, z")
DIMS = ("dimmed", f"SELECT *, {DIM} AS dim FROM solid")
BUCKETS = ("buckets", """SELECT CAST(floor(x / 64) AS INT) AS cell_x, CAST(floor(z / 64) AS INT) AS cell_z,
  name, count(*) AS n FROM solid GROUP BY 1, 2, 3""")


def with_words(w):
    """Voxels packed into words with the chunk's own palette numbering."""
    v = X.with_chunk(w.voxels())
    v = v.join(X.build_chunk_palettes(w.voxels()), ["cx", "cz"])
    v = (v.withColumn("local_index", F.array_position("local_to_global", F.col("palette_id")) - 1)
         .withColumn("dx", F.col("x") - F.col("cx") * 16)
         .withColumn("dz", F.col("z") - F.col("cz") * 16))
    return X.pack_voxel_word(v)


WORDS = ("words", f"""SELECT v.*, dense_rank() OVER (PARTITION BY cx, cz ORDER BY palette_id) - 1 AS li
  FROM (SELECT *, {CX} AS cx, {CZ} AS cz FROM voxels) v""")


@query("voxel_word_fields", "SELECT cx, cz, x - cx * 16 AS dx, z - cz * 16 AS dz, y, li AS local_index FROM words",
       ["voxels"], [WORDS])
def _(w):
    packed = with_words(w).select("cx", "cz", "word")
    return X.voxel_word_fields(packed).drop("word") \
        .withColumn("local_index", F.col("local_index").cast("bigint"))


@query("world_coords", f"""SELECT {CX} AS cx, {CZ} AS cz, count(*) AS n, CAST(sum(x) AS BIGINT) AS sx,
  CAST(sum(z) AS BIGINT) AS sz, min(x) AS x0, max(z) AS z1 FROM voxels GROUP BY 1, 2""", ["voxels"])
def _(w):
    fields = X.voxel_word_fields(with_words(w).select("cx", "cz", "word"))
    return X.world_coords(fields).groupBy("cx", "cz").agg(
        C.n_rows(), F.sum("x").alias("sx"), F.sum("z").alias("sz"),
        F.min("x").alias("x0"), F.max("z").alias("z1"))


@query("chunk_local_to_global", "SELECT palette_id, count(*) AS n FROM voxels GROUP BY palette_id", ["voxels"])
def _(w):
    fields = X.voxel_word_fields(with_words(w).select("cx", "cz", "word"))
    joined = fields.join(X.build_chunk_palettes(w.voxels()), ["cx", "cz"])
    return X.chunk_local_to_global(joined).groupBy("palette_id").agg(C.n_rows())


@query("drop_air", "SELECT x, y, z, palette_id FROM solid", ["solid"])
def _(w):
    return X.drop_air(w.voxels(), w.palette()).select("x", "y", "z", "palette_id")


@query("clip_bbox", "SELECT x, y, z, palette_id FROM voxels WHERE x BETWEEN -32 AND 31 AND y BETWEEN 1 AND 5 "
       "AND z BETWEEN -20 AND 40", ["voxels"])
def _(w):
    return X.clip_bbox(w.voxels(), (-32, 31), (1, 5), (-20, 40))


@query("prune_chunks", f"""SELECT {CX} AS cx, {CZ} AS cz, count(*) AS n FROM voxels
  WHERE {CX} * 16 <= 20 AND {CX} * 16 + 15 >= -40 AND {CZ} * 16 <= 33 AND {CZ} * 16 + 15 >= -1 GROUP BY 1, 2""",
       ["voxels"])
def _(w):
    stored = w.spark.read.parquet(w.chunk_table())
    return X.prune_chunks(stored, (-40, 20), (-1, 33)).groupBy("cx", "cz").agg(C.n_rows())


@query("point_chunk_lookup", f"SELECT x, y, z, palette_id FROM voxels WHERE {CX} = -2 AND {CZ} = 1", ["voxels"])
def _(w):
    return T.scan_chunk_range(w.spark, w.chunk_table(), (-2, -2), (1, 1)).select("x", "y", "z", "palette_id")


@query("scan_chunk_range", f"""SELECT x, y, z, palette_id FROM voxels
  WHERE {CX} BETWEEN -2 AND 1 AND {CZ} BETWEEN 0 AND 2""", ["voxels"])
def _(w):
    return T.scan_chunk_range(w.spark, w.chunk_table(), (-2, 1), (0, 2)).select("x", "y", "z", "palette_id")


@query("scan_bounded_blocks", """SELECT x, y, z, name FROM solid
  WHERE x BETWEEN -10 AND 25 AND z BETWEEN -30 AND 5""", ["solid"])
def _(w):
    box = T.scan_bounded(w.spark, w.chunk_table(), (-10, 25), (-30, 5))
    return X.solid_voxels(box, w.palette()).select("x", "y", "z", "name")


@query("snap_region_to_chunks", """SELECT extent_id,
  CAST(floor((width - 400) / 16) - 8 AS INT) AS cx0, CAST(floor((depth - 600) / 16) - 8 AS INT) AS cz0,
  CAST(ceil((2 * width - 400) / 16) + 8 AS INT) AS cx1, CAST(ceil((2 * depth - 600) / 16) + 8 AS INT) AS cz1
  FROM extents""", ["extents"])
def _(w):
    regions = w.extents().selectExpr("extent_id", "width - 400 AS x0", "depth - 600 AS z0",
                                     "2 * width - 400 AS x1", "2 * depth - 600 AS z1")
    return X.snap_region_to_chunks(regions).select("extent_id", "cx0", "cz0", "cx1", "cz1")


@query("filter_labels", f"""SELECT label, count(*) AS n FROM solid WHERE label IN ({R.quoted(V.OBJECT_LABELS)})
  OR label NOT IN ({R.quoted(V.NEVER_GROUND_LABELS)}) GROUP BY label""", ["solid"])
def _(w):
    objects = X.filter_labels(w.solid(), wanted=V.OBJECT_LABELS)
    ground = X.filter_labels(w.solid(), never=list(V.NEVER_GROUND_LABELS) + list(V.OBJECT_LABELS))
    return objects.unionByName(ground).groupBy("label").agg(C.n_rows())


@query("split_mapped", """SELECT 'mapped' AS kind, CAST(NULL AS VARCHAR) AS name, count(*) AS n FROM solid
    WHERE name IN (SELECT name FROM blocks)
  UNION ALL (SELECT 'unmapped', name, count(*) AS n FROM solid WHERE name NOT IN (SELECT name FROM blocks)
    GROUP BY name ORDER BY n DESC, name LIMIT 5)""", ["solid", "blocks"])
def _(w):
    mapped, unmapped = X.split_mapped(w.solid(), w.blocks().select("name").distinct())
    total = mapped.agg(C.n_rows()).select(F.lit("mapped").alias("kind"),
                                          F.lit(None).cast("string").alias("name"), "n")
    top = unmapped.orderBy(F.desc("n"), "name").limit(5)
    return total.unionByName(top.select(F.lit("unmapped").alias("kind"), "name", "n"))


@query("to_engine_coords", """SELECT x, z, x * 100.0::DOUBLE AS ux, z * 100.0::DOUBLE AS uy, height * 100.0::DOUBLE - 50 AS uz,
  x * 100.0::DOUBLE AS flat_x, height * 100.0::DOUBLE AS flat_y, z * 100.0::DOUBLE AS flat_z,
  (((x % 64) + 64) % 64) * 100.0::DOUBLE + 50 AS rel_x, (((z % 64) + 64) % 64) * 100.0::DOUBLE + 50 AS rel_z,
  z * -100.0::DOUBLE AS mirrored_y FROM columns""", ["columns"])
def _(w):
    cols = top_voxel_per_column(w.solid()).select("x", "z", (F.col("y") + 1).alias("height"))
    return X.to_engine_coords(cols, y="height", z_offset_cm=-50.0, cell=64).drop("height")


@query("column_legality", f"""SELECT extent_id, s AS section_size,
  (width - 1) % s = 0 AND (depth - 1) % s = 0 AND (width - 1) // s > 0 AND (depth - 1) // s > 0 AS legal
  FROM extents, (SELECT unnest({V.SECTION_SIZES}) AS s)""", ["extents"])
def _(w):
    sizes = w.extents().select("extent_id", F.col("width").alias("size_x"), F.col("depth").alias("size_y"),
                               F.explode(F.array(*map(F.lit, V.SECTION_SIZES))).alias("section_size"))
    return X.column_legality(sizes).select("extent_id", "section_size", "legal")


@query("lookup_palette", "SELECT palette_id, label, role, family, count(*) AS n FROM solid GROUP BY 1, 2, 3, 4",
       ["solid"])
def _(w):
    return w.solid().groupBy("palette_id", "label", "role", "family").agg(C.n_rows())


@query("palette_index_of", """SELECT name, min(palette_id) AS palette_id FROM (SELECT DISTINCT name FROM blocks)
  LEFT JOIN palette USING (name) GROUP BY name""", ["blocks", "palette"])
def _(w):
    return X.palette_index_of(w.blocks().select("name").distinct(), w.palette())


@query("build_global_palette", """SELECT name, properties, row_number() OVER (ORDER BY name, properties) - 1 AS palette_id
  FROM (SELECT DISTINCT name, properties FROM blocks)""", ["blocks"])
def _(w):
    states = w.blocks().select("name", "properties").distinct()
    return global_row_number(states, ["name", "properties"], "palette_id")


@query("export_sample", """SELECT rx, rz, count(*) AS n FROM (SELECT CAST(floor(x / 512) AS INT) AS rx,
    CAST(floor(z / 512) AS INT) AS rz, dense_rank() OVER (ORDER BY floor(x / 512), floor(z / 512)) AS k FROM voxels)
  WHERE k <= 2 GROUP BY rx, rz""", ["voxels"])
def _(w):
    return X.export_sample(w.voxels(), 2).groupBy("rx", "rz").agg(C.n_rows())


@query("block_state_histogram", "SELECT dim, name, properties, count(*) AS n FROM dimmed GROUP BY 1, 2, 3",
       ["solid"], [DIMS])
def _(w):
    return C.block_state_histogram(w.dim_solid())


@query("dimension_stats", f"""SELECT dim, count(*) AS non_air, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y,
  max(y) AS max_y, min(z) AS min_z, max(z) AS max_z, count(DISTINCT ({CX}, {CZ})) AS chunks,
  count(DISTINCT ({CX}, {CZ}, y // 16)) AS sections, count(DISTINCT (floor(x / 512), floor(z / 512))) AS regions,
  count(DISTINCT name) AS block_types, count(DISTINCT (name, properties)) AS block_states
  FROM dimmed GROUP BY dim""", ["solid"], [DIMS])
def _(w):
    return C.dimension_stats(w.dim_solid())


@query("world_rollup", """SELECT coalesce(dim, 'total') AS dim, count(*) AS voxels, 4 * count(*) AS est_bytes
  FROM dimmed GROUP BY ROLLUP (dim)""", ["solid"], [DIMS])
def _(w):
    return C.world_rollup(w.dim_solid())


@query("error_sample", """SELECT dim, region, seq, rank, errors FROM (
   SELECT *, row_number() OVER (PARTITION BY dim ORDER BY region, seq) AS rank FROM (
     SELECT user_id % 3 AS dim, user_id % 40 AS region, event_id AS seq,
       row_number() OVER (PARTITION BY user_id % 3, user_id % 40 ORDER BY event_id) AS k,
       count(*) OVER (PARTITION BY user_id % 3) AS errors
     FROM events WHERE event_type = 'error') WHERE k <= 5) WHERE rank <= 20""")
def _(w):
    e = w.table("events").filter("event_type = 'error'").selectExpr(
        "user_id % 3 AS dim", "user_id % 40 AS region", "event_id AS seq")
    return C.error_sample(e)


@query("world_bounds", """SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y,
  min(z) AS min_z, max(z) AS max_z FROM solid""", ["solid"])
def _(w):
    return C.world_bounds(X.drop_air(w.voxels(), w.palette()))


@query("biome_histogram", """SELECT biome, count(*) AS n FROM (SELECT CAST(floor(abs(CAST(unnest(embedding) AS DOUBLE)) * 1000) AS INT)
  % 64 AS biome FROM embeddings) GROUP BY biome""")
def _(w):
    chunks = w.table("embeddings").select(F.transform(
        "embedding", lambda v: (F.floor(F.abs(v.cast("double")) * 1000).cast("int") % 64)).alias("biomes"))
    return C.biome_histogram(chunks)


@query("label_histogram", "SELECT label, count(*) AS n FROM solid GROUP BY label", ["solid"])
def _(w):
    return C.label_histogram(w.solid())


@query("family_counts", f"""SELECT family, n, round(n / sum(n) OVER (), 6) AS share FROM (
  SELECT {R.material_family('name')} AS family, count(*) AS n FROM solid GROUP BY 1)""", ["solid"])
def _(w):
    by_name = w.solid().groupBy("name").agg(C.n_rows()) \
        .withColumn("family", rules.material_family(F.col("name")))
    return C.share_of(by_name, "family", "n")


@query("dominant_properties", """SELECT name, arg_min(properties, (-n, properties)) AS properties, max(n) AS n FROM
  (SELECT name, properties, count(*) AS n FROM blocks GROUP BY 1, 2) GROUP BY name""", ["blocks"])
def _(w):
    return C.dominant_properties(w.blocks())


@query("cell_buckets", """SELECT count(DISTINCT (cell_x, cell_z)) AS cells, max(cell_x) - min(cell_x) + 1 AS extent_x,
  max(cell_z) - min(cell_z) + 1 AS extent_z, count(*) AS groups, CAST(sum(n) AS BIGINT) AS instances,
  CAST(sum(greatest(1, ceil(n / 300))) AS BIGINT) AS components FROM buckets""", ["solid"], [BUCKETS])
def _(w):
    return C.bucket_summary(C.cell_buckets(w.solid(), cell=64), cap=300)


@query("largest_groups", "SELECT * FROM buckets ORDER BY n DESC, cell_x, cell_z, name LIMIT 20", ["solid"], [BUCKETS])
def _(w):
    return C.cell_buckets(w.solid(), cell=64).orderBy(F.desc("n"), "cell_x", "cell_z", "name").limit(20)


BUILT = ("density", f"""SELECT CAST(floor((x - x0) / 8) AS INT) AS cell_x, CAST(floor((z - z0) / 8) AS INT) AS cell_z,
   count(*) AS n, count(*) / 64.0::DOUBLE AS fraction
  FROM top, (SELECT min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM solid)
  WHERE {R.has_any('lower(name)', V.MAN_MADE_TOKENS)}
   AND floor((x - x0) / 8) < floor((x1 - x0 + 1) / 8) AND floor((z - z0) / 8) < floor((z1 - z0 + 1) / 8)
  GROUP BY 1, 2""")


def built_density(w, cell=8):
    """Share of built columns in each cell of the map."""
    top = cut_lineage(top_voxel_per_column(w.solid()))
    return C.cell_density(top.filter("built"), C.world_bounds(top), cell)


@query("cell_density", "SELECT * FROM density", ["solid"], [TOP, BUILT])
def _(w):
    return built_density(w)


@query("density_diagnostics", """SELECT count(*) AS cells_nonzero, round(max(fraction), 6) AS frac_max,
  round(quantile_cont(fraction, 0.99), 6) AS frac_p99, round(quantile_cont(fraction, 0.95), 6) AS frac_p95,
  count(*) FILTER (fraction >= 0.4) AS cells_over_threshold FROM density""", ["solid"], [TOP, BUILT])
def _(w):
    return C.density_diagnostics(built_density(w), threshold=0.4)


@query("column_classes", f"""SELECT count(*) AS solid, count(*) FILTER (b) AS built, count(*) FILTER (m) AS natural,
  round(100.0 * count(*) FILTER (b) / count(*), 6) AS built_pct FROM (
   SELECT {R.has_any('lower(name)', V.MAN_MADE_TOKENS)} AS b, {R.has_any('lower(name)', V.NATURAL_TOKENS)} AS m
   FROM top)""", ["solid"], [TOP])
def _(w):
    return C.column_classes(top_voxel_per_column(w.solid()))


GROUPED = ("grouped", "SELECT *, CASE " + " ".join(
    f"WHEN {R.bare('name')} IN ({R.quoted(n)}) THEN '{g}'" for g, n in V.LANDMARK_GROUPS.items())
    + " END AS grp FROM solid")


@query("landmark_groups", """SELECT a.*, mix FROM (
  SELECT grp, count(*) AS n, CAST(trunc(avg(x)) AS INT) AS centre_x, CAST(trunc(avg(y)) AS INT) AS centre_y,
   CAST(trunc(avg(z)) AS INT) AS centre_z, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z,
   max(x) AS max_x, max(y) AS max_y, max(z) AS max_z FROM grouped WHERE grp IS NOT NULL GROUP BY grp) a
  JOIN (SELECT grp, string_agg(name || '=' || n, ',' ORDER BY k) AS mix FROM (
    SELECT grp, name, count(*) AS n, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, name) AS k
    FROM grouped WHERE grp IS NOT NULL GROUP BY 1, 2) WHERE k <= 6 GROUP BY grp) b USING (grp)""",
       ["solid"], [GROUPED])
def _(w):
    return C.landmark_groups(w.solid())


@query("landmark_blobs", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, bx, bz) AS rank
  FROM (SELECT grp, CAST(floor(x / 8) AS INT) AS bx, CAST(floor(z / 8) AS INT) AS bz, count(*) AS n,
   CAST(trunc(avg(x)) AS INT) AS mean_x, CAST(trunc(avg(y)) AS INT) AS mean_y, CAST(trunc(avg(z)) AS INT) AS mean_z,
   max(y) AS top_y, max(x) - min(x) AS span_x, max(z) - min(z) AS span_z
   FROM grouped WHERE grp IS NOT NULL GROUP BY 1, 2, 3)) WHERE rank <= 8""", ["solid"], [GROUPED])
def _(w):
    return C.landmark_blobs(w.solid())


@query("building_mass_center", """SELECT count(*) AS n, round(avg(x), 6) AS build_x, round(avg(z), 6) AS build_z
  FROM grouped WHERE grp = 'building'""", ["solid"], [GROUPED])
def _(w):
    return C.building_mass_center(w.solid())


SYMBOLS = ("symbols", f"""SELECT CAST(floor(x / 12) AS INT) AS i, CAST(floor((z + 64) / 12) AS INT) AS j,
  coalesce({R.lookup(R.material_family('name'), V.FAMILY_SYMBOLS)}, '#') AS symbol, count(*) AS n, max(y) AS y
  FROM solid GROUP BY 1, 2, 3""")
MODES = ("modes", """SELECT i, j, arg_min(symbol, (CASE WHEN symbol IN ('G', '#') THEN 1 ELSE 0 END, -n, symbol)) AS symbol,
  max(y) AS top_y FROM symbols GROUP BY i, j""")


@query("cell_role_mode", "SELECT * FROM modes", ["solid"], [SYMBOLS, MODES])
def _(w):
    return C.cell_role_mode(w.solid(), origin=(0, -64))


@query("ascii_map_rows", """SELECT a.i AS i, string_agg(coalesce(symbol, '.'), '' ORDER BY b.j) AS line
  FROM (SELECT DISTINCT i FROM modes) a, (SELECT unnest(range((SELECT min(j) FROM modes), (SELECT max(j) + 1 FROM modes))) AS j) b LEFT JOIN modes ON modes.i = a.i AND modes.j = b.j GROUP BY a.i""",
       ["solid"], [SYMBOLS, MODES])
def _(w):
    return C.ascii_map_rows(cut_lineage(C.cell_role_mode(w.solid(), origin=(0, -64))))


STEPS = R.block_rgb_steps("name")
COLOURED = ("coloured", f"SELECT name, n, coalesce({', '.join(STEPS.values())}) AS rgb FROM "
                        "(SELECT name, count(*) AS n FROM top GROUP BY name)")


@query("colour_legend", """SELECT rgb >> 16 AS r, (rgb >> 8) & 255 AS g, rgb & 255 AS b, CAST(sum(n) AS BIGINT) AS n,
  arg_min(name, (-n, name)) AS colour_name, string_agg(name, ',' ORDER BY n DESC, name) AS blocks,
  round(sum(n) / (SELECT sum(n) FROM coloured), 6) AS share FROM coloured GROUP BY rgb""",
       ["solid"], [TOP, COLOURED])
def _(w):
    return C.colour_legend(top_voxel_per_column(w.solid()))


@query("ordered_legend", """SELECT rgb >> 16 AS r, (rgb >> 8) & 255 AS g, rgb & 255 AS b, CAST(sum(n) AS BIGINT) AS n
  FROM coloured GROUP BY rgb ORDER BY n DESC, rgb LIMIT 10""", ["solid"], [TOP, COLOURED])
def _(w):
    legend = C.colour_legend(top_voxel_per_column(w.solid()))
    return legend.orderBy(F.desc("n"), "r", "g", "b").limit(10).select("r", "g", "b", "n")


@query("radius_composition", """SELECT family, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM top
  WHERE (x - 8) * (x - 8) + (z + 5) * (z + 5) <= 3600 GROUP BY family""", ["solid"], [TOP])
def _(w):
    return C.radius_composition(top_voxel_per_column(w.solid()), 8, -5, 60)


@query("height_above_ground", """SELECT s.name, count(*) AS n, median(CAST(s.y - g.y AS DOUBLE)) AS median_above,
  round(avg(CASE WHEN s.y > 4 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_high
  FROM solid s JOIN (SELECT x, z, max(y) AS y FROM solid WHERE label IN ('TERRAIN', 'SUBSURFACE') GROUP BY x, z) g
  USING (x, z) GROUP BY s.name""", ["solid"])
def _(w):
    from ..operators.columns import height_above_ground
    ground = X.filter_labels(w.solid(), V.TERRAIN_LABELS).groupBy("x", "z").agg(F.max("y").alias("ground_y"))
    return height_above_ground(w.solid(), ground, high_y=4)


@query("top_blocks", """SELECT * FROM (SELECT dim, name, n, row_number() OVER (PARTITION BY dim ORDER BY n DESC, name) AS rank
  FROM (SELECT dim, name, count(*) AS n FROM dimmed GROUP BY 1, 2)) WHERE rank <= 10""", ["solid"], [DIMS])
def _(w):
    counts = w.dim_solid().groupBy("dim", "name").agg(C.n_rows())
    return top_per_group(counts, ["dim"], [F.desc("n"), "name"], 10)


@query("top_states", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dim ORDER BY n DESC, name, properties) AS rank
  FROM (SELECT dim, name, properties, count(*) AS n FROM dimmed GROUP BY 1, 2, 3)) WHERE rank <= 12""", ["solid"], [DIMS])
def _(w):
    return top_per_group(C.block_state_histogram(w.dim_solid()), ["dim"],
                         [F.desc("n"), "name", "properties"], 12)


@query("union_part_results", """SELECT name, count(*) AS n, min(y) AS min_y, max(y) AS max_y FROM dimmed
  GROUP BY name""", ["solid"], [DIMS])
def _(w):
    parts = [w.dim_solid().filter(F.col("dim") == d).groupBy("name").agg(
        C.n_rows(), F.min("y").alias("min_y"), F.max("y").alias("max_y")) for d in ("overworld", "nether", "end")]
    return C.union_part_results(parts)


@query("distinct_states", "SELECT DISTINCT name, properties FROM solid", ["solid"])
def _(w):
    return w.solid().select("name", "properties").distinct()


@query("names_except", "SELECT name FROM solid EXCEPT SELECT name FROM blocks", ["solid", "blocks"])
def _(w):
    return w.solid().select("name").subtract(w.blocks().select("name"))


@query("names_intersect", "SELECT name FROM solid INTERSECT SELECT name FROM blocks", ["solid", "blocks"])
def _(w):
    return w.solid().select("name").intersect(w.blocks().select("name"))


@query("coverage_anti", """SELECT name, 'no_entry' AS kind FROM (SELECT DISTINCT name FROM solid) WHERE name NOT IN (SELECT name FROM blocks)
  UNION ALL SELECT name, 'unused' FROM (SELECT DISTINCT name FROM blocks) WHERE name NOT IN (SELECT name FROM solid)""",
       ["solid", "blocks"])
def _(w):
    used = w.solid().select("name").distinct()
    known = w.blocks().select("name").distinct()
    return (used.join(known, "name", "left_anti").withColumn("kind", F.lit("no_entry"))
            .unionByName(known.join(used, "name", "left_anti").withColumn("kind", F.lit("unused"))))


@query("unmapped_names", f"SELECT DISTINCT name FROM blocks WHERE {R.material_family('name')} = 'other'", ["blocks"])
def _(w):
    # stored, or the planner would try the rule on every row before the names are made distinct
    names = cut_lineage(w.blocks().select("name").distinct())
    return names.filter(rules.material_family(F.col("name")) == "other").orderBy("name")


@query("stale_outputs", """SELECT file FROM (SELECT concat('world_', lpad(CAST(p_partkey % 40 AS VARCHAR), 2, '0'), '_',
    lpad(CAST(p_size AS VARCHAR), 2, '0'), CASE WHEN p_partkey % 7 = 0 THEN '.jpg' ELSE '.png' END) AS file FROM part)
  WHERE regexp_matches(file, '^world_[0-9]{2}_[0-9]{2}[.]png$') AND file NOT IN (
    SELECT concat('world_', lpad(CAST(width % 40 AS VARCHAR), 2, '0'), '_', lpad(CAST(depth % 50 AS VARCHAR), 2, '0'), '.png') FROM extents)
  GROUP BY file""", ["extents"])
def _(w):
    from ..operators.quality import stale_outputs
    listing = w.table("part").selectExpr(
        "concat('world_', lpad(cast(p_partkey % 40 as string), 2, '0'), '_', lpad(cast(p_size as string), 2, '0'), "
        "CASE WHEN p_partkey % 7 = 0 THEN '.jpg' ELSE '.png' END) AS file")
    kept = w.extents().selectExpr("concat('world_', lpad(cast(width % 40 as string), 2, '0'), '_', "
                                  "lpad(cast(depth % 50 as string), 2, '0'), '.png') AS file")
    return stale_outputs(listing, kept, "world")


@query("prefix_census", "SELECT split_part(p_name, ' ', 1) AS prefix, count(*) AS n FROM part GROUP BY 1")
def _(w):
    from ..operators.quality import prefix_census
    return prefix_census(w.table("part").selectExpr("replace(p_name, ' ', '_') AS label"))


@query("listing_rollup", """SELECT source, prefix, count(*) FILTER (contains(lower(url), prefix)) AS n,
   (count(*) FILTER (contains(lower(url), prefix)) > 0) AS present
  FROM (SELECT CASE WHEN page_id % 2 = 0 THEN 'a' ELSE 'b' END AS source, url FROM pages),
   (SELECT unnest(['http', 'page', 'nowhere', 'com']) AS prefix) GROUP BY ROLLUP (source), prefix""")
def _(w):
    from ..operators.quality import listing_rollup
    lines = w.table("pages").selectExpr("CASE WHEN page_id % 2 = 0 THEN 'a' ELSE 'b' END AS source", "url AS line")
    return listing_rollup(lines, ["http", "page", "nowhere", "com"])
