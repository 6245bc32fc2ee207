"""Queries that go through source and sink formats and back."""

from pyspark.sql import functions as F

from .. import fixture_bytes as B
from ..operators import census as C
from ..operators import mesh as M
from ..operators import tiles as T
from ..operators import voxels as X
from ..operators.ranking import number_in_groups
from ..session import cut_lineage
from ..sources import images as I
from ..sources import regions as G
from ..sources import text as S
from ..sources.line_packs import scan_lines
from ..operators import quality as Q
from ..sources.voxel_files import chunk_index, chunk_words, header_counts, scan_voxel_file
from .geometry import QUAD_VIEWS, TILE_VIEWS, exported, members
from .registry import query
from .spatial import GRID, SOLID
from .tables import CX, CZ, DIMS, with_words


def payloads(w):
    named = w.dim_solid().withColumn("y", F.col("y") + 12).select("dim", "x", "y", "z", "name", "properties")
    return B.chunk_payloads(named)


def slots(w):
    return G.scan_region_archives(B.region_archives(payloads(w)))


@query("scan_region_archives", f"""SELECT dim, CAST(floor(x / 512) AS INT) AS rx, CAST(floor(z / 512) AS INT) AS rz, {CX} AS cx, {CZ} AS cz, 2 AS ctype,
  CAST(NULL AS VARCHAR) AS error FROM dimmed GROUP BY ALL""", SOLID, [DIMS])
def _(w):
    return slots(w).drop("payload")


@query("decode_chunks", f"""SELECT dim, {CX} AS cx, {CZ} AS cz, (y + 12) // 16 AS sy, count(DISTINCT (name, properties)) + 1 AS states
  FROM dimmed GROUP BY ALL""", SOLID, [DIMS])
def _(w):
    return G.decode_chunks(slots(w)).select("dim", "cx", "cz", "sy", F.size("palette").cast("bigint").alias("states"))


@query("unpack_sections", "SELECT dim, x, y + 12 AS y, z, name, properties FROM dimmed", SOLID, [DIMS])
def _(w):
    return G.unpack_sections(G.decode_chunks(slots(w)))


@query("scan_worlds", """SELECT s_name AS path, CASE WHEN k % 10 > 0 THEN s_name END AS level_name, CASE WHEN k % 10 > 0 THEN CASE k % 5 WHEN 0 THEN 'survival' WHEN 1 THEN 'creative'
   WHEN 2 THEN 'adventure' WHEN 3 THEN 'spectator' ELSE 'unknown' END END AS game_type_name, CASE WHEN k % 10 > 0 THEN k % 2 = 1 END AS hardcore,
  CASE WHEN k % 10 > 0 THEN k::INT END AS spawn_x, CASE WHEN k % 10 > 0 THEN k * 1000003 END AS seed, k % 10 = 0 AS failed FROM (SELECT s_name, s_suppkey AS k FROM supplier)""")
def _(w):
    files = B.world_records(w.table("supplier").selectExpr("s_name AS name", "s_suppkey AS k"))
    return G.scan_worlds(files).select("path", "level_name", "game_type_name", "hardcore", F.col("spawn.x").alias("spawn_x"),
                                       "seed", F.col("error").isNotNull().alias("failed"))


@query("scan_voxel_file", "SELECT x, y, z, name, properties FROM solid", SOLID)
def _(w):
    folder = B.scratch(w.spark, "voxels")
    states = [(r["name"], r["properties"]) for r in w.palette().orderBy("palette_id").collect()]
    B.write_voxel_files(with_words(w).select("cx", "cz", "word", "local_to_global"), states, folder).count()
    return scan_voxel_file(w.spark, folder).select("x", "y", "z", "name", "properties")


@query("header_counts", """SELECT DISTINCT concat('r_', CAST(floor(x / 512) AS INT), '_', CAST(floor(z / 512) AS INT), '.bin') AS file,
  CAST(0 AS BIGINT) AS diff_n, 'ok' AS state FROM solid""", SOLID)
def _(w):
    folder = B.scratch(w.spark, "voxels")
    states = [(r["name"], r["properties"]) for r in w.palette().orderBy("palette_id").collect()]
    B.write_voxel_files(with_words(w).select("cx", "cz", "word", "local_to_global"), states, folder).count()
    stated = header_counts(w.spark, folder).select("file", F.col("voxels").alias("n"))
    read = chunk_words(chunk_index(w.spark, folder)).groupBy("file").agg(C.n_rows())
    return Q.reconcile_counts(read, stated, "file", ["n"])


@query("write_voxels", "SELECT dim, x, y, z, palette_id FROM dimmed", SOLID, [DIMS])
def _(w):
    folder = B.scratch(w.spark, "table")
    S.write_voxels(w.dim_solid().select("dim", "x", "y", "z", "palette_id"), folder)
    return w.spark.read.parquet(folder).select("dim", "x", "y", "z", "palette_id")


@query("write_report_json", "SELECT dim, count(*) AS voxels FROM dimmed GROUP BY dim", SOLID, [DIMS])
def _(w):
    folder = B.scratch(w.spark, "report")
    per = w.dim_solid().groupBy("dim").agg(C.n_rows("voxels"))
    S.write_report_json(per.agg(F.array_sort(F.collect_list(F.struct("dim", "voxels"))).alias("dims"))
                        .withColumn("elapsed_s", F.lit(1.0)), folder)
    back = w.spark.read.schema("dims array<struct<dim:string,voxels:bigint>>").json(folder)
    return back.select(F.explode("dims").alias("d")).select("d.*")


SAMPLES = "SELECT tile, row, col, v FROM samples"


@query("scan_heightmap_images", SAMPLES, GRID, TILE_VIEWS)
def _(w):
    return I.scan_heightmap_images(B.height_pngs(exported(w)[1].select("tile", "row", "col", "v")))


@query("write_u16_tiles", """SELECT tile, CAST(row // 64 * 64 AS INT) AS row0, max(col) + 1 AS width, CAST(count(DISTINCT row) AS INT) AS height,
  upper(string_agg(printf('%02x%02x', v % 256, v // 256), '' ORDER BY row, col)) AS bytes FROM samples GROUP BY tile, row // 64""", GRID, TILE_VIEWS)
def _(w):
    folder = B.scratch(w.spark, "rasters")
    I.write_u16_tiles(exported(w)[1], folder)
    return w.spark.read.parquet(folder).select("tile", "row0", "width", "height", F.hex("raster").alias("bytes"))


@query("scan_u16_tiles", SAMPLES, GRID, TILE_VIEWS)
def _(w):
    folder = B.scratch(w.spark, "rasters")
    I.write_u16_tiles(exported(w)[1], folder)
    return I.scan_u16_tiles(w.spark.read.parquet(folder))


@query("pack_instances", f"""SELECT name, {CX} AS cx, {CZ} AS cz, CAST(count(*) AS INT) AS n, upper(string_agg(printf('%02x%02x%02x%02x%02x%02x',
   ((x % 64) + 64) % 64, 0, ((z % 64) + 64) % 64, 0, y % 256, y // 256), '' ORDER BY y, ((z % 64) + 64) % 64, ((x % 64) + 64) % 64)) AS bytes FROM solid GROUP BY 1, 2, 3""", SOLID)
def _(w):
    return I.pack_instances(w.solid(), 64).select("name", "cx", "cz", "n", F.hex("records").alias("bytes"))


@query("unpack_instances", """SELECT CAST(floor(x / 64) AS INT) AS cell_x, CAST(floor(z / 64) AS INT) AS cell_z, name, (((x % 64) + 64) % 64) * 100 + 50.0::DOUBLE AS ux,
  (((z % 64) + 64) % 64) * 100 + 50.0::DOUBLE AS uy, y * 100 + 50 + 20000000.0::DOUBLE AS uz FROM solid""", SOLID)
def _(w):
    return I.unpack_instances(I.pack_instances(w.solid(), 64), 20000000.0)


# --- meshes as text ----------------------------------------------------------

def numbered_quads(w):
    """Quads of all objects, numbered in the object. They are stored in even
    parts by object, as each quad grows to many lines."""
    quads = M.greedy_quads(M.exposed_face_rows(members(w), w.solid()))
    return number_in_groups(quads, "object_id", ["material", "axis", "sign", "plane", "r0", "c0"], "quad", first="head")


def obj_lines(w):
    """OBJ lines of all objects."""
    return S.quad_obj_lines(M.mesh_quads(numbered_quads(w)))


@query("write_obj_tiles", """SELECT CAST(object_id AS VARCHAR) AS name, count(*) * 4 AS v, count(*) * 4 AS vt, count(*) * 4 AS vn, count(*) * 2 + count(DISTINCT material) AS f,
  count(*) * 14 + count(DISTINCT material) - 1 AS last_line FROM quads GROUP BY object_id""", SOLID, QUAD_VIEWS)
def _(w):
    folder = B.scratch(w.spark, "obj")
    S.write_obj_tiles(numbered_quads(w), folder)
    tag = F.substring_index("line", " ", 1)
    return scan_lines(w.spark, folder).groupBy("name").agg(*[F.count_if(tag == t).alias(t) for t in ("v", "vt", "vn")],
                                                           F.count_if(tag.isin("f", "usemtl")).alias("f"), F.max("line_no").alias("last_line"))


@query("obj_line_census", """SELECT object_id AS file, count(*) * 4 AS n_v, count(*) * 4 AS n_vt, count(*) * 4 AS n_vn, count(*) * 2 AS n_f, count(DISTINCT material) AS n_usemtl,
  count(*) * 2 AS triangles, CAST(0 AS BIGINT) AS negative_zeros, CAST(0 AS BIGINT) AS cr FROM quads GROUP BY object_id""", SOLID, QUAD_VIEWS)
def _(w):
    return S.obj_line_census(obj_lines(w).withColumnRenamed("object_id", "file"))


@query("usemtl_first_seen", """SELECT file, material, CAST(row_number() OVER (PARTITION BY file ORDER BY material) - 1 AS INT) AS place
  FROM (SELECT DISTINCT object_id AS file, material FROM quads)""", SOLID, QUAD_VIEWS)
def _(w):
    lines = obj_lines(w).withColumn("line_no", F.struct("section", "k"))
    return S.usemtl_first_seen(lines.withColumnRenamed("object_id", "file"))


def mesh_pack(w):
    """Vertices and triangles of each height tile, numbered in the tile, and the range of heights."""
    tiles, samples, lo, sp = exported(w)
    cm = T.decode_height(F.col("v"), T.z_scale_cm(sp), T.z_offset_cm(lo, sp))
    s = cut_lineage(samples.join(tiles.select("tile", "size_x", "size_y"), "tile")
                    .withColumn("vertex", F.col("row") * F.col("size_x") + F.col("col")).withColumn("z_cm", cm))
    a = F.col("vertex")
    b, d = a + 1, a + F.col("size_x")
    tri = F.array(F.struct(a.alias("a"), (d + 1).alias("b"), b.alias("c")), F.struct(a.alias("a"), d.alias("b"), (d + 1).alias("c")))
    t = s.filter("row < size_y - 1 AND col < size_x - 1").select("tile", F.explode(tri).alias("t")).select("tile", "t.*")
    return s.select("tile", "vertex", "row", "col", "z_cm"), t, lo, sp


PACK = """SELECT tile, max(size_x) * max(size_y)::BIGINT AS vertices, (max(size_x) - 1) * (max(size_y) - 1) * 2::BIGINT AS triangles, TRUE AS ok FROM samples GROUP BY tile"""


@query("write_mesh_pack", PACK, GRID, TILE_VIEWS)
def _(w):
    folder = B.scratch(w.spark, "mesh")
    S.write_mesh_pack(*mesh_pack(w)[:2], folder)
    return S.scan_mesh_pack(w.spark, folder)


@query("scan_mesh_pack", "SELECT tile, row, col, v FROM samples", GRID, TILE_VIEWS)
def _(w):
    folder = B.scratch(w.spark, "mesh")
    v, t, lo, sp = mesh_pack(w)
    S.write_mesh_pack(v, t, folder)
    back = w.spark.read.parquet(f"{folder}/vertices")
    cm = F.rint((F.col("z_cm") - T.z_offset_cm(lo, sp)) / T.z_scale_cm(sp) * 128.0 + 32768.0)
    return back.select(F.col("tile").cast("string"), "row", "col", cm.cast("int").alias("v"))


DOCS = """SELECT node, concat('d', CAST(node AS STRING), '.json') AS path, CASE WHEN node % 9 = 8 THEN '{{"parent": ' ELSE concat('{{"parent":"block/p', CAST(parent AS STRING),
  '","textures":{{"all":"block/t', CAST(node % 7 AS STRING), '"}},"elements":[{{"from":[0,0,0],"to":[16,', CAST(8 + 8 * (node % 2) AS STRING), ',16],"faces":{{"up":{{"texture":"#all"}}}}}}]}}') END AS text FROM ({parents}) AS p WHERE parent IS NOT NULL"""


@query("scan_asset_json", """SELECT node, node % 9 = 8 AS bad, CASE WHEN node % 9 < 8 THEN 'block/p' || parent END AS parent, CASE WHEN node % 9 < 8 THEN 'block/t' || node % 7 END AS texture,
  CASE WHEN node % 9 < 8 THEN node % 2 = 1 END AS is_full FROM parents WHERE parent IS NOT NULL""", ["parents"])
def _(w):
    from ..fixtures import PARENTS
    text = DOCS.replace("{parents}", PARENTS)
    docs = S.scan_asset_json(w.spark.sql(text, customer=w.table("customer")))
    faces = S.model_elements(docs).select("node", "is_full")
    return docs.join(faces, "node", "left").select("node", "bad", F.col("doc.parent").alias("parent"),
                                                   F.col("doc.textures")["all"].alias("texture"), "is_full")


@query("image_to_pixels", "SELECT CAST(image_id AS VARCHAR) AS image, px_row, px_col, r, g, b FROM pixels WHERE px_col BETWEEN 1 AND 6 AND px_row % 2 = 0 AND px_col % 2 = 0", ["pixels"])
def _(w):
    folder = B.scratch(w.spark, "pictures")
    B.write_pictures(w.pixels(), folder).count()
    px = I.image_to_pixels(w.spark.read.format("image").load(folder), crop=(1, 0, 7, 8), step=2)
    return px.withColumn("image", F.regexp_extract("origin", r"([0-9]+)\.png$", 1)).drop("origin")
