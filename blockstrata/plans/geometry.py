"""Queries over faces, quads, triangles, tiles and height codes."""

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import census as C
from ..operators import columns as L
from ..operators import mesh as M
from ..operators import objects as O
from ..operators import stencils as S
from ..operators import tiles as T
from ..operators.ranking import percentile_of, sorted_counts
from ..session import cut_lineage
from . import rule_sql as R
from . import sql_parts as P
from .registry import query
from .spatial import FLAT, GRID, HMV, LIQUID, OBJ_COMP, SOLID, filled, r6, tops

# --- faces -------------------------------------------------------------------

MEMBERS = ("members", "SELECT c.x, c.y, c.z, c.component AS object_id, s.family AS material FROM comp c JOIN solid s USING (x, y, z)")
FACES = ("faces", """SELECT object_id, material, axis, sign, plane, row, col FROM (
   SELECT m.*, axis, sign, CASE axis WHEN 'x' THEN m.x WHEN 'y' THEN m.y ELSE m.z END + CASE WHEN sign > 0 THEN 1 ELSE 0 END AS plane,
    CASE axis WHEN 'x' THEN m.y ELSE m.x END AS row, CASE axis WHEN 'z' THEN m.y ELSE m.z END AS col,
    m.x + CASE WHEN axis = 'x' THEN sign ELSE 0 END AS ox, m.y + CASE WHEN axis = 'y' THEN sign ELSE 0 END AS oy,
    m.z + CASE WHEN axis = 'z' THEN sign ELSE 0 END AS oz
   FROM members m, (SELECT unnest(['x', 'y', 'z']) AS axis) a, (SELECT unnest([-1, 1]) AS sign) b) f
  WHERE NOT EXISTS (SELECT 1 FROM solid s WHERE s.x = ox AND s.y = oy AND s.z = oz)""")
RUNS = ("runs", """SELECT object_id, axis, sign, plane, row, material, min(col) AS c0, max(col) + 1 AS c1 FROM (
   SELECT *, (row_number() OVER (PARTITION BY object_id, axis, sign, plane, row, material, island ORDER BY col) - 1) // 4 AS part FROM (
    SELECT *, col - row_number() OVER (PARTITION BY object_id, axis, sign, plane, row, material ORDER BY col) AS island FROM faces))
  GROUP BY object_id, axis, sign, plane, row, material, island, part""")
QUADS = ("quads", """SELECT object_id, axis, sign, plane, material, c0, c1, min(row) AS r0, max(row) + 1 AS r1 FROM (
   SELECT *, (row_number() OVER (PARTITION BY object_id, axis, sign, plane, material, c0, c1, island ORDER BY row) - 1) // 4 AS part FROM (
    SELECT *, row - row_number() OVER (PARTITION BY object_id, axis, sign, plane, material, c0, c1 ORDER BY row) AS island FROM runs))
  GROUP BY object_id, axis, sign, plane, material, c0, c1, island, part""")
FACE_VIEWS = OBJ_COMP + [MEMBERS, FACES]
QUAD_VIEWS = FACE_VIEWS + [RUNS, QUADS]


def members(w):
    """Object voxels with object and material, as a stored table."""
    solid = w.stored_solid()
    comp = O.object_components(solid)
    return cut_lineage(comp.select("x", "y", "z", F.col("component").alias("object_id"), F.col("family").alias("material")))


def faces(w, m=None):
    return M.exposed_face_rows(m if m is not None else members(w), w.stored_solid())


@query("exposed_face_rows", "SELECT * FROM faces", SOLID, FACE_VIEWS)
def _(w):
    return faces(w)


@query("horizontal_runs", "SELECT * FROM runs", SOLID, FACE_VIEWS + [RUNS])
def _(w):
    return M.horizontal_runs(faces(w))


@query("greedy_quads", "SELECT * FROM quads", SOLID, QUAD_VIEWS)
def _(w):
    return M.greedy_quads(faces(w))


CORNERS = ("corners", """SELECT object_id, axis, sign, plane, material, r0, r1, c0, c1, corner,
   CASE WHEN i IN (1, 2) THEN r1 ELSE r0 END AS r, CASE WHEN i IN (2, 3) THEN c1 ELSE c0 END AS c,
   CASE WHEN i IN (1, 2) THEN r1 - r0 ELSE 0 END AS u, CASE WHEN i IN (2, 3) THEN c1 - c0 ELSE 0 END AS v
  FROM (SELECT *, CASE WHEN (CASE WHEN axis = 'y' THEN -1 ELSE 1 END) * sign > 0 THEN 3 - corner ELSE (corner + 1) % 4 END AS i
   FROM quads, (SELECT unnest([0, 1, 2, 3]) AS corner))""")


@query("mesh_quads", """SELECT object_id, axis, sign, material, corner, plane, r0, c0, u, v,
  (CASE axis WHEN 'x' THEN plane ELSE r END) * 100.0::DOUBLE AS ux, (CASE axis WHEN 'z' THEN plane ELSE c END) * 100.0::DOUBLE AS uy,
  (CASE axis WHEN 'y' THEN plane WHEN 'x' THEN r ELSE c END) * 100.0::DOUBLE AS uz,
  CASE axis WHEN 'x' THEN sign ELSE 0 END AS nx, CASE axis WHEN 'z' THEN sign ELSE 0 END AS ny, CASE axis WHEN 'y' THEN sign ELSE 0 END AS nz
  FROM corners""", SOLID, QUAD_VIEWS + [CORNERS])
def _(w):
    return M.mesh_quads(M.greedy_quads(faces(w))).select(
        "object_id", "axis", "sign", "material", "corner", "plane", "r0", "c0", "u", "v", "ux", "uy", "uz", "nx", "ny", "nz")


LAYOUT = ("layout", "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join([f"'{r[0]}'"] + [str(v) for v in r[1:8]] + [f"{v!r}::DOUBLE" for v in r[8:]]) + ")" for r in M.atlas_layout())
    + ") AS l(family, idx, col, row, px0, py0, px1, py1, u0, v0, u1, v1)")


def layout(w):
    return w.spark.createDataFrame(M.atlas_layout(), M.LAYOUT_SCHEMA)


DYED = f"regexp_replace(material, '_({'|'.join(V.DYES)})$', '')"


@query("block_uv", """SELECT material, max(u) AS max_u, max(v) AS max_v, CAST(sum(u) AS BIGINT) AS su, CAST(sum(v) AS BIGINT) AS sv
  FROM corners GROUP BY material""", SOLID, QUAD_VIEWS + [CORNERS])
def _(w):
    return M.mesh_quads(M.greedy_quads(faces(w))).groupBy("material").agg(
        F.max("u").alias("max_u"), F.max("v").alias("max_v"), F.sum("u").alias("su"), F.sum("v").alias("sv"))


@query("atlas_uv", f"""SELECT material, corner, axis, sign, round(avg(u0 + u / (r1 - r0) * (u1 - u0)), 6) AS atlas_u,
   round(avg(v0 + v / (c1 - c0) * (v1 - v0)), 6) AS atlas_v, count(*) AS n
  FROM corners JOIN layout ON layout.family = CASE WHEN material IN ({R.quoted(V.ATLAS_FAMILIES)}) THEN material ELSE {DYED} END
  GROUP BY 1, 2, 3, 4""", SOLID, QUAD_VIEWS + [CORNERS, LAYOUT])
def _(w):
    placed = M.atlas_uv(M.mesh_quads(M.greedy_quads(faces(w))), layout(w))
    return placed.groupBy("material", "corner", "axis", "sign").agg(
        F.round(F.avg("atlas_u"), 6).alias("atlas_u"), F.round(F.avg("atlas_v"), 6).alias("atlas_v"), C.n_rows())


@query("grid_cell_layout", """SELECT name, family, idx, col, row, px0, py0, px1, py1, round(u0, 6) AS u0, round(v0, 6) AS v0,
  round(u1, 6) AS u1, round(v1, 6) AS v1 FROM (SELECT DISTINCT name, family FROM solid) JOIN (
   SELECT * FROM layout) USING (family)""", SOLID, [LAYOUT])
def _(w):
    names = w.solid().select("name", "family").distinct()
    return names.join(layout(w), "family").select("name", "family", "idx", "col", "row", "px0", "py0", "px1", "py1",
                                                  *r6("u0", "v0", "u1", "v1"))


@query("volume_from_quads", """SELECT object_id, CAST(sum(CASE WHEN axis = 'x' THEN sign * plane ELSE 0 END) AS BIGINT) AS volume, count(*) AS area
  FROM faces GROUP BY object_id""", SOLID, FACE_VIEWS)
def _(w):
    return M.volume_from_quads(M.greedy_quads(faces(w)))


BOXES = ("boxes", """SELECT q.object_id, ax0 = x0 AND ax1 = x1 AND ay0 = y0 AND ay1 = y1 AND az0 = z0 AND az1 = z1 AS matches FROM (
   SELECT object_id, min(CASE axis WHEN 'x' THEN plane ELSE row END) AS ax0, max(CASE axis WHEN 'x' THEN plane ELSE row + 1 END) AS ax1,
    min(CASE axis WHEN 'y' THEN plane WHEN 'x' THEN row ELSE col END) AS ay0, max(CASE axis WHEN 'y' THEN plane WHEN 'x' THEN row + 1 ELSE col + 1 END) AS ay1,
    min(CASE axis WHEN 'z' THEN plane ELSE col END) AS az0, max(CASE axis WHEN 'z' THEN plane ELSE col + 1 END) AS az1 FROM faces GROUP BY 1) q
  JOIN (SELECT object_id, min(x) AS x0, max(x) + 1 AS x1, min(y) AS y0, max(y) + 1 AS y1, min(z) AS z0, max(z) + 1 AS z1 FROM members GROUP BY 1) m
  ON m.object_id = q.object_id""")


@query("bbox_check", "SELECT object_id, coalesce(matches, FALSE) AS matches FROM (SELECT DISTINCT object_id FROM members) LEFT JOIN boxes USING (object_id)",
       SOLID, FACE_VIEWS + [BOXES])
def _(w):
    m = members(w)
    return M.bbox_check(M.greedy_quads(faces(w, m)), m)


@query("mesh_reduction", """SELECT q.*, blocks, quads * 2 AS triangles, round(blocks * 12 / (quads * 2), 2) AS reduction FROM (
   SELECT object_id, CAST(sum(q) AS BIGINT) AS quads, count(*) AS materials, arg_min(material, (-q, material)) AS dominant,
    round(CAST(sum(a) AS BIGINT) / CAST(sum(q) AS BIGINT), 2) AS mean_extent FROM (
    SELECT object_id, material, count(*) AS q, sum((r1 - r0) * (c1 - c0)) AS a FROM quads GROUP BY 1, 2) GROUP BY 1) q
  JOIN (SELECT object_id, count(*) AS blocks FROM members GROUP BY 1) b ON b.object_id = q.object_id""", SOLID, QUAD_VIEWS)
def _(w):
    m = members(w)
    return M.mesh_reduction(M.greedy_quads(faces(w, m)), m)


# --- height field ------------------------------------------------------------

TRIS = [("sq", f"""SELECT x, z, h00, h10, lead(h00) OVER ({P.COL}) AS h01, lead(h10) OVER ({P.COL}) AS h11, x1, lead(z) OVER ({P.COL}) AS z1 FROM (
    SELECT x, z, height * 100.0::DOUBLE AS h00, lead(height * 100.0::DOUBLE) OVER ({P.ROW}) AS h10, lead(x) OVER ({P.ROW}) AS x1 FROM hm)"""),
        ("flips", "SELECT *, abs(h01 - h10) < abs(h00 - h11) AS flip FROM sq WHERE x1 IS NOT NULL AND z1 IS NOT NULL"),
        ("tris", """SELECT x, z, t, x * 100.0::DOUBLE + CASE WHEN NOT flip AND t = 1 THEN 0 ELSE 0 END AS a_x,
    CASE WHEN NOT flip AND t = 1 THEN h01 ELSE h00 END AS a_y, (CASE WHEN NOT flip AND t = 1 THEN z1 ELSE z END) * 100.0::DOUBLE AS a_z,
    (CASE WHEN t = 0 THEN x ELSE x1 END) * 100.0::DOUBLE AS b_x, CASE WHEN t = 0 THEN h01 ELSE h11 END AS b_y, z1 * 100.0::DOUBLE AS b_z,
    x1 * 100.0::DOUBLE AS c_x, CASE WHEN flip AND t = 0 THEN h11 ELSE h10 END AS c_y, (CASE WHEN flip AND t = 0 THEN z1 ELSE z END) * 100.0::DOUBLE AS c_z
   FROM flips, (SELECT unnest([0, 1]) AS t)"""),
        ("normals", """SELECT *, (b_y - a_y) * (c_z - a_z) - (b_z - a_z) * (c_y - a_y) AS nx, (b_z - a_z) * (c_x - a_x) - (b_x - a_x) * (c_z - a_z) AS ny,
    (b_x - a_x) * (c_y - a_y) - (b_y - a_y) * (c_x - a_x) AS nz FROM tris""")]
TRI_VIEWS = HMV + TRIS


def flat_points(df):
    return df.select("x", "z", "t", *[F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in "abc" for c in "xyz"])


@query("heightfield_mesh", "SELECT * FROM tris", GRID, TRI_VIEWS)
def _(w):
    return flat_points(M.heightfield_mesh(filled(w)))


@query("mesh_stats", """SELECT count(*) AS triangles, count(*) FILTER (len * 0.5 <= 1e-9) AS degenerate, count(*) FILTER (ny / len < -1e-6) AS down_facing,
   count(*) FILTER (ny / len > 1e-6) AS up_facing, round(sum(len * 0.5::DOUBLE), 2) AS area_cm2, min(least(a_y, b_y, c_y)) AS y_min_cm,
   max(greatest(a_y, b_y, c_y)) AS y_max_cm, CAST(0 AS BIGINT) AS nan FROM (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS len FROM normals)""",
       GRID, TRI_VIEWS)
def _(w):
    return M.mesh_stats(M.heightfield_mesh(filled(w)))


@query("repair_mesh", """SELECT x, z, t, a_x, a_y, a_z, CASE WHEN ny < 0 THEN c_x ELSE b_x END AS b_x, CASE WHEN ny < 0 THEN c_y ELSE b_y END AS b_y,
  CASE WHEN ny < 0 THEN c_z ELSE b_z END AS b_z, CASE WHEN ny < 0 THEN b_x ELSE c_x END AS c_x, CASE WHEN ny < 0 THEN b_y ELSE c_y END AS c_y,
  CASE WHEN ny < 0 THEN b_z ELSE c_z END AS c_z FROM normals WHERE sqrt(nx * nx + ny * ny + nz * nz) > 1e-9""", GRID, TRI_VIEWS)
def _(w):
    return flat_points(M.repair_mesh(M.heightfield_mesh(filled(w))))


VERTS = ("verts", """SELECT x, y, z, sum(nx) AS nx, sum(ny) AS ny, sum(nz) AS nz FROM (
   SELECT a_x AS x, a_y AS y, a_z AS z, nx, ny, nz FROM normals UNION ALL SELECT b_x, b_y, b_z, nx, ny, nz FROM normals
   UNION ALL SELECT c_x, c_y, c_z, nx, ny, nz FROM normals) GROUP BY 1, 2, 3""")


@query("vertex_normals", """SELECT x, y, z, round(nx / sqrt(nx * nx + ny * ny + nz * nz), 6) + 0.0::DOUBLE AS nx,
  round(ny / sqrt(nx * nx + ny * ny + nz * nz), 6) + 0.0::DOUBLE AS ny, round(nz / sqrt(nx * nx + ny * ny + nz * nz), 6) + 0.0::DOUBLE AS nz FROM verts""",
       GRID, TRI_VIEWS + [VERTS])
def _(w):
    v = M.vertex_normals(M.heightfield_mesh(filled(w)))
    return v.select("x", "y", "z", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("nx", "ny", "nz")])


@query("tangent_basis", """SELECT x, z, usable, round(nx, 6) + 0.0::DOUBLE AS nx, round(ny, 6) + 0.0::DOUBLE AS ny, round(nz, 6) AS nz,
   round((1 - nx * nx) / sqrt(1 - nx * nx), 6) AS tx, round(-ny * nx / sqrt(1 - nx * nx), 6) + 0.0::DOUBLE AS ty,
   round(-nz * nx / sqrt(1 - nx * nx), 6) + 0.0::DOUBLE AS tz FROM (
  SELECT x, z, TRUE AS usable, -dx / sqrt(dx * dx + dz * dz + 1.0) AS nx, -dz / sqrt(dx * dx + dz * dz + 1.0) AS ny, 1.0 / sqrt(dx * dx + dz * dz + 1.0) AS nz
  FROM grads)""", GRID, HMV + [("grads", f"SELECT x, z, ({P.grad('height', P.ROW)}) AS dx, ({P.grad('height', P.COL)}) AS dz FROM hm")])
def _(w):
    g = S.height_gradient_normals(filled(w).withColumn("height", F.col("height").cast("double")), step_cm=1.0)
    g = g.withColumn("tx", F.lit(1.0)).withColumn("ty", F.lit(0.0)).withColumn("tz", F.lit(0.0))
    t = M.tangent_basis(g)
    return t.select("x", "z", "usable", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("nx", "ny", "nz", "tx", "ty", "tz")])


@query("winding_sample", """SELECT count(*) AS sampled, count(*) FILTER (ny >= 1e-4) AS front, count(*) FILTER (ny <= -1e-4) AS back,
   count(*) FILTER (abs(ny) < 1e-4) AS degenerate, round(100.0::DOUBLE * count(*) FILTER (ny >= 1e-4) / count(*), 6) AS front_pct,
   100.0 * count(*) FILTER (ny >= 1e-4) / count(*) >= 95 AS ok
  FROM normals""", GRID, TRI_VIEWS)
def _(w):
    return M.winding_sample(M.heightfield_mesh(filled(w)))


@query("strided_mesh", """SELECT x, z, height FROM hm, (SELECT min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM solid)
  WHERE ((x - x0) % 5 = 0 OR x = x1) AND ((z - z0) % 5 = 0 OR z = z1)""", GRID, HMV)
def _(w):
    return M.strided_mesh(filled(w), C.world_bounds(w.solid()), 5).select("x", "z", "height")


@query("liquid_quads", """SELECT x, z, (SELECT count(*) FROM vs v WHERE (v.z, v.x) < (q.z, q.x)) AS v0,
   (SELECT count(*) FROM vs v WHERE (v.z, v.x) < (q.z + 1, q.x)) AS v1, (SELECT count(*) FROM vs v WHERE (v.z, v.x) < (q.z + 1, q.x + 1)) AS v2,
   (SELECT count(*) FROM vs v WHERE (v.z, v.x) < (q.z, q.x + 1)) AS v3 FROM qs q""", SOLID, [LIQUID,
       ("qs", """SELECT a.x, a.z FROM liquid a JOIN liquid b ON b.x = a.x + 1 AND b.z = a.z JOIN liquid c ON c.x = a.x AND c.z = a.z + 1
          JOIN liquid d ON d.x = a.x + 1 AND d.z = a.z + 1"""),
       ("vs", "SELECT x, z FROM qs UNION SELECT x + 1, z FROM qs UNION SELECT x, z + 1 FROM qs UNION SELECT x + 1, z + 1 FROM qs")])
def _(w):
    q = M.liquid_mesh(L.liquid_columns(w.solid()))
    return q.select(F.col("qx").alias("x"), F.col("qz").alias("z"), "v0", "v1", "v2", "v3")


@query("quads_by_family", """SELECT family, CAST(sum(q) AS BIGINT) AS quads, count(*) AS tiles, CAST(sum(q) * 2 AS BIGINT) AS triangles FROM (
   SELECT family, (x - x0) // 32 AS tx, (z - z0) // 32 AS tz, count(*) AS q FROM (
     SELECT t.x, t.z, coalesce(arg_max(s.family, s.y), 'other') AS family FROM terrain t
     LEFT JOIN solid s ON s.x = t.x AND s.z = t.z AND s.y BETWEEN terrain_h - 3 AND terrain_h GROUP BY 1, 2),
    (SELECT min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM solid)
   WHERE (x - x0) % 32 <> 31 AND x < x1 AND (z - z0) % 32 <> 31 AND z < z1 GROUP BY 1, 2, 3) GROUP BY family""",
       GRID, [P.TOPS, P.SPREAD, P.TERRAIN])
def _(w):
    h = O.terrain_height(tops(w)).select("x", "z", F.col("terrain_h").alias("h"))
    return M.quads_by_family(O.surface_asof(h, w.solid()), C.world_bounds(w.solid()), 32)


# --- tiles -------------------------------------------------------------------

@query("overlap_tiles", """SELECT extent_id, i AS tile_no, s AS start, e AS "end", CASE WHEN ce <= cs THEN s ELSE cs END AS core_start,
   CASE WHEN ce <= cs THEN e ELSE ce END AS core_end FROM (
   SELECT *, s + CASE WHEN i > 0 THEN 20 ELSE 0 END AS cs, e - CASE WHEN i < n - 1 THEN 20 ELSE 0 END AS ce FROM (
    SELECT extent_id, width, s::INT AS s, least(s + 128, width)::INT AS e, (row_number() OVER (PARTITION BY extent_id ORDER BY s) - 1)::INT AS i,
     count(*) OVER (PARTITION BY extent_id) AS n FROM (
     SELECT extent_id, width, unnest(range(0, greatest(1, width - 128 + 1), 108)) AS s FROM extents
     UNION ALL SELECT extent_id, width, width - 128 FROM extents WHERE width > 128 AND (width - 128) // 108 * 108 + 128 < width)))""", ["extents"])
def _(w):
    return T.overlap_tiles(w.extents(), "width", 128, 20).select("extent_id", "tile_no", "start", "end", "core_start", "core_end")


@query("blend_weight", """SELECT extent_id, i, round(least(CASE WHEN i >= r THEN 1.0::DOUBLE ELSE 0.5::DOUBLE * (1 - cos(pi() * i / (r - 1))) END,
   CASE WHEN n - 1 - i >= r THEN 1.0::DOUBLE ELSE 0.5::DOUBLE * (1 - cos(pi() * (n - 1 - i) / (r - 1))) END), 6) + 0.0::DOUBLE AS weight
  FROM (SELECT extent_id, least(20, width // 2) AS r, width AS n, unnest(range(width))::INT AS i FROM extents)""", ["extents"])
def _(w):
    e = w.extents().withColumn("i", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    return e.select("extent_id", "i", (F.round(T.blend_weight(F.col("i"), F.col("width"), F.lit(20)), 6) + F.lit(0.0)).alias("weight"))


@query("exact_tiles", """SELECT extent_id, (s // 100)::INT AS tile_no, s::INT AS start, least(s + 100, depth)::INT AS "end"
  FROM (SELECT extent_id, depth, unnest(range(0, depth, 100)) AS s FROM extents)""", ["extents"])
def _(w):
    return T.exact_tiles(w.extents(), "depth", 100).select("extent_id", "tile_no", "start", "end")


@query("axis_split", """SELECT extent_id, i::INT AS no, (i * (width // 7) + least(i, width % 7))::INT AS start,
  ((i + 1) * (width // 7) + least(i + 1, width % 7))::INT AS "end" FROM extents, range(7) r(i)""", ["extents"])
def _(w):
    return T.axis_split(w.extents(), "width", 7).select("extent_id", "no", "start", "end")


def cands(shapes, out):
    return [(out + "_c", f"""SELECT *, greatest((cx * s * 100.0::DOUBLE - w * 100.0::DOUBLE) / (w * 100.0::DOUBLE), (cy * s * 100.0::DOUBLE - h * 100.0::DOUBLE) / (h * 100.0::DOUBLE)) - 0.06::DOUBLE AS rel
      FROM (SELECT *, unnest(range(nx, least(64, nx + slack) + 1))::INT AS cx FROM (
        SELECT *, greatest(2, 64 // greatest(nx, ny) + 1) AS slack FROM (
         SELECT *, greatest(1, ceil(w / s))::INT AS nx, greatest(1, ceil(h / s))::INT AS ny FROM {shapes}, (SELECT unnest({V.SECTION_SIZES}) AS s))
        WHERE nx <= 64 AND ny <= 64)), LATERAL (SELECT unnest(range(ny, least(64, ny + slack) + 1))::INT AS cy)"""),
            (out, f"""SELECT id, b.s AS section, b.cx AS cx, b.cy AS cy, b.cx * b.s + 1 AS size_x, b.cy * b.s + 1 AS size_y, b.cx * b.s * 100.0::DOUBLE - b.w * 100.0::DOUBLE AS err_x,
      b.cy * b.s * 100.0::DOUBLE - b.h * 100.0::DOUBLE AS err_y FROM (SELECT id, arg_min({{'s': s, 'cx': cx, 'cy': cy, 'w': w, 'h': h}},
      (round(greatest(0.0::DOUBLE, rel), 12), greatest(0, cx * cy - 1024), cx * cy, (cx + cy) * s, round(abs(ln(cx / cy)), 12), s, cx, cy)) AS b
      FROM {out}_c GROUP BY id)""")]


SHAPES = ("shapes", "SELECT extent_id AS id, width AS w, depth AS h FROM extents")


@query("grid_candidates", "SELECT id AS extent_id, s AS section, count(*) AS n, CAST(sum(cx) AS BIGINT) AS sx, CAST(sum(cy) AS BIGINT) AS sy FROM best_c GROUP BY 1, 2",
       ["extents"], [SHAPES] + cands("shapes", "best"))
def _(w):
    return T.grid_candidates(w.extents()).groupBy("extent_id", "section").agg(
        C.n_rows(), F.sum("cx").alias("sx"), F.sum("cy").alias("sy"))


BEST = """SELECT id AS extent_id, section, cx, cy, size_x, size_y, err_x, err_y,
  CASE WHEN section IS NULL THEN 'needs more than 64 sections on an axis' END AS reason FROM shapes LEFT JOIN best USING (id)"""


@query("candidate_rank", "SELECT id AS extent_id, section, cx, cy FROM best", ["extents"], [SHAPES] + cands("shapes", "best"))
def _(w):
    ranked = T.candidate_rank(T.grid_candidates(w.extents()), ["extent_id", "width", "depth"][0])
    return ranked.select("extent_id", "section", "cx", "cy")


@query("plan_tile_components", BEST, ["extents"], [SHAPES] + cands("shapes", "best"))
def _(w):
    return T.plan_tile_components(w.extents()).drop("width", "depth")


SMALL = """SELECT id, arg_min(s, (round(greatest(0.0::DOUBLE, greatest((cx * s * 100.0::DOUBLE - w * 100.0::DOUBLE) / (w * 100.0::DOUBLE), (cy * s * 100.0::DOUBLE - h * 100.0::DOUBLE) / (h * 100.0::DOUBLE)) - 0.06::DOUBLE), 12),
   greatest(0, cx * cy - 1024), cx * cy, (cx + cy) * s)) AS section FROM (
   SELECT *, greatest(1, ceil(w / s))::INT AS cx, greatest(1, ceil(h / s))::INT AS cy FROM {}, (SELECT unnest([7, 15, 31, 63, 127]) AS s))
  WHERE cx <= 64 AND cy <= 64 GROUP BY id"""


@query("plan_tile_grid", """SELECT extent_id, coalesce(min(n) FILTER (ok AND n >= lo), max(n) FILTER (ok AND n < lo), 1)::INT AS tiles FROM (
   SELECT extent_id, n, any_value(lo) AS lo, min(t.section) >= any_value(CASE b.section WHEN 7 THEN 7 WHEN 15 THEN 7 WHEN 31 THEN 15 WHEN 63 THEN 31 ELSE 63 END) AS ok
   FROM split s JOIN tiled t ON t.id = s.id JOIN base b ON b.id = s.extent_id GROUP BY extent_id, n) GROUP BY extent_id""", ["extents"], [
    SHAPES, ("base", SMALL.format("shapes")),
    ("split", """SELECT extent_id, n, lo, w, h, concat_ws('/', extent_id, n, w, h) AS id FROM (
      SELECT DISTINCT extent_id, n, lo, CASE a WHEN 0 THEN floor(width / n) ELSE ceil(width / n) END::INT AS w,
       CASE b WHEN 0 THEN floor(depth / n) ELSE ceil(depth / n) END::INT AS h FROM (
       SELECT *, unnest(range(1, greatest(lo, 8) + 1)) AS n FROM (SELECT *, greatest(ceil(width / 256), ceil(depth / 256))::INT AS lo FROM extents)),
       range(2) x(a), range(2) y(b))"""),
    ("tiled", SMALL.format("split"))])
def _(w):
    return T.plan_tile_grid(w.extents(), 256).select("extent_id", "tiles")


SPAN = ("span", "SELECT min(height)::DOUBLE AS lo, (max(height) - min(height))::DOUBLE AS sp FROM hm")
ENC = "CAST(least(greatest(round_even((height - lo) / sp * 65535.0::DOUBLE, 0), 0), 65535) AS INT)"
DEC = "(lo * 100 + (sp * 100.0::DOUBLE / 512) * 256 + ({v} - 32768.0::DOUBLE) / 128.0::DOUBLE * (sp * 100.0::DOUBLE / 512))"


def span(h, value="height"):
    one = h.agg(F.min(value).cast("double").alias("lo"), (F.max(value) - F.min(value)).cast("double").alias("sp"))
    return one.select("lo").scalar(), one.select("sp").scalar()


@query("encode_height", f"SELECT x, z, {ENC} AS v FROM hm, span", GRID, HMV + [SPAN])
def _(w):
    h = filled(w)
    return h.select("x", "z", T.encode_height(F.col("height"), *span(h)).alias("v"))


@query("decode_height", f"""SELECT x, z, round(cm, 6) AS cm, round(abs(cm / 100 - height), 6) < 0.001 AS close FROM (
  SELECT x, z, height, {DEC.format(v=ENC)} AS cm FROM hm, span)""", GRID, HMV + [SPAN])
def _(w):
    h = filled(w)
    lo, sp = span(h)
    cm = T.decode_height(T.encode_height(F.col("height"), lo, sp), T.z_scale_cm(sp), T.z_offset_cm(lo, sp))
    return h.withColumn("cm", cm).select("x", "z", F.round("cm", 6).alias("cm"),
                                         (F.abs(F.col("cm") / 100 - F.col("height")) < 0.001).alias("close"))


@query("normalize_u16", "SELECT x, z, CAST(floor(least(greatest((height - lo) / sp * 65535.0::DOUBLE, 0), 65535)) AS INT) AS v FROM hm, span", GRID, HMV + [SPAN])
def _(w):
    h = filled(w)
    lo, sp = span(h)
    return h.select("x", "z", T.normalize_u16(F.col("height"), lo, lo + sp).alias("v"))


TILES = [("ext", "SELECT min(x) AS bx, min(z) AS bz, max(x) - min(x) + 1 AS bw, max(z) - min(z) + 1 AS bd FROM solid"),
         ("rects", """SELECT printf('%02d_%02d', zi, xi) AS id, zi::INT AS zno, xi::INT AS xno, (bx + xi * (bw // 3) + least(xi, bw % 3))::INT AS x0,
    (bz + zi * (bd // 2) + least(zi, bd % 2))::INT AS z0, (bw // 3 + CASE WHEN xi < bw % 3 THEN 1 ELSE 0 END)::INT AS w,
    (bd // 2 + CASE WHEN zi < bd % 2 THEN 1 ELSE 0 END)::INT AS h FROM ext, range(3) a(xi), range(2) b(zi)""")] + cands("rects", "fit") + [
    ("tiles", "SELECT id AS tile, zno, xno, x0, z0, w AS width, h AS depth, section, cx, cy, size_x, size_y, err_x, err_y FROM rects JOIN fit USING (id)"),
    ("samples", f"""SELECT tile, row::INT AS row, col::INT AS col, x0, z0, size_x, size_y, lo, sp, {ENC} AS v FROM (
      SELECT *, x0 + least(greatest(round_even(col * (width::DOUBLE / size_x), 0), 0), width - 1)::INT AS sx,
       z0 + least(greatest(round_even(row * (depth::DOUBLE / size_y), 0), 0), depth - 1)::INT AS sz
      FROM (SELECT *, unnest(range(size_x)) AS col FROM tiles), LATERAL (SELECT unnest(range(size_y)) AS row))
     JOIN hm ON hm.x = sx AND hm.z = sz, span""")]
TILE_VIEWS = HMV + [SPAN] + TILES


def exported(w):
    h = filled(w)
    lo, sp = span(h)
    return (*T.export_tiles(h, C.world_bounds(w.solid()), 3, 2, lo, sp), lo, sp)


@query("resample_to_grid", "SELECT tile, row, col, v FROM samples", GRID, TILE_VIEWS)
def _(w):
    return exported(w)[1].select("tile", "row", "col", "v")


@query("export_tiles", """SELECT t.*, n, lo_v, hi_v, total FROM tiles t JOIN (SELECT tile, count(*) AS n, min(v) AS lo_v, max(v) AS hi_v,
  CAST(sum(v) AS BIGINT) AS total FROM samples GROUP BY tile) s ON s.tile = t.tile""", GRID, TILE_VIEWS)
def _(w):
    tiles, samples, _, _ = exported(w)
    per = samples.groupBy("tile").agg(C.n_rows(), F.min("v").alias("lo_v"), F.max("v").alias("hi_v"), F.sum("v").alias("total"))
    return tiles.join(per, "tile")


@query("tile_totals", """SELECT count(*) AS tiles, CAST(sum(cx) AS BIGINT) AS sum_cx, CAST(sum(cy) AS BIGINT) AS sum_cy, CAST(sum(cx * cy) AS BIGINT) AS components,
  max(err_x) AS max_err_x, max(err_y) AS max_err_y FROM tiles""", GRID, TILES)
def _(w):
    return T.tile_totals(T.world_tiles(C.world_bounds(w.solid()), 3, 2))


@query("mosaic_tiles", f"""SELECT CAST(x0 * 100 + col * 100 AS INT) AS key_x, CAST(z0 * 100 + row * 100 AS INT) AS key_y,
  round(arg_max({DEC.format(v='v')}, tile), 6) AS z_cm FROM samples GROUP BY 1, 2""", GRID, TILE_VIEWS)
def _(w):
    tiles, samples, lo, sp = exported(w)
    return T.mosaic_tiles(tiles, samples, T.z_scale_cm(sp), T.z_offset_cm(lo, sp)).select("key_x", "key_y", *r6("z_cm"))


@query("tile_partition_check", "SELECT tile, TRUE AS ok FROM tiles", GRID, TILES)
def _(w):
    bounds = C.world_bounds(w.solid())
    return T.tile_partition_check(T.world_tiles(bounds, 3, 2), bounds)


@query("height_range_check", f"""SELECT tile, round(min(y), 6) AS lo, round(max(y), 6) AS hi, TRUE AS ok FROM (
   SELECT tile, {DEC.format(v='v')} / 100 AS y FROM samples)
  GROUP BY tile""", GRID, TILE_VIEWS)
def _(w):
    tiles, samples, lo, sp = exported(w)
    return T.height_range_check(tiles, samples, lo, sp, T.z_scale_cm(sp), T.z_offset_cm(lo, sp))


@query("upsample_grid", """SELECT u, v, round((h00 * (1 - fx) + h10 * fx) * (1 - fz) + (h01 * (1 - fx) + h11 * fx) * fz, 6) AS h FROM (
   SELECT u::INT AS u, v::INT AS v, u * (bw - 1) / (2 * bw - 1.0::DOUBLE) - i AS fx, v * (bd - 1) / (2 * bd - 1.0::DOUBLE) - j AS fz,
    a.height::DOUBLE AS h00, b.height::DOUBLE AS h10, c.height::DOUBLE AS h01, d.height::DOUBLE AS h11 FROM (
    SELECT *, (u * (bw - 1)) // (2 * bw - 1) AS i, (v * (bd - 1)) // (2 * bd - 1) AS j FROM (
     SELECT *, unnest(range(2 * bw)) AS u FROM ext), LATERAL (SELECT unnest(range(2 * bd)) AS v))
   JOIN hm a ON a.x = bx + i AND a.z = bz + j JOIN hm b ON b.x = bx + least(i + 1, bw - 1) AND b.z = bz + j
   JOIN hm c ON c.x = bx + i AND c.z = bz + least(j + 1, bd - 1) JOIN hm d ON d.x = bx + least(i + 1, bw - 1) AND d.z = bz + least(j + 1, bd - 1))""",
       GRID, HMV + TILES[:1])
def _(w):
    return T.upsample_grid(filled(w), C.world_bounds(w.solid()), 2).select("u", "v", *r6("h"))


STRETCH = ("stretch", "SELECT x, z, least(greatest((smooth - lo) / (hi - lo), 0), 1) * 5 AS pos FROM flatted, "
           "(SELECT quantile_cont(smooth, 0.01) AS lo, quantile_cont(smooth, 0.995) AS hi FROM flatted)")


def ramp_sql(ch):
    stops = "[" + ", ".join(f"{s[ch]}::DOUBLE" for s in T.RAMP) + "]"
    i = "CAST(least(floor(pos), 4) AS INT)"
    lo, hi = f"list_extract({stops}, {i} + 1)", f"list_extract({stops}, {i} + 2)"
    return f"CAST(floor(round(({lo} + ({hi} - {lo}) * (pos - {i})) * 255, 9)) AS INT)"


@query("hypsometric_colour", f"SELECT x, z, {ramp_sql(0)} AS r, {ramp_sql(1)} AS g, {ramp_sql(2)} AS b FROM stretch", GRID, FLAT + [STRETCH])
def _(w):
    h = cut_lineage(S.flat_restore_smooth(filled(w)).select("x", "z", "smooth"))
    ends = sorted_counts(h.select("smooth"), "smooth").agg(
        percentile_of("smooth", 0.01).alias("lo"), percentile_of("smooth", 0.995).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    t = h.withColumn("t", (F.col("smooth") - lo) / (hi - lo))
    return t.select("x", "z", *[T.ramp_colour(F.col("t"), i).alias(c) for i, c in enumerate("rgb")])
