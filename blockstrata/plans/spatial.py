"""Queries over neighbours, columns, grids, components and objects."""

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import census as C
from ..operators import columns as L
from ..operators import components as K
from ..operators import neighbors as N
from ..operators import objects as O
from ..operators import stencils as S
from ..operators.nearest import nearest_points, nearest_valid
from ..operators.ranking import global_row_number
from ..fixture_bytes import scratch
from ..session import cut_lineage
from ..sources.text import write_grids
from . import rule_sql as R
from . import sql_parts as P
from .registry import query
from .tables import BUILT, TOP, built_density

SOLID = ["solid"]
GRID = ["solid", "grid"]


def r6(*cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


def surface_grid(w):
    """Ground surface on the full grid; cells without ground are null."""
    solid = w.stored_solid()
    return L.on_full_grid(L.surface_columns(solid), C.world_bounds(solid))


def filled(w):
    """The surface with holes filled, as a stored table."""
    return cut_lineage(nearest_valid(surface_grid(w)))


def tops(w):
    solid = w.stored_solid()
    return O.column_tops(solid, L.full_grid(C.world_bounds(solid)))


# --- neighbours --------------------------------------------------------------

@query("face_neighbors", """SELECT a.x, a.y, a.z, axis FROM solid a,
   (SELECT 'x' AS axis, 1 AS dx, 0 AS dy, 0 AS dz UNION ALL SELECT 'y', 0, 1, 0 UNION ALL SELECT 'z', 0, 0, 1) s
  SEMI JOIN solid b ON b.x = a.x + dx AND b.y = a.y + dy AND b.z = a.z + dz""", SOLID)
def _(w):
    return N.face_neighbors(w.solid())


OCC = ("occ", """SELECT a.x, a.y, a.z, count(b.x) AS occupied FROM solid a,
   (SELECT * FROM (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) AS t(dx,dy,dz)) s
  LEFT JOIN solid b ON b.x = a.x + dx AND b.y = a.y + dy AND b.z = a.z + dz GROUP BY 1, 2, 3""")


@query("six_neighbor_occupancy", "SELECT x, y, z, CAST(occupied AS INT) AS occupied FROM occ", SOLID, [OCC])
def _(w):
    return N.six_neighbor_occupancy(w.solid())


@query("exposed_faces", """SELECT count(*) AS solid, CAST(sum(6 - occupied) AS BIGINT) AS faces,
  CAST(sum(6 - occupied) * 2 AS BIGINT) AS triangles, count(*) * 6 AS naive_faces, count(*) * 12 AS naive_triangles FROM occ""",
       SOLID, [OCC])
def _(w):
    return N.exposed_faces(w.solid())


@query("enclosed_filter", "SELECT s.x, s.y, s.z, s.name FROM solid s JOIN occ USING (x, y, z) WHERE occupied < 6", SOLID, [OCC])
def _(w):
    return N.enclosed_filter(w.solid()).select("x", "y", "z", "name")


@query("neighborhood_range", "SELECT x, z, top, spread, edge FROM spreads", GRID, [P.TOPS, P.SPREAD])
def _(w):
    return N.neighborhood_range(tops(w)).select("x", "z", "top", "spread", "edge")


@query("flatness", "SELECT x, z, top_role = 'structure' AND spread <= 1 AS flat FROM spreads", GRID, [P.TOPS, P.SPREAD])
def _(w):
    return O.flatness(tops(w)).select("x", "z", "flat")


@query("terrain_height", "SELECT x, z, top, terrain_top, terrain_h FROM terrain", GRID, [P.TOPS, P.SPREAD, P.TERRAIN])
def _(w):
    return O.terrain_height(tops(w)).select("x", "z", "top", "terrain_top", "terrain_h")


# --- columns -----------------------------------------------------------------

@query("top_voxel_per_column", "SELECT x, z, y, name, family FROM top", SOLID, [TOP])
def _(w):
    return L.top_voxel_per_column(w.solid()).select("x", "z", "y", "name", "family")


@query("surface_columns", """SELECT g.x, g.z, height, label, height IS NOT NULL AS valid FROM grid g
  LEFT JOIN surface USING (x, z)""", GRID, [P.SURFACE])
def _(w):
    return surface_grid(w).withColumn("valid", F.col("height").isNotNull())


@query("surface_predicate", f"""SELECT a.x, a.z, a.height AS any_ground, b.height AS terrain_only FROM surface a LEFT JOIN
  (SELECT x, z, max(y) + 1 AS height FROM solid WHERE label IN ({R.quoted(V.TERRAIN_LABELS)}) GROUP BY x, z) b USING (x, z)""",
       SOLID, [P.SURFACE])
def _(w):
    a = L.surface_columns(w.solid()).select("x", "z", F.col("height").alias("any_ground"))
    b = L.surface_columns(w.solid(), V.TERRAIN_LABELS).select("x", "z", F.col("height").alias("terrain_only"))
    return a.join(b, ["x", "z"], "left")


LIQUID = ("liquid", """SELECT x, z, max(y) + 1 AS height, arg_max(label, y) = 'LAVA' AS is_lava FROM solid
  WHERE label IN ('WATER', 'LAVA') GROUP BY x, z""")


@query("liquid_columns", "SELECT * FROM liquid", SOLID, [LIQUID])
def _(w):
    return L.liquid_columns(w.solid())


@query("sea_level", """SELECT CAST(sum(k) AS BIGINT) AS columns, round(arg_min(lo + bin * step, (-k, bin)), 6) AS sea_level_blocks,
   round(arg_min(lo + bin * step, (-k, bin)) * 100, 6) AS sea_level_cm, min(mn) AS min_blocks, max(mx) AS max_blocks,
   round(CAST(sum(total) AS BIGINT) / CAST(sum(k) AS BIGINT) * 100.0::DOUBLE, 6) AS mean_cm, count(*) > 0 AS has_water
  FROM (SELECT bin, lo, step, count(*) AS k, min(height) AS mn, max(height) AS mx, sum(height) AS total
   FROM (SELECT height, lo, (hi - lo) / 64.0::DOUBLE AS step, least(floor((height - lo) / ((hi - lo) / 64.0::DOUBLE)), 63) AS bin
    FROM liquid, (SELECT min(height)::DOUBLE AS lo, max(height)::DOUBLE AS hi FROM liquid)) GROUP BY 1, 2, 3)""",
       SOLID, [LIQUID])
def _(w):
    return L.sea_level(L.liquid_columns(w.solid()))


@query("write_grids", "SELECT x, z, top, top_role, terrain_h, spread <= 1 AND top_role = 'structure' AS flat FROM terrain",
       GRID, [P.TOPS, P.SPREAD, P.TERRAIN])
def _(w):
    folder = scratch(w.spark, "grids")
    write_grids(O.terrain_height(tops(w)).select("x", "z", "top", "top_role", "terrain_h", "flat"), folder)
    return w.spark.read.parquet(folder).select("x", "z", "top", "top_role", "terrain_h", "flat")


# --- nearest, smoothing ------------------------------------------------------

@query("nearest_valid", "SELECT x, z, height, valid FROM hm", GRID, [P.SURFACE, P.HM])
def _(w):
    return nearest_valid(surface_grid(w))


@query("hole_fill", """SELECT x, z, height FROM hm WHERE NOT valid""", GRID, [P.SURFACE, P.HM])
def _(w):
    return nearest_valid(surface_grid(w)).filter("NOT valid").select("x", "z", "height")


HMV = [P.SURFACE, P.HM]


@query("gaussian_smooth", "SELECT x, z, round(smooth, 6) AS smooth FROM g", GRID, HMV + P.gauss("hm", "height", 1.4, "g"))
def _(w):
    return S.gaussian_smooth(filled(w), 1.4).select("x", "z", *r6("smooth"))


@query("perona_malik", "SELECT x, z, round(diffused, 6) AS diffused FROM d", GRID, HMV + P.diffusion("hm", "height", 1.4, "d"))
def _(w):
    return S.perona_malik(filled(w), 1.4).select("x", "z", *r6("diffused"))


@query("edge_preserving_smooth", "SELECT x, z, round((1.0::DOUBLE - 0.6::DOUBLE) * smooth + 0.6::DOUBLE * diffused, 6) AS smooth FROM d",
       GRID, HMV + P.gauss("hm", "height", 1.4, "g") + P.diffusion("g", "height", 1.4, "d"))
def _(w):
    return S.edge_preserving_smooth(filled(w)).select("x", "z", *r6("smooth"))


@query("destair", """SELECT x, z, round(s2 * k + m * (1.0::DOUBLE - k), 5) AS smooth FROM g2, (SELECT avg(s2) AS m FROM g2),
  (SELECT 0.65::DOUBLE * avg(CASE WHEN valid THEN 1.0::DOUBLE ELSE 0 END) + 0.35::DOUBLE AS k FROM hm)""",
       GRID, HMV + P.gauss("hm", "height", 2.0, "g1", "s1") + P.gauss("g1", "s1", 0.6, "g2", "s2"))
def _(w):
    return S.destair(filled(w)).select("x", "z", F.round("smooth", 5).alias("smooth"))


FLAT = HMV + P.gauss("hm", "height", 0.9, "g") + [
    ("f1", f"""SELECT *, max(height) OVER ({P.ROW} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS hi1,
      min(height) OVER ({P.ROW} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS lo1 FROM g"""),
    ("f2", f"""SELECT *, max(hi1) OVER ({P.COL} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS hi2,
      min(lo1) OVER ({P.COL} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS lo2 FROM f1"""),
    ("flatted", """SELECT x, z, height, CASE WHEN hi2 - lo2 <= 1 THEN height * 0.85::DOUBLE + smooth * (1.0::DOUBLE - 0.85::DOUBLE)
      ELSE smooth END AS smooth FROM f2""")]


@query("flat_restore_smooth", "SELECT x, z, round(smooth, 6) AS smooth FROM flatted", GRID, FLAT)
def _(w):
    return S.flat_restore_smooth(filled(w)).select("x", "z", *r6("smooth"))


@query("smoothing_error", """SELECT round(avg(d), 6) AS mean_abs, round(quantile_cont(d, 0.95), 6) AS p95_abs,
  round(max(d), 6) AS max_abs, count(*) FILTER (d > 1) AS moved, round(100.0::DOUBLE * avg(CASE WHEN d > 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS moved_pct
  FROM (SELECT abs(smooth - height) AS d FROM flatted)""", GRID, FLAT)
def _(w):
    return S.smoothing_error(S.flat_restore_smooth(filled(w)))


@query("height_gradient_normals", """SELECT x, z, round(-dx / sqrt(dx * dx + dz * dz + 1.0), 6) + 0.0::DOUBLE AS nx,
   round(-dz / sqrt(dx * dx + dz * dz + 1.0), 6) + 0.0::DOUBLE AS ny, round(1.0 / sqrt(dx * dx + dz * dz + 1.0), 6) AS nz,
   round(1.0 / sqrt(dx * dx + 1.0), 6) AS tx, round(-dx / sqrt(dx * dx + 1.0), 6) + 0.0::DOUBLE AS tz FROM grads""", GRID,
       HMV + [("grads", f"SELECT x, z, ({P.grad('height', P.ROW)}) / 100.0::DOUBLE AS dx, ({P.grad('height', P.COL)}) / 100.0::DOUBLE AS dz FROM hm")])
def _(w):
    g = S.height_gradient_normals(filled(w).withColumn("height", F.col("height").cast("double")))
    return g.select("x", "z", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("nx", "ny", "nz", "tx", "tz")])


# --- components --------------------------------------------------------------

OBJ = ("obj", f"SELECT x, y, z, label FROM solid WHERE label IN ({P.OBJECTS})")
OBJ_COMP = [OBJ] + P.components("obj", "comp", K.FACES_3D, "oc")


@query("connected_components", "SELECT x, y, z, label, component FROM obj JOIN comp USING (x, y, z)", SOLID, OBJ_COMP)
def _(w):
    return O.object_components(w.solid()).select("x", "y", "z", "label", "component")


@query("components_pitch", "SELECT s.x, s.y, s.z, component FROM obj s JOIN comp2 c ON c.x = floor(s.x / 2) AND c.y = floor(s.y / 2) "
       "AND c.z = floor(s.z / 2)", SOLID,
       [OBJ, ("bed", "SELECT DISTINCT CAST(floor(x / 2) AS INT) AS x, CAST(floor(y / 2) AS INT) AS y, CAST(floor(z / 2) AS INT) AS z "
         "FROM obj")] + P.components("bed", "comp2", K.FACES_3D, "pc"))
def _(w):
    return O.object_components(w.solid(), pitch=2).select("x", "y", "z", "component")


PLANTS = [("plants", "SELECT x, y, z FROM solid WHERE role = 'vegetation'")] + P.components("plants", "trees", K.HALF_26, "tc")


@query("components_26", "SELECT * FROM trees", SOLID, PLANTS)
def _(w):
    return K.connected_components(w.solid().filter("role = 'vegetation'"), K.HALF_26)


SUMMARY = """SELECT component, count(*) AS blocks, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y,
  min(z) AS min_z, max(z) AS max_z, round(avg(x), 6) AS mean_x, round(avg(y), 6) AS mean_y, round(avg(z), 6) AS mean_z,
  CAST(floor((min(x) + max(x)) / 2) AS INT) AS centre_x, CAST(floor((min(y) + max(y)) / 2) AS INT) AS centre_y,
  CAST(floor((min(z) + max(z)) / 2) AS INT) AS centre_z FROM {} GROUP BY component HAVING count(*) >= {}"""


@query("segment_trees", SUMMARY.format("trees", 5), SOLID, PLANTS)
def _(w):
    return O.segment_trees(w.solid(), min_blocks=5)


SEED = [TOP, BUILT, ("seed", "SELECT cell_x AS x, 0 AS y, cell_z AS z FROM density WHERE fraction >= 0.6")] \
    + P.components("seed", "regions", K.FACES_2D, "rc")


@query("components_2d", "SELECT x AS cell_x, z AS cell_z, component FROM regions", SOLID, SEED)
def _(w):
    return K.components_2d(built_density(w).filter("fraction >= 0.6"))


@query("find_built_region", """SELECT min(x) * 8 AS x0, (max(x) + 1) * 8 AS x1, min(z) * 8 AS z0, (max(z) + 1) * 8 AS z1, count(*) AS cells,
   any_value(b.x0) + min(x) * 8 AS world_x0, any_value(b.x0) + (max(x) + 1) * 8 - 1 AS world_x1,
   any_value(b.z0) + min(z) * 8 AS world_z0, any_value(b.z0) + (max(z) + 1) * 8 - 1 AS world_z1,
   round(count(*) / any_value(floor((b.x1 - b.x0 + 1) / 8) * floor((b.z1 - b.z0 + 1) / 8)), 6) AS built_fraction
  FROM regions, (SELECT min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM solid) b
  WHERE component IN (SELECT component FROM regions GROUP BY component HAVING count(*) >= 2)""",
       SOLID, SEED)
def _(w):
    return K.find_built_region(built_density(w), C.world_bounds(w.stored_solid()), cell=8, threshold=0.6, min_cells=2)


# --- objects -----------------------------------------------------------------

COMPOSED = ("composed", """SELECT component, count(*) AS voxels, count(*) FILTER (label = 'VEGETATION') / count(*) AS veg,
   count(*) FILTER (label = 'STRUCTURE') / count(*) AS struct, count(*) FILTER (label = 'GLASS') / count(*) AS glass,
   count(*) FILTER (label = 'PROP') / count(*) AS prop, max(y) - min(y) + 1 AS height, min(y) AS min_y,
   CAST(max(x) - min(x) + 1 AS BIGINT) * (max(z) - min(z) + 1) AS footprint, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz,
   CAST(count(*) * sum(x::BIGINT * x) - sum(x) * sum(x) AS DOUBLE) AS sxx, CAST(count(*) * sum(z::BIGINT * z) - sum(z) * sum(z) AS DOUBLE) AS szz,
   CAST(count(*) * sum(x::BIGINT * z) - sum(x) * sum(z) AS DOUBLE) AS sxz FROM obj JOIN comp USING (x, y, z) GROUP BY component""")
CLASSED = ("classed", """SELECT *, CASE WHEN veg > 0.55 THEN CASE WHEN height >= 4 THEN 'tree' ELSE 'plant' END
   WHEN struct > 0.5 THEN CASE WHEN footprint >= 25 AND height >= 3 THEN 'building' ELSE 'structure' END
   WHEN veg > 0.2 THEN CASE WHEN height >= 4 THEN 'tree' ELSE 'plant' END ELSE 'prop' END AS class,
  CASE WHEN voxels < 4 OR (sxz = 0 AND sxx = szz) THEN 0.0::DOUBLE ELSE round(CASE WHEN degrees(0.5 * atan2(2 * sxz, szz - sxx)) <= -90
    THEN degrees(0.5 * atan2(2 * sxz, szz - sxx)) + 180 ELSE degrees(0.5 * atan2(2 * sxz, szz - sxx)) END, 2) END AS yaw_deg FROM composed""")
CLASS_VIEWS = OBJ_COMP + [COMPOSED, CLASSED]


def composition(w):
    return O.component_composition(O.object_components(w.solid()))


@query("component_composition", """SELECT component, voxels, round(veg, 3) AS veg, round(struct, 3) AS struct, round(glass, 3) AS glass,
  round(prop, 3) AS prop, height, footprint, class FROM classed""", SOLID, CLASS_VIEWS)
def _(w):
    return composition(w).select("component", "voxels", *[F.round(c, 3).alias(c) for c in ("veg", "struct", "glass", "prop")],
                                 "height", F.col("footprint").cast("bigint"), "class")


@query("object_class", "SELECT class, count(*) AS n, CAST(sum(voxels) AS BIGINT) AS voxels FROM classed GROUP BY class", SOLID, CLASS_VIEWS)
def _(w):
    return composition(w).groupBy("class").agg(C.n_rows(), F.sum("voxels").alias("voxels"))


@query("principal_yaw", "SELECT component, yaw_deg + 0.0::DOUBLE AS yaw_deg FROM classed", SOLID, CLASS_VIEWS)
def _(w):
    return composition(w).select("component", (F.col("yaw_deg") + F.lit(0.0)).alias("yaw_deg"))


@query("component_drop_stats", """SELECT count(*) AS components_seen, count(*) FILTER (voxels < 6) AS dropped_small,
  count(*) FILTER (voxels > 15) AS dropped_large, CAST(coalesce(sum(voxels) FILTER (voxels > 15), 0) AS BIGINT) AS dropped_large_voxels
  FROM classed""", SOLID, CLASS_VIEWS)
def _(w):
    return O.component_drop_stats(composition(w), 6, 15)


@query("largest_first_limit", "SELECT component, voxels, class FROM classed ORDER BY voxels DESC, component LIMIT 25", SOLID, CLASS_VIEWS)
def _(w):
    return composition(w).orderBy(F.desc("voxels"), "component").limit(25).select("component", "voxels", "class")


@query("components_by_rank", "SELECT component, voxels, row_number() OVER (ORDER BY voxels DESC, component) - 1 AS id FROM classed",
       SOLID, CLASS_VIEWS)
def _(w):
    ranked = global_row_number(composition(w).withColumn("_k", -F.col("voxels")), ["_k", "component"])
    return ranked.select("component", "voxels", "id")


@query("object_summary", SUMMARY.format("comp", 6), SOLID, OBJ_COMP)
def _(w):
    return O.object_summary(O.object_components(w.solid()), 6)


@query("fill_ratio", """SELECT component, count(*) AS blocks, round(count(*) / ((max(x) - min(x) + 1) * (max(y) - min(y) + 1)
  * (max(z) - min(z) + 1)), 6) AS fill FROM comp GROUP BY component""", SOLID, OBJ_COMP)
def _(w):
    return O.fill_ratio(O.object_components(w.solid()))


BIG = ("big", "SELECT * FROM classed WHERE voxels >= 6")
PLANE = [("patch", """SELECT component, cx, cz, h.x - CAST(trunc(cx) AS INT) AS dx, h.z - CAST(trunc(cz) AS INT) AS dz, h.height::DOUBLE AS h
   FROM big JOIN hm h ON h.x BETWEEN CAST(trunc(cx) AS INT) - 6 AND CAST(trunc(cx) AS INT) + 6
    AND h.z BETWEEN CAST(trunc(cz) AS INT) - 6 AND CAST(trunc(cz) AS INT) + 6"""),
         ("plane", """SELECT component, regr_slope(h, dx) AS unused,
   (sxh * vzz - szh * vxz) / (vxx * vzz - vxz * vxz) AS slope_x, (szh * vxx - sxh * vxz) / (vxx * vzz - vxz * vxz) AS slope_z, mh, mx, mz
  FROM (SELECT component, avg(h) AS mh, avg(dx) AS mx, avg(dz) AS mz, var_pop(dx) AS vxx, var_pop(dz) AS vzz, covar_pop(dx, dz) AS vxz,
    covar_pop(dx, h) AS sxh, covar_pop(dz, h) AS szh, any_value(h) AS h, any_value(dx) AS dx FROM patch GROUP BY component)
  GROUP BY ALL""")]
POSED = ("posed", """SELECT component, slope_x, slope_z, mh - slope_x * mx - slope_z * mz AS ground_y,
   -slope_x / sqrt(slope_x * slope_x + slope_z * slope_z + 1) AS nx, 1 / sqrt(slope_x * slope_x + slope_z * slope_z + 1) AS ny,
   -slope_z / sqrt(slope_x * slope_x + slope_z * slope_z + 1) AS nz FROM plane""")
PLANE_VIEWS = CLASS_VIEWS + HMV + [BIG] + PLANE + [POSED]


ALL = ("big", "SELECT *, voxels >= 6 AS kept FROM classed")


def centred(w):
    """All objects with their centre, and whether they are large enough to be placed."""
    return composition(w).withColumns({"kept": F.col("voxels") >= 6, "cx": F.col("sum_x") / F.col("voxels"), "cz": F.col("sum_z") / F.col("voxels")})


@query("patch_join", "SELECT component, kept, count(*) AS cells, CAST(sum(h) AS BIGINT) AS total FROM patch JOIN big USING (component) GROUP BY ALL",
       GRID, CLASS_VIEWS + HMV + [ALL] + PLANE[:1])
def _(w):
    objects = cut_lineage(centred(w))
    patch = O.patch_join(objects, filled(w)).groupBy("component").agg(C.n_rows("cells"), F.sum("h").cast("bigint").alias("total"))
    return patch.join(objects.select("component", "kept"), "component")


@query("ground_plane", """SELECT component, kept, round(slope_x, 6) + 0.0::DOUBLE AS slope_x, round(slope_z, 6) + 0.0::DOUBLE AS slope_z,
  round(ground_y, 6) AS ground_y, round(ny, 6) AS normal_y, round(-ny, 6) AS normal_down FROM posed JOIN big USING (component)""", GRID,
       CLASS_VIEWS + HMV + [ALL] + PLANE + [POSED])
def _(w):
    objects = cut_lineage(centred(w))
    g = O.ground_plane(objects, filled(w)).join(objects.select("component", "kept"), "component")
    return g.select("component", "kept", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in
                                           ("slope_x", "slope_z", "ground_y", "normal_y", "normal_down")])


INSTANCES = """SELECT component, class, voxels, round(cx, 6) AS cx, round(cy, 6) AS cy, round(cz, 6) AS cz, yaw_deg + 0.0::DOUBLE AS yaw_deg,
  round(ground_y, 6) AS ground_y, round(degrees(atan2(-nz, ny)), 4) + 0.0::DOUBLE AS tilt_x,
  round(degrees(atan2(nx, ny)), 4) + 0.0::DOUBLE AS tilt_z FROM big JOIN posed USING (component)"""


def instances(w):
    solid = w.stored_solid()
    ground = nearest_valid(L.on_full_grid(L.surface_columns(solid), C.world_bounds(solid)))
    return O.extract_instances(solid, cut_lineage(ground), 6)


@query("extract_instances", INSTANCES, GRID, PLANE_VIEWS)
def _(w):
    return instances(w).select("component", "class", "voxels", *r6("cx", "cy", "cz"), (F.col("yaw_deg") + F.lit(0.0)).alias("yaw_deg"),
                               *r6("ground_y"), *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("tilt_x", "tilt_z")])


@query("pose_from_normal", """SELECT component, round(degrees(atan2(-nz, ny)), 4) + 0.0::DOUBLE AS tilt_x,
  round(degrees(atan2(nx, ny)), 4) + 0.0::DOUBLE AS tilt_z FROM posed""", GRID, PLANE_VIEWS)
def _(w):
    return instances(w).select("component", *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("tilt_x", "tilt_z")])


RECIPE = ("recipe", f"""SELECT component, class, {R.lookup('class', {k: v[0] for k, v in V.RECIPES.items()})} AS primitive,
  greatest(height, 1) * 100.0::DOUBLE AS height_cm, sqrt(greatest(footprint, 1)) * 100.0::DOUBLE * 0.75::DOUBLE AS radius_cm FROM classed""")


@query("model_recipe", """SELECT component, class, primitive, height_cm, round(radius_cm, 6) AS radius_cm,
  'builtin:' || class || ':' || primitive AS asset FROM recipe""", SOLID, CLASS_VIEWS + [RECIPE])
def _(w):
    return O.model_recipe(composition(w)).select("component", "class", "primitive", "height_cm", *r6("radius_cm"), "asset")


@query("instance_scale", """SELECT component, round(greatest(CASE WHEN primitive = 'box' THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END, 2 * radius_cm / 100), 6) AS scale_xy,
  round(greatest(0.1::DOUBLE, height_cm / 100), 6) AS scale_z FROM recipe""", SOLID, CLASS_VIEWS + [RECIPE])
def _(w):
    return O.instance_scale(O.model_recipe(composition(w))).select("component", *r6("scale_xy", "scale_z"))


@query("cull_band", f"""SELECT class, cull_start, cull_end, count(*) AS n FROM (SELECT class,
   coalesce({R.lookup('class', {k: v[0] for k, v in O.CULL_BANDS.items()})}, 12000)::INT AS cull_start,
   coalesce({R.lookup('class', {k: v[1] for k, v in O.CULL_BANDS.items()})}, 16000)::INT AS cull_end
  FROM (SELECT class FROM classed UNION ALL SELECT label FROM comp JOIN obj USING (x, y, z))) GROUP BY 1, 2, 3""", SOLID, CLASS_VIEWS)
def _(w):
    members = O.object_components(w.solid())
    classes = O.component_composition(members).select("class").unionByName(members.select(F.col("label").alias("class")))
    return O.cull_band(classes).groupBy("class", "cull_start", "cull_end").agg(C.n_rows())


FILES = """SELECT concat(CASE p_partkey % 5 WHEN 0 THEN 'Oak-Tree' WHEN 1 THEN 'old_structure' WHEN 2 THEN 'prop-' WHEN 3 THEN 'wild_plant' ELSE 'gate' END,
  '_', CAST(p_size AS STRING), CASE p_partkey % 3 WHEN 0 THEN '.glb' WHEN 1 THEN '.FBX' ELSE '.png' END) AS file FROM {part}"""


@query("asset_token_match", """SELECT component, class, asset FROM classed LEFT JOIN (SELECT token, min(file) AS asset FROM (
   SELECT file, unnest(string_split(replace(lower(regexp_extract(file, '^(.*)[.][^.]*$', 1)), '-', '_'), '_')) AS token FROM files
   WHERE lower(regexp_extract(file, '([.][^.]*)$', 1)) IN ('.glb', '.gltf', '.fbx', '.obj')) WHERE token <> '' GROUP BY token)
  ON token = class""", SOLID, CLASS_VIEWS + [("files", FILES.replace("{part}", "part"))])
def _(w):
    return O.asset_token_match(composition(w), w._sql(FILES, "part")).select("component", "class", "asset")


@query("props_by_class", """SELECT class, primitive, cell_x, cell_z, count(*) AS n FROM (
   SELECT c.class, primitive, CAST(floor(cx / 64) AS INT) AS cell_x, CAST(floor(cz / 64) AS INT) AS cell_z
   FROM classed c JOIN recipe USING (component))
  GROUP BY GROUPING SETS ((class), (primitive, class), (class, cell_x, cell_z))""", SOLID, CLASS_VIEWS + [RECIPE])
def _(w):
    made = O.model_recipe(composition(w)).withColumn("cell_x", F.floor(F.col("sum_x") / F.col("voxels") / 64).cast("int")) \
        .withColumn("cell_z", F.floor(F.col("sum_z") / F.col("voxels") / 64).cast("int"))
    return made.select("class", "primitive", "cell_x", "cell_z").groupingSets(
        [["class"], ["primitive", "class"], ["class", "cell_x", "cell_z"]],
        "class", "primitive", "cell_x", "cell_z").agg(C.n_rows())


# --- buildings ---------------------------------------------------------------

TERR = [P.TOPS, P.SPREAD, P.TERRAIN]
CORE = ("core", """SELECT x, y, z, role FROM solid JOIN terrain USING (x, z)
  WHERE role IN ('structure', 'detail') AND y > terrain_h + 3""")
CORE_COMP = TERR + [CORE] + P.components("core", "corec", K.FACES_3D, "cc")
GROWN = ("grown", f"""SELECT x, y, z, component FROM corec UNION ALL
  SELECT o.x, o.y, o.z, arg_min(c.component, ((o.x - c.x) * (o.x - c.x) + (o.y - c.y) * (o.y - c.y) + (o.z - c.z) * (o.z - c.z), c.x, c.y, c.z))
  FROM (SELECT x, y, z FROM solid WHERE role IN ('structure', 'detail')) o ANTI JOIN corec k USING (x, y, z), corec c
  WHERE abs(o.x - c.x) <= 24 AND abs(o.z - c.z) <= 24 GROUP BY 1, 2, 3""")


def buildings(w):
    solid = w.stored_solid()
    terrain = O.terrain_height(O.column_tops(solid, L.full_grid(C.world_bounds(solid))))
    return O.segment_buildings(solid, cut_lineage(terrain))


@query("wall_core", "SELECT x, y, z, role FROM core", GRID, TERR + [CORE])
def _(w):
    return O.wall_core(w.solid(), O.terrain_height(tops(w))).select("x", "y", "z", "role")


@query("nearest_core_label", "SELECT * FROM grown", GRID, CORE_COMP + [GROWN])
def _(w):
    return buildings(w).select("x", "y", "z", "component")


@query("segment_buildings", SUMMARY.format("grown", 12), GRID, CORE_COMP + [GROWN])
def _(w):
    return O.object_summary(buildings(w), 12)


@query("partition_accounting", """SELECT CAST(sum(blocks) AS BIGINT) AS labelled, CAST(coalesce(sum(blocks) FILTER (blocks >= 12), 0) AS BIGINT) AS in_buildings,
   CAST(coalesce(sum(s) FILTER (blocks >= 12), 0) AS BIGINT) AS structure, CAST(coalesce(sum(d) FILTER (blocks >= 12), 0) AS BIGINT) AS detail,
   CAST(coalesce(sum(blocks) FILTER (blocks < 12), 0) AS BIGINT) AS unclaimed, count(*) FILTER (blocks < 12) AS fragments, TRUE AS adds_up
  FROM (SELECT component, count(*) AS blocks, count(*) FILTER (role = 'structure') AS s, count(*) FILTER (role = 'detail') AS d
   FROM grown JOIN solid USING (x, y, z) GROUP BY component)""", GRID, CORE_COMP + [GROWN])
def _(w):
    return O.partition_accounting(buildings(w), w.solid(), 12)


DETAIL = [("detail", f"""SELECT x, y, z, {R.first_token(R.bare('name'), V.DETAIL_KIND_RULES, 'trim')} AS kind FROM solid WHERE role = 'detail'""")] \
    + P.components("detail", "detc", K.FACES_3D, "dc")


@query("detail_library", """SELECT kind, count(*) AS components, CAST(sum(k) AS BIGINT) AS blocks FROM (
   SELECT component, arg_min(kind, (-k, kind)) AS kind, sum(k) AS k FROM (
    SELECT component, kind, count(*) AS k FROM detail JOIN detc USING (x, y, z) GROUP BY 1, 2) GROUP BY component) GROUP BY kind""",
       SOLID, DETAIL)
def _(w):
    return O.detail_library(O.detail_components(w.solid()))


@query("building_of_detail", """SELECT detail_id, arg_min(building, (-k, building)) AS building, CAST(sum(k) AS BIGINT) AS blocks FROM (
   SELECT d.component AS detail_id, g.component AS building, count(*) AS k FROM detc d JOIN grown g USING (x, y, z) GROUP BY 1, 2)
  GROUP BY detail_id""", GRID, CORE_COMP + [GROWN] + DETAIL)
def _(w):
    return O.building_of_detail(O.detail_components(w.solid()), buildings(w))


SEATED = [("bsum", SUMMARY.format("grown", 12)), ("seats", """SELECT component, min_y, smooth AS ground_y, min_y - smooth AS drop
  FROM bsum JOIN flatted f ON f.x = centre_x AND f.z = centre_z""")]


@query("sample_height_at", "SELECT component, round(ground_y, 6) AS ground_y, round(drop, 6) AS drop FROM seats",
       GRID, CORE_COMP + [GROWN] + FLAT + SEATED)
def _(w):
    ground = S.flat_restore_smooth(filled(w))
    seats = O.sample_height_at(O.object_summary(buildings(w), 12), ground, C.world_bounds(w.solid()))
    return seats.select("component", *r6("ground_y", "drop"))


@query("attach_seating", """SELECT b.component, blocks, round(ground_y, 6) AS ground_y, round(drop, 6) AS drop FROM
  (SELECT component, count(*) AS blocks FROM grown GROUP BY component) b LEFT JOIN seats USING (component)""",
       GRID, CORE_COMP + [GROWN] + FLAT + SEATED)
def _(w):
    summary = cut_lineage(O.object_summary(buildings(w)))
    ground = S.flat_restore_smooth(filled(w))
    seats = O.sample_height_at(summary.filter("blocks >= 12"), ground, C.world_bounds(w.solid()))
    return summary.select("component", "blocks").join(seats.select("component", *r6("ground_y", "drop")), "component", "left")


@query("seating_stats", """SELECT count(*) AS objects, round(avg(abs(drop)), 6) AS mean_abs, round(quantile_cont(abs(drop), 0.95), 6) AS p95_abs,
  round(max(abs(drop)), 6) AS max_abs FROM seats""", GRID, CORE_COMP + [GROWN] + FLAT + SEATED)
def _(w):
    ground = S.flat_restore_smooth(filled(w))
    return O.seating_stats(O.sample_height_at(O.object_summary(buildings(w), 12), ground, C.world_bounds(w.solid())))


@query("nearest_instance", """SELECT x, y, z, arg_min(component, (d2, ix, iy, iz)) AS component, min(d2)::BIGINT AS d2, arg_min(iy, (d2, ix, iy, iz)) - y AS dy FROM (
   SELECT b.centre_x AS x, b.centre_y AS y, b.centre_z AS z, i.component, i.x AS ix, i.y AS iy, i.z AS iz,
    (b.centre_x - i.x) * (b.centre_x - i.x) + (b.centre_y - i.y) * (b.centre_y - i.y) + (b.centre_z - i.z) * (b.centre_z - i.z) AS d2
   FROM treesum b, comp i WHERE abs(b.centre_x - i.x) <= 24 AND abs(b.centre_z - i.z) <= 24) GROUP BY 1, 2, 3""",
       SOLID, PLANTS + OBJ_COMP + [("treesum", SUMMARY.format("trees", 5))])
def _(w):
    trees = O.segment_trees(w.solid(), 5).select(*[F.col("centre_" + c).alias(c) for c in "xyz"])
    items = O.object_components(w.solid()).withColumn("iy", F.col("y"))
    near = nearest_points(trees, items, ["x", "y", "z"], ["component", "iy"])
    return near.select("x", "y", "z", "component", "d2", (F.col("iy") - F.col("y")).alias("dy"))


@query("surface_asof", """SELECT t.x, t.z, terrain_h AS h, coalesce(arg_max(s.family, s.y), 'other') AS family FROM terrain t
  LEFT JOIN solid s ON s.x = t.x AND s.z = t.z AND s.y BETWEEN terrain_h - 3 AND terrain_h GROUP BY 1, 2, 3""", GRID, TERR)
def _(w):
    h = O.terrain_height(tops(w)).select("x", "z", F.col("terrain_h").alias("h"))
    return O.surface_asof(h, w.solid())


# --- spawn search ------------------------------------------------------------

WORLD = ("center", f"""SELECT avg(x) AS bx, avg(z) AS bz FROM solid
  WHERE {R.bare('name')} IN ({R.quoted(V.LANDMARK_GROUPS['building'])})""")
SPAWN = TERR + [WORLD, ("cand", """SELECT t.x, t.z, t.top, bx - t.x AS dx, bz - t.z AS dz,
    greatest(sqrt((bx - t.x) * (bx - t.x) + (bz - t.z) * (bz - t.z)), 1.0) AS dist,
    NOT edge AND top BETWEEN 2 AND 12 AS ok_ground,
    NOT EXISTS (SELECT 1 FROM solid s WHERE s.x BETWEEN t.x - 2 AND t.x + 2 AND s.z BETWEEN t.z - 2 AND t.z + 2
      AND s.y BETWEEN t.top + 1 AND t.top + 2) AS free,
    EXISTS (SELECT 1 FROM wools w WHERE w.x BETWEEN t.x - 16 AND t.x + 16 AND w.z BETWEEN t.z - 16 AND t.z + 16) AS wool
  FROM terrain t, center"""),
                ("tested", """SELECT *, ok_ground AND free AS ok_headroom, ok_ground AND free AS ok_sky, ok_ground AND free AND wool AS ok_field FROM cand"""),
                ("walked", """SELECT c.x, c.z, c.top, step, t.top AS seen FROM tested c, range(2, 32, 2) r(step)
    LEFT JOIN tops t ON t.x = CAST(round_even(c.x + dx / dist * step, 0) AS INT) AND t.z = CAST(round_even(c.z + dz / dist * step, 0) AS INT)
    WHERE ok_field"""),
                ("sight", """SELECT c.*, coalesce(clear, FALSE) AS ok_sight FROM tested c LEFT JOIN (
    SELECT x, z, coalesce(min(step) FILTER (seen > top + 2), 1000) >= coalesce(min(step) FILTER (seen IS NULL), 1000) AS clear
    FROM walked GROUP BY x, z) USING (x, z)""")]
SPAWN.insert(3, ("wools", "SELECT DISTINCT x, z FROM solid WHERE ends_with(name, '_wool')"))


def spawn_cells(w):
    solid = w.stored_solid()
    grid = L.full_grid(C.world_bounds(solid))
    cand = O.spawn_candidates(solid, grid, C.building_mass_center_exact(solid))
    return O.sightline(cut_lineage(cand), O.column_tops(solid, grid))


@query("headroom_skirt", "SELECT x, z, top FROM tested WHERE ok_sky", GRID, SPAWN)
def _(w):
    return spawn_cells(w).filter("ok_sky").select("x", "z", "top")


@query("sightline", "SELECT x, z, top FROM sight WHERE ok_sight", GRID, SPAWN)
def _(w):
    return spawn_cells(w).filter("ok_sight").select("x", "z", "top")


@query("spawn_search", """SELECT ground, headroom, sky, field, sight, x AS spawn_x, z AS spawn_z, top AS surface_y,
   round(degrees(atan2(dz, dx)), 1) AS yaw, round(dist, 1) AS distance FROM
  (SELECT count(*) FILTER (ok_ground) AS ground, count(*) FILTER (ok_headroom) AS headroom, count(*) FILTER (ok_sky) AS sky,
    count(*) FILTER (ok_field) AS field, count(*) FILTER (ok_sight) AS sight FROM sight),
  (SELECT * FROM sight WHERE ok_sight
   ORDER BY round(-abs(top - 4) * 2.0::DOUBLE - abs(dist - 140.0::DOUBLE) * 0.05::DOUBLE - abs(top - 4), 9) DESC, x, z LIMIT 1)""", GRID, SPAWN)
def _(w):
    return O.spawn_search(spawn_cells(w))
