"""Text sources and sinks: meshes as OBJ lines, JSON assets and reports."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .line_packs import write_lines

MODEL_JSON = """struct<parent:string, textures:map<string,string>, elements:array<struct<`from`:array<double>,
 `to`:array<double>, faces:map<string,struct<texture:string>>>>>"""
STATE_JSON = "struct<variants:map<string,string>, multipart:array<string>>"


def scan_asset_json(docs: DataFrame, schema=MODEL_JSON) -> DataFrame:
    """Parsed documents (path, text); broken ones give null and ``bad``."""
    parsed = docs.withColumn("doc", F.from_json("text", schema, {"mode": "PERMISSIVE"}))
    bad = F.col("doc").isNull() | (F.try_parse_json("text").isNull())
    return parsed.withColumn("bad", bad).withColumn("doc", F.when(~F.col("bad"), F.col("doc")))


def model_elements(models: DataFrame) -> DataFrame:
    """One row per element face: node, pos, direction, texture, is_full."""
    full = F.lit(True)
    for i in range(3):
        full = full & (F.abs(F.get("e.from", i)) < 1e-6) & (F.abs(F.get("e.to", i) - 16) < 1e-6)
    return (models.select("node", F.posexplode("doc.elements").alias("pos", "e"))
            .select("node", "pos", F.coalesce(full, F.lit(False)).alias("is_full"), F.explode("e.faces").alias("direction", "face"))
            .select("node", "pos", "is_full", "direction", "face.texture"))


def _fixed(rows, tag, columns, places):
    """Tag and values of a line as ``%.<places>f`` writes them. Whole numbers, the
    rule in a block world, need no format, which takes most of the time of a line.
    Expressions are kept short: the JVM does not compile long methods."""
    def is_int(c):
        return rows.schema[c].dataType.typeName() in ("byte", "short", "integer")

    def text(c):
        if is_int(c):
            return F.concat(F.col(c).cast("string"), F.lit("." + "0" * places))
        v = F.col(c).cast("double")
        # up to 10 ** 7 a double is written with one decimal, and with its sign where it is zero
        return F.when(F.abs(v) < 1e7, F.concat(v.cast("string"), F.lit("0" * (places - 1)))) \
            .otherwise(F.concat(v.cast("bigint").cast("string"), F.lit("." + "0" * places)))

    values = [F.col(c).cast("double") for c in columns]
    whole = reduce(and_, [F.col(c).isNotNull() if is_int(c) else (F.abs(v) < 1e15) & (v == F.rint(v)) for c, v in zip(columns, values)])
    return F.when(whole, F.concat_ws(" ", F.lit(tag), *map(text, columns))) \
        .otherwise(F.format_string(" ".join([tag] + [f"%.{places}f"] * len(columns)), *values))


def _has_line(section):
    """Does a corner add a line to a section of its tile? v, vt and vn for every
    corner; corner 0 holds ``usemtl`` where the material changes, corners 1 and 2
    the two triangles."""
    corner = F.col("corner")
    return (section < 4) | ((corner == 0) & F.col("head") & F.col("material").isNotNull()) | corner.isin(1, 2)


def _corner_line(corners, section):
    """Line that a corner adds to a section of its tile, where it adds one."""
    corner, b = F.col("corner"), F.col("quad") * 4 + 1
    face = [F.lit("f")]
    for n in (b, b + corner, b + corner + 1):  # 0 1 2 at corner 1, 0 2 3 at corner 2
        point = n.cast("string")
        face += [F.lit(" "), point, F.lit("/"), point, F.lit("/"), point]
    return (F.when(section == 1, _fixed(corners, "v", ["ux", "uy", "uz"], 2))
            .when(section == 2, _fixed(corners, "vt", ["u", "v"], 6))
            .when(section == 3, _fixed(corners, "vn", ["nx", "ny", "nz"], 3))
            .when(corner == 0, F.concat(F.lit("usemtl "), "material"))
            .otherwise(F.concat(*face)))


def quad_obj_lines(corners: DataFrame, tile="object_id") -> DataFrame:
    """OBJ lines (tile, section, k, line) of quads with numbered corners.

    corners: tile, quad (number in the tile from 0, materials together),
    corner 0..3, material, head (is it the first quad of its material?), ux uy
    uz, u v, nx ny nz. Each corner makes its own lines, so nothing is shuffled.
    """
    sections = F.array(*[F.struct(F.lit(s).alias("section"), F.when(_has_line(F.lit(s)), _corner_line(corners, F.lit(s))).alias("line"))
                         for s in (1, 2, 3, 4)])
    lines = corners.select(tile, (F.col("quad") * 4 + F.col("corner")).alias("k"), F.explode(sections).alias("e"))
    return lines.select(tile, "e.section", "k", "e.line").filter("line IS NOT NULL")


def write_obj_tiles(quads: DataFrame, folder: str, tile="object_id"):
    """One text per tile, its lines in section and number order, in a pack of
    packed part files (see line_packs). quads: tile, quad, material, head and what
    mesh_quads takes. Quads are dealt and sorted, once for each section; their
    lines are made in the tasks that write them."""
    from ..operators.mesh import mesh_quads
    each = quads.withColumn("section", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))

    def lines(rows):
        corners, section = mesh_quads(rows), F.col("section")
        return corners.filter(_has_line(section)).withColumn("line", _corner_line(corners, section))

    write_lines(each, folder, tile, "section", "quad", packed=True, lines=lines)


def obj_line_census(lines: DataFrame) -> DataFrame:
    """Counts per file of each record, triangles, negative zeros in normals
    and carriage returns."""
    tag = F.substring_index("line", " ", 1)
    spaces = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    out = [F.count_if(tag == t).alias("n_" + t) for t in ("v", "vt", "vn", "f", "usemtl")]
    tris = F.sum(F.when(tag == "f", spaces - 2).otherwise(0)).alias("triangles")
    minus = F.count_if((tag == "vn") & F.contains("line", F.lit(" -0")) & F.col("line").rlike(r" -0(\.0+)?( |$)")).alias("negative_zeros")
    return lines.groupBy("file").agg(*out, tris, minus, F.count_if(F.contains("line", F.lit("\r"))).alias("cr"))


def usemtl_first_seen(lines: DataFrame) -> DataFrame:
    """Material names of each file in the order of their first line."""
    from pyspark.sql import Window
    seen = lines.filter(F.col("line").startswith("usemtl ")) \
        .groupBy("file", F.col("line").substr(F.lit(8), F.length("line")).alias("material")).agg(F.min("line_no").alias("first"))
    return seen.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("first")) - 1).drop("first")


def write_report_json(report: DataFrame, folder: str):
    """A one-row nested report; time columns are left out so that a second run
    writes the same text."""
    timed = [c for c, t in report.dtypes if t.startswith("timestamp") or c.startswith("elapsed")]
    report.drop(*timed).coalesce(1).write.mode("overwrite").json(folder)


def write_voxels(voxels: DataFrame, folder: str):
    """Voxels partitioned by dimension and region, clustered by chunk. Each
    region is written by several tasks, so a full region is no bottleneck."""
    from ..operators.voxels import floor_div, with_chunk
    v = with_chunk(voxels).withColumn("rx", floor_div(F.col("cx"), 32)).withColumn("rz", floor_div(F.col("cz"), 32))
    (v.repartition("dim", "rx", "rz", floor_div(F.col("cx"), 8)).sortWithinPartitions("dim", "rx", "rz", "cx", "cz", "y")
     .write.mode("overwrite").partitionBy("dim", "rx", "rz").parquet(folder))


def scan_chunk_range(spark, folder: str, cx, cz, dim=None) -> DataFrame:
    """Voxels of the chunks cx[0]..cx[1], cz[0]..cz[1] of a table written by
    write_voxels. Regions that the range misses are not opened, and within
    files the chunk numbers are pushed to the reader."""
    rows = spark.read.parquet(folder).filter(F.col("cx").between(*cx) & F.col("cz").between(*cz))
    for region, (low, high) in (("rx", cx), ("rz", cz)):
        rows = rows.filter(F.col(region).between(low // 32, high // 32))
    return rows if dim is None else rows.filter(F.col("dim") == dim)


def scan_bounded(spark, folder: str, x, z, dim=None) -> DataFrame:
    """Voxels of a stored table inside x[0]..x[1], z[0]..z[1]."""
    rows = scan_chunk_range(spark, folder, [v // 16 for v in x], [v // 16 for v in z], dim)
    return rows.filter(F.col("x").between(*x) & F.col("z").between(*z))


def write_grids(grid: DataFrame, folder: str):
    """Column grids (x, z, ...) in squares of 512 columns, clustered by row."""
    from ..operators.voxels import floor_div
    placed = grid.withColumn("rx", floor_div(F.col("x"), 512)).withColumn("rz", floor_div(F.col("z"), 512))
    (placed.repartition("rx", "rz", floor_div(F.col("x"), 64)).sortWithinPartitions("rx", "rz", "x", "z")
     .write.mode("overwrite").partitionBy("rx", "rz").parquet(folder))


def write_mesh_pack(vertices: DataFrame, triangles: DataFrame, folder: str):
    """Vertices and triangles by tile. Rows are dealt by ranges of tile and
    number, so a large tile is written by several tasks."""
    for name, df, number in (("vertices", vertices, "vertex"), ("triangles", triangles, "a")):
        (df.repartitionByRange("tile", number).sortWithinPartitions("tile", number)
         .write.mode("overwrite").partitionBy("tile").parquet(f"{folder}/{name}"))


def scan_mesh_pack(spark, folder: str) -> DataFrame:
    """Per tile: vertex and triangle counts, and whether every triangle names
    an existing vertex and vertex numbers are dense."""
    v = spark.read.parquet(f"{folder}/vertices").groupBy("tile").agg(
        F.count(F.lit(1)).alias("vertices"), F.max("vertex").alias("top"), F.min("vertex").alias("low"))
    t = spark.read.parquet(f"{folder}/triangles").groupBy("tile").agg(
        F.count(F.lit(1)).alias("triangles"), F.max(F.greatest("a", "b", "c")).alias("used"))
    return v.join(t, "tile", "full").select(
        "tile", "vertices", "triangles",
        ((F.col("low") == 0) & (F.col("top") == F.col("vertices") - 1) & (F.col("used") < F.col("vertices"))).alias("ok"))
