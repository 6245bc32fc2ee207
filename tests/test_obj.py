"""OBJ lines: made where they are written, and in the right order."""

import collections
import concurrent.futures
import gzip

from pyspark.sql import functions as F

from blockstrata.operators.mesh import mesh_quads
from blockstrata.operators.ranking import number_in_groups
from blockstrata.sources.line_packs import scan_lines, write_lines
from blockstrata.sources.text import quad_obj_lines, write_obj_tiles


def some_quads(spark):
    quads = spark.range(900).select(
        F.when(F.col("id") < 800, F.lit(5)).otherwise(F.col("id") % 9).alias("object_id"),
        F.concat(F.lit("m"), F.col("id") % 3).alias("material"), F.lit("y").alias("axis"), F.lit(1).alias("sign"), F.lit(2).alias("plane"),
        F.col("id").cast("int").alias("r0"), (F.col("id") + 1).cast("int").alias("r1"), F.lit(0).alias("c0"), F.lit(1).alias("c1"))
    return number_in_groups(quads, "object_id", ["material", "r0"], "quad", first="head")


def test_first_of_a_value_is_known_over_parts(spark):
    rows = some_quads(spark).collect()
    smallest = collections.defaultdict(lambda: 10 ** 9)
    for r in rows:
        smallest[r["object_id"], r["material"]] = min(r["quad"], smallest[r["object_id"], r["material"]])
    assert all(r["head"] == (r["quad"] == smallest[r["object_id"], r["material"]]) for r in rows)


def test_lines_are_neither_shuffled_nor_joined(spark):
    quads = some_quads(spark).localCheckpoint()
    plan = quad_obj_lines(mesh_quads(quads))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_pack_holds_the_lines_in_section_and_number_order(spark, tmp_path):
    quads, folder = some_quads(spark).localCheckpoint(), str(tmp_path / "obj")
    want = collections.defaultdict(list)
    for r in sorted(quad_obj_lines(mesh_quads(quads)).collect(), key=lambda r: (r["object_id"], r["section"], r["k"])):
        want[str(r["object_id"])].append(r["line"])
    write_obj_tiles(quads, folder)
    got = collections.defaultdict(list)
    for r in sorted(scan_lines(spark, folder).collect(), key=lambda r: (r["name"], r["line_no"])):
        got[r["name"]].append(r["line"])
    assert got == want and sum(map(len, got.values())) == 900 * 14 + sum(r["head"] for r in quads.collect())
    tags, n = [t.split(" ")[0] for t in got["5"]], 4 * sum(r["object_id"] == 5 for r in quads.collect())
    assert tags[:n] == ["v"] * n and tags[n:2 * n] == ["vt"] * n and tags[2 * n:3 * n] == ["vn"] * n
    assert tags[3 * n:3 * n + 3] == ["usemtl", "f", "f"] and tags.count("usemtl") == 3


def test_a_thread_without_an_active_session_may_write(spark, tmp_path):
    with concurrent.futures.ThreadPoolExecutor(1) as pool:
        lines = spark.range(9).select(F.lit("a").alias("name"), "id", F.col("id").cast("string").alias("line"))
        pool.submit(write_lines, lines, str(tmp_path / "pack"), "name", "id").result()
        assert pool.submit(lambda: scan_lines(spark, str(tmp_path / "pack")).count()).result() == 9


def test_packed_runs_are_read_alone(spark, tmp_path):
    folder, quads = str(tmp_path / "obj"), some_quads(spark).localCheckpoint()
    write_obj_tiles(quads, folder)
    index, texts = scan_lines(spark, folder, "index").collect(), collections.defaultdict(bytes)
    for r in sorted(index, key=lambda r: r["first_line"]):
        with open(f"{folder}/{r['file']}", "rb") as f:
            f.seek(r["offset"])
            texts[r["name"]] += gzip.decompress(f.read(r["bytes"]))
    lines = scan_lines(spark, folder).collect()
    assert sum(t.count(b"\n") for t in texts.values()) == len(lines)
    assert texts["5"].decode().split("\n")[:-1] == [r["line"] for r in sorted(lines, key=lambda r: r["line_no"]) if r["name"] == "5"]
    assert sum(r["bytes"] for r in index) * 3 < sum(map(len, texts.values()))
