"""OBJ lines at size: formats only where needed, texts of many objects read together."""

import math

from pyspark.sql import functions as F

from blockstrata.operators.mesh import mesh_quads
from blockstrata.sources import text as S
from blockstrata.sources.line_packs import PackReader, scan_lines, write_lines
from test_obj import some_quads

ODD = [0.0, -0.0, 1.0, -3.0, 0.5, -0.004, 2.675, 12800.0, 1e7, -1e7, 123456789.0, 1e15, 1e16, 9.3e18, 1e300, math.nan, math.inf, -math.inf, None]


def test_values_are_written_as_by_a_format(spark):
    rows = spark.createDataFrame([(a, b) for a in ODD for b in (0.0, 7.0, 0.25, None)], "a double, b double")
    rows = rows.withColumn("n", F.when(F.abs("a") < 1e9, F.col("a")).cast("int"))
    for columns, places in ((["a", "b"], 2), (["b", "n"], 3), (["n"], 6)):
        want = F.format_string(" ".join(["t"] + [f"%.{places}f"] * len(columns)), *[F.col(c).cast("double") for c in columns])
        assert rows.select(S._fixed(rows, "t", columns, places).alias("got"), want.alias("want")).filter("NOT got <=> want").collect() == []


def test_lines_are_made_once_and_by_compiled_code(spark, tmp_path, monkeypatch):
    held, folder = {}, str(tmp_path / "quads")
    some_quads(spark).write.parquet(folder)
    monkeypatch.setattr(S, "write_lines", lambda rows, *a, lines, **k: held.update(df=lines(rows)))
    S.write_obj_tiles(spark.read.parquet(folder), "")
    plan = held["df"].select("object_id", "line")._jdf.queryExecution().optimizedPlan().toString()
    filters = [part for part in plan.split("\n") if " Filter " in part or part.startswith("Filter ")]
    assert filters and not any("format_string" in f or "concat" in f for f in filters)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = [spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
                for df in (held["df"].select("object_id", "line"), S.quad_obj_lines(mesh_quads(spark.read.parquet(folder))))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(c.split("maxMethodCodeSize:")[1].split(";")[0]) for c in code]
    assert max(sizes) < 7500  # from 8000 bytes on the JVM leaves a method uncompiled


def test_small_texts_are_read_together(spark, tmp_path):
    folder = str(tmp_path / "pack")
    lines = spark.range(4000).select(F.concat(F.lit("t"), F.floor(F.col("id") / 4)).alias("name"), "id", F.concat(F.lit("l "), "id").alias("line"))
    for packed in (True, False):
        write_lines(lines, folder, "name", "id", packed=packed)
        reader = PackReader({"path": folder})
        batches = [b for part in reader.partitions() for b in reader.read(part)]
        assert len(batches) == len(reader.partitions()) < 20
        got = {(n, k): t for b in batches for n, k, t in zip(*(b.column(i).to_pylist() for i in range(3)))}
        assert got == {(f"t{i // 4}", i % 4): f"l {i}" for i in range(4000)}


def test_long_texts_empty_lines_and_missing_names(spark, tmp_path):
    folder = str(tmp_path / "pack")
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 10 > 0, F.lit("long")).when(F.col("id") % 20 > 0, F.lit("é")).alias("name"), "id",
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("ö"), F.col("id").cast("string"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 30))).alias("line"))
    want = {}
    for r in lines.orderBy("id").collect():
        want.setdefault(r["name"], []).append(r["line"] or "")
    for packed in (True, False):
        write_lines(lines, folder, "name", "id", packed=packed)
        got = {}
        for r in scan_lines(spark, folder).orderBy("name", "line_no").collect():
            assert r["line_no"] == len(got.setdefault(r["name"], []))
            got[r["name"]].append(r["line"])
        assert got == want
