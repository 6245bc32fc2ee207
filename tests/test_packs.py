"""Packs of lines: order over parts, commits, lost attempts."""

import os

import pytest
from pyspark.sql import functions as F

from blockstrata.operators.ranking import number_in_groups
from blockstrata.sources.line_packs import PackWriter, Written, manifest, scan_lines, write_lines


def texts(spark, folder):
    out = {}
    for r in scan_lines(spark, folder).collect():
        out.setdefault(r["name"], []).append((r["line_no"], r["line"]))
    assert all([n for n, _ in sorted(v)] == list(range(len(v))) for v in out.values())
    return {k: [t for _, t in sorted(v)] for k, v in out.items()}


def some_lines(spark):
    big = spark.range(20_000).select(F.lit("big").alias("name"), "id", F.concat(F.lit("line "), "id").alias("line"))
    small = spark.range(500).select(F.concat(F.lit("s"), F.col("id") % 90).alias("name"), "id", F.concat(F.lit("é "), "id").alias("line"))
    return big.unionByName(small).orderBy(F.rand(3))


def test_a_large_text_spans_parts_and_small_ones_share_them(spark, tmp_path):
    folder = str(tmp_path / "pack")
    write_lines(some_lines(spark), folder, "name", "id")
    got = texts(spark, folder)
    assert got["big"] == [f"line {i}" for i in range(20_000)] and len(got) == 91
    assert all(got[f"s{k}"] == [f"é {i}" for i in range(k, 500, 90)] for k in range(90))
    index = scan_lines(spark, folder, "index").collect()
    assert len({r["file"] for r in index if r["name"] == "big"}) > 2 and len({r["file"] for r in index}) < 91
    joined = b""
    for r in sorted((r for r in index if r["name"] == "big"), key=lambda r: r["first_line"]):
        with open(f"{folder}/{r['file']}", "rb") as f:
            f.seek(r["offset"])
            joined += f.read(r["bytes"])
    assert joined == b"".join(b"line %d\n" % i for i in range(20_000))


def test_a_new_write_replaces_and_a_broken_one_does_not(spark, tmp_path):
    folder = str(tmp_path / "pack")
    write_lines(some_lines(spark).where("name = 's1'"), folder, "name", "id")
    write_lines(some_lines(spark).where("name = 's2'"), folder, "name", "id")
    assert set(texts(spark, folder)) == {"s2"}
    bad = some_lines(spark).withColumn("line", F.when(F.col("id") == 400, F.raise_error(F.lit("broken off"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="broken off"):
        write_lines(bad, folder, "name", "id")
    assert set(texts(spark, folder)) == {"s2"}
    assert len([f for f in os.listdir(folder) if f.endswith(".txt")]) >= len(manifest(folder)["parts"])


def test_lines_count_on_over_parts(tmp_path):
    writer = PackWriter({"path": str(tmp_path)})
    made = [Written(2, "c", 1, 5, "a", "a", 5), Written(0, "a", 2, 7, "z", "a", 3), Written(1, "b", 1, 4, "a", "a", 4),
            Written(3, "d", 0, 0, None, None, 0), Written(5, "e", 2, 3, "a", "b", 1), Written(6, "f", 1, 1, "b", "b", 1)]
    writer.commit(made)
    assert [(p["file"], p["base"]) for p in manifest(str(tmp_path))["parts"]] == [("a", 0), ("b", 3), ("c", 7), ("e", 12), ("f", 1)]


def test_empty_packs(spark, tmp_path):
    folder = str(tmp_path / "pack")
    assert scan_lines(spark, folder).collect() == []
    write_lines(some_lines(spark).limit(0), folder, "name", "id")
    assert scan_lines(spark, folder).collect() == [] and manifest(folder) == {"parts": []}


def test_numbers_in_groups_over_many_tasks(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2500, F.lit(0)).otherwise(F.col("id") % 7).alias("g"), F.pmod(F.xxhash64("id"), F.lit(10 ** 9)).alias("v"), "id")
    rows = number_in_groups(df, "g", ["v", "id"], "k").collect()
    for g in {r["g"] for r in rows}:
        own = sorted((r["v"], r["id"], r["k"]) for r in rows if r["g"] == g)
        assert [k for *_, k in own] == list(range(len(own)))
