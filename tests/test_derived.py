"""Kept tables: reused, rebuilt, and never read half written."""

import os

import pytest
from pyspark.sql import functions as F

from blockstrata.sources.derived import Kept, files_stamp, kept_table, rows_stamp


def test_second_run_reads_and_changes_rebuild(spark, tmp_path):
    source, folder, runs = str(tmp_path / "in"), str(tmp_path / "kept"), []

    def derived():
        def build():
            runs.append(1)
            return spark.read.parquet(source).groupBy(F.col("id") % 3).count()
        stamps = {"in": files_stamp(spark, source), "rule": "v1"}
        return sorted(map(tuple, kept_table(spark, folder, stamps, build).collect()))
    spark.range(30).write.parquet(source)
    assert derived() == derived() == [(0, 10), (1, 10), (2, 10)] and len(runs) == 1
    spark.range(3).write.mode("append").parquet(source)
    assert derived() == derived() == [(0, 11), (1, 11), (2, 11)] and len(runs) == 2
    spark.range(6).write.mode("overwrite").parquet(source)
    assert derived() == [(0, 2), (1, 2), (2, 2)] and len(os.listdir(f"{folder}/builds")) == 2


def test_an_aborted_build_is_never_read(spark, tmp_path):
    folder = str(tmp_path / "kept")
    kept_table(spark, folder, {"a": "1"}, lambda: spark.range(5))
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken off"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken off"):
        kept_table(spark, folder, {"a": "2"}, lambda: broken)
    kept = Kept(spark, folder)
    assert kept.read().count() == 5 and kept.reusable({"a": "1"}) and not kept.reusable({"a": "2"})
    assert kept_table(spark, folder, {"a": "2"}, lambda: spark.range(7)).count() == 7
    assert len(os.listdir(f"{folder}/builds")) == 2


def test_agreement_by_input(spark, tmp_path):
    kept = Kept(spark, str(tmp_path / "kept"))
    assert kept.manifest() is None and not kept.reusable({})
    with pytest.raises(FileNotFoundError):
        kept.read()
    kept.build(spark.range(1), {"a": "1", "b": "2", "gone": "3"})
    got = {r["input"]: r["reusable"] for r in kept.agreement({"a": "1", "b": "x", "new": "4"}).collect()}
    assert got == {"a": True, "b": False, "gone": False, "new": False}


def test_rows_stamp_ignores_order(spark):
    a = spark.range(100)
    assert rows_stamp(a) == rows_stamp(a.orderBy(F.desc("id"))) != rows_stamp(a.where("id < 99"))
