"""Quads of many objects: merged with one sort a step, numbered without moving them by hash."""

import random

from pyspark.sql import functions as F

from blockstrata.fixtures import World
from blockstrata.operators.mesh import greedy_quads
from blockstrata.operators.ranking import number_in_groups
from blockstrata.plans.io import numbered_quads


def test_quads_of_an_object_stay_together(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(128), rng.randrange(16384), float(rng.randrange(50)), rng.randrange(24), rng.randrange(7)) for _ in range(6000)]
    spark.createDataFrame(rows, "l_partkey long, l_orderkey long, l_quantity double, l_suppkey long, l_linenumber int") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    quads = numbered_quads(World(spark, str(tmp_path)))
    places = quads.select("object_id", F.spark_partition_id().alias("p")).groupBy("object_id").agg(F.count_distinct("p").alias("n"), F.count("*").alias("q"))
    many = places.filter("q >= 6").agg(F.count("*").alias("n"), F.sum("n").alias("parts")).first()
    assert many["n"] > 100 and many["parts"] <= many["n"] + 40
    assert quads.groupBy("object_id").agg((F.max("quad") + 1 == F.count("*")).alias("ok"), F.count_distinct("quad").alias("d"), F.count("*").alias("q")) \
        .filter("NOT ok OR d <> q").count() == 0


def test_merging_sorts_once_a_step(spark):
    faces = spark.createDataFrame([(1, "x", 1, 0, 0, 0, "m")], "object_id long, axis string, sign int, plane int, row int, col int, material string")
    plan = greedy_quads(faces)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") >= 2 and plan.count("Sort [") == 2


def test_numbers_and_flags_over_parts(spark):
    rng = random.Random(8)
    rows = [(g, v, i) for i, (g, v) in enumerate((rng.choice([0] * 30 + [None, 1, 2, 3]), rng.choice(["a", "b", None, "c"])) for _ in range(5000))]
    df = spark.createDataFrame(rows, "g int, v string, i int").repartition(7)
    got = number_in_groups(df, "g", ["v", "i"], "k", first="head").collect()
    want, seen = {}, {}
    for g, v, i in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2])):
        k = seen.setdefault(g, [])
        want[i] = (len(k), not k or k[-1] != v)
        k.append(v)
    assert {r["i"]: (r["k"], r["head"]) for r in got} == want
