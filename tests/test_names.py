"""Name rules: worked out once per name, and on distinct names only."""

import re

from pyspark.sql import functions as F

from blockstrata.fixtures import NAME_HEADS, NAME_TAILS
from blockstrata.functions import fixed_values as V
from blockstrata.functions import rules
from blockstrata.plans import QUERIES


def family(name):
    return next((k for t, k in V.FAMILY_RULES if t in name), "other")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_first_rule_wins_and_no_token_is_the_default(spark):
    names = [h + t for h in NAME_HEADS for t in NAME_TAILS] + ["", "x", "lantern", "a tall_grass glass", "soul_campfire"]
    rows = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = rows.select("name", rules.material_family(F.col("name")).alias("f")).collect()
    assert all(r["f"] == family(r["name"] or "") for r in got) and len({r["f"] for r in got}) > 10


def test_a_name_is_not_worked_out_for_each_token(spark):
    names = spark.range(3).select(rules.material_family(F.concat(F.lit("a:"), "id")).alias("f"))
    looked = re.findall(r"contains\((.)", plan(names), re.IGNORECASE)
    assert len(looked) == 1 and looked[0] == "l"  # a variable of the rule, no expression


def test_unmapped_names_tries_its_rule_on_distinct_names(spark, tmp_path):
    keys = [(k,) for k in range(1200)] * 3 + [(None,)]
    spark.createDataFrame(keys, "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))
    found = QUERIES["unmapped_names"](spark, str(tmp_path))
    assert "p_partkey" not in plan(found)
    parts = [NAME_HEADS[k % len(NAME_HEADS)] + NAME_TAILS[k // len(NAME_HEADS) % len(NAME_TAILS)] for k in range(1200)]
    want = sorted({"minecraft:" + n for n in parts if family(n) == "other"})
    assert [r["name"] for r in found.collect()] == [None] + want
