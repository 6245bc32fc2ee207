"""The pipeline on a small corpus against what each stage should leave."""

import re

import corpus_pipeline
from blockstrata.llm import queries
from blockstrata.session import shared_folder
from helpers import brute_components, docs_table, shingles

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, folder = docs.columns, f"{shared_folder(spark)}/test-pipeline"
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, SF).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name == "mixing":
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after.items() <= before.items()
        gone = set(before) - set(after)
        if name == "quality":
            assert not [i for i in gone if labels.get(i) == 1] and [i for i in gone if labels.get(i) == 0]
        elif name == "exact_dedup":
            plain = [re.sub(r"[\x20\x09-\x0D]", "", t) for t in before.values()]
            assert len(after) == len(set(plain))
        elif name == "near_dedup":
            want = brute_components(before.items(), 5, 80)
            assert set(after) == {i for i, (_, c) in want.items() if i == c}
        elif name == "decontamination":
            hold = {i for i, t in before.items() if any(5 * len(shingles(b, 5) & shingles(t, 5)) >= 4 * len(shingles(b, 5)) for b in bench)}
            assert gone == hold


def test_queries_have_names_of_their_operators():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.ORACLES) <= set(queries.QUERIES)


ODD = [(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, " \n"), (None, "a text whose row has no number at all"), (None, None),
       (10 ** 6 + 3, "said again and again here"), (10 ** 6 + 3, "said again and again here"), (10 ** 6 + 4, "said  again and again here"),
       (10 ** 6 + 5, " ".join(f"Word{i % 5000} of." for i in range(60_000)))]


def test_stages_take_odd_rows(spark):
    docs = docs_table(spark, ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept = sorted((r["doc_id"] or 0 for r in out.collect()))
        if name == "mixing":
            assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
        else:
            assert out.columns == docs.columns
        gone = {"exact_dedup": {10 ** 6, 10 ** 6 + 1, 10 ** 6 + 3}, "near_dedup": {10 ** 6 + 4}}.get(name, set())
        if name != "quality":
            assert kept == sorted(i or 0 for i, _ in ODD if i not in gone), name
        assert stage(spark, docs.limit(0), SF).collect() == []
