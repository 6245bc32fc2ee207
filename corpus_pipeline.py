"""A corpus cleaned in stages, each written as Parquet and read by the next."""

import uuid

from pyspark.sql import functions as F

from blockstrata.llm.decontamination import find_items
from blockstrata.llm.exact_dedup import exact_duplicates
from blockstrata.llm.mixing import mix_sources
from blockstrata.llm.near_dedup import near_duplicates
from blockstrata.llm.quality import score_quality, train_quality
from blockstrata.session import shared_folder

#: SQL cannot state the learned and hashed stages; tests hold them against brute force.
ORACLE_SQL = None


def _without(docs, ids):
    """Rows whose doc_id is not among ``ids``; a null doc_id stays."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts; without labels all."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_quality(docs, labels)
    if model is None:
        return docs
    return _without(docs, score_quality(docs, model).where(F.col("score") < 0.5))


def exact_copies(spark, docs, sf_dir):
    """One document of each group that is equal without white space."""
    return _without(docs, exact_duplicates(docs).where("not kept"))


def near_copies(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def no_benchmark(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return _without(docs, find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixture(spark, docs, sf_dir):
    """Words that the mixture of sources takes from each document that is left."""
    return mix_sources(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", no_benchmark),
    ("mixing", mixture),
]


def run(spark, sf_dir):
    """Apply all stages to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
