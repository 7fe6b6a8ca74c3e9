"""Corpus pipeline: quality classifier, near-duplicate removal, benchmark
decontamination, mixing to target weights, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm.common import cut, load
from staylens.llm.cotraining import SCORES, fit, score
from staylens.llm.decontamination import decontaminate
from staylens.llm.jaccard import one_per_class
from staylens.llm.mixing import mixed_rows
from staylens.llm.sharding import shard_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier accepts."""
    model = fit(docs, load(spark, sf_dir, "labels"))
    named = {c: f"_in_{c}" for c in docs.columns if c in SCORES}   # columns that would clash with the scores
    rows = docs.withColumnsRenamed(named)
    kept = score(rows, model, columns=tuple(rows.columns)).where("kept")
    return kept.select(*[kept[named.get(c, c)].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of documents
    whose 5-word shingle sets are connected by a Jaccard similarity of 0.8."""
    return one_per_class(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target mix takes them."""
    return mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot on the Hilbert curve."""
    return shard_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

# no SQL: the classifier is trained by iteration
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
