"""A corpus pipeline of five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor
kept. All but the last return the columns of ``documents``. ``run`` stores each
result in the shared folder and reads it for the next stage.

Defined results: a null or empty text is scored like any text, is one near-duplicate group
with all others without words, holds no personal data, has size 0, which the mix takes once
or not at all, and is packed as the single end id. Rows without an id stay in every stage,
but lose to rows with an id in their near-duplicate group. Repeated rows are scored alike,
become one, and later come as often as the mix takes them. Extra columns are carried along
and never read, whatever their names. Without rows, or without usable labels, which leave
every document in, all stages run and return what is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumelake.llm import mixing, packing, pii, quality_classifier as qc, simhash
from plumelake.llm.common import written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = qc.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(qc.score(F.col("text"), model) >= 0.5)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.first_of_each(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and without the terms that reveal it."""
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify), ("simhash near-duplicates", dedup), ("personal data", sanitise),
    ("mixing", mix), ("packing", pack)]

# The classifier, fingerprints and token ids are beyond SQL; tests compare the stages
# with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
