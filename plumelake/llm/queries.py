"""Registered queries of the corpus operators: thin calls with production parameters
over whole tables, with the digest columns the contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumelake.llm import (
    alignment, hard_negatives as hn, mixing, oracle, packing, pii, quality_classifier as qc, quality_rules as qr,
    repeated_windows, simhash, substrings, templates, topk, url_filter)

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]
TOP = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = qr.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = qc.train(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", qc.is_held_out().alias("held_out"), qc.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op3_remove_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, terms = pii.find_all(_table(spark, sf_dir, "documents"), ["doc_id"])
    terms = terms.withColumnRenamed("_digest", "_of")
    joined = base.join(terms, F.col("_digest") == F.col("_of"), "left")
    kinds = F.transform("_spans", lambda x: x["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, lambda x: x == F.lit(k)), False)).cast("long").alias(f"n_{k}")
              for k in pii.KINDS]
    return joined.select(
        "doc_id", *counts, F.sha2(pii.spans_text(F.col("_spans")), 256).alias("base_sha256"),
        pii.spans_text(F.col("_spans"), F.col("_terms")).alias("spans"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(_table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), TOP, F.col("vec_id") % 50 == 0)


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit_urls(url_filter.url_table(spark))
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES, model)
    return judged.drop("score")


def op11_remove_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows.remove_windows(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))[0]


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hn.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


REGISTERED: list[Query] = [
    op1_quality_rules, op2_quality_classifier, op3_remove_repeated_substrings, op4_simhash_components, op5_packing,
    op6_personal_data, op7_main_text, op8_mixing, op9_top_k, op10_url_verdicts,
    op11_remove_repeated_windows, op12_token_alignment, op13_hard_negatives]


def registered() -> dict[str, Query]:
    return {q.__name__: q for q in REGISTERED}


def statements() -> dict[str, str]:
    return oracle.statements()
