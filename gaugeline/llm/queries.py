"""Each operator of this subpackage as a query over its whole table, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (debruijn_dedup, decontaminate, importance, jaccard_join, kneser_ney, language_crf, mixture, pii, quality_model, repetition_rules,
               suffix_dedup, toxicity, vector_codes)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules.repetition_rules(documents(spark, sf_dir))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_texts(documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))
    base = ("email", "ip", "card", "phone")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(joined(of(*base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "spans")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_crf.identify_language(documents(spark, sf_dir))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "held_out", "score", "predicted", "spans")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_substring_dedup, op3_jaccard_join, op4_quality_classifier, op5_quality_rules, op6_lm_scoring,
    op7_pii, op8_decontamination, op9_language_id, op10_mix_sources, op11_vector_codes, op12_importance_resampling, op13_toxicity)}

ORACLES: dict[str, str] = {"op10_mix_sources": mixture.ORACLE, "op11_vector_codes": vector_codes.ORACLE, "op12_importance_resampling": importance.ORACLE}
