"""The stages of the pipeline. Each takes (spark, docs, sf_dir) and decides on all of ``docs``.

All but the last return rows of ``docs`` with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import catalogue, exact_dedup, jaccard_join, mixing, packing, quality_classifier


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, catalogue.read(spark, sf_dir, "labels"))
    return quality_classifier.good_documents(docs, model)


def first_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs, exact_dedup.exact_dedup(docs, spark))


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, jaccard_join.near_components(docs, spark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, mixing.mix(docs, spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, spark, catalogue.tokenizer("word_bpe_49k.json"))
