"""The pipeline over ``documents``: quality, exact copies, near copies, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import catalogue, stages
from tallymart.llm.common import staged

STAGES = [
    ("quality classifier", stages.good_quality),
    ("exact dedup", stages.first_of_copies),
    ("n-gram Jaccard join", stages.first_of_near_copies),
    ("mixing sources to target weights", stages.mixed),
    ("best-fit packing", stages.packed),
]

#: Trained scores and random draws have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    docs = catalogue.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"), spark)
    return docs
