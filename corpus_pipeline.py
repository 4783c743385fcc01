"""The corpus pipeline: quality rules, near duplicates, benchmark
decontamination, pseudonyms, packing.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame that is written as Parquet and read again as the next one's docs.
``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm import decontaminate, packing, pseudonyms, quality, simhash_dedup
from layerkit.llm.common import stage, table
from layerkit.llm.queries import DEMO_KEY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers and dates get pseudonyms; every document stays."""
    return pseudonyms.pseudonymize(docs, DEMO_KEY)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in their bins."""
    return packing.pack(docs, packing.word_lengths(F.col("text")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_values", private_values),
    ("best_fit_packing", best_fit),
]

# SimHash components, sequential packing and keyed permutations are beyond
# SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
