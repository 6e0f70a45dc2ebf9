"""A training corpus in five stages: toxicity, quality rules, near duplicates, repeated substrings, packing.

Each stage takes the documents that the one before kept, as written Parquet, and gives documents; the last gives pieces of
packed windows. `run` is registered as query `pipeline`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsearch.llm.chunk_dedup import remove_repeats
from catalogsearch.llm.jaccard_join import first_of_groups
from catalogsearch.llm.line_quality import kept_documents
from catalogsearch.llm.packing import pack_documents
from catalogsearch.llm.shared import table, written
from catalogsearch.llm.toxicity import clean_documents


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic (operator 5)."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without boilerplate lines (operator 8)."""
    kept = kept_documents(docs)
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates (operator 4)."""
    return first_of_groups(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has (operator 6)."""
    cut = remove_repeats(docs.withColumnRenamed("n_chars", "old_chars"))
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("bigint").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in packed windows (operator 3)."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("packing", packing_stage),
]

#: Trees, MinHash and a tokenizer are not SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
