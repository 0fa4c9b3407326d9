"""Corpus pipeline: from raw documents to packed training windows, one operator per stage.

Each stage takes (spark, docs, sf_dir), works on every document its predecessor kept, and its result is written as
few Parquet files and read again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import decontaminate, linededup, packing, quality, simhash
from lakeworks.llm.common import few_files, free_name, stored, table
from lakeworks.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    return few_files(quality.keep_good(docs, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks an earlier document holds; a document that loses all its lines goes."""
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    rows = linededup.dedup_lines(docs, n_lines=n_lines, n_removed=n_removed)
    changed = F.col(n_removed) > 0
    kept = rows.where(~F.coalesce(changed & (F.trim("text") == ""), F.lit(False)))
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return few_files(kept.withColumn("n_chars", n_chars).select(*docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (four-word shingles, at most four differing bits): the smallest id."""
    return few_files(simhash.one_of_each(docs))


def without_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return few_files(decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with little padding."""
    return few_files(packing.pack_documents(docs, tokenizer_path()))


STAGES = [
    ("quality", good_quality),
    ("line dedup", without_repeated_lines),
    ("near duplicates", one_of_each_group),
    ("decontamination", without_benchmark_items),
    ("packing", packed),
]

#: Tokens, fingerprints and the fitted classifier are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
