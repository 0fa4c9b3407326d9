"""The registered queries of this subpackage, with production parameters, and their statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import (
    decontaminate, factors, licenses, linededup, merkle, neighbours, packing, periods, quality, sharding, simhash, substrings, toxicity,
)
from lakeworks.llm.common import table

SHARDS = 24
NEIGHBOURS = 20
QUERY_STEP = 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    n_spans = (F.size("bounds") / 2).cast("long").alias("n_spans")
    return rows.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.length("text").alias("kept_chars"), F.crc32("text").alias("kept_crc32"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, NEIGHBOURS
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.duplicate_spans(table(spark, sf_dir, "documents")).drop("bounds")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.Manifest(table(spark, sf_dir, "documents"), claimed=merkle.tampered_leaf()).proofs()


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_substrings": op6_substrings,
    "op7_lines": op7_lines,
    "op8_neighbours": op8_neighbours,
    "op9_licenses": op9_licenses,
    "op10_toxicity": op10_toxicity,
    "op11_factors": op11_factors,
    "op12_manifest": op12_manifest,
    "op13_periods": op13_periods,
}

ORACLES: dict[str, str] = {}
