"""Stored results and pipeline stages are written as few files, however many partitions they have, if they read little."""

import corpus_pipeline
from lakeworks.llm import common


def most_files(spark):
    return 4 * spark.sparkContext.defaultParallelism


def test_stored_in_few_files(spark):
    rows = spark.range(0, 3000, 1, 150)
    kept = common.stored(rows)
    assert len(kept.inputFiles()) <= most_files(spark) < 150
    assert sorted(r["id"] for r in kept.collect()) == list(range(3000))


def test_stage_in_few_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(150)
    left = corpus_pipeline.good_quality(spark, docs, small)
    assert left.rdd.getNumPartitions() <= most_files(spark)
    assert left.count() > 0


def test_much_input_keeps_its_partitions(spark, monkeypatch):
    monkeypatch.setattr(common, "FILE_BYTES", 80)  # a row of range has 8 bytes
    rows = spark.range(0, 3000, 1, 150)
    assert common.few_files(rows).rdd.getNumPartitions() == 150
    assert common.few_files(rows.union(rows)).rdd.getNumPartitions() == 300
    assert common.few_files(spark.range(0, 300, 1, 150)).rdd.getNumPartitions() == 30
