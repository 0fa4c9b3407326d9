"""Proportional stratified interleaving: every shard holds the corpus mixture of sources.

Rows are put in a seeded random order within each source, the row at rank r of n gets the fraction (r + u) / n with a
seeded u of its source between 0 and 1 (so that sources of equal size do not fall together), all rows are sorted by
fraction, and the sorted list is cut into shards of equal row counts (at most one apart). A cut is
a window of fractions, so it holds each source in its share, up to one row.

Defined results: a null text has size 8 and the checksum of no bytes (0); null sources form a source of their own; a
null id takes part like any other; repeated rows are separate rows; an empty table gives an empty result. Equal texts
are not kept together, since the law is on row counts. Other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import rank_buckets, ranked

ROW_BYTES = 8


def shard(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot (from 0, gapless in a shard), and the columns in ``carry``."""
    spark, n = docs.sparkSession, docs.count()
    body = F.coalesce(F.col(text), F.lit(""))
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_source"),
        F.substring(F.md5(label), 1, 16).alias("_draw"),
        *[F.col(c).alias(f"_carry_{c}") for c in carry],
    )
    buckets = rank_buckets(spark, n)
    ties = [F.col(c) for c in ("_draw", "doc_id", "text_crc32", "size")]
    share = F.conv(F.substring("_draw", 1, 7), 16, 10).cast("long")
    within = ranked(rows, ["_source"], F.floor(share * buckets / (1 << 28)), ties, "_rank")
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "_source")), 1, 7), 16, 10).cast("long")
    placed = within.withColumn("_fraction", (F.col("_rank") + (draw + 0.5) / (1 << 28)) / F.col("_rank_total"))
    total = ranked(
        placed, [], F.floor(F.col("_fraction") * buckets), [F.col("_fraction"), F.col("_source"), *ties], "_at"
    )
    cut = total.withColumn("shard", F.expr(f"_at * {shards} div _at_total"))
    start = F.expr(f"(shard * _at_total + {shards - 1}) div {shards}")
    return cut.select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("_at") - start).alias("slot"), *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )


def write_shards(docs: DataFrame, path: str, shards: int, **options: object) -> None:
    """Write one folder per shard, rows in slot order; a shard of any size is spread over several tasks and files."""
    others = [c for c in docs.columns if c not in ("doc_id", "source", "shard", "slot", "size", "text_crc32")]
    rows = shard(docs, shards, carry=others, **options)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(
        path
    )
