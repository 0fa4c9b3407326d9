"""Joins with the last earlier row: the value known at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeworks.operators.joins import BROADCAST_BYTES, HotKeys, skew_left_join
from lakeworks.session import durable, shuffle_partitions

_ASKED = 1


def carry_forward(rows: DataFrame, key: str, order: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """``rows`` with nulls of ``value`` replaced by the last one before, along ``order`` within ``key``.

    Rows are dealt by ranges of (key, order), so a key with most of the rows is cut into many ranges. Each range is
    filled by itself; the last value of each range of a key (as many rows as there are ranges) is then handed on to
    the ranges that follow.
    """
    parts = parts or shuffle_partitions(rows.sparkSession)
    dealt = durable(rows.repartitionByRange(parts, key, *order).withColumn("_part", F.spark_partition_id()))
    upto = W.partitionBy("_part", key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    present = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = dealt.groupBy(key, "_part").agg(F.max_by(value, present).alias("_end"))
    before = W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(key, "_part", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    filled = dealt.withColumn(value, F.last(value, ignorenulls=True).over(upto)).join(carried, [key, "_part"], "left")
    return filled.withColumn(value, F.coalesce(value, "_carried")).drop("_carried", "_part")


def known_at(asked: DataFrame, known: DataFrame, key: str, time: str, values: Sequence[str], parts: int | None = None) -> DataFrame:
    """Each different (key, time) of ``asked`` with the values of the last row of ``known`` at or before it.

    Of several known rows at one time the greatest values count. Nulls of key or time are left out on both sides.
    """
    there = F.col(key).isNotNull() & F.col(time).isNotNull()
    questions = asked.where(there).select(key, time).distinct().withColumn("_kind", F.lit(_ASKED))
    latest = known.where(there).groupBy(key, time).agg(F.max(F.struct(*values)).alias("_known"))
    # At equal times what is known comes first.
    events = latest.withColumn("_kind", F.lit(0)).unionByName(questions, allowMissingColumns=True)
    filled = carry_forward(events, key, [time, "_kind"], "_known", parts)
    return filled.where(F.col("_kind") == _ASKED).select(key, time, *[F.col(f"_known.{v}").alias(v) for v in values])


def _small(df: DataFrame) -> bool:
    """Whether a settled frame of fixed-width columns and short keys fits a broadcast, by counted rows."""
    return df.count() * df._jdf.schema().defaultSize() <= BROADCAST_BYTES


def as_of_join(
    left: DataFrame, right: DataFrame, key: str, left_time: Column, right_time: Column, values: Sequence[str], parts: int | None = None
) -> DataFrame:
    """``left`` with the ``values`` of the last ``right`` row of its key at or before its time; null without one.

    One row per left row, in a table that may be far wider than what is asked: only its different (key, time) pairs are
    sorted and matched, and the answers joined back. ``left`` carries a row slot (see ``skew_left_join``), by which
    pairs that hold many rows are spread. Rows of ``left`` with null key or time are kept without values.
    """
    timed = left.withColumn("_time", left_time)
    answers = known_at(timed, right.withColumn("_time", right_time), key, "_time", values, parts)
    pair = F.when(F.col(key).isNotNull() & F.col("_time").isNotNull(), F.struct(key, "_time"))
    looked_up = durable(answers.select(pair.alias("_pair"), *values))
    rows = timed.withColumn("_pair", pair)
    if _small(looked_up):
        joined = rows.join(F.broadcast(looked_up), "_pair", "left")
    else:
        hot = HotKeys(rows, "_pair", parts=parts)
        joined = skew_left_join(rows, looked_up, "_pair", parts=parts, hot_left=hot, unique_right=True, broadcast=False)
    return joined.drop("_pair", "_time")
