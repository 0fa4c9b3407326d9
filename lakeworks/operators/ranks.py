"""Exact order statistics without a global sort in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeworks.session import durable, estimated_bytes, shuffle_partitions

# Inputs up to this estimated size use Spark's exact percentile, which holds the distinct values of a
# group in memory; anything larger, or of unknown size, is ranked across range partitions.
IN_MEMORY_BYTES = 8 << 20


def values_at(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    positions: Callable[[Column], Sequence[Column]],
    interpolate: bool = True,
) -> DataFrame:
    """The values at given positions of each group's ascending order, one row per group and position.

    ``positions`` turns the group's row count into 0-based positions; a fractional one is interpolated
    between its neighbours. Without interpolation positions are whole and the value keeps its type.
    Nulls do not count. Result: groups, ``position_no``, ``value``.

    Equal values are folded to one row first. The folded rows are range-partitioned and written to the
    shared folder (partition numbers must not change between the two reads), the partition totals give
    each partition its place, and only partitions that hold a wanted position are read on.
    """
    keys = list(groups) or ["_all"]
    rows = df if groups else df.withColumn("_all", F.lit(0))
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    parts = shuffle_partitions(df.sparkSession)
    ranged = durable(counts.repartitionByRange(parts, *keys, value).withColumn("_part", F.spark_partition_id()))

    by_part = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.groupBy(*keys, "_part").agg(F.sum("n").alias("size")).select(
        *keys,
        "_part",
        "size",
        F.coalesce(F.sum("size").over(by_part), F.lit(0)).alias("before"),
        F.sum("size").over(W.partitionBy(*keys)).alias("total"),
    )
    wanted = [
        F.struct(
            F.lit(no).alias("position_no"),
            side(at).cast("long").alias("rank"),
            (F.lit(1.0) - F.abs(at - side(at))).alias("weight"),
        )
        for no, at in enumerate(positions(F.col("total")))
        for side in (F.floor, F.ceil)
    ]
    here = F.filter(F.array(*wanted), lambda w: (w.rank >= F.col("before")) & (w.rank < F.col("before") + F.col("size")))
    hits = placed.select(*keys, "_part", "before", here.alias("wanted")).filter(F.size("wanted") > 0)

    running = W.partitionBy(*keys, "_part").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hit_{k}")) for k in [*keys, "_part"]])
    renamed = hits.select(*[F.col(k).alias(f"_hit_{k}") for k in [*keys, "_part"]], "before", "wanted")
    found = (
        ranged.join(renamed, same)
        .withColumn("_to", F.col("before") + F.sum("n").over(running))
        .withColumn("w", F.explode("wanted"))
        .filter((F.col("w.rank") < F.col("_to")) & (F.col("w.rank") >= F.col("_to") - F.col("n")))
    )
    # A whole position is listed twice, with weight one each; dividing by the weights covers that.
    mixed = F.sum(F.col(value) * F.col("w.weight")) / F.sum("w.weight")
    result = found.groupBy(*keys, F.col("w.position_no").alias("position_no")).agg(
        (mixed if interpolate else F.max(value)).alias("value")
    )
    return result if groups else result.drop("_all")


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles by linear interpolation, one row per group with an array ``quantiles``."""
    size = estimated_bytes(df)
    if size is not None and size <= IN_MEMORY_BYTES:
        return df.groupBy(*groups).agg(F.percentile(value, list(probabilities)).alias("quantiles"))
    rows = values_at(df, groups, value, lambda n: [(n - 1) * F.lit(p) for p in probabilities])
    # One entry per probability: the list has a fixed length.
    ordered = F.array_sort(F.collect_list(F.struct("position_no", "value")))
    found = F.when(F.size(ordered) > 0, F.transform(ordered, lambda x: x["value"])).alias("quantiles")
    ranged = rows.groupBy(*groups).agg(found)
    if not groups:
        return ranged
    # Groups without any value keep their row, as in the small form.
    own = [F.col(g).alias(f"_{g}") for g in groups]
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups])
    return df.select(*groups).distinct().join(ranged.select(*own, "quantiles"), same, "left").select(*groups, "quantiles")


def positional_split(df: DataFrame, key: str, fraction: float = 0.7) -> DataFrame:
    """Mark the first ``floor(fraction * n)`` rows in ``key`` order as ``is_train``.

    A table has no order of its own, so a unique, non-null order key must be named; others are refused.
    """
    unfit = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    if not unfit.isEmpty():
        raise ValueError(f"{key} repeats or is null, so it does not order the rows")
    first_test = values_at(df, [], key, lambda n: [F.floor(n * F.lit(fraction))], interpolate=False)
    boundary = first_test.select("value").scalar()
    return df.withColumn("is_train", F.coalesce(F.col(key) < boundary, F.lit(True)))


def file_positions(scan: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a Parquet scan from 0 as they stand in its files, files in the order of their paths.

    The place within a file comes with the scan and does not change when a task runs again. One aggregate counts the rows
    of each file, and the rows before a file are added by a broadcast table of one row per file: no row is shuffled.
    """
    place, path = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    placed = scan.select("*", path.alias("_file"), place.alias("_place"))
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    starts = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_file").withColumn(name, F.col("_start") + F.col("_place")).drop("_file", "_place", "_start")


def split_by_file_position(scan: DataFrame, fraction: float = 0.7) -> DataFrame:
    """Mark the first ``floor(fraction * n)`` rows of a Parquet scan, as stored, as ``is_train``: no key is needed."""
    first_test = math.floor(fraction * scan.count())
    return file_positions(scan, "_position").withColumn("is_train", F.col("_position") < first_test).drop("_position")
