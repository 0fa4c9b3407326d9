"""Profiles of a table: gaps, value counts, rates and summary statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.ranks import quantiles


def melt(df: DataFrame, columns: Mapping[str, Column], keep: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per input row and named expression: ``keep``, ``name``, ``value``."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), c.alias(value)) for k, c in columns.items()])
    return df.select(*keep, F.inline(pairs))


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and percent per column, only for columns that have nulls; one pass."""
    gaps = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns]
    )
    listed = melt(gaps, {name: F.col(name) for name in df.columns}, ["_rows"], "column_name", "missing_count")
    return listed.filter(F.col("missing_count") > 0).select(
        "column_name",
        "missing_count",
        F.round(F.col("missing_count") * 100 / F.col("_rows"), 2).alias("missing_pct"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), column)


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with each class's percent of all counted rows."""
    total = df.agg(F.count(column)).scalar()
    return value_counts(df, column).withColumn("share_pct", F.round(F.col("n_rows") * 100 / total, 2))


def overall_rate(df: DataFrame, outcome: str) -> DataFrame:
    """Row count, positives, the rest, and the success percent, also as text."""
    total, hits = F.count(F.lit(1)), F.sum(F.col(outcome).cast("int"))
    percent = F.round(F.try_divide(hits * 100, total), 2)
    return df.agg(
        total.alias("total"),
        hits.alias("deals"),
        (total - hits).alias("no_deals"),
        percent.alias("success_pct"),
        F.when(percent.isNotNull(), F.format_string("%.2f%%", percent)).alias("success_text"),
    )


def rate_by(df: DataFrame, key: str, outcome: str) -> DataFrame:
    """Mean and count of a 0/1 outcome per key, percent rounded; rows without key are left out."""
    rate = F.avg(outcome)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            rate.alias("deal_rate"),
            F.count(outcome).alias("total_pitches"),
            F.round(rate * 100, 2).alias("deal_rate_pct"),
        )
    )


def top_rates(df: DataFrame, key: str, outcome: str, k: int = 5) -> DataFrame:
    return rate_by(df, key, outcome).select(key, "deal_rate").orderBy(F.desc("deal_rate"), key).limit(k)


def rate_extremes(rates: DataFrame, key: str, rate: str = "deal_rate_pct") -> DataFrame:
    """Highest and lowest rate, their keys (the first key on ties) and the range.

    ``max_by`` leaves ties open, so the key is part of what is compared.
    """
    # The smallest (-rate, key) and (rate, key): both put the first key first on ties.
    best = F.min(F.struct((-F.col(rate)).alias("r"), F.col(key).alias("k")))
    worst = F.min(F.struct(F.col(rate).alias("r"), F.col(key).alias("k")))
    return rates.agg(
        F.max(rate).alias("max_rate"),
        best["k"].alias("max_key"),
        F.min(rate).alias("min_rate"),
        worst["k"].alias("min_key"),
        F.round(F.max(rate) - F.min(rate), 2).alias("rate_range"),
    )


def against_average(df: DataFrame, key: str, outcome: str) -> DataFrame:
    """Each group's percent with its class against the overall rate (of all rows)."""
    average = df.agg(F.avg(outcome) * 100).scalar()
    percent = (F.col("deal_rate") * 100).alias("rate_pct")
    label = F.when(F.col("deal_rate") * 100 >= average, "Above Average").otherwise("Below Average")
    return rate_by(df, key, outcome).select(key, percent, label.alias("class")).orderBy("rate_pct", key)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    values = melt(df, {c: F.col(c).cast("double") for c in columns}, [], "column_name", "x").filter(F.col("x").isNotNull())
    basic = values.groupBy("column_name").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    cuts = quantiles(values, ["column_name"], "x", [0.25, 0.5, 0.75])
    return basic.join(cuts, "column_name").select(
        "column_name",
        "n",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("q25"),
        F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
        "max",
    )
