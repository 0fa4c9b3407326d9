"""The numbers behind histograms and box plots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.ranks import quantiles

BINS = 20
WHISKER = 1.5


def _edge(number: Column, bins: int) -> Column:
    """Lower edge of a bin; the edge past the last bin is the maximum itself."""
    step = (F.col("hi") - F.col("lo")) / bins
    return F.when(number >= bins, F.col("hi")).otherwise(F.col("lo") + number * step)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where nulls match; the columns of ``left`` and those of ``right`` beside the keys."""
    other = right.withColumnsRenamed({k: f"_{k}_" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in keys])
    return left.join(other, same, how).drop(*[f"_{k}_" for k in keys])


def histogram(df: DataFrame, series: Sequence[str], value: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins between each series' own minimum and maximum, the last bin closed.

    ``series`` names few groups of fixed number (a feature list, a 0/1 outcome), which bounds the
    broadcast range table. Empty bins are listed with count 0. A constant series gets a width of one, and rows whose
    series is null form a series of their own.
    """
    keys = list(series)
    rows = df.filter(F.col(value).isNotNull())
    spans = rows.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    spans = spans.select(
        *keys,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    guess = F.least(
        F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)
    ).cast("int")
    # Rounding may put a value one bin off its edges; the edges decide.
    step_back = (F.col(value) < _edge(F.col("guess"), bins)).cast("int")
    step_on = ((F.col("guess") < bins - 1) & (F.col(value) >= _edge(F.col("guess") + 1, bins))).cast("int")
    counts = (
        rows.select(*keys, value)
        .transform(lambda r: _null_safe(r, spans, keys))
        .withColumn("guess", guess)
        .groupBy(*keys, (F.col("guess") - step_back + step_on).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    # At most ``bins`` rows per series on either side.
    return _null_safe(grid, counts, [*keys, "bin"], "left").select(
        *keys,
        (F.col("bin") + 1).alias("bin"),
        _edge(F.col("bin"), bins).alias("lower_edge"),
        _edge(F.col("bin") + 1, bins).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("n_rows"),
    )


def _with_fences(df: DataFrame, series: Sequence[str], value: str) -> DataFrame:
    """Rows with their series' quartiles and fences; one row per series to join with."""
    cuts = quantiles(df, series, value, [0.25, 0.5, 0.75])
    q1, q2, q3 = (F.col("quantiles")[i] for i in range(3))
    reach = WHISKER * (q3 - q1)
    fences = cuts.select(
        *series,
        q1.alias("q1"),
        q2.alias("median"),
        q3.alias("q3"),
        (q1 - reach).alias("low_fence"),
        (q3 + reach).alias("high_fence"),
    )
    return _null_safe(df.filter(F.col(value).isNotNull()), fences, list(series))


def box_numbers(df: DataFrame, series: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 quartile ranges, and outlier counts."""
    x = F.col(value)
    within = x.between(F.col("low_fence"), F.col("high_fence"))
    return _with_fences(df, series, value).groupBy(*series, "q1", "median", "q3").agg(
        F.min(F.when(within, x)).alias("whisker_low"),
        F.max(F.when(within, x)).alias("whisker_high"),
        F.count_if(~within).alias("n_outliers"),
    )


def outliers(df: DataFrame, series: Sequence[str], value: str) -> DataFrame:
    """The rows beyond the whiskers."""
    rows = _with_fences(df, series, value).select(*df.columns, "low_fence", "high_fence")
    return rows.filter(~F.col(value).between(F.col("low_fence"), F.col("high_fence"))).drop("low_fence", "high_fence")
