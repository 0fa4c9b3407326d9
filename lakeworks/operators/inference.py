"""Group comparisons and linear relations as single-pass aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.profile import melt
from lakeworks.operators.ranks import positional_split

# Decision limits of the three tests.
T_LIMIT = 2.0
RATE_GAP_POINTS = 5.0
RANGE_POINTS = 10.0


def mean_where(value: Column, condition: Column) -> Column:
    """Mean of ``value`` over the rows that meet a condition."""
    return F.avg(F.when(condition, value))


def t_tests(df: DataFrame, features: Sequence[str], outcome: str) -> DataFrame:
    """Two-sample t statistic with unequal variances per feature, between outcome 1 and 0.

    All features come from one aggregate. The group sizes count every row of the group, as the
    means' standard error is taken over the whole group.
    """
    groups = {"yes": F.col(outcome) == 1, "no": F.col(outcome) == 0}
    sizes = {side: F.count_if(test) for side, test in groups.items()}
    stats = df.agg(
        *[
            F.struct(
                *[mean_where(F.col(f), test).alias(f"mean_{side}") for side, test in groups.items()],
                *[F.stddev_samp(F.when(test, F.col(f))).alias(f"std_{side}") for side, test in groups.items()],
                *[sizes[side].alias(f"n_{side}") for side in groups],
            ).alias(f)
            for f in features
        ]
    )
    rows = melt(stats, {f: F.col(f) for f in features}, [], "feature", "s").select("feature", "s.*")
    error = F.sqrt(
        F.try_divide(F.pow("std_yes", F.lit(2)), F.col("n_yes")) + F.try_divide(F.pow("std_no", F.lit(2)), F.col("n_no"))
    )
    t = F.try_divide(F.col("mean_yes") - F.col("mean_no"), error)
    return rows.select(
        "feature",
        "mean_yes",
        "n_yes",
        "mean_no",
        "n_no",
        t.alias("t_statistic"),
        F.coalesce(F.abs(t) > T_LIMIT, F.lit(False)).alias("significant"),
    )


def rate_comparisons(df: DataFrame, factors: Sequence[str], outcome: str) -> DataFrame:
    """Percent of positive outcomes with a 0/1 factor off and on; meaningful beyond five points."""
    rates = df.agg(
        *[
            F.struct(
                (mean_where(F.col(outcome), F.col(f) == 0) * 100).alias("rate_off"),
                (mean_where(F.col(outcome), F.col(f) == 1) * 100).alias("rate_on"),
            ).alias(f)
            for f in factors
        ]
    )
    gap = F.abs(F.col("rate_on") - F.col("rate_off"))
    return melt(rates, {f: F.col(f) for f in factors}, [], "factor", "r").select(
        "factor",
        F.col("r.rate_off").alias("rate_off"),
        F.col("r.rate_on").alias("rate_on"),
    ).withColumns({"difference": gap, "meaningful": F.coalesce(gap > RATE_GAP_POINTS, F.lit(False))})


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present; null for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the target, strongest first; one aggregate for all."""
    row = df.agg(*[F.round(correlation(F.col(f), F.col(target)), 4).alias(f) for f in features])
    sign = F.when(F.col("correlation") >= 0, "positive").otherwise("negative")
    listed = melt(row, {f: F.col(f) for f in features}, [], "feature", "correlation")
    return listed.withColumn("direction", sign).orderBy(F.abs("correlation").desc(), "feature")


def line_fits(train: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One least-squares line per feature: slope and intercept, one aggregate for all."""
    y = F.col(target).cast("double")
    fits = train.agg(
        *[
            F.struct(
                F.try_divide(F.covar_pop(x, y), F.var_pop(x)).alias("slope"),
                F.avg(x).alias("x_mean"),
                F.avg(y).alias("y_mean"),
            ).alias(f)
            for f, x in ((f, F.col(f).cast("double")) for f in features)
        ]
    )
    return melt(fits, {f: F.col(f) for f in features}, [], "feature", "fit").select(
        "feature",
        F.col("fit.slope").alias("slope"),
        (F.col("fit.y_mean") - F.col("fit.slope") * F.col("fit.x_mean")).alias("intercept"),
        F.col("fit.x_mean").alias("x_mean"),
    )


def additive_predictions(df: DataFrame, features: Sequence[str], target: str, key: str, fraction: float = 0.7) -> DataFrame:
    """Predict the held-out rows from the per-feature slopes of the leading rows.

    The constant is the target's mean over the whole table less each slope times its training mean.
    The coefficients are one row, attached as a scalar subquery.
    """
    split = positional_split(df, key, fraction)
    y = F.col(target).cast("double")
    model = split.agg(
        F.avg(y).alias("y_mean"),
        *[
            F.struct(
                F.try_divide(F.covar_pop(x, F.when(F.col("is_train"), y)), F.var_pop(x)).alias("slope"),
                F.avg(x).alias("mean"),
            ).alias(f)
            for f, x in ((f, F.when(F.col("is_train"), F.col(f).cast("double"))) for f in features)
        ],
    )
    shift = sum((F.col(f"{f}.slope") * F.col(f"{f}.mean") for f in features), F.lit(0.0))
    fitted = model.select(
        F.struct(
            (F.col("y_mean") - shift).alias("constant"), *[F.col(f"{f}.slope").alias(f) for f in features]
        )
    ).scalar()
    rows = split.filter(~F.col("is_train")).withColumn("_m", fitted)
    value = sum((F.col("_m")[f] * F.col(f) for f in features), F.col("_m")["constant"])
    return rows.select(key, value.alias("prediction"), F.col(target).alias("actual"))


def range_verdicts(extremes: Mapping[str, DataFrame], always: Sequence[str] = ()) -> DataFrame:
    """Range of group rates per grouping; significant beyond ten points, or always where so named."""
    verdicts = [
        df.select(
            F.lit(name).alias("grouping"),
            "max_rate",
            "min_rate",
            "rate_range",
            F.coalesce(F.lit(name in always) | (F.col("rate_range") > RANGE_POINTS), F.lit(False)).alias("significant"),
        )
        for name, df in extremes.items()
    ]
    result = verdicts[0]
    for other in verdicts[1:]:
        result = result.unionByName(other)
    return result
