"""The pitch study: cleaning, features, tests of seven hypotheses and plot numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators import distribution, inference, profile
from lakeworks.operators.profile import melt

# Names looked for among the investors of a pitch.
INVESTORS = ["Barbara", "Kevin", "Mark", "Lori", "Robert", "Daymond"]

# Features correlated with the outcome.
CORRELATED = [
    "askedfor",
    "exchangeforstake",
    "valuation",
    "season",
    "multiple_entreprenuers",
    "has_website",
    "valuation_ask_ratio",
    "log_askedfor",
    "log_valuation",
]

# Season groups, each up to the named season; later or unknown seasons are the last.
SEASON_GROUPS = {2: "Early (S1-S2)", 4: "Mid (S3-S4)"}
LAST_SEASON_GROUP = "Late (S5-S6)"

# The seven hypotheses and how each is tested.
HYPOTHESES = [
    ("H1", "Lower equity asked → Higher deal rate", "Manual T-test"),
    ("H2", "Lower valuation/ask ratio → Higher deal rate", "Manual T-test"),
    ("H3", "Category affects deal success", "Group rate comparison"),
    ("H4", "Multiple entrepreneurs → More deals", "Rate comparison"),
    ("H5", "Website presence → More deals", "Rate comparison"),
    ("H6", "Lower amount asked → Higher deal rate", "Manual T-test"),
    ("H7", "Season affects deal rate", "Season-wise grouping"),
]

MONEY = ("askedfor", "exchangeforstake", "valuation")
SHARKS = ["shark1", "shark2", "shark3", "shark4", "shark5"]
# What the second study asks of a row; a pitch without a stake counts there.
SECOND_REQUIRED = ("deal", "askedfor", "valuation")
TESTED = ["exchangeforstake", "valuation_ask_ratio", "askedfor"]
NUMERIC = ["askedfor", "exchangeforstake", "valuation", "season", "has_website"]


def flag_from_text(value: Column) -> Column:
    """TRUE/FALSE in any case to 1/0; anything else to null."""
    word = F.upper(value.cast("string"))
    return F.when(word == "TRUE", 1).when(word == "FALSE", 0)


def clean(raw: DataFrame, required: Sequence[str] = ("deal", *MONEY)) -> DataFrame:
    """Outcome and team flags as 0/1, no description, no row with a required value missing."""
    flags = {name: flag_from_text(F.col(name)) for name in ("deal", "multiple_entreprenuers")}
    return raw.drop("description").withColumns(flags).dropna(subset=list(required))


def complete_rows(raw: DataFrame) -> DataFrame:
    """Rows without any null (columns that are null throughout would leave none)."""
    return raw.dropna("any")


def season_group(season: Column) -> Column:
    groups = iter(SEASON_GROUPS.items())
    last, label = next(groups)
    chain = F.when(season <= last, label)
    for last, label in groups:
        chain = chain.when(season <= last, label)
    return chain.otherwise(LAST_SEASON_GROUP)


def with_features(cleaned: DataFrame) -> DataFrame:
    asked, worth = F.col("askedfor"), F.col("valuation")
    return cleaned.withColumns(
        {
            "investment_ratio": F.try_divide(asked, worth),
            "valuation_ask_ratio": F.try_divide(worth, asked),
            "log_askedfor": F.log1p(asked),
            "log_valuation": F.log1p(worth),
            "season_group": season_group(F.col("season")),
            "all_sharks": F.concat_ws(",", *SHARKS),
        }
    )


def rate_by_investor(features: DataFrame, names: Sequence[str] = INVESTORS) -> DataFrame:
    """Success rate of the pitches each investor took part in, all names in one pass."""
    text = F.lower(F.coalesce("all_sharks", F.lit("")))
    rates = features.agg(*[inference.mean_where(F.col("deal"), text.contains(n.lower())).alias(n) for n in names])
    return melt(rates, {n: F.col(n) for n in names}, [], "investor", "success_rate")


def category_rates(features: DataFrame) -> DataFrame:
    return profile.rate_by(features, "category", "deal").orderBy(F.desc("deal_rate_pct"), "category")


def season_rates(features: DataFrame) -> DataFrame:
    return profile.rate_by(features, "season", "deal").select("season", "deal_rate_pct", "total_pitches").orderBy("season")


def season_extremes(features: DataFrame) -> DataFrame:
    return profile.rate_extremes(profile.rate_by(features, "season", "deal"), "season")


def ratio_by_outcome(features: DataFrame) -> DataFrame:
    """Mean asked-to-valuation ratio of funded and unfunded pitches."""
    ratio, deal = F.col("investment_ratio"), F.col("deal")
    return features.agg(
        inference.mean_where(ratio, deal == 1).alias("success_ratio"),
        inference.mean_where(ratio, deal == 0).alias("failure_ratio"),
    )


def t_tests(features: DataFrame) -> DataFrame:
    return inference.t_tests(features, TESTED, "deal")


def rate_comparisons(features: DataFrame) -> DataFrame:
    return inference.rate_comparisons(features, ["multiple_entreprenuers", "has_website"], "deal")


def range_tests(features: DataFrame) -> DataFrame:
    """Category and season ranges; the category verdict stands whatever the range is."""
    extremes = {
        key: profile.rate_extremes(profile.rate_by(features, key, "deal"), key) for key in ("category", "season")
    }
    return inference.range_verdicts(extremes, always=["category"])


def correlations(features: DataFrame) -> DataFrame:
    return inference.correlations(features, CORRELATED, "deal")


def hypothesis_summary(features: DataFrame) -> DataFrame:
    """The seven hypotheses with their computed verdicts."""
    tests = t_tests(features).select(F.col("feature").alias("subject"), F.col("t_statistic").alias("measure"), "significant")
    rates = rate_comparisons(features).select("factor", "difference", "meaningful").toDF(*tests.columns)
    ranges = range_tests(features).select("grouping", "rate_range", "significant").toDF(*tests.columns)
    results = tests.unionByName(rates).unionByName(ranges)
    subjects = [
        "exchangeforstake",
        "valuation_ask_ratio",
        "category",
        "multiple_entreprenuers",
        "has_website",
        "askedfor",
        "season",
    ]
    number, text, test = (
        F.create_map(*[x for s, h in zip(subjects, HYPOTHESES) for x in (F.lit(s), F.lit(h[i]))])[F.col("subject")]
        for i in range(3)
    )
    verdict = F.when(F.col("significant"), "difference found").otherwise("no clear difference")
    return results.select(
        number.alias("no"), text.alias("hypothesis"), test.alias("test_used"), "measure", verdict.alias("result")
    ).orderBy("no")


def by_series(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, deal, x) rows for plots by outcome."""
    return melt(features, {c: F.col(c).cast("double") for c in columns}, ["deal"], "feature", "x")


def histograms(features: DataFrame) -> DataFrame:
    return distribution.histogram(by_series(features, ["exchangeforstake", "investment_ratio"]), ["feature", "deal"], "x")


def ratio_histogram(features: DataFrame) -> DataFrame:
    """The asked-to-valuation ratio over all pitches."""
    rows = melt(features, {"investment_ratio": F.col("investment_ratio")}, [], "feature", "x")
    return distribution.histogram(rows, ["feature"], "x")


BOXED = ["askedfor", "valuation_ask_ratio", "investment_ratio"]


def box_plots(features: DataFrame) -> DataFrame:
    return distribution.box_numbers(by_series(features, BOXED), ["feature", "deal"], "x")


def ratio_box(features: DataFrame) -> DataFrame:
    """Box numbers of the asked-to-valuation ratio over all pitches."""
    rows = melt(features, {"investment_ratio": F.col("investment_ratio")}, [], "feature", "x")
    return distribution.box_numbers(rows, ["feature"], "x")


def box_outliers(features: DataFrame) -> DataFrame:
    return distribution.outliers(by_series(features, BOXED), ["feature", "deal"], "x")


def scatter_points(features: DataFrame) -> DataFrame:
    return features.select("valuation", "deal")
