import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeworks.operators import distribution, inference, profile, ranks
from lakeworks.plans import medallion
from lakeworks.plans import pitches as study
from lakeworks.sources import views


@pytest.fixture(scope="module")
def features(spark, small):
    return study.with_features(study.clean(views.view(spark, small, "pitches"))).cache()


@pytest.fixture(scope="module")
def frame(features):
    return features.toPandas()


@pytest.fixture(params=["in memory", "ranged"])
def limit(request, monkeypatch):
    monkeypatch.setattr(ranks, "IN_MEMORY_BYTES", 1 << 60 if request.param == "in memory" else -1)


def test_study_builds_no_commerce_layer(spark, small):
    """The pitches are landed alone; the commerce layers come when a commerce query asks for them."""
    rows = medallion.pitches_of_given_tables(spark, f"{small}/")  # a run of its own
    assert rows.count() == views.view(spark, small, "pitches").count()
    run, built = medallion._runs[spark.sparkContext.applicationId, f"{small}/"]
    assert built == {"pitches"}
    assert [t.name for layer in run.layers.values() for t in spark.catalog.listTables(layer) if not t.isTemporary] == ["pitches"]


def test_quantiles_match_numpy(spark, limit):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(size=700), np.full(400, 1.5), rng.normal(size=33)])
    pdf = pd.DataFrame({"g": np.arange(len(x)) % 3, "x": x})
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([(0, None)], "g long, x double"))
    got = {r.g: r.quantiles for r in ranks.quantiles(df, ["g"], "x", probabilities).collect()}
    assert set(got) == {0, 1, 2}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx(np.quantile(part.x, probabilities))


def test_quantiles_of_one_row_and_one_value(spark, limit):
    df = spark.createDataFrame([("a", 4.0), ("b", 2.0), ("b", 2.0)], "g string, x double")
    got = {r.g: r.quantiles for r in ranks.quantiles(df, ["g"], "x", [0.25, 0.5]).collect()}
    assert got == {"a": [4.0, 4.0], "b": [2.0, 2.0]}


@pytest.mark.parametrize("n", [1, 2, 6, 10, 101])
def test_split_takes_the_leading_rows(spark, n):
    keys = [(2**60 + i * 3,) for i in reversed(range(n))]
    out = ranks.positional_split(spark.createDataFrame(keys, "k long"), "k").orderBy("k").collect()
    assert [r.is_train for r in out] == [i < int(np.floor(0.7 * n)) for i in range(n)]


def test_cleaning_and_features(spark):
    df = spark.createDataFrame(
        [(1, "true", "FALSE", "d", 10.0, 5.0, 20.0, 2), (2, "maybe", "True", "d", 1.0, 1.0, 1.0, 3), (3, "False", "True", "d", None, 1.0, 1.0, 9)],
        "pitch_id long, deal string, multiple_entreprenuers string, description string, askedfor double, exchangeforstake double, valuation double, season int",
    ).withColumns({s: F.lit(None).cast("string") for s in study.SHARKS})
    out = study.with_features(study.clean(df)).collect()
    assert [(r.pitch_id, r.deal, r.multiple_entreprenuers, r.investment_ratio, r.valuation_ask_ratio) for r in out] == [(1, 1, 0, 0.5, 2.0)]
    assert "description" not in out[0].asDict() and out[0].all_sharks == ""


def test_season_groups(spark):
    df = spark.createDataFrame([(s,) for s in (1, 2, 3, 4, 5, 7, None)], "season int")
    labels = [r[0] for r in df.select(study.season_group(F.col("season"))).collect()]
    assert labels == ["Early (S1-S2)"] * 2 + ["Mid (S3-S4)"] * 2 + ["Late (S5-S6)"] * 3


def test_t_tests_match_pandas(features, frame):
    got = {r.feature: r for r in study.t_tests(features).collect()}
    yes, no = frame[frame.deal == 1], frame[frame.deal == 0]
    for f in study.TESTED:
        t = (yes[f].mean() - no[f].mean()) / np.sqrt(yes[f].std() ** 2 / len(yes) + no[f].std() ** 2 / len(no))
        assert got[f].t_statistic == pytest.approx(t) and got[f].significant == (abs(t) > 2)
        assert (got[f].n_yes, got[f].n_no) == (len(yes), len(no))


def test_t_test_of_constant_feature_has_no_statistic(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (0, 2.0), (0, 2.0)], "deal int, x double")
    (row,) = inference.t_tests(df, ["x"], "deal").collect()
    assert row.t_statistic is None and row.significant is False


def test_correlations_match_pandas(features, frame):
    got = {r.feature: r.correlation for r in study.correlations(features).collect()}
    for f in study.CORRELATED:
        assert got[f] == pytest.approx(frame[[f, "deal"]].dropna().corr().loc[f, "deal"], abs=6e-5)
    strength = [abs(r.correlation) for r in study.correlations(features).collect()]
    assert strength == sorted(strength, reverse=True)


def test_correlation_uses_complete_pairs_and_guards_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (None, 1.0, 5.0), (5.0, 1.0, 5.0)], "x double, y double, c double")
    both, constant = df.agg(inference.correlation(F.col("x"), F.col("y")), inference.correlation(F.col("x"), F.col("c"))).collect()[0]
    assert both == pytest.approx(np.corrcoef([1, 3, 5], [2, 5, 1])[0, 1]) and constant is None


def test_rates_by_group_leave_out_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], "category string, deal int")
    assert [tuple(r) for r in profile.rate_by(df, "category", "deal").orderBy("category").collect()] == [("a", 0.5, 2, 50.0), ("b", 1.0, 1, 100.0)]
    assert [(r.category, r["class"]) for r in profile.against_average(df, "category", "deal").collect()] == [("a", "Above Average"), ("b", "Above Average")]


def test_extremes_take_the_first_key_on_ties(spark):
    df = spark.createDataFrame([(3, 10.0), (1, 10.0), (2, 4.0), (5, 4.0)], "season int, deal_rate_pct double")
    assert tuple(profile.rate_extremes(df, "season").collect()[0]) == (10.0, 1, 4.0, 2, 6.0)


def test_investor_names_match_in_any_case(spark):
    df = spark.createDataFrame([("mark cuban,LORI Greiner", 1), ("Mark", 0), ("", 1), (None, 1)], "all_sharks string, deal int")
    got = {r.investor: r.success_rate for r in study.rate_by_investor(df).collect()}
    assert got == {"Mark": 0.5, "Lori": 1.0, "Barbara": None, "Kevin": None, "Robert": None, "Daymond": None}


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (None, "b", "x")], "a int, b string, c string")
    assert sorted(map(tuple, profile.missing_profile(df).collect())) == [("a", 1, 33.33), ("b", 2, 66.67)]
    assert [tuple(r) for r in profile.value_counts(df.union(df).union(spark.createDataFrame([(1, "q", "x")], df.schema)), "a").collect()] == [(1, 3), (2, 2)]
    rates = spark.createDataFrame([(1,), (1,), (0,)], "deal int")
    assert tuple(profile.overall_rate(rates, "deal").collect()[0]) == (3, 2, 1, 66.67, "66.67%")
    assert [tuple(r) for r in profile.class_shares(rates, "deal").collect()] == [(1, 2, 66.67), (0, 1, 33.33)]


def test_describe_matches_pandas(features, frame, limit):
    got = {r.column_name: r for r in profile.describe(features, study.NUMERIC).collect()}
    for c, want in frame[study.NUMERIC].describe().items():
        r = got[c]
        assert [r.n, r["mean"], r["std"], r["min"], r.q25, r.q50, r.q75, r["max"]] == pytest.approx(list(want))


def test_histograms_match_numpy(features, frame):
    got = study.histograms(features).toPandas()
    for f in ("exchangeforstake", "investment_ratio"):
        for deal in (0, 1):
            counts, edges = np.histogram(frame[frame.deal == deal][f], bins=20)
            part = got[(got.feature == f) & (got.deal == deal)].sort_values("bin")
            assert list(part.n_rows) == list(counts)
            assert list(part.lower_edge) == pytest.approx(list(edges[:-1])) and list(part.upper_edge) == pytest.approx(list(edges[1:]))


def test_histogram_of_constant_series_and_of_edge_values(spark):
    df = spark.createDataFrame([("c", 3.0)] * 4 + [("e", i / 10) for i in range(21)], "s string, x double")
    got = distribution.histogram(df, ["s"], "x").toPandas()
    for s, values in (("c", [3.0] * 4), ("e", [i / 10 for i in range(21)])):
        assert list(got[got.s == s].sort_values("bin").n_rows) == list(np.histogram(values, bins=20)[0])


def test_box_numbers_and_outliers(features, frame, limit):
    got = study.box_plots(features).toPandas().set_index(["feature", "deal"])
    for f in study.BOXED:
        for deal in (0, 1):
            x = frame[frame.deal == deal][f].to_numpy()
            q1, median, q3 = np.quantile(x, [0.25, 0.5, 0.75])
            inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
            want = [q1, median, q3, inside.min(), inside.max(), len(x) - len(inside)]
            assert list(got.loc[(f, deal)]) == pytest.approx(want)
    assert study.box_outliers(features).count() == got.n_outliers.sum()


# A worked example small enough to follow by hand; four rows train, two are held out.
SIX_ROWS = [(0, 4, 1, 3, 52), (1, 9, 2, 1, 51), (2, 8, 3, 2, 50), (3, 8, 1, 1, 52), (4, 7, 1, 4, 70), (5, 5, 0, 2, 60)]


def test_line_fits_and_predictions_by_hand(spark):
    df = spark.createDataFrame(SIX_ROWS, "no long, x1 int, x2 int, x3 int, y int")
    pdf = pd.DataFrame(SIX_ROWS, columns=["no", "x1", "x2", "x3", "y"])
    train, names = pdf[:4], ["x1", "x2", "x3"]
    slopes = {c: ((train[c] - train[c].mean()) * (train.y - train.y.mean())).sum() / ((train[c] - train[c].mean()) ** 2).sum() for c in names}
    fits = {r.feature: r for r in inference.line_fits(ranks.positional_split(df, "no").filter("is_train"), names, "y").collect()}
    for c in names:
        assert fits[c].slope == pytest.approx(slopes[c])
        assert fits[c].intercept == pytest.approx(train.y.mean() - slopes[c] * train[c].mean())
    constant = pdf.y.mean() - sum(slopes[c] * train[c].mean() for c in names)
    got = inference.additive_predictions(df, names, "y", "no").orderBy("no").collect()
    want = [(r.no, constant + sum(slopes[c] * r[c] for c in names), r.y) for r in pdf[4:].itertuples(index=False) for r in [pd.Series(r._asdict())]]
    assert [(r.no, r.prediction, r.actual) for r in got] == [(n, pytest.approx(p), y) for n, p, y in want]


def test_summary_names_all_seven_hypotheses(features):
    rows = study.hypothesis_summary(features).collect()
    assert [r.no for r in rows] == [h[0] for h in study.HYPOTHESES]
    assert [r.test_used for r in rows] == [h[2] for h in study.HYPOTHESES]


def test_category_verdict_stands_whatever_the_range(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "category string, season int, deal int")
    got = {r.grouping: r.significant for r in study.range_tests(df).collect()}
    assert got == {"category": True, "season": False}


@pytest.mark.parametrize("rows", [[("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0), (None, 7.0)], []])
def test_quantiles_give_the_same_rows_at_any_size(spark, monkeypatch, rows):
    table = spark.createDataFrame(rows, "g string, x double")
    results = []
    for limit in (1 << 40, -1):
        monkeypatch.setattr(ranks, "IN_MEMORY_BYTES", limit)
        results.append([sorted(ranks.quantiles(table, groups, "x", [0.25, 0.5]).collect(), key=str) for groups in (["g"], [])])
    assert results[0] == results[1]


def test_positional_split_refuses_repeated_and_null_keys(spark):
    for keys in ([1, 1, 2], [1, None]):
        with pytest.raises(ValueError, match="does not order"):
            ranks.positional_split(spark.createDataFrame([(k,) for k in keys], "k int"), "k")


def test_second_study_keeps_pitches_without_a_stake(spark, small):
    raw = views.view(spark, small, "pitches")
    first, second = (study.clean(raw, required) for required in (("deal", *study.MONEY), study.SECOND_REQUIRED))
    without = raw.where("exchangeforstake is null and askedfor is not null and valuation is not null").count()
    assert without > 0 and second.count() == first.count() + without


def test_split_by_file_position_needs_no_key(spark, tmp_path):
    """Several files, repeated and null keys: rows are marked as they stand, file after file."""
    path = str(tmp_path / "rows")
    for i, n in enumerate((300, 1, 777, 0, 50)):
        part = spark.range(n).selectExpr("if(id % 3 = 0, null, id % 5) as k", f"id + {i * 1000} as place")
        part.coalesce(1).write.parquet(f"{path}/part={i}")
    scan = spark.read.parquet(path).drop("part")
    numbered = ranks.file_positions(scan).orderBy("place").collect()
    assert [r.position for r in numbered] == list(range(1128))
    marked = ranks.split_by_file_position(scan, 0.5)
    assert marked.columns == ["k", "place", "is_train"] and marked.where("is_train").count() == 564
    assert marked.where("is_train").agg({"place": "max"}).first()[0] < marked.where("not is_train").agg({"place": "min"}).first()[0]
    assert "hashpartitioning(place" not in marked._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_file_do_not_meet_in_one_task(spark, tmp_path):
    """However large the inputs are guessed to be, only the table of files moves."""
    spark.range(100).write.parquet(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = ranks.file_positions(spark.read.parquet(str(tmp_path / "rows")))
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert numbered.where("position >= 0").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan



def test_null_series_are_listed(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 90.0), ("a", 5.0), ("a", None)], "s string, x double")
    bins = {(r.s, r.bin): r.n_rows for r in distribution.histogram(rows, ["s"], "x", 2).collect()}
    assert bins == {(None, 1): 2, (None, 2): 1, ("a", 1): 0, ("a", 2): 1}
    assert {r.s: r.median for r in distribution.box_numbers(rows, ["s"], "x").collect()} == {None: 2.0, "a": 5.0}
