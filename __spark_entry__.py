"""Registered queries: each has a Spark job and, where SQL can say it, a DuckDB statement beside it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators import chunking, inference, profile, ranks, retrieval
from lakeworks.plans import cube, gold, kpis, medallion
from lakeworks.plans import pitches as study
from lakeworks.plans import silver as silver_plans
from lakeworks.session import work_folder
from lakeworks.sources import lakehouse, views
from oracles import statements

try:  # the subpackage and the pipeline may be absent; anything else missing is an error
    import corpus_pipeline
    from lakeworks.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("lakeworks.llm", "corpus_pipeline"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = os.environ.get("SMOKE_DIR", "/root/testdata/sf0.001")


def _plain(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Decimals as DOUBLE and the named doubles rounded, so that two engines can be compared."""
    money = {
        f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)
    }
    rounded = {name: F.round(F.col(name).cast("double"), n) for name, n in (digits or {}).items()}
    return df.withColumns({**money, **rounded}) if money or rounded else df


def _six(*names: str) -> dict[str, int]:
    return dict.fromkeys(names, 6)


# Ingest and sinks


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and content of the five ingested tables as stored."""
    run = medallion.over_given_tables(spark, sf_dir)
    parts = []
    for name, rule in silver_plans.RULES.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in rule.columns])
        number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
        stored = run.stored("bronze", f"{name}_bronze")
        parts.append(
            stored.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("content_sum")).select(
                F.lit(f"{name}_bronze").alias("table_name"), "n_rows", "content_sum"
            )
        )
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage columns of a file scan: file names and whether the time stamp is set."""
    rows = lakehouse.with_lineage(views.table(spark, sf_dir, "lineitem"))
    return rows.groupBy(
        F.element_at(F.split("source_file", "/"), -1).alias("source_file_name"),
        F.col("ingested_at").isNotNull().alias("stamped"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def schema_checked_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver customers written as a table, replaced by its valid rows under the schema check, and read back."""
    run = medallion.over_given_tables(spark, sf_dir)
    table = f"{run.layers['silver']}.customers_checked"
    lakehouse.save(run.stored("silver", "silver_customers").drop(*silver_plans.LINEAGE), table)
    return lakehouse.save_same_schema(spark.table(table).where("is_valid = 1"), table)


def schema_refused_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of an overwrite with other columns, and the rows of the table that it left alone."""
    run = medallion.over_given_tables(spark, sf_dir)
    table = f"{run.layers['silver']}.customers_kept"
    lakehouse.save(run.stored("silver", "silver_customers").drop(*silver_plans.LINEAGE), table)
    other = spark.table(table).selectExpr("cast(customer_id AS bigint) AS customer_id", "customer_name", "registration_date", "country_code", "channel", "is_valid", "1 AS score")
    verdicts = lakehouse.checked_overwrite(other, table)
    return verdicts.crossJoin(F.broadcast(spark.table(table).agg(F.count(F.lit(1)).alias("n_rows"))))  # one row


def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and types of all columns of the given tables."""
    return lakehouse.column_listing({name: views.table(spark, sf_dir, name) for name in views.TABLES})


def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first cleaned orders by number."""
    return _plain(lakehouse.preview(silver_plans.SILVER["orders"](views.bronze(spark, sf_dir, "orders")), 5, ["order_id", "customer_id"]))


def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and column counts of the given tables."""
    parts = []
    for name in views.TABLES:
        df = views.table(spark, sf_dir, name)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
            )
        )
    return _union(parts)


# Silver and gold


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: _plain(silver_plans.SILVER[name](views.bronze(spark, sf_dir, name)))


def validity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = [name for name, rule in silver_plans.RULES.items() if rule.checks]
    return _union(
        [
            silver_plans.validity_counts(silver_plans.SILVER[name](views.bronze(spark, sf_dir, name))).withColumn(
                "table_name", F.lit(name)
            )
            for name in flagged
        ]
    )


def _from_silver(build: Callable[[DataFrame], DataFrame], name: str) -> Query:
    return lambda spark, sf_dir: _plain(build(silver_plans.SILVER[name](views.bronze(spark, sf_dir, name))))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact straight from the given tables, in one plan."""
    ready = {name: clean(views.bronze(spark, sf_dir, name)) for name, clean in silver_plans.SILVER.items()}
    return gold.fact_orders(
        ready["order_items"],
        ready["orders"],
        gold.dim_products(ready["products"]),
        gold.dim_customers(ready["customers"]),
        ready["exchange_rates"],
    )


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from the stored silver tables and dimensions."""
    run = medallion.over_given_tables(spark, sf_dir)
    return _plain(run.fact_frame())


def fact_orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with the rate in force on the order date."""
    rates = silver_plans.silver_exchange_rates(views.bronze(spark, sf_dir, "rate_history"))
    return _plain(medallion.over_given_tables(spark, sf_dir).fact_frame(rates, "as_of"))


def _stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.over_given_tables(spark, sf_dir).stored("gold", "fact_orders")


def _on_fact(build: Callable[[DataFrame], DataFrame], digits: dict[str, int] | None = None) -> Query:
    return lambda spark, sf_dir: _plain(build(_stored_fact(spark, sf_dir)), digits)


# Pitch study


def _pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.pitches_of_given_tables(spark, sf_dir)


def _on_pitches(build: Callable[[DataFrame], DataFrame], digits: dict[str, int] | None = None) -> Query:
    return lambda spark, sf_dir: _plain(build(_pitches(spark, sf_dir)), digits)


def _on_features(build: Callable[[DataFrame], DataFrame], digits: dict[str, int] | None = None) -> Query:
    return _on_pitches(lambda raw: build(study.with_features(study.clean(raw))), digits)


def _on_second(build: Callable[[DataFrame], DataFrame], digits: dict[str, int] | None = None) -> Query:
    """The second study drops fewer rows: a pitch without a stake stays."""
    return _on_pitches(lambda raw: build(study.with_features(study.clean(raw, study.SECOND_REQUIRED))), digits)


def pitch_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitches written as CSV and read back with inferred types."""
    path = lakehouse.write_csv(
        _pitches(spark, sf_dir).select(*statements.PITCH_COLUMNS), f"{work_folder(spark)}/csv-{abs(hash(sf_dir))}"
    )
    back = lakehouse.read_csv(spark, path)
    return back.withColumn("pitch_id", F.col("pitch_id").cast("long"))


def _dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Pitches as CSV lines, some with words for the asked sum, some cut off after the season."""
    money = ("askedfor", "exchangeforstake", "valuation")
    texts = [F.col(c).cast("decimal(18,2)").cast("string") if c in money else F.col(c).cast("string") for c in statements.PITCH_COLUMNS]
    at = statements.PITCH_COLUMNS.index("askedfor")
    texts[at] = F.when(F.col("pitch_id") % 13 == 0, "on request").otherwise(texts[at])
    cells = [F.coalesce(F.concat(F.lit('"'), F.translate(t, '"', "'"), F.lit('"')), F.lit("")) for t in texts]
    line = F.when(F.col("pitch_id") % 17 == 0, F.concat_ws(",", *cells[:8])).otherwise(F.concat_ws(",", *cells))
    path = f"{work_folder(spark)}/dirty-{abs(hash(sf_dir))}"
    _pitches(spark, sf_dir).select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty CSV read back: the rows that fit all fifteen columns, and the rejected records with their reasons."""
    path = _dirty_csv(spark, sf_dir)
    names = ", ".join(f"{c} string" for c in statements.PITCH_COLUMNS)
    schema = lakehouse.guessed_schema(spark.read.schema(names).csv(path))
    good, rejects = lakehouse.read_csv_checked(spark, path, schema, header=False)
    return good.unionByName(rejects, allowMissingColumns=True)


OLS = (statements.OLS_FEATURES, statements.OLS_TARGET)


def _ols_per_feature(features: DataFrame) -> DataFrame:
    train = inference.positional_split(features, "pitch_id").filter("is_train")
    return inference.line_fits(train, *OLS)


# Text and retrieval


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "embeddings")


def article_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    articles = spark.sql(statements.ARTICLES)
    records = articles.select("pmid", "title", F.split("body", "\n").alias("abstract"))
    return retrieval.article_documents(records).select("pmid", "page_content", "metadata.title", "metadata.source")


def chunk_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.fixed_chunks(views.table(spark, sf_dir, "documents").select("doc_id", "text"))


def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").alias("page_content"))
    return chunking.split_documents(docs)


def chunk_recursive_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, whether its recursive chunks keep the law of the splitter."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunking.chunk_coverage(docs, chunking.split_documents(docs, "text", located=True), "doc_id", "text")


def split_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, which have no unique key, split by their place in the file."""
    rows = ranks.split_by_file_position(views.table(spark, sf_dir, "lineitem"))
    return rows.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_orderkey").cast("long")).alias("key_sum"), F.max("l_orderkey").cast("long").alias("last_key")
    )


def _hits(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    vectors = _embeddings(spark, sf_dir)
    return retrieval.nearest(vectors, retrieval.topic_questions(vectors), k)


def topk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_hits(spark, sf_dir, retrieval.SOURCES_K), _six("distance"))


def topk_one_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors nearest to the mean of all, as one ordered top-k."""
    vectors = _embeddings(spark, sf_dir)
    (question,) = retrieval.topic_questions(vectors.withColumn("topic", F.lit(0)), "topic").collect()  # one vector
    return _plain(retrieval.nearest_to(vectors, question["question_vector"]), _six("distance"))


def context_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors to places in documents, places to chunks, chunks to one context per question."""
    places = views.view(spark, sf_dir, "vector_places")
    return retrieval.chunk_contexts(_hits(spark, sf_dir, retrieval.CONTEXT_K), places, views.table(spark, sf_dir, "documents"))


def context_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk behind each hit, with its place in the document."""
    places = views.view(spark, sf_dir, "vector_places")
    return retrieval.context_chunks(_hits(spark, sf_dir, retrieval.CONTEXT_K), places, views.table(spark, sf_dir, "documents"))


def source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    _embeddings(spark, sf_dir).createOrReplaceTempView("embeddings")
    sources = spark.sql(statements.CHUNK_SOURCES)
    return retrieval.source_list(_hits(spark, sf_dir, retrieval.SOURCES_K), sources)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: completed revenue by country, from the raw tables through silver and the fact."""
    return _plain(kpis.revenue_by_country(fact(spark, SMOKE_DIR)))


def queries() -> dict[str, Query]:
    ratios = _six("investment_ratio", "valuation_ask_ratio", "log_askedfor", "log_valuation")
    box = _six("q1", "median", "q3", "whisker_low", "whisker_high")
    edges = _six("lower_edge", "upper_edge")
    shares = {"kpi_completed_order_rate": _six("completed_order_rate"), "kpi_data_quality": _six("data_quality_score")}
    return {
        "bronze_ingest": bronze_ingest,
        "source_lineage": source_lineage,
        "table_shape": table_shape,
        "column_types": column_types,
        "preview_orders": preview_orders,
        "schema_checked_overwrite": schema_checked_overwrite,
        "schema_refused_overwrite": schema_refused_overwrite,
        **{f"silver_{name}": _silver(name) for name in silver_plans.SILVER},
        "validity_summary": validity_summary,
        "missing_profile": _on_pitches(profile.missing_profile),
        "dim_customers": _from_silver(gold.dim_customers, "customers"),
        "dim_products": _from_silver(gold.dim_products, "products"),
        "dim_date": _from_silver(gold.dim_date, "orders"),
        "fact_orders": fact_orders,
        "fact_orders_as_of": fact_orders_as_of,
        "cube_sales": _on_fact(cube.cube_sales),
        "cube_sales_grouping_id": _on_fact(lambda f: cube.cube_sales(f, with_grouping_id=True)),
        **{name: _on_fact(kpi, shares.get(name)) for name, kpi in kpis.KPIS.items()},
        "kpi_scorecard": _on_fact(kpis.scorecard, _six("completed_order_rate")),
        "pitch_clean": _on_pitches(study.clean),
        "pitch_features": _on_features(lambda f: f, ratios),
        "pitch_dropna_all": _on_pitches(study.complete_rows),
        "pitch_csv_roundtrip": pitch_csv_roundtrip,
        "csv_rejects": csv_rejects,
        "describe_numeric": _on_pitches(
            lambda raw: profile.describe(raw, study.NUMERIC), {**_six("mean", "q25", "q50", "q75"), "std": 4}
        ),
        "value_counts_deal": _on_pitches(lambda raw: profile.class_shares(study.clean(raw), "deal")),
        "value_counts_raw": _on_pitches(lambda raw: profile.class_shares(raw, "deal")),
        "overall_rate": _on_pitches(lambda raw: profile.overall_rate(raw.withColumn("deal", study.flag_from_text(F.col("deal"))), "deal")),
        "rate_by_category": _on_features(study.category_rates, _six("deal_rate")),
        "top_categories": _on_second(lambda f: profile.top_rates(f, "category", "deal"), _six("deal_rate")),
        "rate_by_season": _on_features(study.season_rates),
        "season_extremes": _on_features(study.season_extremes),
        "rate_by_investor": _on_second(study.rate_by_investor, _six("success_rate")),
        "rate_comparison": _on_features(study.rate_comparisons, _six("rate_off", "rate_on", "difference")),
        "ttest_by_outcome": _on_features(study.t_tests, _six("mean_yes", "mean_no", "t_statistic")),
        "group_range_test": _on_features(study.range_tests),
        "ratio_by_outcome": _on_second(study.ratio_by_outcome, _six("success_ratio", "failure_ratio")),
        "hypothesis_summary": _on_features(study.hypothesis_summary, _six("measure")),
        "feature_correlation": _on_features(study.correlations),
        "train_test_split": _on_features(
            lambda f: inference.positional_split(f, "pitch_id").select("pitch_id", "is_train")
        ),
        "split_by_position": split_by_position,
        "ols_per_feature": _on_features(_ols_per_feature, dict.fromkeys(("slope", "intercept", "x_mean"), 4)),
        "ols_predict": _on_features(
            lambda f: inference.additive_predictions(f, *OLS, key="pitch_id"), {"prediction": 4}
        ),
        "histogram_by_outcome": _on_features(study.histograms, edges),
        "histogram_ratio": _on_second(study.ratio_histogram, edges),
        "boxplot_by_outcome": _on_features(study.box_plots, box),
        "boxplot_ratio": _on_second(study.ratio_box, box),
        "boxplot_outliers": _on_features(study.box_outliers, _six("x")),
        "above_average_groups": _on_features(
            lambda f: profile.against_average(f, "category", "deal"), _six("rate_pct")
        ),
        "scatter_points": _on_second(study.scatter_points),
        "article_documents": article_documents,
        "chunk_fixed": chunk_fixed,
        "chunk_recursive": chunk_recursive,
        "chunk_recursive_law": chunk_recursive_law,
        "topk_vectors": topk_vectors,
        "topk_one_question": topk_one_question,
        "context_per_query": context_per_query,
        "context_chunks": context_chunks,
        "source_list": source_list,
        **({**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**statements.statements(), **(llm.ORACLES if llm else {})}
