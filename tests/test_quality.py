from pyspark.sql import functions as F

from lakeworks.functions import quality as q
from lakeworks.plans import silver


def values(df, name):
    return [row[name] for row in df.collect()]


def test_sentinels_become_null_and_other_values_stay_untouched(spark):
    texts = ["\n", "?", "", "null", "NA", " N/a ", "  ", None, " Ann ", "nab", "\\N", "a\\Nb"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, plain string, marked string")
    out = q.null_sentinels(df, ["plain", "marked"], null_mark=["marked"]).orderBy("i")
    assert values(out, "plain") == [None] * 8 + [" Ann ", "nab", "\\N", "a\\Nb"]
    assert values(out, "marked") == [None] * 8 + [" Ann ", "nab", None, None]


def test_blanks_around_newline_still_match(spark):
    df = spark.createDataFrame([(" \n ",), ("\n\n",), ("\tx",)], "c string")
    assert values(df.select(q.is_missing("c").alias("m")), "m") == [True, False, False]


def test_dates_agree_with_trying_each_pattern(spark):
    texts = [
        "03/04/2024", "25/12/2023", "13/13/2024", "2024-02-29", "2023-02-29", "31-05-2023", "12-31-2023", "30/02/2024",
        "02/30/2024", "1/2/2024", " 2024-01-01", "2024-01-01 ", "not a date", "", None, "2024/01/02", "03-04/2024",
        "01/02/2024\n", "2024-1-5", "00/10/2020", "10/00/2020", "99-99-2020", "01012024", "2024-13-01", "2024-01-01T00:00:00",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    tried = F.coalesce(*[F.try_to_date("d", p) for p in q.DATE_PATTERNS])
    for ours, plain in ((q.parse_date, tried), (q.iso_date, F.try_to_date("d", "yyyy-MM-dd"))):
        rows = df.select("d", ours(F.col("d")).cast("string").alias("ours"), plain.cast("string").alias("plain")).collect()
        assert [(r.d, r.ours) for r in rows] == [(r.d, r.plain) for r in rows]


def test_ambiguous_day_reads_month_first_and_garbage_stays(spark):
    df = spark.createDataFrame([("03/04/2024",), ("13/04/2024",), ("soon",), (None,)], "d string")
    assert values(df.select(q.normalise_date("d")), "d") == ["2024-03-04", "2024-04-13", "soon", None]


def test_status_words_are_twenty_and_unique(spark):
    rows = q.status_map(spark).collect()
    assert len(rows) == 20 and len({r.raw_status for r in rows}) == 20
    assert {r.standard_status for r in rows} == set(q.STATUS_WORDS)


def orders(spark, *statuses):
    rows = [(str(i), "c", "2024-01-01", s, "DE", "web", None, "EUR") for i, s in enumerate(statuses)]
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, order_date string, order_status string, country_code string,"
        " channel string, total_amount decimal(12,2), currency string",
    )


def test_status_match_is_exact(spark):
    out = silver.silver_orders(orders(spark, "已完成", "enviado", "Shipped", " shipped", "NULL", None, "\\N")).orderBy("order_id")
    assert values(out, "standard_status") == ["completed", "shipped", None, None, None, None, None]
    assert values(out, "order_status") == ["已完成", "enviado", "Shipped", " shipped", None, None, "\\N"]
    assert values(out, "is_invalid_status") == [0, 0, 0, 0, 1, 1, 0]


def test_null_mark_counts_on_customer_email_only(spark):
    df = spark.createDataFrame(
        [("1", "\\N", "a@b", "2024-01-01", "DE", "\\N"), ("2", "n", "x\\N", "2024-01-01", "DE", "web"), (None, "n", "e", "d", "c", "w")],
        "customer_id string, customer_name string, email string, registration_date string, country_code string, channel string",
    )
    rows = silver.silver_customers(df).orderBy("customer_id").collect()
    assert [(r.customer_id, r.customer_name, r.email, r.channel, r.is_valid) for r in rows] == [
        ("1", "\\N", "a@b", "\\N", 1),
        ("2", "n", None, "web", 0),
    ]


def test_validity_is_taken_from_raw_values(spark):
    df = spark.createDataFrame(
        [("1", "", "p", None, None, None), ("2", "o", "p", None, None, None)],
        "order_item_id string, order_id string, product_id string, quantity decimal(9,2), unit_price decimal(12,2), line_total decimal(18,2)",
    )
    rows = silver.silver_order_items(df).orderBy("order_item_id").collect()
    assert [(r.order_id, r.is_valid) for r in rows] == [(None, 0), ("o", 1)]


def test_lineage_columns_are_carried_when_present(spark):
    df = spark.createDataFrame(
        [("EUR", "1.1", "25/12/2023", "m")], "currency_code string, exchange_rate_to_usd string, effective_date string, _modified string"
    ).withColumn("ingested_at", F.current_timestamp())
    out = silver.silver_exchange_rates(df)
    assert out.columns == ["currency_code", "exchange_rate_to_usd", "effective_date", "_modified", "ingested_at"]
    assert values(out, "effective_date") == ["2023-12-25"]


def test_cleaning_is_one_projection(spark):
    plan = silver.silver_orders(orders(spark, "x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.count("Project [") <= 4


def test_silver_also_runs_over_a_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    batch = orders(spark, "enviado", "null")
    batch.write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = (
        silver.silver_orders(stream)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert sorted(map(str, spark.read.parquet(sink).collect())) == sorted(map(str, silver.silver_orders(batch).collect()))
