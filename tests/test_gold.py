import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import joins
from lakeworks.plans import cube, gold, kpis
from lakeworks.session import durable

ITEMS = "order_item_id string, order_id string, product_id string, quantity decimal(9,2), unit_price decimal(12,2)"
ORDERS = "order_id string, customer_id string, order_date string, standard_status string, country_code string, channel string"
PRODUCTS = "product_id string, product_name string, category string, price decimal(12,2), country_code string, currency string"
CUSTOMERS = "customer_id string, customer_name string, email string, country_code string"
RATES = "currency_code string, exchange_rate_to_usd decimal(9,4)"
FACT = (
    "order_id string, customer_id string, product_id string, order_date string, status string, country string,"
    " channel string, quantity decimal(9,2), local_price decimal(12,2), price_usd decimal(19,2), revenue_usd decimal(27,2)"
)


def d(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "items": make(
            [
                ("1", "o1", "p1", d("2"), d("10.05")),
                ("2", "o1", "p2", d("1"), d("3")),
                ("3", None, "p1", d("1"), d("7")),
                ("4", "gone", "p3", d("1"), d("7")),
                ("5", "o2", None, d("1"), d("7")),
            ],
            ITEMS,
        ),
        "orders": make(
            [
                ("o1", "c1", "2024-01-02", "completed", "DE", "web"),
                ("o2", None, "soon", None, None, None),
                ("o3", "c2", "2024-01-02", "completed", "DE", "web"),
            ],
            ORDERS,
        ),
        "products": make(
            [("p1", "a", "x", d("1"), "DE", "EUR"), ("p2", "b", "x", d("1"), "DE", "USD"), ("p3", "c", "x", d("1"), "DE", "JPY")],
            PRODUCTS,
        ),
        "customers": make([("c1", "n", "e", "DE"), ("c1", "n", "e2", "DE"), (None, "n", "e", "DE")], CUSTOMERS),
        "rates": make([("EUR", d("1.1")), ("EUR", d("1.2")), ("USD", d("1"))], RATES),
    }


@pytest.fixture(params=["broadcast", "salted"])
def side(request, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 16 << 20 if request.param == "broadcast" else -1)


def test_fact_repeats_rows_for_rates_and_variants_and_keeps_unmatched(spark, tables, side):
    rows = gold.fact_orders(**tables).collect()
    seen = sorted((str(r.order_id), str(r.product_id), str(r.customer_id), str(r.price_usd), str(r.revenue_usd)) for r in rows)
    assert seen == sorted(
        [("o1", "p1", "c1", "11.06", "22.11"), ("o1", "p1", "c1", "12.06", "24.12")] * 2
        + [("o1", "p2", "c1", "3.00", "3.00")] * 2
        + [("None", "p1", "None", "7.70", "7.70"), ("None", "p1", "None", "8.40", "8.40")]
        + [("gone", "p3", "None", "None", "None"), ("o2", "None", "None", "None", "None")]
    )


def keyed(spark, n, third, value):
    """A third of the rows under one key, a third null, the rest under keys of their own."""
    i = F.col("id")
    key = F.when(i % 3 == 0, third).when(i % 3 == 1, F.lit(None)).otherwise(i.cast("string"))
    return spark.range(n, numPartitions=4).select(key.alias("k"), i.alias(value))


def test_fact_with_hot_orders_on_both_sides_equals_plain_joins(spark, tables, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    many = spark.range(60, numPartitions=3).select(
        F.col("id").cast("string").alias("order_item_id"),
        F.when(F.col("id") % 3 < 2, "o1").otherwise("o2").alias("order_id"),
        F.lit("p1").alias("product_id"),
        F.lit(d("2")).cast("decimal(9,2)").alias("quantity"),
        F.lit(d("10.05")).cast("decimal(12,2)").alias("unit_price"),
    )
    repeated = tables["orders"]
    for _ in range(3):
        repeated = repeated.union(repeated.filter("order_id = 'o1'"))
    items = tables["items"].union(many)
    ours = gold.fact_orders(**{**tables, "items": items, "orders": repeated})
    joined = (
        items.join(repeated, "order_id", "left")
        .join(tables["products"].select("product_id", "currency"), "product_id", "left")
        .join(tables["customers"].select("customer_id"), "customer_id", "left")
        .join(tables["rates"].withColumnRenamed("currency_code", "currency"), "currency", "left")
    )
    assert ours.count() == joined.count() > 1000
    keys = ["order_id", "customer_id", "product_id"]
    assert joined.select(keys).exceptAll(ours.select(keys)).count() == 0


@pytest.mark.parametrize(
    "left_third,right_third,n_right",
    [("hot", "other", 3000), ("hot", "hot", 90), ("rare", "hot", 300), ("absent", "5", 300)],
)
def test_skewed_join_equals_a_plain_left_join(spark, monkeypatch, left_third, right_third, n_right):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    left = keyed(spark, 900, left_third, "v").union(spark.createDataFrame([("hot", -1), ("other", -2)], "k string, v long"))
    right = keyed(spark, n_right, right_third, "w")
    plain = left.join(right, "k", "left").select("k", "v", "w")
    for numbered, slot in ((right, None), (right.withColumn("n", F.monotonically_increasing_id()), "n")):
        joined = joins.skew_left_join(joins.with_row_slot(left), numbered, "k", parts=16, right_slot=slot)
        assert set(joined.columns) == {"k", "v", "w", joins.SLOT}
        ours = joined.select("k", "v", "w")
        assert ours.count() == plain.count() and ours.exceptAll(plain).count() == 0


def test_hot_keys_get_slots_by_their_share(spark):
    rows = keyed(spark, 9000, "hot", "v").withColumn("c", F.col("v") % 2)
    found = joins.HotKeys(rows, "k", "c", parts=12)
    assert dict(map(tuple, found.of("k").collect())) == {"hot": 4} and dict(map(tuple, found.of("c").collect())) == {0: 6, 1: 6}
    assert joins.HotKeys(rows.limit(0), "k", parts=12).of("k") is None


@pytest.mark.parametrize("looked_at", [1, 32])
def test_hot_keys_without_a_limit_on_their_number(spark, monkeypatch, looked_at):
    """2,000 hot keys among 100,000 partitions, found over all rows or from a sample, and the join laid out by them."""
    monkeypatch.setattr(joins, "LOOKED_AT", looked_at)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    rows = spark.range(240_000).selectExpr("if(id < 200000, id % 2000, id) as k", "id as v")
    found = joins.HotKeys(rows, "k", parts=100_000).of("k")
    got = dict(map(tuple, found.collect()))
    assert {k: n for k, n in got.items() if k < 2000} == {k: 42 for k in range(2000)} and len(got) == 2000
    left = joins.with_row_slot(rows).where("v % 5 = 0")
    right = spark.range(0, 3000).selectExpr("id as k", "id * 2 as w")
    joined = joins.skew_left_join(left, right, "k", parts=100_000, hot_left=joins.HotKeys(rows, "k", parts=100_000), unique_right=True)
    totals = joined.agg(F.count("*"), F.count("w"), F.sum("w"), F.sum("v")).first()
    plain = left.join(right, "k", "left").agg(F.count("*"), F.count("w"), F.sum("w"), F.sum("v")).first()
    assert tuple(totals) == tuple(plain)


def test_a_hot_key_leaves_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    left = keyed(spark, 9000, "hot", "v")
    out = joins.skew_left_join(joins.with_row_slot(left), left.filter("k = 'hot'").limit(1).select("k"), "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) <= 9000 / 3 and len(sizes) > 2


def test_rows_are_repeated_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(gold, "COPY_BLOCK", 3)
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 6, 7)], "n long")
    got = {r.n: r["count"] for r in gold._repeat(df, F.col("n")).groupBy("n").count().collect()}
    assert got == {n: n for n in (1, 2, 3, 4, 6, 7)}


def test_date_dimension_survives_unreadable_text(spark, tables):
    rows = gold.dim_date(tables["orders"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(None, None, None, None), (rows[0].date or rows[1].date, 2024, 1, 2)], key=str)


def test_item_rows_meet_products_before_they_are_wide(spark, tables, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    dated = tables["rates"].withColumn("effective_date", F.lit("2024-01-01"))
    fact = gold.fact_orders(**{**tables, "rates": dated}, rate_policy="as_of")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert -1 < plan.index("Exchange hashpartitioning(order_id") < plan.index("Exchange hashpartitioning(product_id")
    assert "hashpartitioning(customer_id" in plan  # nothing fits a broadcast here
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 400)  # few customers repeat, whatever the tables hold
    plan = gold.fact_orders(**{**tables, "rates": dated}, rate_policy="as_of")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" not in plan and "hashpartitioning(order_id" in plan


def test_stored_frames_leave_no_shuffle_files(spark):
    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in disk.getAllFiles().mkString(",").split(",") if "shuffle_" in x}

    before = files()
    kept = durable(spark.range(1000).groupBy(F.col("id") % 50).count())
    for _ in range(50):  # they are deleted in the background
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and kept.count() == 50


def test_dimensions_drop_only_equal_rows(spark, tables):
    customers = tables["customers"]
    assert gold.dim_customers(customers.union(customers)).count() == 3
    assert gold.dim_products(tables["products"].union(tables["products"])).count() == 3


def plain_cube(fact):
    day = F.try_to_date("order_date", "yyyy-MM-dd")
    return (
        fact.withColumn("year", F.year(day))
        .withColumn("month", F.month(day))
        .cube(*cube.DIMS)
        .agg(
            F.round(F.sum("revenue_usd"), 2).alias("total_revenue_usd"),
            F.countDistinct("order_id").alias("total_orders"),
            F.round(F.avg("revenue_usd"), 2).alias("avg_order_value"),
            F.grouping_id().alias("grouping_id"),
        )
    )


def test_cube_equals_plain_cube_even_with_repeated_orders(spark):
    rows = spark.range(400).select(
        F.when(F.col("id") % 11 > 0, (F.col("id") % 60).cast("string")).alias("order_id"),
        F.lit("c").alias("customer_id"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("string")).alias("product_id"),
        F.element_at(F.array(F.lit("2023-12-31"), F.lit("2024-01-01"), F.lit("soon")), (F.col("id") % 3 + 1).cast("int")).alias("order_date"),
        F.lit("completed").alias("status"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("L"), F.col("id") % 3)).alias("country"),
        F.when(F.col("id") % 5 > 0, "web").alias("channel"),
        F.when(F.col("id") % 13 > 0, F.col("id") * F.lit(d("0.37"))).cast("decimal(27,2)").alias("revenue_usd"),
    )
    plain, ours = plain_cube(rows), cube.cube_numbers(rows)
    assert ours.count() == plain.count()
    assert plain.select(*ours.columns).exceptAll(ours).count() == 0


def test_cube_rows_multiply_behind_their_last_shuffle(spark, monkeypatch):
    """One product fills most partitions of its own, and the rows of the others are shuffled by product before they are rolled up."""
    monkeypatch.setattr(cube, "LEAST_ROWS", 50)
    monkeypatch.setattr(joins, "LOOKED_AT", 1)
    rows = spark.range(900).select(
        F.when(F.col("id") % 17 > 0, (F.col("id") % 350).cast("string")).alias("order_id"),
        F.when(F.col("id") % 19 > 0, F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 40).cast("string"))).alias("product_id"),
        F.element_at(F.array(F.lit("2023-12-31"), F.lit("2024-01-01")), (F.col("id") % 2 + 1).cast("int")).alias("order_date"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("L"), F.col("id") % 3)).alias("country"),
        F.lit("web").alias("channel"),
        F.when(F.col("id") % 13 > 0, F.col("id") * F.lit(d("0.37"))).cast("decimal(27,2)").alias("revenue_usd"),
    )
    plain, ours = plain_cube(rows), cube.cube_numbers(rows)
    assert ours.count() == plain.count()
    assert plain.select(*ours.columns).exceptAll(ours).count() == 0
    plan = ours._jdf.queryExecution().executedPlan().toString()
    roll_ups = [i for i, line in enumerate(plan.splitlines()) if "Generate explode" in line]
    last_shuffles = [line for line in plan.splitlines()[: roll_ups[0]] if "Exchange hashpartitioning" in line]
    assert not last_shuffles and "Exchange hashpartitioning(product_id" in plan


def test_cube_label_collision_is_kept_and_told_apart(spark):
    fact = spark.createDataFrame([("o1", None, "p", "2024-01-01", "completed", None, "web", None, None, None, d("5"))], FACT)
    rows = cube.cube_sales(fact, with_grouping_id=True).filter(
        "year = '2024' AND month = '1' AND country = 'ALL' AND channel = 'web' AND product_id = 'p'"
    )
    assert sorted(r.grouping_id for r in rows.collect()) == [0, 4]
    assert "grouping_id" not in cube.cube_sales(fact).columns


@pytest.fixture(scope="module")
def fact(spark):
    def line(order, customer, product, date, status, revenue):
        return (order, customer, product, date, status, "DE" if order else None, "web", None, None, None, revenue and d(revenue))

    return spark.createDataFrame(
        [
            line("o1", "c1", "p1", "2024-02-01", "completed", "10.00"),
            line("o1", "c1", "p2", "2024-02-01", "completed", "5.50"),
            line("o2", "c1", "p1", "2024-01-15", "pending", "100.00"),
            line("o3", "c2", "p3", "2024-02-20", "completed", "1.00"),
            line("o4", "c3", "p4", "garbage", None, "1.00"),
            line(None, None, "p1", None, None, None),
        ],
        FACT,
    )


def one(df):
    (row,) = df.collect()
    return row[0]


def test_kpis_on_a_small_fact(spark, fact):
    assert one(kpis.total_revenue(fact)) == d("16.50")
    assert dict(map(tuple, kpis.revenue_by_country(fact).collect())) == {"DE": d("16.50"), None: None}
    assert dict(map(tuple, kpis.revenue_by_channel(fact).collect())) == {"web": d("16.50")}
    assert one(kpis.completed_orders(fact)) == 2
    assert one(kpis.completed_order_rate(fact)) == 0.5
    assert one(kpis.average_order_value(fact)) == d("8.25")
    assert [r.product_id for r in kpis.top_products(fact).collect()] == ["p1", "p2", "p3", "p4"]
    assert one(kpis.active_customers(fact)) == 3
    assert [tuple(r) for r in kpis.customer_acquisition(fact).collect()] == [(None, 1), ("2024-01", 1), ("2024-02", 1)]
    assert one(kpis.data_quality(fact)) == pytest.approx(4 / 6)
    assert tuple(kpis.scorecard(fact).collect()[0]) == (d("16.50"), 2, 0.5, d("8.25"))


def test_kpis_on_an_empty_fact(spark, fact):
    empty = fact.limit(0)
    assert one(kpis.completed_order_rate(empty)) is None and one(kpis.data_quality(empty)) is None
    assert one(kpis.total_revenue(empty)) is None and one(kpis.active_customers(empty)) == 0


def test_fused_kpis_equal_the_single_ones(spark, fact):
    for rows in (fact, fact.limit(0)):
        fused = kpis.fused(rows, lambda df, name: df.cache())
        for name, kpi in kpis.KPIS.items():
            assert fused[name].schema.names == kpi(rows).schema.names
            assert sorted(map(str, fused[name].collect())) == sorted(map(str, kpi(rows).collect())), name


def test_top_products_is_a_bounded_top_k(spark, fact):
    plan = kpis.top_products(fact)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan
