"""Silver to gold: dimensions and the order fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.functions.quality import iso_date
from lakeworks.operators.asof import as_of_join
from lakeworks.operators.joins import SLOT, HotKeys, counted_small, fits_broadcast, skew_left_join, with_row_slot
from lakeworks.session import durable

COMPLETED = "completed"

COPY_BLOCK = 10_000

RATE_POLICIES = ("all", "as_of")


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_name", "email", "country_code").distinct()


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "price", "country_code", "currency").distinct()


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per order date, with its parts; the distinct runs on the text, before any parsing.

    Silver keeps unreadable text, which reads as one null date here and must not stop the job.
    """
    dates = orders.select("order_date").distinct().select(iso_date(F.col("order_date")).alias("date")).distinct()
    return dates.select("date", F.year("date").alias("year"), F.month("date").alias("month"), F.day("date").alias("day"))


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times, unfolded in blocks so that no long array is ever held."""
    blocks = F.sequence(F.lit(0), F.floor((times - 1) / COPY_BLOCK))
    left_over = F.least(times - F.col("_block") * COPY_BLOCK, F.lit(COPY_BLOCK))
    return (
        df.withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), left_over)))
    )


def fact_orders(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    rates: DataFrame,
    rate_policy: str = "all",
) -> DataFrame:
    """One row per order item, matching customer variant and matching exchange rate.

    ``rate_policy`` "all" matches every rate of the product's currency; "as_of" the one in force on the order
    date (the last that took effect on or before it, the greatest of several of one day), or none.

    Everything is kept: items without an order, product or rate have nulls, several rates of a
    currency and several variants of a customer repeat the row. Conversion follows the product's
    currency. Three choices keep the shuffles of the item rows down to two (product, order) and narrow: the
    customer join needs only the number of variants and hangs on the order, so it is made on the orders, with
    the customers that repeat; the order's columns come with the second shuffle, which leaves the lines of an
    order side by side; and the rates, which multiply rows, come last, as a broadcast of checked size.
    """
    if rate_policy not in RATE_POLICIES:
        raise ValueError(f"rate_policy is one of {RATE_POLICIES}, not {rate_policy}")
    item_keys, order_keys = HotKeys(items, "order_id", "product_id"), HotKeys(orders, "customer_id", "order_id")
    # A customer that does not repeat leaves the order as it is, known or not.
    variants = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    if not (few_variants := fits_broadcast(variants)):
        variants = durable(variants)
        few_variants = counted_small(variants)
    placed = orders.select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("standard_status").alias("status"),
        F.col("country_code").alias("country"),
        "channel",
    )
    order_side = with_row_slot(placed)
    if few_variants:
        order_side = order_side.join(F.broadcast(variants), "customer_id", "left")
    else:
        order_side = skew_left_join(order_side, variants, "customer_id", hot_left=order_keys, unique_right=True, broadcast=False)
    order_side = order_side.withColumnRenamed(SLOT, "_order_slot")
    lines = with_row_slot(items.select("order_id", "product_id", "quantity", "unit_price"))

    def with_orders(left: DataFrame) -> DataFrame:
        # One row per order row, with fewer columns: the stored orders bound its size.
        return skew_left_join(
            left,
            order_side,
            "order_id",
            hot_left=item_keys,
            hot_right=order_keys,
            sized_by=orders,
            right_slot="_order_slot",
        )

    def with_products(left: DataFrame, right: DataFrame, right_slot: str | None = None) -> DataFrame:
        hot_right = HotKeys(products, "product_id")
        return skew_left_join(left, right, "product_id", hot_left=item_keys, hot_right=hot_right, right_slot=right_slot)

    priced = products.select("product_id", "currency")
    as_of = rate_policy == "as_of"
    per_currency = rates.select(F.col("currency_code").alias("currency"), "exchange_rate_to_usd")
    few_rates = as_of or fits_broadcast(per_currency)
    if few_rates:
        # The currency is one narrow column and an order six: the rows shuffle twice before they are wide.
        joined = with_orders(with_products(lines, priced))
    else:
        # Few currencies share many rates: pair them with the products, not with the wider item rows, and multiply last.
        priced = skew_left_join(with_row_slot(priced), per_currency, "currency").withColumnRenamed(SLOT, "_product_slot")
        joined = with_products(with_orders(lines), priced, "_product_slot")
    if as_of:
        dated = rates.select(F.col("currency_code").alias("currency"), "exchange_rate_to_usd", "effective_date")
        days = (iso_date(F.col(name)) for name in ("order_date", "effective_date"))
        with_rate = as_of_join(joined, dated, "currency", *days, ["exchange_rate_to_usd"])
    else:
        with_rate = joined.join(F.broadcast(per_currency), "currency", "left") if few_rates else joined
    usd = F.col("unit_price") * F.col("exchange_rate_to_usd")
    line = F.col("quantity") * F.col("unit_price") * F.col("exchange_rate_to_usd")
    return _repeat(with_rate, F.coalesce("variants", F.lit(1))).select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "status",
        "country",
        "channel",
        "quantity",
        F.col("unit_price").alias("local_price"),
        F.round(usd, 2).alias("price_usd"),
        F.round(line, 2).alias("revenue_usd"),
    )
