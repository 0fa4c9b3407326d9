"""Five-dimension sales cube."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeworks.operators.joins import HotKeys
from lakeworks.session import shuffle_partitions

ORDER_DIMS = ["year", "month", "country", "channel"]
DIMS = [*ORDER_DIMS, "product_id"]
ALL = "ALL"
MONEY = "decimal(38,2)"

# Rows of one task while orders are counted, and while rows are rolled up to sixteen times as many.
ORDER_ROWS, CUBE_ROWS, LEAST_ROWS = 250_000, 100_000, 20_000


def _tasks(fact: DataFrame, n: int, most: int) -> int:
    """Partitions for ``n`` rows: ``most`` rows each, fewer while that leaves tasks idle."""
    return max(1, min(shuffle_partitions(fact.sparkSession), -(-n // LEAST_ROWS)), -(-n // most))


def _roll_up(rows: DataFrame, bits: Column, kept: Sequence[str]) -> DataFrame:
    """Each row once per entry of the array ``bits``: the subset's order dimensions, rolled-up ones null, and its bits.

    The entry null leaves all dimensions as they are.
    """
    numbered = rows.withColumn("bits", F.explode(bits))
    masks = {name: 2 ** (len(ORDER_DIMS) - 1 - i) for i, name in enumerate(ORDER_DIMS)}
    return numbered.select(
        "bits", *[F.when(F.coalesce(F.col("bits").bitwiseAND(m), F.lit(0)) == 0, F.col(n)).alias(n) for n, m in masks.items()], *kept
    )


def _all_subsets() -> Column:
    return F.sequence(F.lit(0), F.lit(2 ** len(ORDER_DIMS) - 1))


def _counted(folded: DataFrame, fixed: list[str]) -> DataFrame:
    """``bits``, dimensions, revenue, lines and the ``orders`` they count for; ``bits`` is null where that holds in every subset.

    ``folded`` has one row per (dimensions, order). An order that occurs once (per ``fixed`` value)
    counts one in whatever group its row falls into, so its distinct count is a plain sum. Only orders
    with several dimension values, which come from repeated order keys, are rolled up here and folded per
    group. The rows of an order lie in one partition, that of its ``_spot``, so nothing is shuffled.
    """
    spread = F.count(F.lit(1)).over(W.partitionBy("_spot", "order_id", *fixed))
    rows = folded.withColumn("variants", F.when(F.col("order_id").isNotNull(), spread).otherwise(0))
    bits = F.when(F.col("variants") > 1, _all_subsets()).otherwise(F.array(F.lit(None).cast("int")))
    return (
        _roll_up(rows, bits, ["_spot", *fixed, "order_id", "revenue", "lines", "variants"])
        .groupBy("_spot", "bits", *ORDER_DIMS, *fixed, "order_id")
        .agg(
            F.sum("revenue").cast(MONEY).alias("revenue"),
            F.sum("lines").alias("lines"),
            F.max(F.least("variants", F.lit(1))).alias("orders"),
        )
    )


def _rolled_up(counted: DataFrame, fixed: list[str]) -> DataFrame:
    """The sums of all subsets beside ``fixed``, of rows made by ``_counted``."""
    bits = F.when(F.col("bits").isNull(), _all_subsets()).otherwise(F.array("bits"))
    return _summed(_roll_up(counted, bits, [*fixed, "revenue", "lines", "orders"]), ["bits", *ORDER_DIMS, *fixed])


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("lines").alias("lines"), F.sum("orders").alias("orders")
    )


def cube_numbers(fact: DataFrame) -> DataFrame:
    """All 32 grouping sets with null for a rolled-up dimension, and the grouping id.

    One shuffle brings the lines of an order together; they are folded to one row per (dimensions, order) and once
    more without the product, which gives the 16 sets without product. For the other 16 a second shuffle brings the
    rows of a product together; its sets are all rolled up there, so that the rows are shuffled before they multiply and never after.
    Rows without a product, and those of products that would fill a partition of their own, are summed per group of
    all dimensions instead, which folds them, before they are rolled up.
    """
    day = F.col("order_date").try_cast("date")  # also reads 2024-1-5, 2024-01 and dates with a time
    # Lines without an order count for none: they need not meet and are dealt by what else they hold.
    spot = F.when(F.col("order_id").isNotNull(), F.xxhash64("order_id")).otherwise(F.xxhash64("product_id", "revenue_usd"))
    lines = fact.select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        *["country", "channel", "product_id", "order_id", "revenue_usd"],
        spot.alias("_spot"),
    )
    n = fact.count()
    tasks = _tasks(fact, n, CUBE_ROWS)
    dealt = lines.repartition(_tasks(fact, n, ORDER_ROWS), "_spot")
    by_product = dealt.groupBy("_spot", *DIMS, "order_id").agg(
        F.sum("revenue_usd").cast(MONEY).alias("revenue"), F.count("revenue_usd").alias("lines")
    )
    by_order = by_product.groupBy("_spot", *ORDER_DIMS, "order_id").agg(
        F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("lines").alias("lines")
    )
    found = HotKeys(fact, "product_id", parts=tasks).of("product_id")
    counted = _counted(by_product, ["product_id"]).withColumn("alone", F.col("product_id").isNull())
    if found is not None:
        known = F.broadcast(found.select("product_id", F.lit(True).alias("hot")))  # fewer than one per partition
        counted = counted.join(known, "product_id", "left").withColumn("alone", F.coalesce("hot", "alone"))
    # Told by a sum, too, so that both parts are split behind the shuffle and share it.
    alone = F.when(F.col("orders") >= 0, F.col("alone"))
    met = counted.filter(~alone).repartition(tasks, "product_id")
    folded = _summed(counted.filter(alone), ["bits", *DIMS])
    detailed = _rolled_up(met, ["product_id"]).unionByName(_rolled_up(folded, ["product_id"]))
    rolled = _rolled_up(_summed(_counted(by_order, []), ["bits", *ORDER_DIMS]), [])
    both = detailed.withColumn("grouping_id", F.col("bits") * 2).unionByName(
        rolled.withColumns({"product_id": F.lit(None).cast(fact.schema["product_id"].dataType), "grouping_id": F.col("bits") * 2 + 1})
    )
    # Same digits as an average over DECIMAL(p,2): scale six first, then two.
    mean = F.try_divide(F.col("revenue"), F.col("lines")).cast("decimal(38,6)")
    return both.select(
        *DIMS,
        F.round("revenue", 2).alias("total_revenue_usd"),
        F.col("orders").alias("total_orders"),
        F.round(mean, 2).alias("avg_order_value"),
        F.col("grouping_id").cast("long").alias("grouping_id"),
    )


def cube_sales(fact: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """The labelled cube: text dimensions, ``ALL`` for null.

    A dimension that is null in the data also reads ``ALL``; ``with_grouping_id`` keeps the id that
    tells the two apart.
    """
    labels = {name: F.coalesce(F.col(name).cast("string"), F.lit(ALL)) for name in DIMS}
    cube = cube_numbers(fact).withColumns(labels)
    return cube if with_grouping_id else cube.drop("grouping_id")
