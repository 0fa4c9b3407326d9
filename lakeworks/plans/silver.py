"""Bronze to silver: one cleaning rule per table, applied in a single projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.functions import quality as q

# Numbers are typed at ingest: arithmetic on text fails, and sums of doubles depend on row order.
SOURCE_TYPES = {
    "orders": {"total_amount": "decimal(12,2)"},
    "order_items": {"quantity": "decimal(9,2)", "unit_price": "decimal(12,2)", "line_total": "decimal(18,2)"},
    "products": {"price": "decimal(12,2)"},
    "exchange_rates": {"exchange_rate_to_usd": "decimal(9,4)"},
}

LINEAGE = ("_modified", "ingested_at")


@dataclass(frozen=True)
class CleaningRule:
    """What one silver table keeps and checks.

    ``checks`` maps each checked column to whether the null mark counts as missing there.
    """

    columns: tuple[str, ...]
    key: str | None = None
    checks: dict[str, bool] = field(default_factory=dict)
    date: str | None = None


RULES = {
    "customers": CleaningRule(
        columns=("customer_id", "customer_name", "email", "registration_date", "country_code", "channel"),
        key="customer_id",
        checks={"customer_name": False, "email": True, "channel": False, "country_code": False},
        date="registration_date",
    ),
    "orders": CleaningRule(
        columns=(
            "order_id",
            "customer_id",
            "order_date",
            "order_status",
            "country_code",
            "channel",
            "total_amount",
            "currency",
        ),
        key="order_id",
        checks={"customer_id": True, "channel": True, "country_code": True},
        date="order_date",
    ),
    "order_items": CleaningRule(
        columns=("order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"),
        key="order_item_id",
        checks={"order_id": True, "product_id": True},
    ),
    "products": CleaningRule(
        columns=("product_id", "product_name", "category", "price", "currency", "country_code"),
        key="product_id",
        checks={"product_name": True, "category": True, "country_code": True},
    ),
    "exchange_rates": CleaningRule(
        columns=("currency_code", "exchange_rate_to_usd", "effective_date"),
        date="effective_date",
    ),
}


def clean(bronze: DataFrame, rule: CleaningRule) -> DataFrame:
    """Apply a rule: key filter, flag on the raw values, nulling and date text, in one select."""

    def cleaned(name: str):
        if name in rule.checks:
            return q.keep_present(name, rule.checks[name])
        return q.normalise_date(name) if name == rule.date else F.col(name)

    carried = [F.col(name) for name in LINEAGE if name in bronze.columns]
    flag = [q.validity_flag(rule.checks).alias("is_valid")] if rule.checks else []
    rows = bronze.filter(F.col(rule.key).isNotNull()) if rule.key else bronze
    return rows.select(*[cleaned(name) for name in rule.columns], *carried, *flag)


def standardise_status(orders: DataFrame) -> DataFrame:
    """Add standard_status and is_invalid_status, then null missing statuses.

    The match is exact: other case or stray blanks leave the standard status null.
    """
    words = F.broadcast(q.status_map(orders.sparkSession))  # twenty fixed rows
    matched = orders.join(words, F.col("order_status") == F.col("raw_status"), "left").drop("raw_status")
    return matched.withColumn("is_invalid_status", q.is_missing("order_status").cast("int")).withColumns(
        {name: q.keep_present(name) for name in ("order_status", "standard_status")}
    )


def silver_customers(bronze: DataFrame) -> DataFrame:
    return clean(bronze, RULES["customers"])


def silver_orders(bronze: DataFrame) -> DataFrame:
    return standardise_status(clean(bronze, RULES["orders"]))


def silver_order_items(bronze: DataFrame) -> DataFrame:
    return clean(bronze, RULES["order_items"])


def silver_products(bronze: DataFrame) -> DataFrame:
    return clean(bronze, RULES["products"])


def silver_exchange_rates(bronze: DataFrame) -> DataFrame:
    return clean(bronze, RULES["exchange_rates"])


SILVER = {
    "customers": silver_customers,
    "orders": silver_orders,
    "order_items": silver_order_items,
    "products": silver_products,
    "exchange_rates": silver_exchange_rates,
}


def validity_counts(silver: DataFrame) -> DataFrame:
    """Rows per validity flag."""
    return silver.groupBy("is_valid").agg(F.count(F.lit(1)).alias("n_rows"))
