"""Dirty commerce tables derived from the given parquet tables.

Each view is one SQL text that Spark and DuckDB read alike; ``chr(92)`` is the backslash. The given
tables have no nulls and no broken keys, so dirt is added by key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

CUSTOMERS = """
SELECT cast(c_custkey AS string) AS customer_id,
 CASE WHEN c_custkey % 29 = 0 THEN ' N/A ' ELSE c_name END AS customer_name,
 CASE WHEN c_custkey % 31 = 0 THEN chr(92) || 'N' WHEN c_custkey % 37 = 0 THEN NULL ELSE lower(c_name) || '@example.com' END AS email,
 CASE c_custkey % 4 WHEN 0 THEN '2023-01-15' WHEN 1 THEN '03/04/2023' WHEN 2 THEN '25/12/2023' ELSE '31-05-2023' END AS registration_date,
 CASE WHEN c_custkey % 41 = 0 THEN '?' ELSE n_name END AS country_code,
 CASE WHEN c_custkey % 43 = 0 THEN chr(10) WHEN c_custkey % 47 = 0 THEN chr(92) || 'N' ELSE c_mktsegment END AS channel
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

ORDERS = """
SELECT cast(o_orderkey AS string) AS order_id,
 CASE WHEN o_orderkey % 41 = 0 THEN 'n/a' WHEN o_orderkey % 43 = 0 THEN chr(92) || 'N' WHEN o_orderkey % 47 = 0 THEN NULL ELSE cast(o_custkey AS string) END AS customer_id,
 CASE WHEN o_orderkey % 101 = 0 THEN 'not a date' ELSE CASE o_orderkey % 5
  WHEN 0 THEN mm || '/' || dd || '/' || yy WHEN 1 THEN dd || '/' || mm || '/' || yy WHEN 2 THEN yy || '-' || mm || '-' || dd
  WHEN 3 THEN mm || '-' || dd || '-' || yy ELSE dd || '-' || mm || '-' || yy END END AS order_date,
 CASE o_orderstatus
  WHEN 'F' THEN CASE o_orderkey % 5 WHEN 0 THEN 'completado' WHEN 1 THEN 'abgeschlossen' WHEN 2 THEN '已完成' ELSE 'completed' END
  WHEN 'O' THEN CASE o_orderkey % 5 WHEN 0 THEN 'enviado' WHEN 1 THEN 'Shipped' ELSE 'shipped' END
  ELSE CASE o_orderkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'cancelado' WHEN 2 THEN NULL ELSE 'pending' END END AS order_status,
 CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE n_name END AS country_code,
 CASE WHEN o_orderkey % 59 = 0 THEN 'NULL' ELSE o_orderpriority END AS channel,
 cast(o_totalprice AS decimal(12,2)) AS total_amount,
 'USD' AS currency
FROM (SELECT *, lpad(cast(month(o_orderdate) AS string), 2, '0') AS mm, lpad(cast(day(o_orderdate) AS string), 2, '0') AS dd, cast(year(o_orderdate) AS string) AS yy FROM orders) o
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

ORDER_ITEMS = """
SELECT CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) END AS order_item_id,
 CASE WHEN l_orderkey % 61 = 0 THEN '' ELSE cast(l_orderkey AS string) END AS order_id,
 CASE WHEN l_partkey % 67 = 0 THEN chr(92) || 'N' ELSE cast(l_partkey AS string) END AS product_id,
 cast(l_quantity AS decimal(9,2)) AS quantity, cast(l_extendedprice AS decimal(12,2)) AS unit_price,
 cast(l_quantity * l_extendedprice AS decimal(18,2)) AS line_total
FROM lineitem
"""

PRODUCTS = """
SELECT cast(p_partkey AS string) AS product_id,
 CASE WHEN p_partkey % 71 = 0 THEN 'x' || chr(92) || 'Nx' ELSE p_name END AS product_name,
 CASE WHEN p_partkey % 73 = 0 THEN 'na' ELSE p_type END AS category,
 cast(p_retailprice AS decimal(12,2)) AS price,
 CASE p_partkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'INR' WHEN 3 THEN 'GBP' WHEN 4 THEN 'JPY' END AS currency,
 p_brand AS country_code
FROM part
"""

# Euro twice (the row repeats), no yen, and products without currency above.
EXCHANGE_RATES = """
SELECT currency_code, cast(rate AS decimal(9,4)) AS exchange_rate_to_usd, effective_date FROM (VALUES
 ('USD', 1.0, '2024-01-01'), ('EUR', 1.08, '01/06/2024'), ('EUR', 1.1, '25/06/2024'), ('INR', 0.012, '06-30-2024'), ('GBP', 1.27, '30-06-2024')) AS t(currency_code, rate, effective_date)
"""

# Rates by day: two of one day at the start of a month, the rupee only from mid-1994, no yen, some days unreadable.
RATE_HISTORY = """
SELECT CASE k WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'INR' WHEN 3 THEN 'GBP' END AS currency_code,
 cast(cast(5000 + n % 5000 + extra AS double) / 10000 AS decimal(9,4)) AS exchange_rate_to_usd,
 CASE WHEN n % 37 = 0 THEN 'soon' WHEN n % 2 = 0 THEN yy || '-' || mm || '-' || dd ELSE mm || '/' || dd || '/' || yy END AS effective_date
FROM (SELECT o_custkey % 5 AS k, o_orderdate, 0 AS extra, min(o_orderkey) AS n, lpad(cast(month(o_orderdate) AS string), 2, '0') AS mm,
  lpad(cast(day(o_orderdate) AS string), 2, '0') AS dd, cast(year(o_orderdate) AS string) AS yy FROM orders GROUP BY o_custkey % 5, o_orderdate
 UNION ALL SELECT o_custkey % 5 AS k, o_orderdate, 7 AS extra, min(o_orderkey) AS n, lpad(cast(month(o_orderdate) AS string), 2, '0') AS mm,
  lpad(cast(day(o_orderdate) AS string), 2, '0') AS dd, cast(year(o_orderdate) AS string) AS yy FROM orders WHERE day(o_orderdate) = 1 GROUP BY o_custkey % 5, o_orderdate) r
WHERE k <> 2 OR o_orderdate >= cast('1994-06-15' AS date)
"""

# Where each vector's text stands: a place in the document of the same number.
VECTOR_PLACES = """
SELECT vec_id, doc_id, cast((vec_id * 977) % greatest(length(text), 1) AS bigint) AS place FROM embeddings JOIN documents ON doc_id = vec_id
"""

PITCHES = """
SELECT o_orderkey AS pitch_id, o_orderstatus = 'F' AS deal,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Pitch "' || o_orderpriority || '", no. ' || cast(o_orderkey AS string) END AS description, c_mktsegment AS category,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS askedfor,
 CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE cast(1 + o_orderkey % 50 AS double) END AS exchangeforstake,
 CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice * (1 + o_custkey % 20) END AS valuation,
 cast(year(o_orderdate) - 1994 AS int) AS season,
 o_custkey % 2 = 0 AS multiple_entreprenuers, cast(o_orderkey % 3 = 0 AS int) AS has_website,
 CASE o_orderkey % 7 WHEN 0 THEN 'Barbara Corcoran' WHEN 1 THEN 'Kevin Harrington' WHEN 2 THEN 'mark cuban' WHEN 3 THEN 'Lori Greiner' ELSE NULL END AS shark1,
 CASE o_orderkey % 5 WHEN 0 THEN 'Robert Herjavec' WHEN 1 THEN 'Daymond John' ELSE NULL END AS shark2,
 CASE o_orderkey % 3 WHEN 0 THEN 'Barbara Corcoran' WHEN 1 THEN 'Kevin Harrington' ELSE NULL END AS shark3,
 CASE WHEN o_orderkey % 2 = 0 THEN 'Lori Greiner' END AS shark4, CASE WHEN o_custkey % 4 < 2 THEN 'Nick, guest' END AS shark5
FROM orders JOIN customer ON o_custkey = c_custkey
"""

VIEWS = {
    "customers_bronze": CUSTOMERS,
    "orders_bronze": ORDERS,
    "order_items_bronze": ORDER_ITEMS,
    "products_bronze": PRODUCTS,
    "exchange_rates_bronze": EXCHANGE_RATES,
    "rate_history_bronze": RATE_HISTORY,
    "vector_places": VECTOR_PLACES,
    "pitches": PITCHES,
}

COMMERCE = ("customers", "orders", "order_items", "products", "exchange_rates")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived view over the given tables of a folder."""
    text = VIEWS[name]
    for base in ("customer", "nation", "orders", "lineitem", "part", "documents", "embeddings"):
        table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(text)


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return view(spark, sf_dir, f"{name}_bronze")
