"""Small tables for the fact, shared by tests."""

from decimal import Decimal as D


def fact_tables(spark):
    make = spark.createDataFrame
    return {
        "items": make(
            [("1", "o1", "p1", D("2"), D("10.05")), ("2", "o1", "p2", D("1"), D("3")), ("3", None, "p1", D("1"), D("7")),
             ("4", "gone", "p3", D("1"), D("7")), ("5", "o2", None, D("1"), D("7"))],
            "order_item_id string, order_id string, product_id string, quantity decimal(9,2), unit_price decimal(12,2)",
        ),
        "orders": make(
            [("o1", "c1", "2024-01-02", "completed", "DE", "web"), ("o2", None, "soon", None, None, None)],
            "order_id string, customer_id string, order_date string, standard_status string, country_code string, channel string",
        ),
        "products": make(
            [("p1", "a", "x", D("1"), "DE", "EUR"), ("p2", "b", "x", D("1"), "DE", "USD"), ("p3", "c", "x", D("1"), "DE", "JPY")],
            "product_id string, product_name string, category string, price decimal(12,2), country_code string, currency string",
        ),
        "customers": make([("c1", "n", "e", "DE"), ("c1", "n", "e2", "DE"), (None, "n", "e", "DE")], "customer_id string, customer_name string, email string, country_code string"),
    }
