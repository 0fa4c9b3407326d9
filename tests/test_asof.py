"""Joins with the last earlier row against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import asof, joins
from lakeworks.plans import gold
from tests_fact import fact_tables


def brute(left, right):
    out = []
    for n, key, time in left:
        known = [(t, v) for k, t, v in right if key is not None and time is not None and k == key and t is not None and t <= time]
        out.append((n, key, time, max(known, key=lambda x: (x[0], x[1] is not None, x[1] or 0))[1] if known else None))
    return sorted(out)


def rows(seed, n, hot):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "late", None])
    time = lambda: rng.choice([None, *range(60)])
    left = [(i, key(), time()) for i in range(n)]
    right = [(key(), time(), rng.randrange(100)) for _ in range(n // 4)]
    right = [(k, t + 50 if k == "late" and t is not None else t, v) for k, t, v in right] + [("a", 10, 3), ("a", 10, 9), ("only", 1, 1)]
    return left, right


@pytest.mark.parametrize(("seed", "hot", "limit", "parts"), [(0, 0.0, 16 << 20, 4), (1, 0.6, 16 << 20, 16), (2, 0.6, -1, 16), (3, 1.0, -1, 7)])
def test_as_of_join_matches_brute_force(spark, monkeypatch, seed, hot, limit, parts):
    monkeypatch.setattr(asof, "BROADCAST_BYTES", limit)
    left, right = rows(seed, 800, hot)
    frame = joins.with_row_slot(spark.createDataFrame(left, "n int, k string, t int"))
    known = spark.createDataFrame(right, "k string, since int, v int")
    got = asof.as_of_join(frame, known, "k", F.col("t"), F.col("since"), ["v"], parts=parts)
    assert sorted(map(tuple, got.select("n", "k", "t", "v").collect()), key=lambda r: r[0]) == brute(left, right)
    none = asof.as_of_join(frame, known.limit(0), "k", F.col("t"), F.col("since"), ["v"], parts=parts)
    assert none.where("v is not null").count() == 0 and none.count() == len(left)


def test_a_hot_key_is_cut_into_ranges(spark):
    """One key with every row is filled in many ranges, and what is known early reaches the last of them."""
    events = spark.range(4000).selectExpr("'hot' as k", "id as t", "if(id in (0, 1500), id, null) as v").repartition(5)
    filled = asof.carry_forward(events, "k", ["t"], "v", parts=16)
    assert [tuple(r) for r in filled.groupBy("v").count().orderBy("v").collect()] == [(0, 1500), (1500, 2500)]
    dealt = events.repartitionByRange(16, "k", "t").groupBy(F.spark_partition_id()).count()
    assert dealt.count() > 8


def test_fact_takes_the_rate_in_force(spark):
    tables = fact_tables(spark)
    rates = spark.createDataFrame(
        [("EUR", "1.5", "2024-01-01"), ("EUR", "2", "2024-01-02"), ("EUR", "1.75", "2024-01-02"), ("EUR", "9", "2024-01-03"), ("EUR", "8", "soon"),
         ("USD", "1", "2025-01-01"), (None, "7", "2020-01-01")], "currency_code string, r string, effective_date string",
    ).selectExpr("currency_code", "cast(r as decimal(9,4)) as exchange_rate_to_usd", "effective_date")
    frames = [tables[n] for n in ("items", "orders", "products", "customers")]
    got = gold.fact_orders(*frames, rates, "as_of").select("order_id", "product_id", F.col("revenue_usd").cast("double")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("o1", "p1", 40.2)] * 2 + [("o1", "p2", None)] * 2 + [(None, "p1", None), ("gone", "p3", None), ("o2", None, None)], key=str
    )
    with pytest.raises(ValueError, match="rate_policy"):
        gold.fact_orders(*frames, rates, "newest")
