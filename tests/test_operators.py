"""Choice of row, joins under skew, pivots, periods, filters, identity."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from resalelake.operators import identity
from resalelake.operators import periods as P
from resalelake.operators.aggregate import frequency, latest_known, one_row, share_of_total
from resalelake.operators.dedup import best_row, best_row_by, located_first
from resalelake.operators.filters import Filters
from resalelake.operators.joins import attach, match_or_keep
from resalelake.operators.reshape import pivot_attributes

ORDERS = "order_id string, order_location_name string, date date, note string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_location_beats_recency_and_ties_are_total(spark):
    rows = [
        ("1", None, date(2026, 1, 3), "newer"), ("1", "S", date(2026, 1, 1), "older, has store"),
        ("2", None, date(2026, 1, 1), "a"), ("2", None, date(2026, 1, 2), "b"),
        ("3", "S", date(2026, 1, 1), "x"), ("3", "S", date(2026, 1, 1), "y"),
        ("4", "S", None, "undated"), ("4", "S", date(2020, 1, 1), "dated"),
    ]
    expected = {"1": "older, has store", "2": "b", "3": "y", "4": "dated"}
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, ORDERS).repartition(3)
        got = {r.order_id: r.note for r in best_row(df, ["order_id"], ["date"], [located_first()]).collect()}
        assert got == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=30))
def test_best_row_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, w int")
    expected = {k: max((v, w) for kk, v, w in rows if kk == k) for k, _, _ in rows}
    assert {r.k: (r.v, r.w) for r in best_row(df, ["k"], latest=["v"]).collect()} == expected


def test_null_folded_keys_collapse(spark):
    df = spark.createDataFrame([("o", None, 1), ("o", 0, 2), ("o", 5, 1)], "k string, amount int, v int")
    out = best_row_by(df, {"k": F.col("k"), "a": F.coalesce("amount", F.lit(0))}, latest=["v"])
    assert rows_of(out) == [("o", 0, 2), ("o", 5, 1)]


def test_attach_equals_plain_left_join_under_skew(spark):
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 40).cast("string")).alias("k"), "id"
    )
    dim = spark.createDataFrame([("hot", 1), ("7", 2), ("unused", 3)], "k string, price int")
    for threshold in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert rows_of(attach(big, dim, "k", spread=["id"])) == rows_of(big.join(dim, "k", "left"))


def test_hot_key_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    big = spark.range(8000).select(F.lit("hot").alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1)], "k string, price int")
    sizes = attach(big, dim, "k", spread=["id"]).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert len(sizes) > 1 and max(r[1] for r in sizes) < 8000


def test_match_or_keep_fans_out_and_keeps(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = spark.createDataFrame([("a", i) for i in range(40)] + [(None, 99)], "k string, r int")
    assert rows_of(match_or_keep(left, right, "k", ["r"])) == rows_of(left.join(right, "k", "left"))


def test_names_match_without_case_or_padding(spark):
    sellers = spark.createDataFrame([(" Ann LEE ",), ("Bo Ray",), ("Nobody",)], "seller_name string")
    buyers = spark.createDataFrame(
        [("1", "ann", "lee "), ("2", " Ann", "Lee"), ("3", "Bo", None)],
        "customer_id string, customer_first_name string, customer_last_name string",
    )
    got = identity.match_by_name(sellers, buyers).select("seller_name", "customer_id")
    assert rows_of(got) == [(" Ann LEE ", "1"), (" Ann LEE ", "2"), ("Bo Ray", None), ("Nobody", None)]


def test_pivot_newest_and_any_version(spark):
    day = date(2026, 1, 1)
    rows = [
        ("p", "buy", "date", "2026-01-02", day, "a"), ("p", "buy", "date", "2026-01-01", day, "z"),
        ("p", "buy", "msrp", "2026-01-02", day, None), ("p", "buy", "msrp", "2026-01-01", day, "9"),
        ("q", "other", "date", "2026-01-01", day, "ignored"),
    ]
    df = spark.createDataFrame(
        rows,
        "product_id string, product_metafield_namespace string, product_metafield_key string, "
        "product_metafield_update_at string, date date, product_metafield_value string",
    )
    wanted = {"day": ("buy", "date"), "msrp": ("buy", "msrp")}
    assert rows_of(pivot_attributes(df, wanted, newest=True)) == [("p", "a", None)]
    assert rows_of(pivot_attributes(df, wanted, newest=False)) == [("p", "z", "9")]


def test_latest_known_skips_nulls(spark):
    rows = [("c", 3, None), ("c", 2, "two"), ("c", 1, "one"), ("d", 1, None)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert rows_of(df.groupBy("k").agg(latest_known("v", "t").alias("v"))) == [("c", "two"), ("d", None)]


def test_shares_frequencies_and_scalars(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "k string")
    grouped = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert rows_of(share_of_total(grouped, "n", "pct")) == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert [tuple(r) for r in frequency(df, ["k"]).collect()] == [("a", 3), ("b", 1)]
    parts = [df.agg(F.count("k").alias("x")), df.where("false").agg(F.sum(F.lit(1)).alias("y"))]
    assert rows_of(one_row(parts)) == [(4, None)]


def test_periods():
    day = date(2026, 1, 31)
    assert P.this_month(day) == P.Period(date(2026, 1, 1), date(2026, 1, 31))
    assert P.same_month_last_year(date(2024, 2, 29)) == P.Period(date(2023, 2, 1), date(2023, 2, 28))
    assert P.last_days(day, 30).start == date(2026, 1, 1)
    assert P.last_months(date(2026, 3, 31), 1).start == date(2026, 2, 28)
    assert P.previous(P.Period(date(2026, 3, 1), date(2026, 3, 10))) == P.Period(date(2026, 2, 19), date(2026, 2, 28))


def test_filters_add_only_what_is_set(spark):
    df = spark.createDataFrame(
        [("A", "Retail", date(2026, 1, 1)), ("B", "Ecomm", date(2026, 2, 1))], "store_location string, channel string, day date"
    )
    assert Filters().apply(df, "day").count() == 2
    assert Filters(store_location="A").apply(df).count() == 1
    with pytest.raises(ValueError):
        Filters(store_location="A").apply(df, only=("channel",))
    with pytest.raises(ValueError):
        Filters(contract_type="x").apply(df)
    assert Filters(P.Period(date(2026, 1, 15)), channel=("Retail", "Ecomm")).apply(df, "day").count() == 1
