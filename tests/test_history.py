"""Versions in time against taking each day by itself."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from resalelake.operators import history
from resalelake.operators.periods import Period
from resalelake.plans.facts import Facts
from resalelake.sources.driver_tables import DriverTables

DAY = date(2001, 1, 1)


@pytest.fixture(scope="module")
def known():
    rng = random.Random(4)
    rows = [(f"k{rng.randrange(9)}", DAY + timedelta(days=rng.randrange(70)), rng.randrange(20), rng.choice("ab"), rng.randrange(5)) for _ in range(150)]
    return [*rows, *rows[:5], ("k0", None, 99, "a", 1), ("k1", DAY, None, "b", None), (None, DAY, 3, "a", 2)]


def best_on(known, day):
    best = {}
    for k, d, u, g, v in known:
        if d is not None and d <= day:
            rank = ((u is not None, u), d, g, (v is not None, v))
            if k not in best or rank > best[k][0]:
                best[k] = (rank, (k, d, u, g, v))
    return {k: row for k, (_, row) in best.items()}


SCHEMA = "k string, d date, u int, g string, v int"


def test_versions(spark, known):
    found = history.versions(spark.createDataFrame(known, SCHEMA), ["k"], "d", ["u"])
    rows = found.collect()
    for n in range(72):
        day = DAY + timedelta(days=n)
        held = {r.k: (r.k, r.d, r.u, r.g, r.v) for r in rows if r.valid_from <= day and (r.valid_to is None or r.valid_to > day)}
        assert held == best_on(known, day)
        if n % 30 == 3:
            assert history.on_day(found, F.lit(day)).count() == len(held)


def test_totals_by_day(spark, known):
    found = history.versions(spark.createDataFrame(known, SCHEMA), ["k"], "d", ["u"])
    period = Period(DAY + timedelta(days=5), DAY + timedelta(days=90))
    got = {(r.g, r.day): (r.n, r.v) for r in history.totals_by_day(found, period, ["g"], {"v": F.col("v")}).collect()}
    want = {}
    for n in range(5, 91):
        for _, _, _, g, v in best_on(known, DAY + timedelta(days=n)).values():
            n_, v_ = want.get((g, DAY + timedelta(days=n)), (0, 0))
            want[g, DAY + timedelta(days=n)] = (n_ + 1, v_ + (v or 0))
    assert got == want
    assert history.totals_by_day(found.limit(0), period, ["g"], {"v": F.col("v")}).count() == 0


def test_attach_as_of(spark, known):
    found = history.versions(spark.createDataFrame(known, SCHEMA), ["k"], "d", ["u"])
    rows = [(f"k{n % 11}", DAY + timedelta(days=7 * n % 120 - 10), n) for n in range(200)] + [(None, DAY, -1), ("k1", None, -2)]
    left = spark.createDataFrame(rows, "k string, on_day date, n int")
    got = {r.n: (r.d, r.u) for r in history.attach_as_of(left, found, ["k"], "on_day").collect()}
    assert len(got) == len(rows)
    for k, day, n in rows:
        row = best_on(known, day).get(k) if day and k else None
        assert got[n] == ((row[1], row[2]) if row else (None, None))


def test_attach_as_of_does_not_make_the_rows_to_find_their_newest_day(spark, known):
    """Given a day that no row is after, however late, the rows are the same and are not read for it."""
    found = history.versions(spark.createDataFrame(known, SCHEMA), ["k"], "d", ["u"])
    left = spark.createDataFrame([(f"k{n % 11}", DAY + timedelta(days=7 * n % 120 - 10), n) for n in range(200)], "k string, on_day date, n int")
    want = sorted(map(str, history.attach_as_of(left, found, ["k"], "on_day").collect()))
    for late in (DAY + timedelta(days=109), DAY + timedelta(days=900)):
        assert sorted(map(str, history.attach_as_of(left, found, ["k"], "on_day", late).collect())) == want
    broken = left.withColumn("n", F.raise_error(F.lit("read")).cast("int")).where("n > 0")
    assert history.attach_as_of(broken, found, ["k"], "on_day", DAY + timedelta(days=109)).columns[:3] == ["k", "on_day", "n"]


def test_daily_stock_equals_each_day_by_itself(spark):
    facts = Facts(DriverTables(spark, "/root/testdata/sf0.001").raw())
    days = [date(2001, 6, 13), date(2001, 6, 14), date(2001, 7, 13), date(2001, 7, 20)]
    found = facts.daily_stock(Period(days[0], days[-1])).where(F.col("day").isin(days))
    got = {(r.day, r.aging_bucket): (r.products, r.units_on_hand, r.retail_value) for r in found.collect()}
    want = {}
    for day in days:
        sums = facts.inventory(as_of=day).groupBy("aging_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("units_on_hand").alias("u"), F.sum("retail_value").alias("v"))
        want |= {(day, r.aging_bucket): (r.n, r.u, r.v) for r in sums.collect()}
    assert got == want and want
