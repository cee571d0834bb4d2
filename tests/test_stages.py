"""Written stages: the same facts, joins without an exchange, folders of the months asked for, opened again elsewhere."""

import re
from datetime import date

import pytest

from resalelake.operators.periods import Period, spans_of_months
from resalelake.plans import stages
from resalelake.plans.facts import Facts
from resalelake.sources.driver_tables import DriverTables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    return stages.stage(DriverTables(spark, SMALL).raw(), str(tmp_path_factory.mktemp("stages")), buckets=4)


def rows(df, like):
    return sorted(map(str, df.select(sorted(like.columns)).collect()))


@pytest.mark.parametrize("name", ["orders", "daily_sales", "product_sales", "refunds", "customers", "seller"])
@pytest.mark.parametrize("period", [None, Period(date(2001, 5, 3), date(2001, 6, 20)), spans_of_months([date(1999, 2, 1), date(2001, 6, 1)])], ids=["all", "days", "gaps"])
def test_same_facts(spark, staged, name, period):
    if period is not None and name in ("customers", "seller"):
        pytest.skip("no business day")
    want = Facts(DriverTables(spark, SMALL).raw()).fact(name, period)
    got = staged.fact(name, period)
    assert rows(got, want) == rows(want, want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_and_refunds_join_without_an_exchange(spark, staged):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("orders", "refunds"):
            for period in (None, Period(date(2001, 5, 3), date(2001, 6, 20))):
                text = plan(staged.fact(name, period))
                assert "SortMergeJoin" in text and "Exchange" not in text, name
        again = stages.StagedFacts.open(staged.raw, spark.newSession(), staged.root)
        text = plan(again.fact("orders"))
        assert "SortMergeJoin" in text and "Exchange" not in text
        want = staged.fact("orders")
        assert rows(again.fact("orders"), want) == rows(want, want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_folders_of_the_period_are_read(staged):
    df = staged.clean_orders(Period(date(2001, 5, 3), date(2001, 6, 20)))
    files = {re.search(r"month_start=([^/]+)", f)[1] for f in df.inputFiles()}
    df.collect()
    scans = re.findall(r"PartitionFilters: \[(.*?)\]", plan(df))
    assert files == {"2001-05-01", "2001-06-01"} and any("month_start" in s for s in scans)


def test_some_stages_only(spark, tmp_path):
    facts = stages.stage(DriverTables(spark, SMALL).raw(), str(tmp_path), ("headers",), buckets=2)
    want = Facts(DriverTables(spark, SMALL).raw())
    for name in ("orders", "refunds"):
        assert rows(facts.fact(name), want.fact(name)) == rows(want.fact(name), want.fact(name))
