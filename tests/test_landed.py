"""Facts from landed Parquet under the declared contracts: same results, and filters that reach the scan."""

from datetime import date

import pytest

from resalelake.operators.periods import Period
from resalelake.plans.facts import FACT_NAMES, Facts
from resalelake.sources.contracts import RAW_DDL, conform, schema_differences
from resalelake.sources.driver_tables import DriverTables
from resalelake.sources.raw import RawTables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    derived = DriverTables(spark, SMALL).raw()
    for name in RAW_DDL:
        conform(getattr(derived, name), name).write.parquet(f"{root}/{name}")
    return RawTables.landed(spark, root)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contracts_hold(landed):
    assert all(schema_differences(getattr(landed, name), name) == {} for name in RAW_DDL)


@pytest.mark.parametrize("name", FACT_NAMES)
def test_same_facts(spark, landed, name):
    want = getattr(Facts(DriverTables(spark, SMALL).raw()), name)()
    got = getattr(Facts(landed), name)()
    columns = sorted(want.columns)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_period_and_columns_reach_the_scan(spark, landed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    july = Period(date(2001, 7, 1), date(2001, 7, 31))
    plan = plan_of(Facts(landed).orders(july, {"channel", "net_sales"}))
    assert "GreaterThanOrEqual(order_created_at,2001-06-29)" in plan
    assert "LessThan(order_created_at,2001-08-03)" in plan
    read = plan[plan.index("ReadSchema"):]
    assert "line_item" not in read and "utm" not in read and "order_quantity" not in read


def test_facts_need_no_cross_join_and_no_python(landed):
    for name in FACT_NAMES:
        plan = plan_of(getattr(Facts(landed), name)())
        assert not any(word in plan for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas")), name
