"""Old versions go when nobody can be reading them, and nothing else does."""

import time
from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from resalelake.operators.periods import Period
from resalelake.plans import retention, warehouse
from resalelake.plans.facts import Facts
from resalelake.sources.driver_tables import DriverTables
from resalelake.sources.raw import RawTables
from resalelake.streaming import changes

NOW = timedelta(0)


def versions(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_a_reader_of_the_old_version_goes_on(spark, tmp_path):
    raw = DriverTables(spark, "/root/testdata/sf0.001").raw()
    some = raw.orders.where("order_created_at >= '2001-01-01'")
    facts, root = Facts(RawTables(lambda name: some if name == "orders" else getattr(raw, name))), str(tmp_path / "facts")
    warehouse.publish(facts, root, ("daily_sales",))
    reader = warehouse.PublishedFacts(spark, root).fact("daily_sales")
    want = sorted(map(str, reader.collect()))
    data = tmp_path / "facts/daily_sales/data"
    for _ in range(3):
        warehouse.publish(facts, root, ("daily_sales",))
        assert retention.sweep_fact(spark, root, "daily_sales") == []  # within the grace period
    assert len(versions(data)) == 4 and sorted(map(str, reader.collect())) == want
    warehouse.refresh(facts, root, Period(date(2001, 6, 1), date(2001, 6, 30)), ("daily_sales",))
    (data / "00000000000000000001-failed00").mkdir()
    assert len(retention.sweep_fact(spark, root, "daily_sales", NOW)) == 4  # three old ones and the failed write
    assert len(versions(data)) == 2
    assert sorted(map(str, warehouse.PublishedFacts(spark, root).fact("daily_sales").collect())) == want
    for _ in range(3):  # constant storage
        warehouse.refresh(facts, root, Period(date(2001, 6, 1), date(2001, 6, 30)), ("daily_sales",))
        retention.sweep_fact(spark, root, "daily_sales", NOW)
        assert len(versions(data)) == 2
    assert sorted(map(str, warehouse.PublishedFacts(spark, root).fact("daily_sales").collect())) == want


def test_changes_go_once_they_are_compacted(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, v int")
    table = changes.LatestRows(str(tmp_path / "t"), schema, ["id"], ["v"])
    for k in range(3):
        table.step(spark.createDataFrame([(str(k), k), ("x", k)], schema), k)
    root, rows = str(tmp_path / "t"), tmp_path / "t/rows"
    assert retention.sweep_changes(spark, root, ["rows"], NOW) == []
    table.compact(spark)
    table.step(spark.createDataFrame([("y", 9)], schema), 3)
    assert retention.sweep_changes(spark, root, ["rows"]) == []
    assert len(retention.sweep_changes(spark, root, ["rows"], NOW, time.time_ns())) == 3
    assert len(versions(rows)) == 2
    assert sorted(map(tuple, table.read(spark).collect())) == [("0", 0), ("1", 1), ("2", 2), ("x", 2), ("y", 9)]


def test_grace_is_counted_from_the_replacement(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, v int")
    table = changes.LatestRows(str(tmp_path / "t"), schema, ["id"], ["v"])
    table.step(spark.createDataFrame([("a", 1)], schema), 0)
    time.sleep(2)
    table.compact(spark)
    root = str(tmp_path / "t")
    assert retention.sweep_changes(spark, root, ["rows"], timedelta(seconds=1), retention._begun(table.log.versions(spark)[0]) + 500_000_000) == []
    assert retention.sweep_changes(spark, root, ["rows"], timedelta(seconds=1), time.time_ns() + 5_000_000_000) != []
    with pytest.raises(ValueError):
        retention._begun("nothing")
