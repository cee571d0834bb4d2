"""Sinks, incremental jobs, streams, quality checks."""

from datetime import date
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from resalelake.operators.dedup import best_row
from resalelake.operators.filters import Filters
from resalelake.operators.periods import Period
from resalelake.plans import incremental, quality, warehouse
from resalelake.plans.facts import Facts
from resalelake.session import shared_folder
from resalelake.sources import contracts, sinks
from resalelake.sources.driver_tables import DriverTables
from resalelake.sources.raw import RawTables
from resalelake.streaming import changes, jobs

SMALL = "/root/testdata/sf0.001"
ROWS = "date date, id string, v int"


def ads(spark, *rows):
    return spark.createDataFrame([(date(2026, 1, d), i, v) for d, i, v in rows], ROWS)


def stored(spark, path):
    return sorted(map(tuple, spark.read.schema(ROWS).parquet(path).select("date", "id", "v").collect()))


def test_append_keeps_repeats_and_replace_days_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(ads(spark, (1, "a", 1), (2, "b", 2)), path)
    sinks.append(ads(spark, (1, "a", 1)), path)
    assert len(stored(spark, path)) == 3
    for _ in range(2):
        sinks.replace_days(ads(spark, (1, "a", 9)), path)
        assert stored(spark, path) == [(date(2026, 1, 1), "a", 9), (date(2026, 1, 2), "b", 2)]


def test_replace_swaps_whole_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.replace(ads(spark, (1, "a", 1), (1, "a", 1)), root)
    sinks.rebuild(root, spark, lambda df: df.distinct())
    assert sinks.current(spark, root).count() == 1


def test_merge_days_takes_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(ads(spark, (1, "a", 1), (2, "b", 1)), path)
    incremental.merge_days(spark, path, ads(spark, (1, "a", 2), (1, "c", 2)), lambda df: best_row(df, ["date", "id"], ["v"]))
    assert [r[1:] for r in stored(spark, path)] == [("a", 2), ("c", 2), ("b", 1)]


def test_repull_leaves_older_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(ads(spark, (1, "a", 1), (20, "a", 1)), path)
    incremental.repull(ads(spark, (1, "a", 7), (20, "a", 7)), path, date(2026, 1, 21), days=5)
    assert [r[2] for r in stored(spark, path)] == [1, 7]


def test_days_that_vanish_from_a_pull_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(ads(spark, (1, "a", 1), (18, "a", 1), (20, "a", 1), (25, "a", 1)), path)
    for _ in range(2):
        sinks.replace_days(ads(spark, (20, "a", 7)), path, asked=Period(date(2026, 1, 17), date(2026, 1, 21)))
        assert [(r[0].day, r[2]) for r in stored(spark, path)] == [(1, 1), (20, 7), (25, 1)]
    incremental.repull(ads(spark), path, date(2026, 1, 21), days=5)
    assert [r[0].day for r in stored(spark, path)] == [1]


def test_a_slot_that_is_not_offered_is_an_error(spark):
    with pytest.raises(ValueError):
        Filters(ship_province="Ontario").apply(ads(spark, (1, "a", 1)))
    with pytest.raises(ValueError):
        Filters(ship_province="Ontario").apply(ads(spark, (1, "a", 1)).withColumn("ship_province", F.lit("Ontario")), only=("channel",))


def test_lookback_and_backfill_windows(spark):
    df = spark.createDataFrame([("1", "2026-01-01T00:00:00Z", "2026-02-09T10:00:00Z"), ("2", "2026-02-08T00:00:00Z", "2026-02-10T23:00:00Z")],
                               "id string, created_at string, updated_at string")
    assert incremental.recently_updated(df, date(2026, 2, 10)).count() == 2
    assert incremental.recently_updated(df, date(2026, 2, 10), lookback=0).count() == 1
    assert incremental.created_between(df, Period(date(2026, 2, 1), date(2026, 2, 28))).count() == 1


def test_cleanup_keeps_days_apart(spark):
    rows = [("o", date(2026, 1, d), "l", date(2026, 1, d), store, c, None, None, None, None) for d, store, c in
            ((1, None, "c"), (1, "S", None), (1, "S", "c"), (2, None, None))]
    df = spark.createDataFrame(rows, "order_id string, date date, line_item__id string, ingested_at date, order_location_name string, "
                               "order_customer_id string, line_item__product_id string, line_item__quantity int, line_item__price int, "
                               "line_item__total_discount int")  # fmt: skip
    got = [(r.date.day, r.order_location_name, r.order_customer_id) for r in incremental.one_per_day(df).orderBy("date").collect()]
    assert got == [(1, "S", "c"), (2, None, None)]


@pytest.mark.parametrize("files,per_batch,grain", [(1, None, "month"), (4, 1, "month"), (4, 3, "month"), (2, 1, "day")])
def test_stream_of_daily_sales_equals_batch(spark, tmp_path, files, per_batch, grain):
    """Late repeats included, files in no order of time, whatever the micro-batches."""
    raw = DriverTables(spark, SMALL).raw()
    if grain == "day":
        march = raw.orders.where("order_created_at >= '2000-03-01' AND order_created_at < '2000-04-01'")
        raw = RawTables(lambda name: march)
    columns = ["order_id", "date", "order_created_at", "order_app_name", "order_financial_status", "order_test", "order_net_sales",
               "order_shipping_price", "ingested_at", "order_processed_at", "order_subtotal_price", "order_location_name"]
    headers = raw.orders.select(*columns).distinct()
    headers.unionByName(headers.limit(200)).repartition(files).write.parquet(str(tmp_path / "in"))
    job = changes.DailySales(str(tmp_path / "sales"), grain=grain)
    jobs.drain_each(jobs.follow(spark, str(tmp_path / "in"), headers.schema, per_batch), job.step, str(tmp_path / "check"))
    batch = Facts(raw).clean_orders(columns={"order_date", "channel", "net_sales"}).groupBy("order_date", "channel").agg(
        F.sum("net_sales").alias("net_sales"), F.count("order_id").alias("orders"))
    want = sorted(map(tuple, batch.collect()), key=str)
    assert sorted(map(tuple, job.read(spark).select("order_date", "channel", "net_sales", "orders").collect()), key=str) == want
    assert len(want) > (300 if grain == "month" else 10)


@pytest.mark.parametrize("per_batch", [None, 1, 3])
def test_repeats_go_and_nothing_else(spark, tmp_path, per_batch):
    rows = DriverTables(spark, SMALL).raw().orders.select("order_id", "order_created_at").distinct()
    rows.unionByName(rows.where("CAST(order_id AS BIGINT) % 3 = 0")).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = jobs.drop_repeats(jobs.follow(spark, str(tmp_path / "in"), rows.schema, per_batch), ["order_id"])
    jobs.drain(stream.drop(jobs.ARRIVED), str(tmp_path / "out"), str(tmp_path / "check"))
    out = spark.read.schema(rows.schema).parquet(str(tmp_path / "out"))
    assert out.count() == out.distinct().count() == rows.count()


def test_published_facts_read_only_the_months_asked_for(spark, tmp_path):
    facts = warehouse.stage(DriverTables(spark, SMALL).raw(), str(tmp_path / "stages"))
    warehouse.publish(facts, str(tmp_path / "facts"), ("orders", "inventory"))
    period = Period(date(2001, 7, 1), date(2001, 7, 31))
    published = warehouse.PublishedFacts(spark, str(tmp_path / "facts"))
    july = published.fact("orders", period)
    plain = Facts(DriverTables(spark, SMALL).raw()).orders(period)
    order = sorted(plain.columns)
    assert sorted(map(str, july.select(order).collect())) == sorted(map(str, plain.select(order).collect()))
    assert july.count() > 0
    assert published.fact("inventory").count() == facts.inventory().count()


def published(spark, root, name="orders"):
    return sorted(map(str, warehouse.PublishedFacts(spark, root).fact(name).collect()))


def test_refresh_writes_only_its_months_and_changes_nothing_else(spark, tmp_path):
    root = str(tmp_path / "facts")
    facts = Facts(DriverTables(spark, SMALL).raw())
    warehouse.publish(facts, root, ("orders",))
    before = published(spark, root)
    for _ in range(2):
        warehouse.refresh(facts, root, Period(date(2001, 6, 20), date(2001, 7, 2)), ("orders",))
    assert published(spark, root) == before
    newest = max((tmp_path / "facts/orders/data").iterdir())
    assert {p.name for p in newest.glob("month_start=*")} == {"month_start=2001-06-01", "month_start=2001-07-01"}


def test_refresh_follows_late_updates_costs_and_withdrawals(spark, tmp_path):
    root = str(tmp_path / "facts")
    raw = DriverTables(spark, SMALL).raw()
    facts, today = Facts(raw), date(2001, 9, 1)
    names = ("orders", "product_sales", "refunds", "customers")
    warehouse.publish(facts, root, names)
    late = F.col("order_created_at").startswith("2000-03")
    changed = {
        "orders": raw.orders.where(~F.col("order_created_at").startswith("1999-11"))
        .withColumn("ingested_at", F.when(late, F.lit(today)).otherwise(F.col("ingested_at")))
        .withColumn("order_app_name", F.when(late, "Shop").otherwise(F.col("order_app_name"))),
        "products": raw.products.unionByName(
            raw.products.where("product_id = '7' AND date = DATE '2001-07-14'").withColumns(
                {"date": F.lit(today), "product_updated_at_datetime": F.lit("2001-09-01T00:00:00Z"),
                 "product_variant_inventory_item_cost": F.lit(3).cast("decimal(18,4)")})),
    }
    now = Facts(RawTables(lambda name: changed.get(name, getattr(raw, name))))
    warehouse.refresh(now, root, Period(today), names)
    warehouse.refresh(now, root, Period(date(1999, 11, 1), date(1999, 11, 30)), ("orders", "product_sales", "refunds"))
    for name in names:
        assert published(spark, root, name) == sorted(map(str, now.fact(name).collect())), name


def test_contract_checks(spark):
    df = spark.createDataFrame([("x", "1"), ("2", None)], "customer_id string, extra string")
    found = contracts.schema_differences(df, "customers")
    assert found["extra"] == "unexpected" and found["date"] == "missing" and "customer_id" not in found
    assert contracts.schema_differences(contracts.conform(df, "customers"), "customers") == {}
    assert [tuple(r) for r in contracts.cast_failures(df, {"customer_id": "bigint"}).collect()] == [("customer_id", 2, 1)]


def test_quality_reports(spark):
    a = ads(spark, (1, "a", 10), (1, "a", 10), (2, "b", 5))
    b = ads(spark, (1, "a", 20), (3, "c", 1))
    assert [tuple(r)[1:3] for r in quality.duplicates(a, ["date", "id"]).collect()] == [("a", 2)]
    assert sorted(tuple(r)[1:] for r in quality.row_delta(a, b).collect()) == [(0, 1, 1), (1, 0, -1), (2, 1, -1)]
    got = {r.date.day: (r.difference, r.difference_pct, r.within_tolerance) for r in quality.reconcile(a, b, "date", "v", 1.0).collect()}
    assert got == {1: (0, 0.0, True), 2: (5, None, False), 3: (-1, -100.0, False)}
    report = quality.load_report(a, "id", ["v"]).first()
    assert (report.total_rows, report.unique_keys, report.has_v) == (3, 2, 3)


def test_shared_folder_follows_the_cluster_setting(spark):
    def session(settings, master):
        conf = SimpleNamespace(get=lambda key, default: settings.get(key, default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    shared = session({"spark.checkpoint.dir": "hdfs://a/b/"}, "spark://host")
    assert shared_folder(shared, "x").startswith("hdfs://a/b/x-")
    with pytest.raises(ValueError):
        shared_folder(session({}, "spark://host"), "x")
    assert shared_folder(session({}, "local[2]"), "x") != shared_folder(session({}, "local[2]"), "x")


def test_money_stays_exact(spark):
    facts = Facts(DriverTables(spark, SMALL).raw())
    by_day = facts.daily_sales(columns={"net_sales"}).agg(F.sum("net_sales")).first()[0]
    by_order = facts.clean_orders(columns={"net_sales"}).agg(F.sum("net_sales")).first()[0]
    assert isinstance(by_order, Decimal) and abs(by_day - by_order) < 1
