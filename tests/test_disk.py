"""What queries put on disk: landed documents are compressed, and the lines of an order are moved once, as they were read."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from resalelake.plans import operator_queries
from resalelake.plans.facts import Facts
from resalelake.sources import driver_tables
from resalelake.sources.driver_tables import DriverTables


def lines_of(orders):
    """Lines of some orders, one of them twice, one without order and one whose order is not there."""
    keys = [k for k in orders for _ in range(0 if k is None else k % 4)]
    rows = [(k, n % 97, 1, n % 7 + 1, float(n % 5), n / 8, 0.1, 0.05, "R" if n % 3 else "N", "F", datetime(2000, 1 + n % 12, 3)) for n, k in enumerate(keys)]
    return [*rows, rows[0], (None, *rows[1][1:]), (10**6, *rows[2][1:])]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, orders = str(tmp_path_factory.mktemp("shop")), [None, *range(1, 400), 5, 6, None]
    rows = [(k, None if n % 9 == 0 else n % 31, "OPF"[n % 3], n * 1.25, datetime(1999, 1 + n % 12, 1 + n % 28), f"{n % 5 + 1}-HIGH" if n % 5 == 1 else "1-URGENT") for n, k in enumerate(orders)]
    parts = [(k, f"name {k}", f"Brand#{k % 7}", "t", k % 9, k / 4) for k in range(97)]
    for name, found in (("orders", rows), ("lineitem", lines_of(orders)), ("part", parts)):
        spark.createDataFrame(found, driver_tables.TABLES[name][0]).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def counted(df):
    return sorted(map(str, df.collect()))


def test_landed_documents_are_compressed(spark, folder, tmp_path, monkeypatch):
    made = []

    def new_folder(_, label):
        made.append(tmp_path / f"{label}-{len(made)}")
        return str(made[-1])

    monkeypatch.setattr(operator_queries, "shared_folder", new_folder)
    x = operator_queries.Context(spark, folder)
    found = counted(operator_queries.s2_flatten_landed_json(x))
    files = [f for f in made[0].iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    documents = operator_queries.order_payloads(x).where("id IS NOT NULL")  # without an id none is landed
    documents.write.json(str(tmp_path / "plain"))
    assert sum(f.stat().st_size for f in files) < sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*")) / 2
    assert operator_queries.payloads.read_landing(spark, "order", str(made[0])).count() == documents.count()
    monkeypatch.setattr(operator_queries.payloads, "read_landing", lambda *_: documents)
    assert found == counted(operator_queries.s2_flatten_landed_json(x))


def exchanges(df):
    """What rows are dealt out by, from the last exchange to the first."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1].split(", ENSURE")[0].split(", REPARTITION")[0] for line in plan.splitlines() if "Exchange " in line]


def test_lines_of_an_order_are_moved_once(spark, folder, monkeypatch):
    """Rows of orders and lines meet by the order's id, and clean-up by order, or order and line, moves none of them again."""
    monkeypatch.setattr(driver_tables, "DEALT", {"orders": 1 << 12})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = DriverTables(spark, folder).raw()
        lines, headers = Facts(raw).merchandise_lines(labels=("order_app_name",)), Facts(raw).clean_orders(columns={"net_sales"})
        by = exchanges(lines)
        assert len(by) == 2 and all("AS STRING" in x.upper() or "as string" in x for x in by)
        assert not any("line_item__id" in x or "order_id" in x for x in by)
        assert len(exchanges(headers)) == 1 and "lineitem" not in headers._jdf.queryExecution().executedPlan().toString()
        rows = raw.orders.select("order_id", "ingested_at", "order_quantity", "line_item__id", "line_item__title", "line_item__price")
        orders, items = (DriverTables(spark, folder).table(name).collect() for name in ("orders", "lineitem"))
        want = []
        for o in orders:
            own = [r for r in items if o.o_orderkey is not None and r.l_orderkey == o.o_orderkey]
            quantity = sum(r.l_quantity for r in own) if own else None
            for old in (0, 1) if o.o_orderkey is not None and o.o_orderkey % 5 == 0 else (0,):
                for r in own or [None]:
                    title = r and ("Gift Card" if r.l_partkey % 50 == 0 else "paper bag" if r.l_partkey % 50 == 1 else f"Item {r.l_partkey}")
                    want.append((o.o_orderkey and str(o.o_orderkey), o.o_orderdate.date().toordinal() + 2 * old, quantity, r and f"{r.l_orderkey}-{r.l_linenumber}", title, r and r.l_extendedprice))
        number = lambda v: None if v is None else float(v)
        got = [(r[0], r[1].toordinal(), number(r[2]), r[3], r[4], number(r[5])) for r in rows.collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
