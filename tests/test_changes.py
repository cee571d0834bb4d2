"""Append-only tables of micro-batches: results by any batching, replays, failures, compaction."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resalelake.streaming import changes

HEADERS = ("order_id string, date date, ingested_at date, order_processed_at string, order_financial_status string, order_subtotal_price decimal(18,4), "
           "order_location_name string, order_created_at string, order_app_name string, order_test string, order_net_sales string, order_shipping_price decimal(18,4)")  # fmt: skip
CHANNEL = {"Point of Sale": "Retail", "Shop": "Ecomm", "x": "Other"}


def headers(seed, n=120):
    """Versions of orders: amounts, channels and stores change, some are cancelled or unreadable, days are null."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        created = f"200{rng.randrange(3)}-0{rng.randrange(1, 4)}-15T20:00:00Z" if k % 11 else "never"
        for v in range(rng.randrange(1, 4)):
            day = date(2005, 1, 1) + timedelta(days=rng.randrange(9))
            net = rng.choice([None, "n/a", str(rng.randrange(100))])
            rows.append((str(k), day, day, str(v), rng.choice(["paid", "cancelled", "PENDING"]), Decimal(v), rng.choice([None, "S"]), created,
                         rng.choice(list(CHANNEL)), rng.choice([None, "True", "False"]), net, rng.choice([None, Decimal(rng.randrange(9))])))
    rng.shuffle(rows)
    return rows


def by_hand(rows):
    best = {}
    for r in rows:
        if (r[9] or "false").lower() != "false" or r[4].lower() == "cancelled":
            continue
        day = None if r[7] == "never" else date.fromisoformat(r[7][:10])
        channel, net = CHANNEL[r[8]], Decimal(r[10]) if r[10] and r[10].isdigit() else None
        low = lambda x: (x is not None, x)  # noqa: E731  nulls lose
        rank = (r[6] is not None, r[1], r[2], r[3], r[4], r[5], low(r[6]), low(day), channel, low(net), low(r[11]))
        best[r[0]] = max(best.get(r[0], (rank,)), (rank,))
    cells = {}
    for ((_, _, _, _, _, _, _, (_, day), channel, (_, net), (_, ship)),) in best.values():
        cells.setdefault((day, channel), []).append((net, ship))

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    return sorted(((d, c, total(n for n, _ in v), total(s for _, s in v), len(v)) for (d, c), v in cells.items()), key=str)


def read(spark, job):
    return sorted(((d, c, n if n is None else Decimal(int(n)), s if s is None else Decimal(int(s)), k) for d, c, n, s, k in job.read(spark).collect()), key=str)


@pytest.mark.parametrize("seed, batches, grain", [(1, 1, "month"), (2, 4, "month"), (3, 3, "day")])
def test_signed_cells(spark, tmp_path, seed, batches, grain):
    rows = headers(seed)
    job = changes.DailySales(str(tmp_path / "t"), zone="UTC", grain=grain)
    assert read(spark, job) == []
    size = -(-len(rows) // batches)
    for k in range(batches):
        batch = spark.createDataFrame(rows[k * size : (k + 1) * size], HEADERS)
        job.step(batch, k)
        job.step(batch.withColumn("order_net_sales", F.lit("1")), k)  # a replay does nothing
        assert read(spark, job) == by_hand(rows[: (k + 1) * size])
        if k == 1:
            written = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
            job.compact(spark)
            assert len(job.log.versions(spark)) == 1 and read(spark, job) == by_hand(rows[: (k + 1) * size])
            job.step(batch.withColumn("order_net_sales", F.lit("1")), k)
            assert {p: p.stat().st_mtime_ns for p in written} == written
    assert read(spark, job) == by_hand(rows)


def test_a_failed_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    rows = headers(7)
    job = changes.DailySales(str(tmp_path / "t"), zone="UTC")
    job.step(spark.createDataFrame(rows[:50], HEADERS), 0)
    monkeypatch.setattr(changes.ChangeLog, "record", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        job.step(spark.createDataFrame(rows[50:], HEADERS), 1)
    monkeypatch.undo()
    assert read(spark, job) == by_hand(rows[:50])
    job.step(spark.createDataFrame(rows[50:], HEADERS), 1)
    assert read(spark, job) == by_hand(rows)


def test_latest_rows_of_two_streams(spark, tmp_path):
    schema = T.StructType.fromDDL("day date, id string, v int")
    rows = [(date(2001, 1, 1 + k % 3), str(k % 7), k) for k in range(40)]
    tables = [changes.LatestRows(str(tmp_path / "t"), schema, ["day", "id"], ["v"], stream=s) for s in ("a", "b")]
    for k, part in enumerate((rows[30:], rows[:10], rows[10:30])):
        table = tables[k % 2]
        table.step(spark.createDataFrame(part, schema), k // 2)
        table.step(spark.createDataFrame([(date(2001, 1, 1), "0", 999)], schema), k // 2)
        if k == 1:
            tables[0].compact(spark)
            tables[0].step(spark.createDataFrame([(date(2001, 1, 1), "0", 999)], schema), 0)
    best = {}
    for d, i, v in rows:
        best[d, i] = max(v, best.get((d, i), v))
    assert sorted(map(tuple, tables[1].read(spark).collect())) == sorted((d, i, v) for (d, i), v in best.items())
    assert len(tables[0].log.versions(spark)) == 2
