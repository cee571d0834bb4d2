"""Reconciliation down to rows, and distinct counts that add up."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from resalelake.operators import distinct
from resalelake.plans import quality

SCHEMA = "id string, day date, v int"


def test_row_differences(spark):
    rng = random.Random(1)
    rows = [(str(k), date(2001, 1, 1) + timedelta(days=rng.randrange(50)) if k % 40 else None, rng.choice([None, 1, 2])) for k in range(2000)]
    rows += rows[:30]
    theirs = [r for r in rows if int(r[0]) % 97]
    changed = {k for k in range(0, 2000, 61) if k % 97}
    theirs = [(i, d, -5) if int(i) in changed else (i, d + timedelta(days=1) if d and int(i) % 83 == 0 else d, v) for i, d, v in theirs] + [("x1", None, 1), ("x2", date(2001, 1, 3), 2)]
    moved = {int(r[0]) for r in rows if int(r[0]) % 83 == 0 and r[1] and int(r[0]) % 97}
    a, b = (spark.createDataFrame(side, SCHEMA) for side in (rows, theirs))
    got = {r.id: (r.status, r.ours, r.theirs) for r in quality.row_differences(a, b, ["id"], ["v"], "day").collect()}
    want = {str(k): ("extra", 2 if k < 30 else 1, 0) for k in range(0, 2000, 97)}
    want |= {str(k): ("changed", 2 if k < 30 else 1, 2 if k < 30 else 1) for k in changed | moved}
    want |= {"x1": ("missing", 0, 1), "x2": ("missing", 0, 1)}
    assert got == want
    assert quality.row_differences(a, a, ["id"], ["v"], "day").count() == 0
    fewer = a.where("id <> '0'").unionByName(a.where("id = '0'").limit(1))  # a repeat is gone
    assert [tuple(r) for r in quality.row_differences(a, fewer, ["id"], ["v"], "day").collect()] == [("0", "changed", 2, 1)]


def test_bitmaps_equal_distinct_counts(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(12), rng.choice([None, *map(str, range(90))])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "g string, d int, m string").repartition(5)
    numbers = distinct.numbered(df.where("d < 6").select(F.col("m").alias("member")), str(tmp_path / "n"))
    first = distinct.cells(df.where("d < 6"), ["g", "d"], {"m": (F.col("m"), numbers)})
    first.write.parquet(str(tmp_path / "cells"))
    numbers = distinct.numbered(df.select(F.col("m").alias("member")), str(tmp_path / "n"))
    assert numbers.count() == numbers.select("number").distinct().count() == len({m for _, _, m in rows} - {None})
    distinct.cells(df.where("d >= 6"), ["g", "d"], {"m": (F.col("m"), numbers)}).write.mode("append").parquet(str(tmp_path / "cells"))
    stored = spark.read.schema(first.schema).parquet(str(tmp_path / "cells"))
    for low, high in ((0, 12), (3, 8), (7, 7)):
        want = {(g, len({m for h, d, m in rows if h == g and low <= d < high and m})) for g in "ab"} - {("a", 0), ("b", 0)}
        assert {(r.g, r.members) for r in distinct.counts(stored.where(f"d >= {low} AND d < {high}"), ["g"]).collect()} == want
    assert distinct.counts(stored).first().members == len({m for _, _, m in rows} - {None})
