"""Tables whose rows are multiplied are dealt out by their bytes, so that no task sorts what one file becomes."""

import random

import pytest
from pyspark.sql import functions as F

from resalelake.operators.dedup import best_row
from resalelake.plans.facts import Facts
from resalelake.sources import driver_tables
from resalelake.sources.driver_tables import DriverTables

KEYS = ["product_id", "product_metafield_namespace", "product_metafield_key"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One file of products over three times what a task takes, some of them twice, some without a key."""
    rng, path = random.Random(3), str(tmp_path_factory.mktemp("shop"))
    rows = [(None if k % 50 == 0 else k % 5500, f"{rng.getrandbits(4000):x}", f"B{k % 7}", "t", k % 9, k / 4) for k in range(6_000)]
    schema, _ = driver_tables.TABLES["part"]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/part.parquet")
    return path


def rows_of(df):
    """Number and order-free hash of the rows, whole rows repeated included."""
    hashes = df.select(F.xxhash64(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).cast("decimal(38,0)").alias("h"))
    return hashes.agg(F.count("h"), F.sum("h"), F.sum(F.col("h") % 1_000_003 * (F.col("h") % 1_000_003))).first()


def tasks_of(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_no_task_multiplies_a_whole_file(spark, folder, monkeypatch):
    dealt = DriverTables(spark, folder)
    found = {name: getattr(dealt, name)() for name in ("metafields", "products")}
    assert all(tasks_of(df) > 2 for df in found.values())
    newest = best_row(found["metafields"], KEYS, latest=["product_metafield_update_at"])
    stock = Facts(dealt.raw()).inventory()
    monkeypatch.setattr(driver_tables, "DEALT", {})
    whole = DriverTables(spark, folder)
    assert tasks_of(whole.metafields()) == 1
    for name, df in found.items():
        assert rows_of(df) == rows_of(getattr(whole, name)())
    assert rows_of(newest) == rows_of(best_row(whole.metafields(), KEYS, latest=["product_metafield_update_at"]))
    assert rows_of(stock) == rows_of(Facts(whole.raw()).inventory())


def test_small_tables_stay_as_they_are(spark):
    small = DriverTables(spark, "/root/testdata/sf0.001")
    assert [small._tasks(name) for name in ("part", "customer", "orders", "lineitem")] == [1, 1, 1, 1]
    assert "Repartition" not in small.metafields()._jdf.queryExecution().optimizedPlan().toString()
