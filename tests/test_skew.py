"""Hot keys by measurement: found exactly, only they are split, and nothing is copied where nothing is hot."""

import random

import pytest
from pyspark.sql import functions as F

from resalelake.operators.joins import attach, hot_keys, match_or_keep


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    keys = ["hot"] * 1000 + [f"k{rng.randrange(500)}" for _ in range(1900)] + [None] * 100
    rng.shuffle(keys)
    return spark.createDataFrame(list(zip(keys, range(len(keys)))), "key string, n int").repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", 1), *((f"k{k}", k) for k in range(0, 500, 2))], "key string, cost int")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_exact(spark, rows):
    assert hot_keys(rows, "key") == ["hot"]
    assert hot_keys(rows.where("key <> 'hot'"), "key") == []
    assert hot_keys(rows.limit(0), "key") == [] and hot_keys(rows.where("key IS NULL"), "key") == []
    even = spark.createDataFrame([(f"k{k % 4}",) for k in range(400)], "key string")
    assert sorted(hot_keys(even, "key", 0.25)) == ["k0", "k1", "k2", "k3"] and hot_keys(even, "key", 0.26) == []


@pytest.mark.parametrize("hot", [None, ["hot"], [], ["not there"]])
def test_same_rows_whatever_is_split(rows, dim, hot):
    want = sorted(map(str, rows.join(dim, "key", "left").select("key", "n", "cost").collect()))
    assert sorted(map(str, attach(rows, dim, "key", ["n"], hot=hot).select("key", "n", "cost").collect())) == want
    fan = rows.withColumnRenamed("n", "m")
    some = dim.unionByName(dim.limit(3)).withColumn("key", F.when(F.col("cost") == 4, None).otherwise(F.col("key")))
    want = sorted(map(str, some.join(fan, "key", "left").select("key", "cost", "m").collect()))
    assert sorted(map(str, match_or_keep(some, fan, "key", ["m"], hot=hot).select("key", "cost", "m").collect())) == want


def test_nothing_is_copied_where_nothing_is_hot(rows, dim):
    assert "Generate explode" in plan(attach(rows, dim, "key", ["n"]))
    assert "Generate" not in plan(attach(rows, dim, "key", ["n"], hot=[])) and "_salt" not in plan(attach(rows, dim, "key", ["n"], hot=[]))


def test_a_hot_key_is_in_parts(spark, rows, dim):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}.items():
        spark.conf.set(k, v)
    try:
        def longest(df):
            return max(r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())

        whole = rows.where("key IS NOT NULL")
        assert longest(attach(whole, dim, "key", ["n"], hot=[])) >= 1000
        assert longest(attach(whole, dim, "key", ["n"], hot=["hot"])) < 700
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
