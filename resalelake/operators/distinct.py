"""Distinct counts that can be added up: exact bitmaps of the members of each cell.

Members get numbers once, close together within a task, so a bucket of 32,768 numbers is one bitmap of 4 KB and cells hold few of
them. Bitmaps of cells are merged bit by bit, so the distinct members of any union of cells follow from the stored bitmaps.
New members of a later load are numbered after the known ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numbered(members: DataFrame, path: str, member: str = "member") -> DataFrame:
    """Number the members (text) that the table at ``path`` does not have yet, add them to it and give the whole table."""
    spark = members.sparkSession
    schema = T.StructType.fromDDL(f"{member} string, number bigint")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    new = members.select(F.col(member).cast("string").alias(member)).dropna().distinct()
    base = 0
    if known:
        table = spark.read.schema(schema).parquet(path)
        base = (table.agg(F.max("number")).first()[0] or 0) // _STEP * _STEP + _STEP
        new = new.join(table, member, "left_anti")
    # A number is a task's block of numbers and the place in it; blocks are whole buckets, so tasks share no bitmap.
    place = F.monotonically_increasing_id()
    task, inside = F.shiftright(place, 33), place.bitwiseAND((1 << 33) - 1)
    new.withColumn("number", F.lit(base) + task * _STEP + inside).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


#: Numbers of a task: far more members than one task can hold.
_STEP = 1 << 36


def cells(rows: DataFrame, by: Sequence[str], members: Mapping[str, tuple[Column, DataFrame]]) -> DataFrame:
    """``by``, what, bucket, bits: bitmaps of the distinct members of each cell, by the name of what is counted. Rows are reduced to
    distinct members of a cell before they meet their numbers; null members are not counted."""
    parts = []
    for what, (member, numbers) in members.items():
        seen = rows.select(*by, member.cast("string").alias("member")).where("member IS NOT NULL").distinct()
        numbered_ = seen.join(numbers.toDF("member", "number"), "member")
        own = numbered_.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket"))
        bits = own.agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        parts.append(bits.select(*by, F.lit(what).alias("what"), "bucket", "bits"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def counts(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, what, members: distinct members over the cells given, filtered beforehand as one likes."""
    merged = stored.groupBy(*by, "what", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by, "what").agg(F.sum(F.bitmap_count("bits")).alias("members"))
