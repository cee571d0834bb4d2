"""Landing of JSON-lines folders: readable documents go on, the others are kept with the place they came from.

A dead letter is the text of a document with its kind, file, line and reason. Landing a file again adds nothing. A repaired
letter is written to the table's ``repaired`` folder, from which its document can be read like any other; letters that
still cannot be read stay open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resalelake.session import shared_folder
from resalelake.sources.payloads import opened, parse

LETTERS = "kind string, file string, line bigint, modified timestamp, reason string, body string"
PLACE = ["kind", "file", "line", "modified"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the block of it that a task read, and a number that grows along a block."""
    return spark.read.text(path).select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )


def unreadable(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Documents that cannot be landed, with file and line (from 1). Blank lines are no documents.

    A file is read in blocks, so a line's number is the lines of the blocks before it and its place in its own block. Blocks are
    counted without parsing; what is joined is one row per block.
    """
    lines = _lines(spark, path)
    blocks = lines.groupBy("file", "block").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a file's blocks
    blocks = blocks.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    bad = opened(lines.where("trim(body) <> ''"), kind).where("reason IS NOT NULL").drop("document")
    line = F.col("before") + F.col("n") - F.col("first") + 1
    return bad.join(blocks, ["file", "block"]).select(F.lit(kind).alias("kind"), "file", line.alias("line"), "modified", "reason", "body")


def _letters(spark: SparkSession, folder: str, part: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{part}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], LETTERS)
    return spark.read.schema(LETTERS).parquet(path)


def _added(rows: DataFrame, folder: str, part: str) -> None:
    """Append letters that are not there yet; they are computed once, before the folder they are compared with grows."""
    spark = rows.sparkSession
    side = shared_folder(spark, f"letters-{uuid.uuid4().hex[:8]}")
    rows.join(_letters(spark, folder, part).select(*PLACE), PLACE, "left_anti").write.parquet(side)
    spark.read.schema(LETTERS).parquet(side).write.mode("append").parquet(f"{folder.rstrip('/')}/{part}")


def land(spark: SparkSession, kind: str, path: str, dead_letters: str) -> DataFrame:
    """Keep what cannot be read as dead letters and give the readable documents of a landing folder."""
    _added(unreadable(spark, kind, path), dead_letters, "letters")
    return parse(spark.read.text(path).where("trim(value) <> ''"), kind, "value")


def open_letters(spark: SparkSession, dead_letters: str) -> DataFrame:
    """Dead letters that nobody has repaired."""
    return _letters(spark, dead_letters, "letters").join(_letters(spark, dead_letters, "repaired").select(*PLACE), PLACE, "left_anti")


def replay(spark: SparkSession, kind: str, dead_letters: str, repair: Column | str = "body") -> DataFrame:
    """Try open letters of a kind again with ``repair`` (text made of ``body``) and give the documents this made readable.

    Repaired letters are closed and keep their repaired text, so a replay that is run again gives only what is new.
    """
    text = F.expr(repair) if isinstance(repair, str) else repair
    tried = open_letters(spark, dead_letters).where(F.col("kind") == kind).withColumn("body", text).drop("reason")
    good = opened(tried, kind).where("reason IS NULL").withColumn("reason", F.lit("repaired")).select(*PLACE, "reason", "body")
    side = shared_folder(spark, "repaired")
    good.write.parquet(side)
    fixed = spark.read.schema(LETTERS).parquet(side)
    fixed.select(*[f.split()[0] for f in LETTERS.split(", ")]).write.mode("append").parquet(f"{dead_letters.rstrip('/')}/repaired")
    return parse(fixed, kind)
