"""Tables that micro-batches only append to.

A table is a set of versions, one per micro-batch, and a log that names them. A micro-batch writes its version into a folder of
its own and is recorded afterwards, so a batch that is replayed after it was recorded does nothing, and one that failed half-way left
nothing that is read. ``compact`` writes what still counts as one version; earlier versions are not read after that. One writer
at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resalelake.functions import columns as C
from resalelake.functions import rules as R
from resalelake.operators.dedup import best_row, located_first
from resalelake.plans.facts import HEADER_RECENCY, HEADER_TIES
from resalelake.sources.contracts import contract

#: Folder column of a version; a table's own columns have other names.
VERSION = "change_set"
LOG = "batch string, version string, base boolean"


class ChangeLog:
    """The versions of a table. ``stream`` tells the batches of one stream from those of another that writes to the same table."""

    def __init__(self, root: str, stream: str = "stream"):
        self.root, self.stream = root.rstrip("/"), stream

    def _entries(self, spark: SparkSession) -> list:
        """Entries since the newest base, one per batch since the last compaction."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return []
        rows = spark.read.schema(LOG).parquet(f"{self.root}/log").orderBy("version").collect()
        start = max((k for k, r in enumerate(rows) if r.base), default=0)
        return rows[start:]

    def versions(self, spark: SparkSession) -> list[str]:
        return [r.version for r in self._entries(spark)]

    def done(self, spark: SparkSession, batch: int) -> bool:
        """Whether a batch was recorded. A stream replays its last batch only, so entries since the base and that base are enough."""
        return any(f"{self.stream}-{batch}" == last for r in self._entries(spark) for last in r.batch.split(","))

    @staticmethod
    def new_version() -> str:
        return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # versions sort by time

    def record(self, spark: SparkSession, version: str, batch: int | None = None, base: bool = False) -> None:
        """A base carries the last batch of each stream that is in it."""
        name = f"{self.stream}-{batch}"
        if base:
            last: dict[str, int] = {}
            for r in self._entries(spark):
                for stream, _, n in (x.rpartition("-") for x in r.batch.split(",") if x):
                    last[stream] = max(int(n), last.get(stream, -1))
            name = ",".join(f"{s}-{n}" for s, n in sorted(last.items()))
        spark.createDataFrame([(name, version, base)], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def read(self, spark: SparkSession, part: str, schema: T.StructType) -> DataFrame | None:
        """Rows of a part of the table in all versions that count, or None while there are none."""
        paths = [self.folder(part, v) for v in self.versions(spark)]
        if not paths:
            return None
        fields = [*schema.fields, T.StructField(VERSION, T.StringType())]
        rows = spark.read.schema(T.StructType(fields)).option("basePath", f"{self.root}/{part}").parquet(*paths)
        return rows.select(*schema.names)

    def folder(self, part: str, version: str) -> str:
        return f"{self.root}/{part}/{VERSION}={version}"


class LatestRows:
    """The newest row per key, from batches in any order. Batches are appended as they come; reading picks the row."""

    def __init__(self, root: str, schema: T.StructType, keys: Sequence[str], latest: Sequence[str], stream: str = "stream"):
        self.log, self.schema, self.keys, self.latest = ChangeLog(root, stream), schema, list(keys), list(latest)

    def step(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if self.log.done(spark, number):
            return
        version = self.log.new_version()
        self._picked(batch.select(*self.schema.names)).write.parquet(self.log.folder("rows", version))
        self.log.record(spark, version, number)

    def _picked(self, rows: DataFrame) -> DataFrame:
        return best_row(rows, self.keys, latest=self.latest)

    def read(self, spark: SparkSession) -> DataFrame:
        rows = self.log.read(spark, "rows", self.schema)
        return spark.createDataFrame([], self.schema) if rows is None else self._picked(rows)

    def compact(self, spark: SparkSession) -> None:
        version = self.log.new_version()
        self.read(spark).write.parquet(self.log.folder("rows", version))
        self.log.record(spark, version, base=True)


FOLDER = "folder"
_MONEY = "decimal(28,4)"
CELLS = f"order_date date, channel string, net_sales {_MONEY}, shipping_revenue {_MONEY}, orders bigint, priced bigint, shipped bigint"
#: What a header adds to its cell.
VALUES = ("order_date", "channel", "net_sales", "shipping_revenue")


class DailySales:
    """Sales per local day and channel, kept right while order headers repeat and arrive late and in any order.

    The newest header of each order is state. A micro-batch looks up the stored headers of its own orders, in the
    folders of the months (or days) they were created in, and appends the headers that are new or changed together with signed cells: minus what
    the old header gave, plus what the new one gives. Reading sums the cells; nothing that was written is written again.
    ``priced`` and ``shipped`` count the known amounts, so a sum of unknown ones stays unknown.
    """

    def __init__(self, root: str, zone: str = R.STORE_ZONE, grain: str = "month", stream: str = "stream"):
        self.log, self.zone, self.grain = ChangeLog(root, stream), zone, grain

    @staticmethod
    def _schema(*more: T.StructField) -> T.StructType:
        """Of stored headers."""
        declared = contract("orders")
        ranked = [declared[c] for c in ("order_id", "order_location_name", *HEADER_RECENCY, *HEADER_TIES)]
        return T.StructType([*ranked, *T.StructType.fromDDL(CELLS).fields[: len(VALUES)], *more, T.StructField(FOLDER, T.DateType())])

    def _headers(self, batch: DataFrame) -> DataFrame:
        """What ranks a header and what it gives, one per order of the batch."""
        dated = batch.where(C.valid_order()).select(
            *[F.col(f.name).cast(f.dataType) for f in self._schema().fields if f.name not in (*VALUES, FOLDER)],
            C.business_day("order_created_at", self.zone).alias("order_date"),
            C.sales_channel("order_app_name").alias("channel"),
            C.amount("order_net_sales").cast(_MONEY).alias("net_sales"),
            C.amount("order_shipping_price").cast(_MONEY).alias("shipping_revenue"),
        )
        day = F.col("order_date")
        return dated.withColumn(FOLDER, F.trunc(day, "month") if self.grain == "month" else day)

    def _top(self) -> Column:
        """A header as one value, better ones greater."""
        rest = [f.name for f in self._schema().fields if f.name not in ("order_id", FOLDER)]
        return F.struct(located_first().alias("located"), *dict.fromkeys([*HEADER_RECENCY, *HEADER_TIES, *rest]))

    def step(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if self.log.done(spark, number):
            return
        rows = self._headers(batch).withColumn("stored", F.lit(False))
        state = self.log.read(spark, "headers", self._schema())
        if state is not None:
            folders = [r[0] for r in rows.select(FOLDER).distinct().collect()]  # bounded by the calendar
            known = F.col(FOLDER).isin([f for f in folders if f]) | (F.col(FOLDER).isNull() if None in folders else F.lit(False))
            own = state.where(known).join(rows.select("order_id").distinct(), "order_id", "left_semi")
            rows = rows.unionByName(own.withColumn("stored", F.lit(True)))
        # The newest of what is stored, and of all: at most one row per order and task is shuffled.
        top = self._top()
        both = rows.groupBy("order_id", FOLDER).agg(F.max(F.when(F.col("stored"), top)).alias("old"), F.max(top).alias("new"))
        version = self.log.new_version()
        changed = both.where("NOT (old <=> new)").select(
            "order_id", "new.*", F.col("old").isNotNull().alias("replaces"), *[F.col(f"old.{v}").alias(f"old_{v}") for v in VALUES], FOLDER
        ).drop("located")
        changed.hint("rebalance", FOLDER).write.partitionBy(FOLDER).parquet(self.log.folder("headers", version))
        written = spark.read.schema(changed.schema).parquet(self.log.folder("headers", version))
        self._cells(written).write.parquet(self.log.folder("cells", version))
        self.log.record(spark, version, number)

    @staticmethod
    def _cells(changed: DataFrame) -> DataFrame:
        def signed(sign: int, prefix: str) -> Column:
            return F.struct(F.lit(sign).alias("sign"), *[F.col(prefix + v).alias(v) for v in VALUES])

        sides = F.when(F.col("replaces"), F.array(signed(1, ""), signed(-1, "old_"))).otherwise(F.array(signed(1, "")))
        rows = changed.select(F.inline(sides))

        def known(value: str) -> Column:
            return F.sum(F.when(F.col(value).isNotNull(), F.col("sign")).otherwise(0)).cast("bigint")

        def total(value: str) -> Column:
            return F.coalesce(F.sum(F.col(value) * F.col("sign")), F.lit(0)).cast(_MONEY)

        return rows.groupBy("order_date", "channel").agg(
            total("net_sales").alias("net_sales"), total("shipping_revenue").alias("shipping_revenue"), F.sum("sign").alias("orders"),
            known("net_sales").alias("priced"), known("shipping_revenue").alias("shipped"),
        )

    def _summed(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromDDL(CELLS)
        cells = self.log.read(spark, "cells", schema)
        if cells is None:
            cells = spark.createDataFrame([], schema)
        sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in ("order_date", "channel")]
        return cells.groupBy("order_date", "channel").agg(*sums).where("orders <> 0")

    def read(self, spark: SparkSession) -> DataFrame:
        """order_date, channel, net_sales, shipping_revenue, orders."""
        known = {"net_sales": "priced", "shipping_revenue": "shipped"}
        return self._summed(spark).select("order_date", "channel", *[F.when(F.col(n) > 0, F.col(v)).alias(v) for v, n in known.items()], "orders")

    def compact(self, spark: SparkSession) -> None:
        """One version of all headers and cells."""
        version = self.log.new_version()
        state = self.log.read(spark, "headers", self._schema())
        if state is None:
            return
        newest = state.groupBy("order_id", FOLDER).agg(F.max(self._top()).alias("new")).select("order_id", "new.*", FOLDER).drop("located")
        newest.hint("rebalance", FOLDER).write.partitionBy(FOLDER).parquet(self.log.folder("headers", version))
        self._summed(spark).write.parquet(self.log.folder("cells", version))
        self.log.record(spark, version, base=True)

