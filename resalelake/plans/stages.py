"""Clean rows written once, laid out so that the facts join them without moving them.

Three stages are bucketed by order, each into the same number of buckets, with a folder per month:

* ``headers``: one row per order: what its refunds take from it, and, for a valid order, its header
* ``lines``: the rows picked per order and line, marked as picked for the order's totals, for sales of merchandise or both, with their unit cost
* ``refunds``: refund lines that count

so header and lines, and refund and order, meet bucket by bucket. ``headers`` and ``lines`` take one pass each over the raw orders.
A manifest keeps schemas and buckets, so any session can open the stages again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import cached_property, partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resalelake.functions import columns as C
from resalelake.functions import rules as R
from resalelake.operators.dedup import located_first, top_row
from resalelake.operators.joins import attach
from resalelake.operators.periods import Period, stretches
from resalelake.plans import facts as plain
from resalelake.plans.facts import LINE_LABELS, LINE_VALUES, Facts, created_within
from resalelake.session import together
from resalelake.sources.raw import RawTables

STAGES = ("headers", "lines", "refunds", "unit_costs")
MONTH = "month_start"
MANIFEST = "name string, fields string, buckets int"
#: The day a stage's folders are made of. Orders without a readable day lie in a folder of their own.
FOLDER_DAY = {"headers": "order_date", "lines": "order_date", "refunds": "refund_date"}


@dataclass(frozen=True)
class Layout:
    schema: T.StructType
    buckets: int


class StagedFacts(Facts):
    """Facts over written stages; a stage that was not written is computed. Writing cuts the lineage, so a lost executor
    costs one stage and not the whole build."""

    def __init__(self, raw: RawTables, spark: SparkSession, root: str, layouts: dict[str, Layout], zone: str = R.STORE_ZONE):
        super().__init__(raw, zone)
        self.spark, self.root, self.layouts = spark, root.rstrip("/"), layouts
        for name, layout in layouts.items():
            _register(spark, self.root, name, layout)

    @classmethod
    def open(cls, raw: RawTables, spark: SparkSession, root: str, zone: str = R.STORE_ZONE) -> StagedFacts:
        """Stages that an earlier session wrote."""
        rows = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest").collect()  # one per stage
        return cls(raw, spark, root, {r.name: Layout(T.StructType.fromJson(json.loads(r.fields)), r.buckets) for r in rows}, zone)

    def _stage(self, name: str, period: Period | None = None) -> DataFrame:
        df = self.spark.table(_table(self.root, name))
        if MONTH not in df.columns:
            return df
        if period is not None:
            df = df.where(_months_of(period)).where(period.covers(FOLDER_DAY[name]))
        return df.drop(MONTH)

    def clean_orders(self, period: Period | None = None, columns: Collection[str] | None = None) -> DataFrame:
        if "headers" not in self.layouts:
            return super().clean_orders(period, columns)
        df = self._stage("headers", period).where("valid")
        made = plain.HEADER | plain.HEADER_AMOUNTS | plain.HEADER_DERIVED
        return df.select(*[c for c in made if columns is None or c in columns or c == "order_id" or (period is not None and c == "order_date")])

    def clean_lines(self, period: Period | None = None) -> DataFrame:
        if "lines" not in self.layouts:
            return super().clean_lines(period)
        lines = self.spark.table(_table(self.root, "lines")).where("counted")
        if period is not None:
            # As on raw rows a coarse range on the creation time decides; its text can be days away from the store's day.
            lines = lines.where(_months_of(period, 4)).where(created_within(period))
        return lines.drop(MONTH, "counted", "merchandise")

    def merchandise_lines(self, period: Period | None = None, labels: Collection[str] = LINE_LABELS) -> DataFrame:
        if "lines" not in self.layouts:
            return super().merchandise_lines(period, labels)
        return self._stage("lines", period).where("merchandise").drop("counted", "merchandise")

    def order_lines_total(self, period: Period | None = None) -> DataFrame:
        if "lines" not in self.layouts:
            return super().order_lines_total(period)
        quantity, line_cost = C.amount("line_item__quantity"), C.amount("line_item__variant_unit_cost")
        lines = self.clean_lines(period).select("order_id", quantity.alias("quantity"), line_cost.alias("line_cost"), "unit_cost")
        return self._line_totals(lines)

    def parent_orders(self, wanted: DataFrame | None = None) -> DataFrame:
        if "headers" not in self.layouts:
            return super().parent_orders(wanted)
        # Refunds meet their orders bucket by bucket, so leaving orders out beforehand would only read the refunds twice.
        return self._stage("headers").select("order_id", "parent.*")

    def clean_refunds(self, period: Period | None = None, key: str = "amounts") -> DataFrame:
        if "refunds" not in self.layouts or key != "amounts":
            return super().clean_refunds(period, key)
        return self._stage("refunds", period).drop("refund_date")

    @cached_property
    def unit_costs(self) -> DataFrame:
        return self._stage("unit_costs") if "unit_costs" in self.layouts else Facts(self.raw, self.zone).unit_costs


def _months_of(period: Period, spare_days: int = 0) -> Column:
    """Folders that can hold days of a period."""
    def around(part: Period) -> Column:
        out, month = F.lit(True), F.col(MONTH)
        if part.start is not None:
            out = month >= F.trunc(F.date_sub(F.lit(part.start), spare_days), "month")
        if part.end is not None:
            out = out & (month <= F.date_add(F.lit(part.end), spare_days))
        return out

    out = around(stretches(period)[0])
    for part in stretches(period)[1:]:
        out = out | around(part)
    return out


# ---- writing -------------------------------------------------------------------


def _headers(raw: RawTables, facts: Facts) -> DataFrame:
    """Both choices of a row per order in one aggregation."""
    header = [*dict.fromkeys([*plain.HEADER_RECENCY, *plain.HEADER_TIES, "order_location_name", *(plain.HEADER | plain.HEADER_AMOUNTS | plain.HEADER_DERIVED).values()])]
    header = [c for c in header if c != "order_id"]
    picked = raw.orders.groupBy("order_id").agg(
        top_row(header, ["order_id"], **plain.header_choice(), where=C.valid_order()).alias("header"),
        top_row(plain.PARENT, ["order_id"], latest=plain.PARENT_RECENCY, prefer=[located_first()]).alias("parent"),
    )
    own = picked.select("order_id", F.col("header").isNotNull().alias("valid"), F.struct(*plain.parent_columns("parent")).alias("parent"), "header.*")
    made = [c for c in plain.HEADER | plain.HEADER_AMOUNTS | plain.HEADER_DERIVED if c != "order_id"]
    return own.select("order_id", "valid", "parent", *facts._header_columns(made))


def _lines(raw: RawTables, facts: Facts) -> DataFrame:
    """Both choices of a row per order and line in one aggregation, then the newest cost of the product."""
    key = list(plain.LINE_KEY)
    values = ["order_location_name", *plain.LINE_RECENCY, *LINE_VALUES]
    rows = raw.orders.where(C.valid_order() & C.real_line())
    picked = rows.groupBy(*key).agg(
        top_row(values, key, **plain.line_choice()).alias("counted"),
        top_row([*values, *LINE_LABELS], key, **plain.line_choice(), where=C.merchandise_line()).alias("sold"),
    )
    # Values rank before labels, so both choices are one row where their values agree.
    same = reduce(Column.__and__, [F.col(f"counted.{c}").eqNullSafe(F.col(f"sold.{c}")) for c in values]) & F.col("sold").isNotNull()

    def marked(row: str, counted: bool, merchandise: bool) -> Column:
        columns = [F.col(f"{row}.{c}").alias(c) for c in values]
        columns += [(F.col(f"sold.{c}") if row == "sold" else F.lit(None).cast("string")).alias(c) for c in LINE_LABELS]
        return F.struct(*columns, F.lit(counted).alias("counted"), F.lit(merchandise).alias("merchandise"))

    one, other = marked("counted", True, False), marked("sold", False, True)
    sides = F.when(same, F.array(marked("sold", True, True))).when(F.col("sold").isNull(), F.array(one)).otherwise(F.array(one, other))
    lines = picked.select(*key, F.inline(sides))
    lines = lines.withColumns(
        {
            "product_id": F.col("line_item__product_id").cast("string"),
            "order_date": C.business_day("order_created_at", facts.zone),
            "channel": C.sales_channel("order_app_name"),
        }
    )
    return attach(lines, facts.unit_costs, "product_id", spread=key).drop("product_id")


def _refunds(raw: RawTables, facts: Facts) -> DataFrame:
    return facts.clean_refunds().withColumn("refund_date", C.local_day(F.col("date").cast("timestamp"), facts.zone))


def _table(root: str, name: str) -> str:
    return f"stage_{uuid.uuid5(uuid.NAMESPACE_URL, root).hex}_{name}"


def _register(spark: SparkSession, root: str, name: str, layout: Layout) -> None:
    """Make a written stage known to this session, buckets included."""
    table = _table(root, name)
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.schema.fields)
    parted = MONTH in layout.schema.names
    by_month = f"PARTITIONED BY ({MONTH}) " if parted else ""
    bucketed = f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {layout.buckets} BUCKETS " if layout.buckets else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by_month}{bucketed}LOCATION '{root}/{name}'")
    if parted:
        spark.catalog.recoverPartitions(table)


def stage(raw: RawTables, root: str, names: Sequence[str] = STAGES, zone: str = R.STORE_ZONE, buckets: int | None = None) -> StagedFacts:
    """Write stages into a folder of this run and return facts that start from them.

    ``buckets`` (as many as shuffle partitions, unless given) is the number of tasks of a join of stages: choose it so that
    a bucket of a period fits a task.
    """
    spark, own = raw.orders.sparkSession, f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts: dict[str, Layout] = {}
    if "unit_costs" in names:
        rows = Facts(raw, zone).unit_costs
        rows.write.parquet(f"{own}/unit_costs")
        layouts["unit_costs"] = Layout(rows.schema, 0)
    facts = StagedFacts(raw, spark, own, dict(layouts), zone)

    def write(name: str) -> None:
        rows = {"headers": _headers, "lines": _lines, "refunds": _refunds}[name](raw, facts)
        rows = rows.withColumn(MONTH, F.trunc(FOLDER_DAY[name], "month"))
        # Dealt out as the buckets are, each bucket of a month is one file.
        writer = rows.repartition(buckets, "order_id").write.partitionBy(MONTH).bucketBy(buckets, "order_id").sortBy("order_id")
        writer.format("parquet").option("path", f"{own}/{name}").saveAsTable(_table(own, name))
        layouts[name] = Layout(rows.schema, buckets)

    together([partial(write, name) for name in names if name != "unit_costs"])
    entries = [(name, layout.schema.json(), layout.buckets) for name, layout in layouts.items()]
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.parquet(f"{own}/manifest")
    return StagedFacts(raw, spark, own, layouts, zone)
