"""Cells of facts at several grains, and a router that answers cards from the smallest one that can.

A fact's additive inputs are summed once by all of its dimensions; coarser sets are summed from those cells, never from the
fact again. Ratios are not stored: a card's measure is made from the sums, as it is from rows. The router takes the stored set with
fewest rows that has the card's dimensions, its own filter columns, the filters the reader set, and days or, where the period is made of
whole months, months.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resalelake.functions import columns as C
from resalelake.operators.filters import Filters
from resalelake.operators.periods import Period
from resalelake.plans.facts import Facts
from resalelake.plans.metrics import MEASURES, Card, finished, period_of
from resalelake.session import together

MONTH, ROWS = "month_start", "n"
MANIFEST = "fact string, dimensions string, version string, fields string, cells bigint"


@dataclass(frozen=True)
class Shape:
    """What of a fact adds up: its day, the dimensions of cards, the amounts, the column that counts rows, and the stored sets."""

    day: str
    dimensions: tuple[str, ...]
    amounts: tuple[str, ...]
    sets: tuple[tuple[str, ...], ...]
    counted: str | None = None


def _chain(*dimensions: str) -> tuple[tuple[str, ...], ...]:
    """No dimension, the first, the first two, ..."""
    return tuple(dimensions[:k] for k in range(len(dimensions) + 1))


SHAPES = {
    "orders": Shape(
        "order_date", ("channel", "store_location", "ship_province", "utm_source"),
        ("net_sales", "gross_profit", "cogs", "total_units", "shipping_revenue"),
        (*_chain("channel", "store_location", "ship_province"), ("channel", "utm_source")), "order_id",
    ),
    "daily_sales": Shape("order_date", ("channel", "store_location"), ("net_sales", "shipping_revenue"), _chain("channel", "store_location")),
    "refunds": Shape("refund_date", ("channel", "store_location"), ("refunded_units", "total_refunded", "refund_subtotal"), _chain("channel", "store_location")),
    "marketing": Shape("date", ("source",), ("spend", "conversion_value", "conversions"), _chain("source")),
}


def _summed(df: DataFrame, keys: Iterable[str], shape: Shape, rows: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in shape.amounts], rows.alias(ROWS))


def build(facts: Facts, root: str, names: Iterable[str] = tuple(SHAPES)) -> None:
    """Write all sets of facts as a new version and record them together."""
    root, version = root.rstrip("/"), uuid.uuid4().hex
    entries: list[tuple] = []

    def fact(name: str) -> None:
        shape = SHAPES[name]
        source = facts.fact(name, None, {shape.day, *shape.dimensions, *shape.amounts, *([shape.counted] if shape.counted else [])})
        fine = _summed(source, [shape.day, *shape.dimensions], shape, F.count(shape.counted) if shape.counted else F.count(F.lit(1)))
        spark = fine.sparkSession
        path = f"{root}/{name}/{version}"
        fine.write.parquet(f"{path}/cells")
        stored = spark.read.schema(fine.schema).parquet(f"{path}/cells").withColumn(MONTH, F.trunc(shape.day, "month"))
        for dimensions in shape.sets:
            for time in (shape.day, MONTH):
                keys = [time, *dimensions]
                cells = _summed(stored, keys, shape, F.sum(ROWS))
                folder = f"{path}/{'-'.join(keys)}"
                # Days in order, so a period is a few row groups of few files.
                cells.repartitionByRange(max(1, len(dimensions)), time).sortWithinPartitions(time).write.parquet(folder)
                n = spark.read.schema(cells.schema).parquet(folder).count()
                entries.append((name, ",".join(keys), folder, cells.schema.json(), n))

    together([lambda name=name: fact(name) for name in names])
    facts_spark = SparkSession.active()
    facts_spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest")


def _whole_months(period: Period) -> bool:
    starts = period.start is None or period.start.day == 1
    return starts and (period.end is None or (period.end + timedelta(days=1)).day == 1)


#: How measures are made where a row is a cell; those not named here are made as from rows.
def _count() -> Column:
    return F.coalesce(F.sum(ROWS), F.lit(0))


def _per_row(c: str) -> Callable[[], Column]:
    return lambda: C.ratio(F.sum(c), F.sum(ROWS), 2)


OVER_CELLS: dict[tuple[str, str], Callable[[], Column]] = {
    ("orders", "orders"): _count, ("orders", "aov"): _per_row("net_sales"), ("orders", "upt"): _per_row("total_units"),
}
#: Measures that are no sums of cells.
NOT_ADDITIVE = {("orders", "processing_hours"), ("refunds", "return_orders")}


@dataclass(frozen=True)
class Cells:
    dimensions: frozenset[str]
    time: str
    folder: str
    schema: T.StructType
    cells: int


class Lattice:
    """The stored sets under a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.sets: dict[str, list[Cells]] = {}
        for r in spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest").collect():  # one per set
            time, *dimensions = r.dimensions.split(",")
            cells = Cells(frozenset(dimensions), time, r.version, T.StructType.fromJson(json.loads(r.fields)), r.cells)
            self.sets.setdefault(r.fact, []).append(cells)

    def route(self, card: Card, as_of: date, filters: Filters | None = None) -> Cells | None:
        """The smallest set that can answer a card, or None."""
        shape = SHAPES.get(card.fact)
        if shape is None or card.table is not None or card.fact not in self.sets or any((card.fact, m) in NOT_ADDITIVE for m in card.show.values()):
            return None
        filters, period = filters or Filters(), period_of(card, as_of, filters)
        asked = {slot for slot in card.slots if getattr(filters, slot, None) is not None}
        needed = {*card.by, *card.where_uses, *asked}
        daily = shape.day in needed or (period is not None and not _whole_months(period))
        fitting = [s for s in self.sets[card.fact] if needed - {shape.day} <= s.dimensions and (not daily or s.time == shape.day)]
        return min(fitting, key=lambda s: s.cells, default=None)

    def run(self, card: Card, as_of: date, filters: Filters | None = None) -> DataFrame | None:
        """A card's result from stored cells, or None where it needs the fact."""
        found = self.route(card, as_of, filters)
        if found is None:
            return None
        df = self.spark.read.schema(found.schema).parquet(found.folder)
        period = period_of(card, as_of, filters or Filters())
        if period is not None and card.day:
            df = df.where(period.covers(found.time))
        made = {m: OVER_CELLS.get((card.fact, m), MEASURES[card.fact][m].make) for m in card.show.values()}
        return finished(card, df, filters or Filters(), {name: made[m]() for name, m in card.show.items()})
