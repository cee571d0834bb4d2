"""Versions in time: which row of a key was the one to believe on each day, from the days on which rows became known.

A row believed on a day is the best (latest, then the rest) of those known by then, so it stays until a better one becomes known; a row
that arrives late and is worse changes nothing. Rows of a key and day are reduced to one before the versions are put in order, so a key's
window holds one row per day at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resalelake.operators.dedup import top_row
from resalelake.operators.periods import Period

FROM, TO = "valid_from", "valid_to"


def versions(known: DataFrame, keys: Sequence[str], day: str, latest: Sequence[str]) -> DataFrame:
    """Rows with the days they hold: from ``valid_from`` to the day before ``valid_to`` (null: still). ``day`` is when a row
    became known; rows without one are never known."""
    rows = known.where(F.col(day).isNotNull()).withColumn(FROM, F.col(day))
    columns = [c for c in known.columns if c not in keys]
    daily = rows.groupBy(*keys, FROM).agg(top_row(known.columns, keys, latest).alias("_top"))
    past = Window.partitionBy(*keys).orderBy(FROM)
    best = daily.withColumn("_best", F.max("_top").over(past.rowsBetween(Window.unboundedPreceding, 0)))
    better = best.where(F.col("_top") == F.col("_best")).withColumn(TO, F.lead(FROM).over(past))
    return better.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in columns], FROM, TO)


def on_day(found: DataFrame, day: Column) -> DataFrame:
    """The versions that hold on a day."""
    return found.where((F.col(FROM) <= day) & (F.col(TO).isNull() | (F.col(TO) > day)))


def totals_by_day(found: DataFrame, period: Period, by: Sequence[str], measures: Mapping[str, Column], day: str = "day") -> DataFrame:
    """Sums over the versions that hold, for every day of a closed period and every group that has any in it.

    A version adds to its group on the day it begins and takes the same away on the day it ends, so what is grouped is two rows per
    version however many days it holds; the days are filled in and summed up on grouped rows.
    """
    first, last = F.lit(period.start), F.lit(period.end)
    inside = found.where((F.col(FROM) <= last) & (F.col(TO).isNull() | (F.col(TO) > first)))
    values = inside.select(*by, FROM, TO, F.lit(1).cast("bigint").alias("_n"), *[F.coalesce(m, F.lit(0)).alias(n) for n, m in measures.items()])
    names = ["_n", *measures]

    def event(when: Column, sign: int) -> Column:
        return F.struct(when.alias(day), *[(F.col(n) * sign).alias(n) for n in names])

    both = F.array(event(F.greatest(FROM, first), 1), event(F.col(TO), -1))
    events = values.select(*by, F.inline(both)).where(F.col(day) <= last).groupBy(*by, day).agg(*[F.sum(n).alias(n) for n in names])
    groups = events.select(*by).distinct()
    days = groups.select(*by, F.explode(F.sequence(first, last)).alias(day), *[F.lit(0).cast(events.schema[n].dataType).alias(n) for n in names])
    filled = events.unionByName(days).groupBy(*by, day).agg(*[F.sum(n).alias(n) for n in names])
    so_far = Window.partitionBy(*[F.col(c) for c in by]).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)  # a row per day of the period
    return filled.select(*by, day, *[F.sum(n).over(so_far).alias(n) for n in names]).where("_n > 0").withColumnRenamed("_n", "n")


def attach_as_of(rows: DataFrame, found: DataFrame, keys: Sequence[str], day: str, newest: date | None = None) -> DataFrame:
    """Left join each row to the version that held on its day.

    Versions are listed under the months they touch and rows meet those of their own month, so a key with a long history is not
    compared as a whole. ``found`` has no column of ``rows`` but the keys. ``newest``: a day that no row is after, where that is known
    for less than making all rows once more.
    """
    newest = newest or rows.agg(F.max(day)).first()[0]
    until = F.least(F.coalesce(F.date_sub(TO, 1), F.lit(newest)), F.lit(newest))
    months = F.sequence(F.trunc(FROM, "month"), F.trunc(F.greatest(until, F.col(FROM)), "month"), F.expr("INTERVAL 1 MONTH"))
    listed = found.withColumn("_month", F.explode(months))
    left = rows.withColumn("_month", F.trunc(day, "month"))
    holds = (F.col(f"l.{day}") >= F.col(f"r.{FROM}")) & (F.col(f"r.{TO}").isNull() | (F.col(f"l.{day}") < F.col(f"r.{TO}")))
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "_month"]]
    joined = left.alias("l").join(listed.alias("r"), [*same, holds], "left")
    return joined.select("l.*", *[F.col(f"r.{c}") for c in found.columns if c not in keys]).drop("_month")
