"""Date windows relative to an explicit day, and comparisons between periods."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """Closed range of days; an open end is None."""

    start: date | None = None
    end: date | None = None

    def covers(self, day: str | Column) -> Column:
        c = F.col(day) if isinstance(day, str) else day
        out = F.lit(True)
        if self.start is not None:
            out = c >= F.lit(self.start)
        if self.end is not None:
            upper = c <= F.lit(self.end)
            out = upper if self.start is None else out & upper
        return out


@dataclass(frozen=True)
class Spans(Period):
    """Several stretches of days with gaps between them. ``start`` and ``end`` are those of the whole."""

    parts: tuple[Period, ...] = ()

    @classmethod
    def of(cls, parts: Iterable[Period]) -> Period:
        """Neighbouring and overlapping closed stretches become one; a single one is a plain period."""
        merged: list[Period] = []
        for part in sorted(parts, key=lambda p: p.start):
            if merged and part.start <= merged[-1].end + timedelta(days=1):
                merged[-1] = Period(merged[-1].start, max(merged[-1].end, part.end))
            else:
                merged.append(part)
        if len(merged) == 1:
            return merged[0]
        return cls(merged[0].start, merged[-1].end, tuple(merged))

    def covers(self, day: str | Column) -> Column:
        return reduce(Column.__or__, [p.covers(day) for p in self.parts])


def stretches(period: Period) -> tuple[Period, ...]:
    """The stretches of a period without gaps."""
    return period.parts if isinstance(period, Spans) else (period,)


def spans_of_months(firsts: Iterable[date]) -> Period:
    """The months that begin on the given days; adjoining ones form one stretch."""
    return Spans.of(_month_of(day) for day in firsts)


def _month_of(day: date, years_back: int = 0) -> Period:
    first = date(day.year - years_back, day.month, 1)
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return Period(first, following - timedelta(days=1))


def this_month(as_of: date) -> Period:
    return _month_of(as_of)


def same_month_last_year(as_of: date) -> Period:
    return _month_of(as_of, 1)


def last_days(as_of: date, days: int) -> Period:
    """From ``days`` before the given day, with no upper end (as the dashboards define it)."""
    return Period(as_of - timedelta(days=days))


def last_months(as_of: date, months: int) -> Period:
    total = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(total, 12)
    last = _month_of(date(year, month + 1, 1)).end
    return Period(date(year, month + 1, min(as_of.day, last.day)))


def previous(period: Period) -> Period:
    """The equally long period that ends the day before this one starts."""
    length = (period.end - period.start).days + 1
    return Period(period.start - timedelta(days=length), period.start - timedelta(days=1))


def total_within(value: str, day: str, period: Period) -> Column:
    return F.sum(F.when(period.covers(day), F.col(value)))


def running(value: str, order: str, over: str | None = None) -> Column:
    """Cumulative sum; ``over`` names the column that restarts it."""
    w = Window.partitionBy(over if over else F.lit(1)).orderBy(order)
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))


def known_on(snapshots: DataFrame, day: date, column: str = "date") -> DataFrame:
    """Snapshots that existed on a day; take the best row per key of the result for a true as-of view."""
    return snapshots.where(F.col(column) <= F.lit(day))
