"""Daily jobs: overlapping look-back, idempotent day replacement, backfill, rolling re-pull."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resalelake.operators.dedup import best_row, identified_first, located_first
from resalelake.operators.periods import Period
from resalelake.sources import sinks

LOOKBACK_DAYS = 2
REPULL_DAYS = 30


def recently_updated(payloads: DataFrame, as_of: date, lookback: int = LOOKBACK_DAYS, updated: str = "updated_at") -> DataFrame:
    """Documents touched in the look-back window. It overlaps earlier runs on purpose; clean-up absorbs it."""
    start = (as_of - timedelta(days=lookback)).isoformat()
    end = (as_of + timedelta(days=1)).isoformat()
    return payloads.where((F.col(updated) >= start) & (F.col(updated) < end))


def created_between(payloads: DataFrame, period: Period, created: str = "created_at") -> DataFrame:
    """Documents created in a period, for backfills. Selecting by update time would also sweep up
    older documents that were merely touched."""
    day = F.substring(created, 1, 10).try_cast("date")
    return payloads.where(period.covers(day))


def one_per_day(raw_orders: DataFrame) -> DataFrame:
    """Raw clean-up: one row per order, day and line; rows with a store first, then with a customer.
    Days stay apart, so the history of an order's status survives."""
    return best_row(
        raw_orders,
        ["order_id", "date", "line_item__id"],
        latest=["ingested_at"],
        prefer=[located_first(), identified_first()],
        ties=["line_item__product_id", "line_item__quantity", "line_item__price", "line_item__total_discount"],
    )


def merge_days(
    spark: SparkSession, table: str, rows: DataFrame, clean: Callable[[DataFrame], DataFrame] = one_per_day
) -> None:
    """Add raw rows to the days they belong to and clean those days."""
    sinks.merge_days(rows, table, clean)


def repull(rows: DataFrame, table: str, as_of: date, days: int = REPULL_DAYS) -> None:
    """Replace the last days of a table by a fresh pull, days that vanished from it included; older days are left alone."""
    asked = Period(as_of - timedelta(days=days - 1))
    sinks.replace_days(rows.where(asked.covers("date")), table, asked=asked)
