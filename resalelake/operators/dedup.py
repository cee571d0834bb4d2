"""One row per key.

The survivor is the greatest row under (preferences, recency, tie-breakers, every remaining column).
It is found with ``max(struct(...))`` rather than a window: the partial aggregate leaves at most one
row per key and task before the shuffle, so a key that owns a third of the table stays cheap, and the
total order makes reruns and recomputed tasks agree. Nulls order lowest, so a missing date loses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_row(
    columns: Sequence[str],
    keys: Sequence[str],
    latest: Sequence[str] = (),
    prefer: Sequence[Column] = (),
    ties: Sequence[str] = (),
    where: Column | None = None,
) -> Column:
    """Aggregate: the greatest row as one value, of those that meet ``where``. Several can share one aggregation."""
    ranked = [c for c in dict.fromkeys([*latest, *ties, *columns]) if c not in keys]
    row = F.struct(*[p.alias(f"_prefer{i}") for i, p in enumerate(prefer)], *ranked)
    return F.max(row if where is None else F.when(where, row))


def best_row(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str] = (),
    prefer: Sequence[Column] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    picked = df.groupBy(*keys).agg(top_row(df.columns, keys, latest, prefer, ties).alias("_top"))
    return picked.selectExpr(*[c if c in keys else f"_top.{c}" for c in df.columns])


def best_row_by(
    df: DataFrame,
    normalised: dict[str, Column],
    latest: Sequence[str] = (),
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """Same, for keys that are expressions (for instance with nulls folded into a value)."""
    names = {f"_key_{name}": expr for name, expr in normalised.items()}
    keyed = df.withColumns(names)
    return best_row(keyed, list(names), latest, prefer).drop(*names)


def located_first() -> Column:
    """Preference used for orders: rows that carry a store win over rows that do not."""
    return F.col("order_location_name").isNotNull()


def identified_first() -> Column:
    return F.col("order_customer_id").isNotNull()
