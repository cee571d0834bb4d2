"""Grouped results that are more than a plain sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_known(value: str | Column, *recency: str) -> Column:
    """Aggregate: the value on the most recent row where it is not null."""
    v = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(v.isNotNull(), F.struct(*recency, v.alias("_value"))))["_value"]


def share_of_total(grouped: DataFrame, count: str, name: str, digits: int = 1) -> DataFrame:
    """Percentage each group has of the whole. Meant for results that are already grouped down
    to a handful of labels; the window spans those labels, never detail rows."""
    from resalelake.functions.columns import ratio

    total = F.sum(count).over(Window.partitionBy(F.lit(1)))
    return grouped.withColumn(name, ratio(F.col(count), total, digits, percent=True))


def frequency(df: DataFrame, by: Sequence[str], name: str = "occurrences") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *by)


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Put several one-row aggregates side by side: union with nulls, then keep the known values."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])
