"""Joins that stay even when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


#: A key is hot from this share of the rows on.
HOT_SHARE = 1 / 64


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold at least a share of the rows; at most 1 / share of them, and none if nothing is hot.

    A sketch of bounded size lists every key that may be frequent; the candidates are then counted exactly, so both steps
    return a bounded number of keys.
    """
    rows = df.select(key).where(F.col(key).isNotNull())
    candidates = rows.freqItems([key], share).first()[0] or []
    if not candidates:
        return []
    counted = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(key) == F.lit(c)).alias(f"c{n}") for n, c in enumerate(candidates)]).first()
    return [c for n, c in enumerate(candidates) if counted[f"c{n}"] >= share * counted.n]


def _is_hot(key: str, hot: Sequence | None) -> Column:
    return F.lit(True) if hot is None else F.coalesce(F.col(key).isin(list(hot)), F.lit(False)) if hot else F.lit(False)


def _salted(df: DataFrame, spread: Sequence[str], salts: int, hot: Column) -> DataFrame:
    part = F.pmod(F.xxhash64(*spread), F.lit(salts).cast("bigint"))
    return df.withColumn("_salt", F.when(hot, part).otherwise(F.lit(0).cast("bigint")))


def _every(salts: int, hot: Column) -> Column:
    all_ = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    return F.when(hot, all_).otherwise(F.array(F.lit(0).cast("bigint")))


def attach(
    big: DataFrame, dim: DataFrame, key: str | Sequence[str], spread: Sequence[str], salts: int = SALTS, hot: Sequence | None = None
) -> DataFrame:
    """Left join a one-row-per-key table onto rows whose key may be badly skewed.

    A hash of ``spread`` (columns that vary inside a key, null-safe, stable across task retries) splits
    each key into ``salts`` parts; the dimension is copied once per part. The dimension must be the
    smaller side. Because both sides are shuffled for this join alone, adaptive execution can split a part
    further when it is still oversized. No broadcast is forced: Spark picks one from the sizes it knows or
    measures. With ``hot`` (see ``hot_keys``; one key column) only those keys are split and copied, and with none the join is plain.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if hot is not None and not hot:
        return big.join(dim, keys, "left")
    split = _is_hot(keys[0], hot)
    copied = dim.withColumn("_salt", F.explode(_every(salts, split)))
    return _salted(big, spread, salts, split).join(copied, [*keys, "_salt"], "left").drop("_salt")


def match_or_keep(
    left: DataFrame, right: DataFrame, key: str, spread_right: Sequence[str], salts: int = SALTS, hot: Sequence | None = None
) -> DataFrame:
    """Left join that may fan out, where the *right* side can have hot keys.

    Left rows whose key exists on the right are copied once per part of that key; the others stay single
    and keep nulls. A copy that meets no row of its part is dropped, so nothing is lost or doubled, both
    sides are read once for the join, and no task holds a whole key of the right side. With ``hot`` (of the right side) only those keys
    are in parts, and with none the join is plain.
    """
    if hot is not None and not hot:
        return left.join(right, key, "left")
    split = _is_hot(key, hot)
    present = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    flagged = attach(left, present, key, [c for c in left.columns if c != key], salts)
    known = F.coalesce("_known", F.lit(False))
    copies = flagged.select(*left.columns, known.alias("_known"), F.explode(_every(salts, known & split)).alias("_salt"))
    parts = _salted(right, spread_right, salts, split).withColumn("_met", F.lit(True))
    joined = copies.join(parts, [key, "_salt"], "left")
    return joined.where("_met OR NOT _known").drop("_salt", "_known", "_met")
