"""Checks on loads, coverage and agreement with outside totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.functions import columns as C
from resalelake.operators.dedup import best_row


def load_report(df: DataFrame, key: str, filled: Sequence[str], day: str = "date") -> DataFrame:
    """Rows, distinct keys, filled values and date range, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(key).alias("unique_keys"),
        *[F.count(c).alias(f"has_{c}") for c in filled],
        F.min(day).alias("earliest"),
        F.max(day).alias("latest"),
    )


def row_delta(before: DataFrame, after: DataFrame, by: str = "date") -> DataFrame:
    """Rows per day before and after a load. Both sides are counted before they meet."""
    old = before.groupBy(by).agg(F.count(F.lit(1)).alias("rows_before"))
    new = after.groupBy(by).agg(F.count(F.lit(1)).alias("rows_after"))
    both = old.unionByName(new, allowMissingColumns=True)
    was, now = F.coalesce(F.sum("rows_before"), F.lit(0)), F.coalesce(F.sum("rows_after"), F.lit(0))
    return both.groupBy(by).agg(was.alias("rows_before"), now.alias("rows_after"), (now - was).alias("net_change"))


def coverage(df: DataFrame, flags: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Percent of rows where each flag holds, per group."""
    aggs = [C.ratio(F.count_if(flag), F.count(F.lit(1)), 1, percent=True).alias(name) for name, flag in flags.items()]
    total = F.count(F.lit(1)).alias("rows")
    return df.groupBy(*by).agg(total, *aggs) if by else df.agg(total, *aggs)


def reconcile(ours: DataFrame, theirs: DataFrame, key: str, value: str, tolerance_pct: float) -> DataFrame:
    """Our totals beside an outside source's, with difference, percent and verdict."""
    a = ours.groupBy(key).agg(F.sum(value).alias("ours"))
    b = theirs.groupBy(key).agg(F.sum(value).alias("theirs"))
    both = a.unionByName(b, allowMissingColumns=True).groupBy(key).agg(F.sum("ours").alias("ours"), F.sum("theirs").alias("theirs"))
    zero = F.lit(0)
    diff = F.coalesce("ours", zero) - F.coalesce("theirs", zero)
    pct = C.ratio(diff, F.col("theirs"), 2, percent=True)
    return both.select(
        key, "ours", "theirs", diff.alias("difference"), pct.alias("difference_pct"),
        F.coalesce(F.abs(pct) <= tolerance_pct, F.lit(False)).alias("within_tolerance"),
    )


def row_differences(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], compared: Sequence[str], day: str, buckets: int = 64) -> DataFrame:
    """Keys whose rows differ between two sides: changed, missing (only theirs) or extra (only ours).

    Each side is first summed to order-free row hashes per day and bucket of keys; rows of their own are only looked at in days and buckets whose sums
    differ. A row that moved to another day differs in both days and is found as changed. Repeated rows count.
    """
    columns = list(dict.fromkeys([*keys, day, *compared]))

    def hashed(side: DataFrame) -> DataFrame:
        row = F.xxhash64(*columns).cast("decimal(20,0)")
        return side.select(*keys, F.col(day).alias("_day"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"), row.alias("_row"))

    def summed(side: DataFrame, sign: int) -> DataFrame:
        return side.groupBy("_day", "_bucket").agg((F.count(F.lit(1)) * sign).alias("_n"), (F.sum("_row") * sign).cast("decimal(38,0)").alias("_sum"))

    a, b = hashed(ours), hashed(theirs)
    both = summed(a, 1).unionByName(summed(b, -1)).groupBy("_day", "_bucket").agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"))
    odd = both.where("_n <> 0 OR _sum <> 0").select(F.col("_day").alias("_odd_day"), F.col("_bucket").alias("_odd_bucket"))

    def opened(side: DataFrame, sign: int) -> DataFrame:
        here = F.col("_day").eqNullSafe(F.col("_odd_day")) & (F.col("_bucket") == F.col("_odd_bucket"))
        return side.join(odd, here, "left_semi").select(*keys, "_row", F.lit(sign).alias("_side"))

    rows = opened(a, 1).unionByName(opened(b, -1)).groupBy(*keys).agg(
        F.sum("_side").alias("_n"), F.sum(F.col("_row") * F.col("_side")).alias("_sum"),
        F.count_if(F.col("_side") > 0).alias("ours"), F.count_if(F.col("_side") < 0).alias("theirs"),
    )
    status = F.when(F.col("ours") == 0, "missing").when(F.col("theirs") == 0, "extra").otherwise("changed")
    return rows.where("_n <> 0 OR _sum <> 0").select(*keys, status.alias("status"), "ours", "theirs")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, worst first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1").orderBy(F.desc("copies"), *keys)


def overlap_summary(customers: DataFrame) -> DataFrame:
    """Tagged customers, and how many of them also buy."""
    latest = best_row(customers, ["customer_id"], latest=["customer_updated_at", "date"])
    tagged = latest.where(C.has_tag("customer_tags"))
    return tagged.agg(
        F.count(F.lit(1)).alias("consignors"),
        F.count_if(F.col("customer_orders_count") > 0).alias("also_buyers"),
        C.ratio(F.count_if(F.col("customer_orders_count") > 0), F.count(F.lit(1)), 1, percent=True).alias("also_buyers_pct"),
    )


def top_consignors(customers: DataFrame, n: int = 10) -> DataFrame:
    latest = best_row(customers, ["customer_id"], latest=["customer_updated_at", "date"])
    buying = latest.where(C.has_tag("customer_tags") & (F.col("customer_orders_count") > 0))
    return (
        buying.select("customer_id", "customer_first_name", "customer_last_name", "customer_orders_count", "customer_total_spent")
        .orderBy(F.desc("customer_total_spent"), "customer_id")
        .limit(n)
    )


def tag_frequency(customers: DataFrame) -> DataFrame:
    """How many customers carry each tag, by their latest snapshot."""
    latest = best_row(customers.select("customer_id", "customer_updated_at", "date", "customer_tags"), ["customer_id"], latest=["customer_updated_at", "date"])
    tags = latest.select(F.explode(F.array_distinct(F.transform(F.split("customer_tags", ","), lambda t: F.trim(t)))).alias("tag"))
    return tags.where("tag <> ''").groupBy("tag").agg(F.count(F.lit(1)).alias("customers"))


def notes_with(df: DataFrame, note: str, words: tuple[str, ...]) -> DataFrame:
    return df.where(C.has_word(note, words))
