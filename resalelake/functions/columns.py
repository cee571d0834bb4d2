"""Column expressions: tolerant typing, dates in the store's zone, ratios, text extraction, mappings.

Every helper takes and returns a Column built from Spark built-ins, so whole plans stay in codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from resalelake.functions import rules as R


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- typing ------------------------------------------------------------------

def amount(c: str | Column) -> Column:
    """Tolerant cast of a raw amount; unreadable text becomes null."""
    return col(c).try_cast(R.MONEY)


def amount_or_zero(c: str | Column) -> Column:
    return F.coalesce(amount(c), F.lit(0).cast(R.MONEY))


def whole(c: str | Column) -> Column:
    """Numeric column to a whole number, rounding half away from zero (a plain cast would truncate)."""
    return F.round(col(c).try_cast(R.MONEY), 0).try_cast("bigint")


def whole_from_text(c: str | Column) -> Column:
    """Text to a whole number; text with a fraction is unreadable and becomes null."""
    return col(c).try_cast("bigint")


def text_or_blank(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col(c).cast("string"), F.lit(""))


def true_false_text(flag: Column) -> Column:
    return F.when(flag, "True").otherwise("False")


# ---- dates -------------------------------------------------------------------

def instant(c: str | Column) -> Column:
    """ISO-8601 text with zone to an instant; unreadable text becomes null."""
    return F.try_to_timestamp(col(c))


def local_day(ts: Column, zone: str = R.STORE_ZONE) -> Column:
    """Calendar day of an instant on the store's clock (needs a UTC session zone)."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def business_day(c: str | Column, zone: str = R.STORE_ZONE) -> Column:
    return local_day(instant(c), zone)


def day_from_text(c: str | Column) -> Column:
    return F.try_to_date(col(c), "yyyy-MM-dd")


def iso_week_text(day: Column) -> Column:
    return F.weekofyear(day).cast("string")


def year_month_text(day: Column) -> Column:
    """Packed ``YYYY|M`` period, month without padding."""
    return F.concat_ws("|", F.year(day).cast("string"), F.month(day).cast("string"))


def month_text(day: Column) -> Column:
    return F.lpad(F.month(day).cast("string"), 2, "0")


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


# ---- numbers -----------------------------------------------------------------

def rounded(c: Column, digits: int = 2) -> Column:
    """Round a decimal half away from zero; the caller keeps doubles out."""
    return F.round(c, digits)


def ratio(num: Column, den: Column, digits: int | None = None, percent: bool = False) -> Column:
    """Safe quotient: null when the divisor is zero or null. Rounded in decimal, handed out as double."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    if percent:
        q = q * F.lit(100)
    if digits is None:
        return q
    return F.round(q.cast(R.RATIO), digits).cast("double")


def mean(c: Column, digits: int | None = None, times: int = 1) -> Column:
    """Average from an exact sum and a count, so the result does not depend on summation order."""
    q = F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
    if times != 1:
        q = q * F.lit(times)
    return q if digits is None else F.round(q.cast(R.RATIO), digits).cast("double")


# ---- text --------------------------------------------------------------------

def first_quoted(c: str | Column) -> Column:
    """First element of a JSON string array held as text."""
    return F.nullif(F.regexp_extract(col(c), r'"([^"]+)"', 1), F.lit(""))


def trailing_id(c: str | Column) -> Column:
    """Digits after the last slash of a global id."""
    return F.nullif(F.regexp_extract(col(c), r"/(\d+)$", 1), F.lit(""))


def name_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def full_name(first: str | Column, last: str | Column) -> Column:
    """Null when either part is null."""
    return F.concat(F.trim(col(first)), F.lit(" "), F.trim(col(last)))


def has_word(c: str | Column, words: tuple[str, ...]) -> Column:
    text = F.lower(F.coalesce(col(c), F.lit("")))
    return text.rlike("|".join(re.escape(w) for w in words))


def has_tag(c: str | Column, tag: str = R.CONSIGNOR_TAG) -> Column:
    return F.lower(col(c)).contains(tag)


# ---- mappings ----------------------------------------------------------------

def constant_map(table: dict[str, object]) -> Column:
    """A small constant table as a map literal."""
    quoted = [
        x if isinstance(x, int) else "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
        for item in table.items()
        for x in item
    ]
    return F.expr(f"map({', '.join(map(str, quoted))})")


def lookup(c: str | Column, table: dict[str, str]) -> Column:
    """Value of a constant table, null when absent. The table is a plan literal, so nothing is joined."""
    return F.try_element_at(constant_map(table), col(c))


def sales_channel(app: str | Column = "order_app_name") -> Column:
    return F.coalesce(lookup(app, R.CHANNEL_BY_APP), F.lit(R.OTHER_CHANNEL))


def source_app(source_name: str | Column) -> Column:
    raw = blank_to_null(source_name)
    return F.coalesce(lookup(raw, R.APP_BY_SOURCE_NAME), raw, F.lit(R.UNKNOWN_APP))


def store_name(location_id: str | Column) -> Column:
    """Null id stays null, unmapped id gets the placeholder store."""
    known = blank_to_null(location_id)
    return F.when(known.isNotNull(), F.coalesce(lookup(known, R.STORE_BY_LOCATION_ID), F.lit(R.UNKNOWN_STORE)))


def bucket(value: Column, edges=R.AGE_BUCKETS, last: str = R.OLDEST_BUCKET, unknown: str | None = None) -> Column:
    """Label of the first edge the value does not exceed. A null value falls to the last label
    unless ``unknown`` names another one."""
    (edge, label), *more = edges
    out = F.when(value <= edge, label)
    for edge, label in more:
        out = out.when(value <= edge, label)
    out = out.otherwise(last)
    return out if unknown is None else F.when(value.isNull(), unknown).otherwise(out)


def bucket_rank(label: Column, edges=R.AGE_BUCKETS) -> Column:
    order = {name: i for i, (_, name) in enumerate(edges, 1)}
    return F.coalesce(F.try_element_at(constant_map(order), label), F.lit(len(edges) + 1))


# ---- predicates --------------------------------------------------------------

def valid_order() -> Column:
    """Not a test and not cancelled. A null status is neither, so its row does not pass."""
    live = F.lower(F.coalesce(F.col("order_test"), F.lit("false"))) == "false"
    return live & (F.lower("order_financial_status") != "cancelled")


def real_line() -> Column:
    return F.col("line_item__id").isNotNull() & (F.col("line_item__id") != "")


def merchandise_line() -> Column:
    title = F.lower(F.coalesce(F.col("line_item__title"), F.lit("")))
    return real_line() & F.col("line_item__product_id").isNotNull() & ~title.isin(*R.NON_MERCHANDISE_TITLES)


def meaningful_refund() -> Column:
    return (
        (amount("line_item__refunds_subtotal") > 0)
        | (amount("order_refund_discrepancy_amount") != 0)
        | (amount("order_total_shipping_refunded_price") != 0)
    )


def is_consignment(c: str | Column = "contract_type") -> Column:
    return F.coalesce(F.lower(col(c)) == R.CONSIGNMENT, F.lit(False))


def owned_value(value: Column, contract: str | Column = "contract_type") -> Column:
    """Value of stock we own: consigned stock and stock without a contract count as zero."""
    return F.when(F.lower(col(contract)) != R.CONSIGNMENT, value).otherwise(F.lit(0).cast(R.MONEY))


def customer_type(flag: str | Column) -> Column:
    return F.when(F.lower(col(flag).cast("string")) == "true", "Returning").otherwise("New")


def purchase_segment(orders: Column) -> Column:
    return F.when(orders == 0, "No Orders").when(orders == 1, "One-time").when(orders >= 2, "Repeat")
