"""Measures, and cards made of them: measure x dimensions x filters x window.

A measure is defined once per fact. A card names its measures, so a change of definition reaches every
card. The runner tells the fact which columns and which days the card needs before anything is read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.functions import columns as C
from resalelake.operators import periods as P
from resalelake.operators.aggregate import one_row, share_of_total
from resalelake.operators.filters import Filters
from resalelake.plans.facts import PERIOD_COLUMN, Facts, to_edge


@dataclass(frozen=True)
class Measure:
    uses: tuple[str, ...]
    make: Callable[[], Column]


def _money(c: str) -> Measure:
    return Measure((c,), lambda: C.rounded(F.sum(c)))


def _sum(c: str) -> Measure:
    return Measure((c,), lambda: F.sum(c))


def _rows() -> Measure:
    return Measure((), lambda: F.count(F.lit(1)))


def _unique(c: str) -> Measure:
    """Count of a column that is unique in its fact."""
    return Measure((c,), lambda: F.count(c))


def _distinct(c: str) -> Measure:
    return Measure((c,), lambda: F.countDistinct(c))


def _ratio(a: str, b: str, digits: int, percent: bool = False) -> Measure:
    return Measure((a, b), lambda: C.ratio(F.sum(a), F.sum(b), digits, percent))


def _per_order(c: str) -> Measure:
    return Measure((c, "order_id"), lambda: C.ratio(F.sum(c), F.count("order_id"), 2))


def _mean(c: str, digits: int, times: int = 1) -> Measure:
    return Measure((c,), lambda: C.mean(F.col(c), digits, times))


def _rows_where(uses: str, test: Callable[[], Column]) -> Measure:
    """Percent of rows that pass a test."""
    return Measure((uses,), lambda: C.ratio(F.count_if(test()), F.count(F.lit(1)), 1, percent=True))


def _processing_hours() -> Column:
    return C.mean(C.whole_hours(C.instant("order_created_ts"), C.instant("order_processed_ts")), 1)


MEASURES: dict[str, dict[str, Measure]] = {
    "orders": {
        "net_sales": _money("net_sales"),
        "gross_profit": _money("gross_profit"),
        "cogs": _money("cogs"),
        "gross_margin_pct": _ratio("gross_profit", "net_sales", 1, percent=True),
        "orders": _unique("order_id"),
        "aov": _per_order("net_sales"),
        "units": _sum("total_units"),
        "upt": _per_order("total_units"),
        "shipping_revenue": _money("shipping_revenue"),
        "processing_hours": Measure(("order_created_ts", "order_processed_ts"), _processing_hours),
    },
    "daily_sales": {
        "net_sales": _money("net_sales"),
        "shipping_revenue": _money("shipping_revenue"),
        "shipping_pct": _ratio("shipping_revenue", "net_sales", 1, percent=True),
    },
    "product_sales": {"units_sold": _sum("units_sold")},
    "refunds": {
        "return_orders": _distinct("order_id"),
        "refunded_units": _sum("refunded_units"),
        "refunded_value": _money("total_refunded"),
        "refund_value": _money("refund_subtotal"),
    },
    "inventory": {
        "units": _sum("units_on_hand"),
        "retail_value": _money("retail_value"),
        "owned_cost": _money("cost_excl_consignment"),
        "products": _rows(),
        "consignment_pct": _rows_where("is_consignment", lambda: F.col("is_consignment")),
        "over_90_pct": _rows_where("days_in_inventory", lambda: F.col("days_in_inventory") > 90),
        "old_bucket_pct": _rows_where(
            "aging_bucket", lambda: F.col("aging_bucket").isin("91-180 days", "180+ days")
        ),
        "avg_days": _mean("days_in_inventory", 0),
    },
    "customers": {
        "customers": _rows(),
        "active_customers": _unique("customer_id"),
        "avg_spent": _mean("total_spent", 2),
        "total_spent": _money("total_spent"),
        "avg_aov": _mean("aov", 2),
        "repeat_pct": _rows_where("customer_type", lambda: F.col("customer_type") == "Returning"),
    },
    "seller": {
        "items": _sum("total_items_supplied"),
        "sellers": _distinct("seller_name"),
        "seller_buyers": Measure(
            ("seller_name", "is_also_buyer"),
            lambda: F.countDistinct(F.when(F.col("is_also_buyer"), F.col("seller_name"))),
        ),
        "first_buy": Measure(("first_buy_date",), lambda: F.min("first_buy_date")),
        "last_buy": Measure(("last_buy_date",), lambda: F.max("last_buy_date")),
    },
    "marketing": {
        "spend": _money("spend"),
        "conversion_value": _money("conversion_value"),
        "roas": _ratio("conversion_value", "spend", 2),
        "conversions": _sum("conversions"),
    },
    "email_campaigns": {
        "sends": _sum("recipients"),
        "open_rate_1": _mean("open_rate", 1, times=100),
        "click_rate_1": _mean("click_rate", 1, times=100),
        "click_rate_2": _mean("click_rate", 2, times=100),
    },
}

Window = Callable[[date], P.Period]
MTD: Window = P.this_month
LAST_YEAR_MONTH: Window = P.same_month_last_year


def LAST_30(as_of: date) -> P.Period:
    return P.last_days(as_of, 30)


def LAST_365(as_of: date) -> P.Period:
    return P.last_days(as_of, 365)


# A column name, or a function that makes the expression once a session exists.
Expr = str | Callable[[], Column]


def _named(columns: Mapping[str, Expr]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c()).alias(name) for name, c in columns.items()]


@dataclass(frozen=True)
class Card:
    key: str
    fact: str
    # output name -> measure of the fact, for grouped and number cards
    show: Mapping[str, str] = field(default_factory=dict)
    # output name -> column of the fact, or a function making an expression; for detail tables
    table: Mapping[str, Expr] | None = None
    by: Mapping[str, Expr] = field(default_factory=dict)
    where: Callable[[], Column] | None = None
    where_uses: tuple[str, ...] = ()
    # fixed window relative to as_of, or None when the reader picks the period
    window: Window | None = None
    day: str | None = None
    # filters the reader may set
    slots: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    limit: int | None = None
    finish: Callable[[DataFrame], DataFrame] | None = None


def _columns(card: Card) -> set[str]:
    used = set(card.where_uses) | set(card.slots)
    for name in card.show.values():
        used |= set(MEASURES[card.fact][name].uses)
    for name, c in [*card.by.items(), *(card.table or {}).items()]:
        used.add(c if isinstance(c, str) else name)
    return used


def day_column(card: Card) -> Column:
    """The date a card's period applies to; some facts hold it as text."""
    if card.fact == "email_campaigns":
        return F.to_date(C.instant("send_time"))
    if card.fact == "customers":
        return F.to_date(C.instant(card.day))
    if card.fact == "seller":
        return C.day_from_text(card.day)
    return F.col(card.day)


def period_of(card: Card, as_of: date, filters: Filters) -> P.Period | None:
    """The days a card is about: its own window, or what the reader picked; None for all."""
    period = card.window(as_of) if card.window else filters.period
    return None if period.start is None and period.end is None else period


def run(card: Card, facts: Facts, as_of: date, filters: Filters | None = None) -> DataFrame:
    filters = filters or Filters()
    period = period_of(card, as_of, filters)
    df = facts.fact(card.fact, period if card.day else None, None if card.table else _columns(card))
    if card.day and period is not None and card.fact not in PERIOD_COLUMN:
        df = df.where(period.covers(day_column(card)))
    return finished(card, df, filters, {name: MEASURES[card.fact][m].make() for name, m in card.show.items()})


def finished(card: Card, df: DataFrame, filters: Filters, measures: Mapping[str, Column]) -> DataFrame:
    """A card's result from rows of its period."""
    if card.where is not None:
        df = df.where(card.where())
    df = filters.apply(df, only=card.slots)  # a slot left empty adds nothing
    if card.table is not None:
        df = df.select(*_named(card.table))
    else:
        keys = _named(card.by)
        aggs = [m.alias(name) for name, m in measures.items()]
        df = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    if card.finish is not None:
        df = card.finish(df)
    if card.order:
        ordered = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in card.order]
        df = df.orderBy(*ordered)
    if card.limit:
        df = df.limit(card.limit)
    return to_edge(df)


# ---- card builders -----------------------------------------------------------

_DAY = {"orders": "order_date", "daily_sales": "order_date", "product_sales": "order_date", "refunds": "refund_date",
        "marketing": "date", "email_campaigns": "send_time"}
_STORE, _CHANNEL = ("store_location",), ("channel",)


def _channel(*names: str) -> dict:
    return {"where": lambda: F.col("channel").isin(*names), "where_uses": ("channel",)}


def _in_stock() -> dict:
    return {"where": lambda: F.col("units_on_hand") > 0, "where_uses": ("units_on_hand",)}


def _dated_stock() -> dict:
    return {"where": lambda: F.col("days_in_inventory").isNotNull(), "where_uses": ("days_in_inventory",)}


def _graded() -> dict:
    return {"where": lambda: F.col("condition_grade").isNotNull(), "where_uses": ("condition_grade",)}


def _buyers() -> dict:
    return {"where": lambda: F.col("orders_count") > 0, "where_uses": ("orders_count",)}


def _number(key: str, fact: str, measure: str, name: str | None = None, **kw) -> Card:
    return Card(key, fact, {name or measure: measure}, day=kw.pop("day", _DAY.get(fact)), **kw)


def _by(key: str, fact: str, by: tuple[str, ...] | Mapping[str, Expr], show: Mapping[str, str], **kw) -> Card:
    keys = by if isinstance(by, Mapping) else {c: c for c in by}
    return Card(key, fact, show, by=keys, day=kw.pop("day", _DAY.get(fact)), **kw)


def _or(c: str, label: str) -> Expr:
    return lambda: F.coalesce(F.col(c), F.lit(label))


def _bucket_order(df: DataFrame) -> DataFrame:
    return df.orderBy(C.bucket_rank(F.col("aging_bucket")))


def _percent_of(total: str, name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: share_of_total(df, total, name)


def _round(c: str, digits: int = 2, times: int = 1) -> Expr:
    return lambda: C.rounded(F.col(c) * times if times != 1 else F.col(c), digits)


def _customer_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def _send_date() -> Column:
    return F.to_date(C.instant("send_time"))


# ---- dashboard tabs ----------------------------------------------------------

def tab_cards() -> list[Card]:
    both = (*_STORE, *_CHANNEL)
    stock = ("store_location", "contract_type")
    on_day = ("snapshot_date", *_STORE)
    retail, ecomm = _channel("Retail"), _channel("Ecomm")
    people = {"slots": both}
    return [
        _number("leadership_orders", "orders", "orders", slots=both),
        _number("leadership_units_sold", "orders", "units", "units_sold", slots=both),
        _number("leadership_net_sales", "orders", "net_sales", slots=both),
        _number("leadership_refunded_units", "refunds", "refunded_units", slots=both),
        _by("leadership_orders_by_sales_channel_pie", "orders", ("channel",), {"orders": "orders"}, slots=_STORE),
        _by("leadership_orders_by_channel_and_province_table", "orders", ("ship_province", "channel"),
            {"orders": "orders"}, slots=_STORE, order=("-orders", "ship_province", "channel")),
        _number("leadership_net_sales_mtd", "orders", "net_sales", "net_sales_mtd", window=MTD),
        _number("leadership_gross_profit_mtd", "orders", "gross_profit", "gross_profit_mtd", window=MTD),
        _number("leadership_gross_margin_pct_mtd", "orders", "gross_margin_pct", window=MTD),
        _number("leadership_aov_mtd", "orders", "aov", "aov_mtd", window=MTD),
        _number("leadership_total_orders_mtd", "orders", "orders", "orders_mtd", window=MTD),
        _number("leadership_total_units_sold_mtd", "orders", "units", "units_mtd", window=MTD),
        _number("leadership_total_inventory_retail_value", "inventory", "retail_value", "inventory_retail_value"),
        _number("leadership_total_inventory_cost_excl_consignment", "inventory", "owned_cost", "inventory_cost"),
        _number("leadership_return_orders_mtd", "refunds", "return_orders", "return_orders_mtd", window=MTD),
        _number("leadership_refunded_units_mtd", "refunds", "refunded_units", "refunded_units_mtd", window=MTD),
        _number("leadership_refunded_value_mtd", "refunds", "refunded_value", "refunded_value_mtd", window=MTD),
        _by("leadership_net_sales_daily_trend", "daily_sales", ("order_date",), {"net_sales": "net_sales"}, order=("order_date",)),
        _by("leadership_net_sales_by_channel_over_time", "daily_sales", ("order_date", "channel"),
            {"net_sales": "net_sales"}, order=("order_date", "channel")),
        _by("leadership_orders_by_day", "orders", ("order_date",), {"orders": "orders"}, order=("order_date",)),
        _by("leadership_aov_by_day", "orders", ("order_date",), {"aov": "aov"}, order=("order_date",)),
        _by("leadership_units_sold_by_day", "orders", ("order_date",), {"units": "units"}, order=("order_date",)),
        _by("leadership_gross_margin_pct_by_day", "orders", ("order_date",), {"margin_pct": "gross_margin_pct"}, order=("order_date",)),
        _by("leadership_returns_by_day", "refunds", ("refund_date",), {"return_orders": "return_orders"}, order=("refund_date",)),
        _by("leadership_refunded_value_by_day", "refunds", ("refund_date",), {"refunded_value": "refunded_value"}, order=("refund_date",)),
        _number("inventory_units_on_hand", "inventory", "units", "units_on_hand", slots=("snapshot_date", *stock)),
        _number("inventory_on_hand_retail_value", "inventory", "retail_value", slots=("snapshot_date", *stock)),
        _number("inventory_on_hand_cost_excl_consignment", "inventory", "owned_cost", "cost", slots=on_day),
        _number("inventory_pct_consignment_in_stock", "inventory", "consignment_pct", "pct_consignment", slots=on_day),
        _by("inventory_units_by_location", "inventory", ("store_location",), {"units": "units"},
            where=lambda: F.col("store_location").isNotNull(), slots=("snapshot_date",), order=("-units", "store_location")),
        _number("inventory_pct_aging_over_90_days", "inventory", "over_90_pct", "pct_over_90", slots=stock, **_dated_stock()),
        _by("inventory_products_by_aging_bucket", "inventory", ("aging_bucket",), {"products": "products"}, slots=_STORE,
            finish=_bucket_order, **_dated_stock()),
        _by("inventory_retail_value_by_aging_bucket", "inventory", ("aging_bucket",), {"retail_value": "retail_value"},
            slots=_STORE, **_dated_stock()),
        _number("inventory_dead_stock_units_180_days", "inventory", "units", "dead_stock_units", slots=_STORE,
                where=lambda: F.col("aging_bucket") == "180+ days", where_uses=("aging_bucket",)),
        _number("inventory_avg_days_in_inventory", "inventory", "avg_days", slots=_STORE, **_dated_stock()),
        _by("inventory_products_by_condition_grade", "inventory", ("condition_grade",), {"products": "products"}, slots=_STORE,
            order=("-products", "condition_grade"), **_graded()),
        _by("inventory_retail_value_by_condition_grade", "inventory", ("condition_grade",), {"retail_value": "retail_value"},
            slots=_STORE, **_graded()),
        _by("inventory_condition_grade_summary_table", "inventory", ("condition_grade",),
            {"products": "products", "units": "units", "retail_value": "retail_value", "avg_days_in_stock": "avg_days"},
            slots=_STORE, order=("-retail_value", "condition_grade"), **_graded()),
        Card("inventory_full_inventory_table", "inventory", slots=("snapshot_date", *stock), order=("-retail_value",), table={c: c for c in (
            "product_title", "product_vendor", "product_type", "units_on_hand", "retail_price", "unit_cost", "retail_value",
            "contract_type", "condition_grade", "store_location", "seller_name", "buy_date", "days_in_inventory", "aging_bucket")}),
        Card("inventory_product_sales_table", "product_sales", day="order_date", slots=both, order=("-gross_revenue",),
             table={c: c for c in ("order_date", "product_title", "sku", "vendor", "channel", "store_location", "units_sold",
                                   "gross_revenue", "cost", "gross_profit", "gross_margin_pct")}),
        _number("retail_net_sales", "orders", "net_sales", slots=_STORE, **retail),
        _number("retail_gross_profit", "orders", "gross_profit", slots=_STORE, **retail),
        _number("retail_aov", "orders", "aov", slots=_STORE, **retail),
        _number("retail_orders", "orders", "orders", slots=_STORE, **retail),
        _number("retail_units_sold", "orders", "units", slots=_STORE, **retail),
        _number("retail_return_orders", "refunds", "return_orders", slots=_STORE, **retail),
        _by("retail_sales_by_day", "daily_sales", ("order_date",), {"net_sales": "net_sales"}, slots=_STORE, order=("order_date",), **retail),
        _by("retail_orders_by_day", "orders", ("order_date",), {"orders": "orders"}, slots=_STORE, order=("order_date",), **retail),
        _by("retail_vs_ecomm_sales", "daily_sales", ("order_date", "channel"), {"net_sales": "net_sales"},
            order=("order_date", "channel"), **_channel("Retail", "Ecomm")),
        _number("ecomm_net_sales", "orders", "net_sales", **ecomm),
        _number("ecomm_orders", "orders", "orders", **ecomm),
        _number("ecomm_aov", "orders", "aov", **ecomm),
        _number("ecomm_units_sold", "orders", "units", **ecomm),
        _number("ecomm_gross_profit", "orders", "gross_profit", **ecomm),
        _number("ecomm_return_orders", "refunds", "return_orders", **ecomm),
        _by("ecomm_sales_by_day", "daily_sales", ("order_date",), {"net_sales": "net_sales"}, order=("order_date",), **ecomm),
        _by("ecomm_orders_by_day", "orders", ("order_date",), {"orders": "orders"}, order=("order_date",), **ecomm),
        _by("ecomm_sales_by_utm_source", "orders", {"utm_source": _or("utm_source", "(none)")}, {"net_sales": "net_sales"},
            order=("-net_sales", "utm_source"), **ecomm),
        _by("customers_new_vs_returning_customers", "customers", ("customer_type",), {"customers": "customers"},
            day="customer_created_at", **people, **_buyers()),
        _by("customers_purchase_segments", "customers", ("purchase_segment",), {"customers": "customers"},
            day="customer_created_at", **people),
        _number("customers_repeat_customers", "customers", "customers", "repeat_customers", **people,
                where=lambda: F.col("purchase_segment") == "Repeat", where_uses=("purchase_segment",)),
        _number("customers_average_customer_ltv", "customers", "avg_spent", "avg_ltv", **people, **_buyers()),
        Card("customers_top_20_customers_by_spend", "customers", order=("-total_spent", "customer"), limit=20, **people, table={
            "customer": _customer_name, "orders_count": "orders_count",
            "total_spent": _round("total_spent"), "aov": _round("aov"), "store_location": "store_location",
            "channel": "channel"}),
        _by("supplier_items_supplied_by_contract_type", "seller", ("contract_type",), {"items": "items"}, day="last_buy_date", slots=both),
        _by("supplier_top_20_sellers_by_units", "seller", ("seller_name", "store_location"), {"items_supplied": "items"},
            day="last_buy_date", slots=_STORE, order=("-items_supplied", "seller_name", "store_location"), limit=20),
        Card("supplier_sellers_who_also_buy_table", "seller", where=lambda: F.col("is_also_buyer"), slots=_STORE,
             order=("-buyer_total_spent", "seller_name"), table={
                 "seller_name": "seller_name", "total_items_supplied": "total_items_supplied", "contract_type": "contract_type",
                 "store_location": "store_location", "buyer_orders_count": "buyer_orders_count",
                 "buyer_total_spent": _round("buyer_total_spent")}),
        _by("supplier_sellers_by_contract_type", "seller", ("contract_type",), {"sellers": "sellers"}, slots=_STORE),
        _number("shipping_revenue", "orders", "shipping_revenue", slots=both),
        _number("shipping_total_orders", "orders", "orders", slots=both),
        _by("shipping_orders_by_channel", "orders", ("channel",), {"orders": "orders"}, slots=_STORE),
        _by("shipping_revenue_by_day", "daily_sales", ("order_date",), {"shipping_revenue": "shipping_revenue"}, slots=_CHANNEL,
            order=("order_date",)),
        _by("shipping_returns_by_channel", "refunds", ("channel",), {"return_orders": "return_orders"}, slots=_STORE),
        _number("marketing_total_marketing_spend", "marketing", "spend", "total_spend"),
        _by("marketing_spend_by_channel", "marketing", ("source",), {"spend": "spend"}),
        _by("marketing_roas_by_channel", "marketing", ("source",), {"roas": "roas"}),
        _by("marketing_daily_spend_by_channel", "marketing", ("date", "source"), {"spend": "spend"}, order=("date", "source")),
        _by("marketing_conversions_by_channel", "marketing", ("source",), {"conversions": "conversions"}),
        _number("marketing_total_email_sends", "email_campaigns", "sends", "total_sends"),
        _number("marketing_avg_open_rate", "email_campaigns", "open_rate_1", "avg_open_rate"),
        _number("marketing_avg_click_rate", "email_campaigns", "click_rate_1", "avg_click_rate"),
        Card("marketing_campaign_performance_table", "email_campaigns", day="send_time", order=("-send_date", "campaign_name"), table={
            "campaign_name": "campaign_name", "send_date": _send_date, "recipients": "recipients",
            "unique_opens": "unique_opens", "unique_clicks": "unique_clicks",
            "open_rate_pct": _round("open_rate", 1, 100), "click_rate_pct": _round("click_rate", 1, 100),
            "unsubscribes": "unsubscribes", "revenue": "revenue"}),
    ]


# ---- the older catalogue: only cards that differ from a tab card --------------

def catalogue_cards() -> list[Card]:
    retail, ecomm, stock, buyers = _channel("Retail"), _channel("Ecomm"), _in_stock(), _buyers()
    label = {"order": ("-products",)}
    return [
        _number("cat_net_sales_mtd", "daily_sales", "net_sales", "net_sales_mtd", window=MTD),
        _number("cat_total_inventory_retail_value", "inventory", "retail_value", "total_retail_value", **stock),
        _number("cat_total_inventory_cost_excl_consignment", "inventory", "owned_cost", "total_cost_excl_consignment", **stock),
        _number("cat_active_customers_12_months", "customers", "active_customers", day="customer_updated_at",
                window=lambda d: P.last_months(d, 12), **buyers),
        _number("cat_repeat_purchase_rate", "customers", "repeat_pct", "repeat_rate_pct", **buyers),
        _number("cat_customer_ltv", "customers", "avg_spent", "avg_ltv", **buyers),
        _by("cat_net_sales_by_channel_mtd", "daily_sales", ("channel",), {"net_sales": "net_sales"}, window=MTD,
            order=("-net_sales", "channel")),
        _number("cat_retail_net_sales_mtd", "daily_sales", "net_sales", "retail_net_sales", window=MTD, **retail),
        _number("cat_retail_cogs_mtd", "orders", "cogs", "retail_cogs", window=MTD, **retail),
        _number("cat_retail_upt_mtd", "orders", "upt", window=MTD, **retail),
        _number("cat_retail_units_sold_mtd", "product_sales", "units_sold", window=MTD, **retail),
        Card("cat_retail_returns_mtd", "refunds", {"return_orders": "return_orders", "refund_value": "refund_value"},
             day="refund_date", window=MTD, **retail),
        _number("cat_ecomm_net_sales_mtd", "daily_sales", "net_sales", "ecomm_net_sales", window=MTD, **ecomm),
        _number("cat_ecomm_upt_mtd", "orders", "upt", window=MTD, **ecomm),
        _number("cat_ecomm_shipping_pct_of_sales_mtd", "daily_sales", "shipping_pct", window=MTD, **ecomm),
        _by("cat_ecomm_sales_by_utm_source", "orders", {"source": _or("utm_source", "Direct")},
            {"net_sales": "net_sales", "orders": "orders"}, window=LAST_30, order=("-net_sales", "source"),
            where=lambda: F.col("channel") == "Ecomm", where_uses=("channel", "utm_source")),
        _by("cat_new_vs_returning_customers", "customers", ("customer_type",), {"total_customers": "customers"},
            finish=_percent_of("total_customers", "pct"), **buyers),
        _by("cat_purchase_segments", "customers", ("purchase_segment",), {"customers": "customers", "avg_spent": "avg_spent"},
            order=("-customers", "purchase_segment"), **buyers),
        _by("cat_aov_by_customer_type", "customers", ("customer_type",), {"avg_aov": "avg_aov"}, **buyers),
        Card("cat_top_20_customers_by_spend", "customers", order=("-total_spent", "customer_name"), limit=20, **buyers, table={
            "customer_name": _customer_name, "city": "city", "country": "country",
            "orders_count": "orders_count", "total_spent": _round("total_spent"), "aov": _round("aov")}),
        _by("cat_customers_by_country", "customers", ("country",), {"customers": "customers", "total_spent": "total_spent"},
            order=("-customers", "country"), limit=15,
            where=lambda: (F.col("orders_count") > 0) & F.col("country").isNotNull() & (F.col("country") != ""),
            where_uses=("orders_count",)),
        _number("cat_units_on_hand", "inventory", "units", "units_on_hand", **stock),
        _number("cat_pct_consignment_in_stock", "inventory", "consignment_pct", **stock),
        _by("cat_inventory_aging_breakdown", "inventory", ("aging_bucket",),
            {"products": "products", "units": "units", "retail_value": "retail_value"},
            finish=lambda df: _bucket_order(share_of_total(df, "products", "pct_products")), **stock),
        _number("cat_pct_aging_over_90_days", "inventory", "old_bucket_pct", "aging_over_90_pct", **stock),
        _by("cat_condition_grade_distribution", "inventory", {"condition_grade": _or("condition_grade", "Unknown")},
            {"products": "products", "units": "units"}, **label, **stock),
        _by("cat_inventory_by_location", "inventory", {"location": _or("store_location", "Unknown")},
            {"products": "products", "units": "units", "retail_value": "retail_value"}, order=("-units", "location"), **stock),
        _by("cat_contract_type_distribution", "inventory", {"contract_type": _or("contract_type", "Unknown")},
            {"products": "products", "units": "units", "retail_value": "retail_value"}, **label, **stock),
        _by("cat_top_vendors_by_inventory_value", "inventory", ("product_vendor",),
            {"products": "products", "units": "units", "retail_value": "retail_value"}, order=("-retail_value", "product_vendor"),
            limit=20, where=lambda: (F.col("units_on_hand") > 0) & (F.col("product_vendor") != ""), where_uses=("units_on_hand",)),
        _number("cat_total_unique_sellers", "seller", "sellers", "total_sellers"),
        Card("cat_sellers_also_buyers", "seller", {"seller_buyers": "seller_buyers", "total_sellers": "sellers"},
             finish=lambda df: df.withColumn("pct", C.ratio(F.col("seller_buyers"), F.col("total_sellers"), 1, percent=True))),
        _by("cat_top_20_sellers_by_units_supplied", "seller",
            {"seller_name": "seller_name", "contract_type": "contract_type", "is_also_buyer": "is_also_buyer",
             "buyer_total_spent": "buyer_total_spent"},
            {"units_supplied": "items", "first_supply_date": "first_buy", "last_supply_date": "last_buy"},
            finish=lambda df: df.withColumn("also_spent_as_buyer", _round("buyer_total_spent")()).drop("buyer_total_spent"),
            order=("-units_supplied", "seller_name", "contract_type", "also_spent_as_buyer"), limit=20),
        _by("cat_items_by_contract_type", "seller", ("contract_type",), {"sellers": "sellers", "items": "items"},
            order=("-items", "contract_type")),
        _by("cat_seller_buyer_balance_top_20", "seller",
            {"seller_name": "seller_name", "buyer_total_spent": "buyer_total_spent", "purchase_orders": "buyer_orders_count"},
            {"items_sold_to_us": "items"}, where=lambda: F.col("is_also_buyer"), where_uses=("is_also_buyer",),
            finish=lambda df: df.withColumn("spent_buying_from_us", _round("buyer_total_spent")()).drop("buyer_total_spent"),
            order=("-items_sold_to_us", "seller_name", "spent_buying_from_us", "purchase_orders"), limit=20),
        _by("cat_roas_by_channel_mtd", "marketing", ("source",),
            {"roas": "roas", "spend": "spend", "conversion_value": "conversion_value"}, window=MTD),
        Card("cat_email_campaigns_performance", "email_campaigns", order=("-send_date", "campaign_name"), table={
            "campaign_name": "campaign_name", "send_date": _send_date, "sends": "recipients",
            "unique_opens": "unique_opens", "open_rate_pct": _round("open_rate", 1, 100),
            "unique_clicks": "unique_clicks", "click_rate_pct": _round("click_rate", 2, 100),
            "unsubscribes": "unsubscribes", "revenue": "revenue"}),
        _number("cat_avg_email_open_rate", "email_campaigns", "open_rate_1", "avg_open_rate", day=None),
        _number("cat_avg_email_click_rate", "email_campaigns", "click_rate_2", "avg_click_rate", day=None),
        _number("cat_total_email_sends", "email_campaigns", "sends", "total_sends", day=None),
        _number("cat_shipping_pct_of_sales_mtd", "daily_sales", "shipping_pct", window=MTD),
        _number("cat_avg_order_processing_time", "orders", "processing_hours", "avg_processing_hrs", window=LAST_30),
        _by("cat_orders_by_channel_mtd", "orders", ("channel",),
            {"orders": "orders", "net_sales": "net_sales", "shipping_revenue": "shipping_revenue"}, window=MTD,
            order=("-orders", "channel")),
        _by("cat_shipping_revenue_trend_30_days", "daily_sales", ("order_date",),
            {"shipping_revenue": "shipping_revenue", "net_sales": "net_sales", "shipping_pct": "shipping_pct"}, window=LAST_30,
            order=("order_date",)),
        _by("cat_refunds_by_channel_mtd", "refunds", ("channel",),
            {"refund_orders": "return_orders", "refund_value": "refund_value"}, window=MTD, order=("-refund_value", "channel")),
    ]


def windowed_cards() -> list[Card]:
    """Catalogue cards that are a tab card (or another catalogue card) over a fixed window."""
    known = {c.key: c for c in [*tab_cards(), *catalogue_cards()]}

    def over(window: Window, key: str, base: str, renamed: str | None = None) -> Card:
        card = known[base]
        show = {renamed: measure for measure in card.show.values()} if renamed else card.show
        return replace(card, key=key, window=window, show=show)

    return [
        over(LAST_30, "cat_net_sales_daily_trend", "leadership_net_sales_daily_trend"),
        over(LAST_YEAR_MONTH, "cat_retail_ly_net_sales", "cat_retail_net_sales_mtd", "retail_net_sales_ly"),
        over(MTD, "cat_retail_gross_profit_mtd", "retail_gross_profit", "retail_gross_profit"),
        over(MTD, "cat_retail_aov_mtd", "retail_aov", "retail_aov"),
        over(LAST_YEAR_MONTH, "cat_retail_aov_ly", "retail_aov", "retail_aov_ly"),
        over(LAST_30, "cat_retail_daily_sales", "retail_sales_by_day"),
        over(MTD, "cat_ecomm_total_orders_mtd", "ecomm_orders", "total_orders"),
        over(MTD, "cat_ecomm_aov_mtd", "ecomm_aov", "ecomm_aov"),
        over(MTD, "cat_total_marketing_spend_mtd", "marketing_total_marketing_spend"),
        over(MTD, "cat_spend_by_channel_mtd", "marketing_spend_by_channel"),
        over(LAST_30, "cat_daily_spend_by_channel", "marketing_daily_spend_by_channel"),
    ]


# ---- cards over two facts ----------------------------------------------------
# Scalars of different facts meet by union and one final aggregate; nothing is cross joined.

Special = Callable[[Facts, date], DataFrame]


def _sold_and_stock(facts: Facts, as_of: date, in_stock_only: bool) -> DataFrame:
    sold = facts.fact("product_sales", LAST_30(as_of), {"units_sold"}).agg(F.sum("units_sold").alias("sold"))
    stock = facts.fact("inventory")
    stock = stock.where("units_on_hand > 0") if in_stock_only else stock
    return one_row([sold, stock.agg(F.sum("units_on_hand").alias("on_hand"))])


def sell_through(facts: Facts, as_of: date, in_stock_only: bool = False) -> DataFrame:
    both = _sold_and_stock(facts, as_of, in_stock_only)
    return both.select(C.ratio(F.col("sold"), F.col("sold") + F.col("on_hand"), 1, percent=True).alias("sell_through_pct"))


def _cogs_and_stock(facts: Facts, as_of: date) -> DataFrame:
    cogs = facts.fact("orders", LAST_365(as_of), {"cogs"}).agg(F.sum("cogs").alias("cogs"))
    stock = facts.fact("inventory").where("units_on_hand > 0").agg(F.sum("cost_excl_consignment").alias("owned"))
    return one_row([cogs, stock])


def inventory_turnover(facts: Facts, as_of: date) -> DataFrame:
    return _cogs_and_stock(facts, as_of).select(C.ratio(F.col("cogs"), F.col("owned"), 2).alias("inventory_turnover"))


def days_inventory_outstanding(facts: Facts, as_of: date) -> DataFrame:
    turns = C.ratio(F.col("cogs"), F.col("owned"))
    return _cogs_and_stock(facts, as_of).select(C.ratio(F.lit(365), turns, 0).alias("dio_days"))


def ecomm_return_rate(facts: Facts, as_of: date) -> DataFrame:
    """Share of the month's online orders with a refund of any date. Orders and distinct refunded
    orders are both unique per order, so the join neither fans out nor needs distinct counts."""
    sold = facts.fact("orders", MTD(as_of), {"order_id", "channel"}).where("channel = 'Ecomm'").select("order_id")
    refunded = facts.refunded_orders()
    rate = C.ratio(F.count("refunded"), F.count("order_id"), 1, percent=True)
    return sold.join(refunded, "order_id", "left").agg(rate.alias("return_rate_pct"))


def _spend(facts: Facts, period: P.Period) -> DataFrame:
    return facts.fact("marketing").where(period.covers("date")).agg(F.sum("spend").alias("spend"))


def _new_customers(facts: Facts, as_of: date) -> DataFrame:
    created = F.to_date(C.instant("customer_created_at"))
    return facts.fact("customers").where((F.col("customer_type") == "New") & LAST_30(as_of).covers(created))


def acquisition_cost(facts: Facts, as_of: date) -> DataFrame:
    """Spend per new customer, each total taken on its own (the dashboards' version multiplies spend by
    the number of customers before dividing, so it always shows plain spend)."""
    new = _new_customers(facts, as_of).agg(F.count("customer_id").alias("new_customers"))
    both = one_row([_spend(facts, LAST_30(as_of)), new])
    return both.select(C.ratio(F.col("spend"), F.col("new_customers"), 2).alias("cac"))


def acquisition_cost_as_published(facts: Facts, as_of: date) -> DataFrame:
    """What the dashboards show: total spend whenever there is a new customer."""
    new = _new_customers(facts, as_of).agg(F.count("customer_id").alias("new_customers"))
    both = one_row([_spend(facts, LAST_30(as_of)), new])
    return both.select(F.when(F.col("new_customers") > 0, C.rounded(F.col("spend"))).cast("double").alias("cac"))


def marketing_efficiency(facts: Facts, as_of: date) -> DataFrame:
    sales = facts.fact("daily_sales", MTD(as_of), {"net_sales"}).agg(F.sum("net_sales").alias("net_sales"))
    both = one_row([sales, _spend(facts, MTD(as_of))])
    return both.select(C.ratio(F.col("net_sales"), F.col("spend"), 2).alias("mer"))


def month_against_last_year(facts: Facts, as_of: date, cumulative: bool = False) -> DataFrame:
    """Retail sales by day of month, this year beside last year; optionally as running totals."""
    zero = F.lit(0).cast("decimal(18,4)")

    def of(year: int) -> Column:
        return F.sum(F.when(F.year("order_date") == year, F.col("net_sales")).otherwise(zero))

    # A day that only another year sold on is a row of zeros, so every year is read, as the dashboards define it.
    retail = facts.fact("daily_sales", None, {"net_sales"}).where("channel = 'Retail'")
    daily = (
        retail.where(F.month("order_date") == as_of.month)
        .groupBy(F.dayofmonth("order_date").alias("day_of_month"))
        .agg(of(as_of.year).alias("this_year"), of(as_of.year - 1).alias("last_year"))
    )
    if cumulative:  # at most 31 rows reach the window
        daily = daily.select(
            "day_of_month",
            P.running("this_year", "day_of_month").alias("this_year"),
            P.running("last_year", "day_of_month").alias("last_year"),
        )
    return to_edge(daily.orderBy("day_of_month"))


SPECIAL: dict[str, Special] = {
    "leadership_sell_through_rate_30_days": sell_through,
    "cat_sell_through_rate_30_days": lambda f, d: sell_through(f, d, in_stock_only=True),
    "cat_inventory_turnover_annual": inventory_turnover,
    "cat_days_inventory_outstanding_dio": days_inventory_outstanding,
    "cat_retail_mtd_vs_ly": month_against_last_year,
    "cat_ecomm_return_rate_mtd": ecomm_return_rate,
    "cat_cac_last_30_days": acquisition_cost,
    "cat_mer_marketing_efficiency_ratio": marketing_efficiency,
}


def period_change(card: Card, facts: Facts, as_of: date, period: P.Period) -> DataFrame:
    """A number card beside its value for the preceding period: value, previous, change and change %.

    Both periods adjoin, so they are read together and grouped by which one a day is in.
    """
    (name,) = card.show
    before = P.previous(period)
    span = P.Period(before.start, period.end)
    df = facts.fact(card.fact, span, _columns(card))
    if card.where is not None:
        df = df.where(card.where())
    day = day_column(card)
    side = F.when(period.covers(day), "value").when(before.covers(day), "previous")
    measured = df.groupBy(side.alias("_side")).agg(MEASURES[card.fact][card.show[name]].make().alias(name))
    if card.finish is not None:
        measured = card.finish(measured)
    both = to_edge(measured.agg(*[F.max(F.when(F.col("_side") == s, F.col(name))).alias(s) for s in ("value", "previous")]))
    change = F.col("value") - F.col("previous")
    return both.select(
        "value", "previous", change.alias("change"), C.ratio(change, F.col("previous"), 1, percent=True).alias("change_pct")
    )
