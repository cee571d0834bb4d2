"""The nine facts, as functions of the raw tables.

Amounts stay decimal inside the facts, so sums do not depend on task order; ``to_edge`` hands them out
as doubles. A ``Period`` given to an order-based fact is applied to the raw rows *before* clean-up: an
order keeps its creation time for life, so rows outside the period can never win or lose a comparison
inside it, and the scan skips the rest of history.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resalelake.functions import columns as C
from resalelake.functions import rules as R
from resalelake.operators import history, identity
from resalelake.operators.aggregate import latest_known
from resalelake.operators.dedup import best_row, best_row_by, located_first
from resalelake.operators.joins import attach
from resalelake.operators.periods import Period, known_on, stretches
from resalelake.operators.reshape import pivot_attributes
from resalelake.sources.raw import RawTables

HEADER = {
    "order_id": "order_id",
    "order_name": "order_name",
    "order_currency": "order_currency",
    "sales_channel": "order_app_name",
    "ship_country": "order_shipping_address_country",
    "ship_province": "order_shipping_address_province",
    "store_location_id": "order_location_id",
    "store_location": "order_location_name",
    "order_customer_id": "order_customer_id",
    "order_created_ts": "order_created_at",
    "order_processed_ts": "order_processed_at",
    "utm_source": "order_customer_last_visit_utm_source",
    "utm_medium": "order_customer_last_visit_utm_medium",
    "utm_campaign": "order_customer_last_visit_utm_campaign",
    "year": "year",
    "week": "week",
    "year_month": "year_month",
}
HEADER_AMOUNTS = {
    "net_sales": "order_net_sales",
    "subtotal_revenue": "order_subtotal_price",
    "gross_revenue": "order_total_price",
    "total_discounts": "order_total_discounts",
    "shipping_revenue": "order_shipping_price",
    "total_tax": "order_total_tax_amount",
    "order_quantity": "order_quantity",
}
HEADER_DERIVED = {
    "order_date": "order_created_at",
    "channel": "order_app_name",
    "financial_status": "order_financial_status",
    "raw_date": "date",
}
HEADER_RECENCY = ("date", "ingested_at")
HEADER_TIES = ("order_processed_at", "order_financial_status", "order_subtotal_price")
LINE_RECENCY = ("order_created_at", "date", "ingested_at")
LINE_VALUES = (
    "line_item__product_id", "line_item__quantity", "line_item__price",
    "line_item__total_discount", "line_item__variant_unit_cost",
)
LINE_LABELS = (
    "line_item__sku", "line_item__title", "line_item__vendor",
    "order_app_name", "order_shipping_address_country", "order_shipping_address_province",
)
LINE_KEY = ("order_id", "line_item__id")
PARENT = (
    "order_location_name", "order_created_at", "date", "order_app_name", "order_financial_status", "order_currency",
    "order_shipping_address_country", "order_shipping_address_province",
)
SNAPSHOT_RECENCY = ("product_updated_at_datetime", "date")
PARENT_RECENCY = ("order_created_at", "date")
DAILY_DIMENSIONS = ("order_date", "channel", "ship_country", "ship_province", "store_location")
PRODUCT_DIMENSIONS = (
    "order_date", "product_id", "sku", "product_title", "vendor",
    "channel", "ship_country", "ship_province", "store_location",
)


def to_edge(df: DataFrame) -> DataFrame:
    """Decimals to doubles, for readers outside Spark."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def created_within(period: Period | None) -> Column:
    """Coarse text ranges on the creation time, safe for any zone; Parquet statistics can use them."""
    created = F.col("order_created_at")

    def within(part: Period) -> Column:
        out = F.lit(True)
        if part.start:
            out = created >= F.lit((part.start - timedelta(days=2)).isoformat())
        if part.end:
            upper = created < F.lit((part.end + timedelta(days=3)).isoformat())
            out = upper if part.start is None else out & upper
        return out

    return F.lit(True) if period is None else reduce(Column.__or__, map(within, stretches(period)))


def header_choice() -> dict:
    return {"latest": HEADER_RECENCY, "prefer": [located_first()], "ties": HEADER_TIES}


def line_choice() -> dict:
    return {"latest": LINE_RECENCY, "prefer": [located_first()], "ties": LINE_VALUES}


def parent_columns(row: str = "") -> list[Column]:
    """What a refund takes from its order; ``row`` names the value that holds the order's columns."""
    at = f"{row}." if row else ""
    return [
        C.sales_channel(f"{at}order_app_name").alias("channel"),
        F.lower(f"{at}order_financial_status").alias("financial_status"),
        F.col(f"{at}order_currency").alias("currency"),
        F.col(f"{at}order_shipping_address_country").alias("ship_country"),
        F.col(f"{at}order_shipping_address_province").alias("ship_province"),
        F.col(f"{at}order_location_name").alias("store_location"),
    ]


def refund_key(by: str = "amounts") -> dict[str, Column]:
    """What makes two refund rows one. "amounts": refund, subtotal and quantity, as published, which takes two lines of a refund with
    the same amounts for one; "line": refund and line, where the raw row names its line."""
    zero = F.lit(0).cast(R.MONEY)
    line = F.col("line_item__refunds") if by == "line" else F.lit(None).cast("string")
    return {
        "order": F.col("order_id"),
        "refund": F.coalesce("order_refunds", F.lit("NO_REFUND")),
        "subtotal": F.when(line.isNull(), F.coalesce("line_item__refunds_subtotal", zero)),
        "quantity": F.when(line.isNull(), F.coalesce("line_item__refunds_quantity", zero)),
    } | ({"line": line} if by == "line" else {})


def _header_column(name: str, source: str, derive: Callable[[], Column] | None) -> Column:
    if derive is not None:
        return derive().alias(name)
    if name in HEADER_AMOUNTS:
        return F.expr(f"try_cast({source} AS DECIMAL(18,4)) AS {name}")
    return F.expr(f"{source} AS {name}")


class Facts:
    def __init__(self, raw: RawTables, zone: str = R.STORE_ZONE):
        self.raw = raw
        self.zone = zone

    def fact(self, name: str, period: Period | None = None, columns: Collection[str] | None = None) -> DataFrame:
        """A fact by name. ``period`` and ``columns`` only narrow what is read; both may be ignored."""
        build = getattr(self, name)
        if name == "product_sales":
            return build(period)
        if name == "refunds":
            return build(period=period)
        if name in PERIOD_COLUMN:
            return build(period, columns)
        return build()

    # ---- shared stages -------------------------------------------------------

    def clean_orders(self, period: Period | None = None, columns: Collection[str] | None = None) -> DataFrame:
        """One header per valid order: rows with a store first, then the newest.

        ``columns`` names the output columns the caller needs. The chosen row travels as one value, which
        the optimizer cannot prune, so naming them keeps both the scan and the shuffle narrow. The
        tie-breakers are always read, so every caller picks the same row.
        """
        rows = self.raw.orders.where(C.valid_order()).where(created_within(period))
        made = HEADER | HEADER_AMOUNTS | HEADER_DERIVED
        wanted = [c for c in made if columns is None or c in columns or c == "order_id"]
        if period is not None and "order_date" not in wanted:
            wanted.append("order_date")
        payload = dict.fromkeys([*HEADER_RECENCY, *HEADER_TIES, "order_location_name", *[made[c] for c in wanted]])
        picked = best_row(rows.select("order_id", *[c for c in payload if c != "order_id"]), ["order_id"], **header_choice())
        out = picked.select(*self._header_columns(wanted))
        return out if period is None else out.where(period.covers("order_date"))

    def _header_columns(self, wanted: Collection[str]) -> list[Column]:
        """Columns of a header from the raw row that was chosen."""
        made = HEADER | HEADER_AMOUNTS | HEADER_DERIVED
        derive = {
            "order_date": lambda: C.business_day("order_created_at", self.zone),
            "channel": lambda: C.sales_channel("order_app_name"),
            "financial_status": lambda: F.lower("order_financial_status"),
        }
        return [_header_column(c, made[c], derive.get(c)) for c in wanted]

    def clean_lines(self, period: Period | None = None) -> DataFrame:
        """One row per (order, line) of a valid order, with the amounts of the line."""
        rows = self.raw.orders.where(C.valid_order() & C.real_line()).where(created_within(period))
        return self._pick_lines(rows, ())

    def merchandise_lines(self, period: Period | None = None, labels: Collection[str] = LINE_LABELS) -> DataFrame:
        """Same, for lines that are merchandise; the title rule acts before the choice of row."""
        rows = self.raw.orders.where(C.valid_order() & C.merchandise_line()).where(created_within(period))
        out = self._pick_lines(rows, labels).withColumns(
            {
                "order_date": C.business_day("order_created_at", self.zone),
                "channel": C.sales_channel("order_app_name"),
            }
        )
        return out if period is None else out.where(period.covers("order_date"))

    @staticmethod
    def _pick_lines(rows: DataFrame, labels: Collection[str]) -> DataFrame:
        # Values rank before labels, so leaving labels out never changes which row is picked.
        return best_row(rows.select(*LINE_KEY, "order_location_name", *LINE_RECENCY, *LINE_VALUES, *labels), LINE_KEY, **line_choice())

    @cached_property
    def unit_costs(self) -> DataFrame:
        """Cost on the newest snapshot of each product; products without one are left out, since a
        missing row and a null cost mean the same to every reader."""
        rows = self.raw.products.where("product_id IS NOT NULL").select(
            F.col("product_id").cast("string").alias("product_id"),
            "product_updated_at_datetime",
            "date",
            C.amount("product_variant_inventory_item_cost").alias("unit_cost"),
        )
        newest = best_row(rows, ["product_id"], latest=["product_updated_at_datetime", "date"])
        return newest.where("unit_cost IS NOT NULL").select("product_id", "unit_cost")

    def order_lines_total(self, period: Period | None = None) -> DataFrame:
        """Units and cost of goods per order."""
        lines = self.clean_lines(period).select(
            "order_id",
            "line_item__id",
            F.col("line_item__product_id").cast("string").alias("product_id"),
            C.amount("line_item__quantity").alias("quantity"),
            C.amount("line_item__variant_unit_cost").alias("line_cost"),
        )
        return self._line_totals(attach(lines, self.unit_costs, "product_id", spread=["order_id", "line_item__id"]))

    @staticmethod
    def _line_totals(priced: DataFrame) -> DataFrame:
        unit = F.coalesce("unit_cost", "line_cost", F.lit(0).cast(R.MONEY))
        return priced.groupBy("order_id").agg(
            F.sum("quantity").alias("total_units"),
            F.sum(F.col("quantity") * unit).cast(R.PRODUCT).alias("cogs"),
        )

    # ---- facts ---------------------------------------------------------------

    def orders(self, period: Period | None = None, columns: Collection[str] | None = None) -> DataFrame:
        """Order fact. With ``columns``, the line items are only read when a column comes from them."""
        from_lines = {"total_units", "cogs", "gross_profit", "gross_margin_pct"}
        need = None if columns is None else {*columns, "net_sales"} if from_lines & set(columns) else set(columns)
        header = self.clean_orders(period, need).drop("order_quantity", "raw_date")
        if need is not None and not from_lines & need:
            return header
        joined = header.join(self.order_lines_total(period), "order_id", "left")
        cogs = F.coalesce("cogs", F.lit(0).cast(R.PRODUCT))
        profit = F.col("net_sales") - cogs
        return joined.select(
            *header.columns,
            F.coalesce("total_units", F.lit(0).cast(R.MONEY)).alias("total_units"),
            cogs.alias("cogs"),
            profit.alias("gross_profit"),
            C.ratio(profit, F.col("net_sales")).alias("gross_margin_pct"),
        )

    def daily_sales(self, period: Period | None = None, columns: Collection[str] | None = None) -> DataFrame:
        measures = {
            **{
                c: C.rounded(F.sum(c))
                for c in ("net_sales", "total_discounts", "shipping_revenue", "gross_revenue")
            },
            "total_units": F.sum("order_quantity"),
            # order_id is unique here, so a plain count replaces the distinct one
            "aov": C.ratio(F.sum("net_sales"), F.count("order_id"), 2),
        }
        inputs = {"total_units": "order_quantity", "aov": "net_sales"}
        wanted = [c for c in measures if columns is None or c in columns]
        header = self.clean_orders(period, {*DAILY_DIMENSIONS, *[inputs.get(c, c) for c in wanted]})
        return header.groupBy(*DAILY_DIMENSIONS).agg(*[measures[c].alias(c) for c in wanted])

    def product_sales(self, period: Period | None = None, lines: DataFrame | None = None) -> DataFrame:
        """Grouped first and costed afterwards: the cost depends on the product alone, which is one of the
        grouping columns, so the join sees one row per cell instead of one per line. ``lines``: the merchandise lines, where they are
        written already."""
        qty, price = C.amount("line_item__quantity"), C.amount("line_item__price")
        line_cost = F.coalesce(C.amount("line_item__variant_unit_cost"), F.lit(0).cast(R.MONEY))
        sold = self.merchandise_lines(period) if lines is None else lines
        priced = "unit_cost" in sold.columns
        cells = (
            sold.withColumns(
                {
                    "product_id": F.col("line_item__product_id").cast("string"),
                    "sku": F.col("line_item__sku"),
                    "product_title": F.col("line_item__title"),
                    "vendor": F.col("line_item__vendor"),
                    "ship_country": F.col("order_shipping_address_country"),
                    "ship_province": F.col("order_shipping_address_province"),
                    "store_location": F.col("order_location_name"),
                }
            )
            .groupBy(*PRODUCT_DIMENSIONS)
            .agg(
                F.sum(qty).alias("units_sold"),
                F.sum(price * qty).cast(R.PRODUCT).alias("revenue"),
                F.sum(C.amount("line_item__total_discount")).alias("discounts"),
                F.sum(line_cost * qty).cast(R.PRODUCT).alias("line_cost"),
                F.sum(F.when(price.isNotNull(), qty)).cast(R.MONEY).alias("priced_units"),
                F.sum(F.when(price.isNotNull(), line_cost * qty)).cast(R.PRODUCT).alias("priced_line_cost"),
                *([F.max("unit_cost").alias("unit_cost")] if priced else []),
            )
        )
        costed = cells if priced else attach(cells, self.unit_costs, "product_id", spread=[c for c in PRODUCT_DIMENSIONS if c != "product_id"])
        known = F.col("unit_cost").isNotNull()
        units = F.col("units_sold").cast(R.MONEY)
        cost = F.when(known, (F.col("unit_cost") * units).cast(R.PRODUCT)).otherwise(F.col("line_cost"))
        against = F.when(known, (F.col("unit_cost") * F.col("priced_units")).cast(R.PRODUCT)).otherwise(
            F.col("priced_line_cost")
        )
        profit = F.col("revenue") - against
        return costed.select(
            *PRODUCT_DIMENSIONS,
            "units_sold",
            C.rounded(F.col("revenue")).alias("gross_revenue"),
            C.rounded(F.col("discounts")).alias("total_line_discounts"),
            C.rounded(cost).alias("cost"),
            C.rounded(profit).alias("gross_profit"),
            C.ratio(profit, F.col("revenue"), 1, percent=True).alias("gross_margin_pct"),
        )

    def refunded_orders(self) -> DataFrame:
        """Orders that have a refund at all; which copy of a refund row counts makes no difference here."""
        rows = self.raw.refunds.where(F.col("order_id").isNotNull() & C.meaningful_refund())
        return rows.select("order_id").distinct().withColumn("refunded", F.lit(True))

    def clean_refunds(self, period: Period | None = None, key: str = "amounts") -> DataFrame:
        """Refund lines that moved money, once per ``refund_key``.

        The row that counts has the greatest day of its key, so a lower bound on the day can go below the
        choice without changing it; an upper bound cannot.
        """
        rows = self.raw.refunds.where(F.col("order_id").isNotNull() & C.meaningful_refund())
        if period is not None and period.start is not None:
            rows = rows.where(F.col("date") >= F.lit(period.start - timedelta(days=1)))
        return best_row_by(rows, refund_key(key), latest=["date"])

    def parent_orders(self, wanted: DataFrame | None = None) -> DataFrame:
        """Order attributes a refund inherits; tests and cancelled orders count here. ``wanted`` holds the
        order ids asked for; the others are left out before any choice of row."""
        orders = self.raw.orders if wanted is None else self.raw.orders.join(wanted, "order_id", "left_semi")
        picked = best_row(orders.select("order_id", *PARENT), ["order_id"], latest=PARENT_RECENCY, prefer=[located_first()])
        return picked.select("order_id", *parent_columns())

    def refunds(
        self, refund_date_mode: str = "utc_midnight", adjustments: str = "every_line", period: Period | None = None, key: str = "amounts"
    ) -> DataFrame:
        """Refund lines with the parent order's attributes.

        ``refund_date_mode``: "utc_midnight" reads the stored day as UTC midnight and moves it to the
        store's clock (one day earlier, as the dashboards show it); "source_day" keeps the stored day.
        ``adjustments``: "every_line" counts shipping and discrepancy on each line of a refund;
        "first_line" counts them once per refund. ``key``: see ``refund_key``.
        """
        lines = self.clean_refunds(period, key).withColumn("refund_id", C.trailing_id("order_refunds"))
        shipping = C.amount("order_total_shipping_refunded_price")
        discrepancy = C.amount("order_refund_discrepancy_amount")
        if adjustments == "first_line":
            # One carrier line per refund: the smallest (subtotal, quantity), which clean-up made unique.
            refund = F.coalesce("order_refunds", F.lit("NO_REFUND"))
            rank = F.struct(
                C.amount_or_zero("line_item__refunds_subtotal").alias("s"),
                C.amount_or_zero("line_item__refunds_quantity").alias("q"),
            )
            lines = lines.withColumns({"_refund": refund, "_rank": rank})
            carrier = lines.groupBy("order_id", "_refund").agg(F.min("_rank").alias("_first"))
            lines = attach(lines, carrier, ["order_id", "_refund"], spread=["_rank"]).withColumn(
                "_carrier", F.col("_rank") == F.col("_first")
            )
            zero = F.lit(0).cast(R.MONEY)
            shipping = F.when(F.col("_carrier"), shipping).otherwise(zero)
            discrepancy = F.when(F.col("_carrier"), discrepancy).otherwise(zero)
        day = F.col("date") if refund_date_mode == "source_day" else C.local_day(F.col("date").cast("timestamp"), self.zone)
        slim = lines.select(
            day.alias("refund_date"),
            "refund_id",
            "order_id",
            "order_name",
            C.amount("line_item__refunds_quantity").alias("refunded_units"),
            C.amount("line_item__refunds_subtotal").alias("_subtotal"),
            shipping.alias("_shipping"),
            discrepancy.alias("_discrepancy"),
            C.amount("line_item__refunds_total_tax").alias("_tax"),
            "week",
            "year",
            "year_month",
        )
        if period is not None:
            slim = slim.where(period.covers("refund_date"))
        # An order has a handful of refund lines, so its id is no hot key.
        joined = slim.join(self.parent_orders(slim.select("order_id").distinct()), "order_id", "left")

        def or_zero(c):
            return F.coalesce(F.col(c), F.lit(0).cast(R.MONEY))

        return joined.select(
            "refund_date", "refund_id", "order_id", "order_name", "channel", "financial_status", "currency",
            "ship_country", "ship_province", "store_location", "refunded_units",
            C.rounded(F.col("_subtotal")).alias("refund_subtotal"),
            C.rounded(F.col("_shipping")).alias("refund_shipping"),
            C.rounded(F.col("_discrepancy")).alias("refund_discrepancy"),
            C.rounded(F.col("_tax")).alias("refund_tax"),
            C.rounded(or_zero("_subtotal") + or_zero("_discrepancy") + or_zero("_shipping")).alias("total_refunded"),
            "week", "year", "year_month",
        )

    def preferred(self) -> DataFrame:
        """Store and channel of each customer's latest order that has one."""
        return (
            self.clean_orders(columns={"order_customer_id", "store_location", "channel", "raw_date"})
            .where("order_customer_id IS NOT NULL")
            .groupBy(F.col("order_customer_id").alias("customer_id"))
            .agg(
                latest_known("store_location", "raw_date", "order_id").alias("store_location"),
                latest_known("channel", "raw_date", "order_id").alias("channel"),
            )
        )

    def latest_customers(self) -> DataFrame:
        return best_row(
            self.raw.customers.where("customer_id IS NOT NULL"), ["customer_id"], latest=["customer_updated_at", "date"]
        )

    def customers(self) -> DataFrame:
        orders = C.whole("customer_orders_count")
        return (
            self.latest_customers()
            .select(
                F.col("customer_id").cast("string").alias("customer_id"),
                F.col("customer_first_name").alias("first_name"),
                F.col("customer_last_name").alias("last_name"),
                "customer_created_at",
                "customer_updated_at",
                F.col("customer_default_address_city").alias("city"),
                F.col("customer_default_address_country").alias("country"),
                F.col("customer_default_address_country_code").alias("country_code"),
                orders.alias("orders_count"),
                C.amount("customer_total_spent").alias("total_spent"),
                C.amount("customer_aov").alias("aov"),
                C.customer_type("customer_is_returning").alias("customer_type"),
                C.purchase_segment(orders).alias("purchase_segment"),
            )
            .join(self.preferred(), "customer_id", "left")
        )

    def inventory(self, as_of=None, unknown_bucket: str | None = None) -> DataFrame:
        """Active products on their newest snapshot; with ``as_of``, the newest known on that day."""
        snapshots = self._active_snapshots()
        newest = best_row(snapshots if as_of is None else known_on(snapshots, as_of), ["product_id"], latest=SNAPSHOT_RECENCY)
        return self._stock(newest, unknown_bucket)

    def _active_snapshots(self) -> DataFrame:
        active = self.raw.products.where("product_id IS NOT NULL").where(F.lower("product_status") == "active")
        return active.select(
            F.col("product_id").cast("string").alias("product_id"),
            "product_title", "product_type", "product_vendor", "product_status", "product_tags", "date",
            "product_inventory_quantity", "product_price", "product_variant_inventory_item_cost",
            "product_created_at_datetime", "product_updated_at_datetime",
        )

    def inventory_versions(self, unknown_bucket: str | None = None) -> DataFrame:
        """Inventory rows with the days on which they were what was known of the product (``valid_from``, ``valid_to``)."""
        return self._stock(history.versions(self._active_snapshots(), ["product_id"], "date", SNAPSHOT_RECENCY), unknown_bucket, (history.FROM, history.TO))

    def daily_stock(self, period: Period, by: Collection[str] = ("aging_bucket",)) -> DataFrame:
        """Stock as known on every day of a closed period, from one pass over the snapshots."""
        measures = {
            "units_on_hand": F.col("units_on_hand"),
            "retail_value": F.col("retail_value"),
            "cost_value": F.col("cost_value"),
            "cost_excl_consignment": F.col("cost_excl_consignment"),
            "days_in_inventory": F.col("days_in_inventory").cast("bigint"),
        }
        return history.totals_by_day(self.inventory_versions(), period, list(by), measures).withColumnRenamed("n", "products")

    def _stock(self, newest: DataFrame, unknown_bucket: str | None, more: Collection[str] = ()) -> DataFrame:
        """Inventory columns from chosen snapshots and the products' attributes."""
        attributes = pivot_attributes(self.raw.metafields, R.INVENTORY_ATTRIBUTES, newest=True)
        units = C.whole("product_inventory_quantity")
        price, cost = C.amount("product_price"), C.amount("product_variant_inventory_item_cost")

        def extended(unit_value):
            return C.rounded((unit_value * units).cast(R.PRODUCT))

        age = F.datediff("date", C.day_from_text("buy_date"))
        return newest.join(attributes, "product_id", "left").select(
            "product_id", "product_title", "product_type", "product_vendor", "product_status", "product_tags",
            F.col("date").alias("snapshot_date"),
            units.alias("units_on_hand"),
            price.alias("retail_price"),
            cost.alias("unit_cost"),
            extended(price).alias("retail_value"),
            extended(cost).alias("cost_value"),
            C.owned_value(extended(cost)).alias("cost_excl_consignment"),
            "contract_type",
            C.is_consignment().alias("is_consignment"),
            "buy_date",
            "seller_name",
            C.amount("msrp").alias("msrp"),
            "condition_grade",
            C.first_quoted("location_text").alias("store_location"),
            age.alias("days_in_inventory"),
            C.bucket(age, unknown=unknown_bucket).alias("aging_bucket"),
            "product_created_at_datetime",
            "product_updated_at_datetime",
            *more,
        )

    def supplied_items(self) -> DataFrame:
        """Products with a seller, their contract, buy date, store, and the channel of the latest sale.

        Lines of other products are left out once the copy of each line that counts is known: copies can name different products,
        so leaving them out earlier could let another copy win.
        """
        attributes = pivot_attributes(self.raw.metafields, R.SELLER_ATTRIBUTES, newest=False)
        named = attributes.where("seller_name IS NOT NULL AND seller_name != ''").select(
            F.col("product_id").cast("string").alias("product_id"),
            "seller_name",
            "contract_type",
            "buy_date",
            C.first_quoted("location_text").alias("store_location"),
        )
        lines = self.merchandise_lines(labels=("order_app_name",)).select(
            F.col("line_item__product_id").cast("string").alias("product_id"), "order_date", "channel"
        )
        sold = best_row(
            lines.join(named.select("product_id"), "product_id", "left_semi"),
            ["product_id"],
            latest=["order_date"],
        ).select("product_id", "channel")
        return named.join(sold, "product_id", "left")

    def seller(self, people: bool = False) -> DataFrame:
        """Sellers with the buyer of their name, as published. With ``people``, beside it who the seller is by every key that is
        known, the recorded customer id first: ``person_id``, and how many customer ids that person has."""
        buyers = identity.consignors(self.raw.customers).select(
            "customer_id", "customer_first_name", "customer_last_name",
            C.whole("customer_orders_count").alias("buyer_orders_count"),
            C.amount("customer_total_spent").alias("buyer_total_spent"),
            C.amount("customer_aov").alias("buyer_aov"),
        )
        matched = identity.match_by_name(identity.seller_rollup(self.supplied_items()), buyers)
        out = matched.withColumn("is_also_buyer", F.col("customer_id").isNotNull())
        return self._with_people(out) if people else out

    def seller_people(self) -> DataFrame:
        """key, person_id over customers and the sellers of products: ``id:`` a customer id, ``name:`` a name in lower case."""
        recorded = pivot_attributes(self.raw.metafields, R.SELLER_IDENTITY)
        sellers = recorded.select(F.col("seller_customer_id").alias("id"), C.name_key(F.col("seller_name")).alias("name"))
        buyers = self.latest_customers().select(
            F.col("customer_id").cast("string").alias("id"), F.lower(C.full_name("customer_first_name", "customer_last_name")).alias("name")
        )
        return identity.people(sellers.unionByName(buyers), {"id": F.col("id"), "name": F.col("name")})

    def _with_people(self, sellers: DataFrame) -> DataFrame:
        people = self.seller_people()
        ids = people.where("key LIKE 'id:%'").groupBy("person_id").agg(F.count(F.lit(1)).alias("person_customers"))
        names = people.where("key LIKE 'name:%'").join(ids, "person_id", "left")
        keyed = sellers.withColumn("_key", F.concat(F.lit("name:"), C.name_key(F.col("seller_name"))))
        return attach(keyed, names.withColumnRenamed("key", "_key"), "_key", spread=["contract_type", "store_location", "channel"]).drop("_key")

    def marketing(self) -> DataFrame:
        common = ["date", "campaign_id", "campaign_name", "ad_group_id", "ad_group_name", "ad_id", "ad_name"]
        meta = (
            self.raw.meta_ads.withColumnsRenamed({"adset_id": "ad_group_id", "adset_name": "ad_group_name"})
            .select(
                F.lit("Meta").alias("source"), *common,
                F.col("spend").cast(R.MONEY).alias("spend"),
                F.col("impressions").cast("bigint").alias("impressions"),
                F.col("clicks").cast("bigint").alias("clicks"),
                F.col("reach").cast("bigint").alias("reach"),
                F.col("purchases").cast("bigint").alias("conversions"),
                F.col("purchase_value").cast(R.MONEY).alias("conversion_value"),
                F.col("purchase_roas").cast(R.MONEY).alias("roas"),
                "account_currency",
            )
        )
        google = self.raw.google_ads.select(
            F.lit("Google").alias("source"), *common,
            F.col("spend").cast(R.MONEY).alias("spend"),
            F.col("impressions").cast("bigint").alias("impressions"),
            F.col("clicks").cast("bigint").alias("clicks"),
            F.lit(None).cast("bigint").alias("reach"),
            C.whole("conversions").alias("conversions"),
            F.col("conversion_value").cast(R.MONEY).alias("conversion_value"),
            C.amount("roas").alias("roas"),
            "account_currency",
        )
        return meta.unionByName(google)

    def email_campaigns(self) -> DataFrame:
        headers = best_row(
            self.raw.email_campaigns.select("campaign_id", "campaign_name", "send_time", "status"),
            ["campaign_id"],
            latest=["send_time"],
        )
        newest = best_row(self.raw.email_metrics.drop("campaign_name"), ["campaign_id"], latest=["date"])
        return newest.join(headers, "campaign_id", "left").select(
            "campaign_id",
            "campaign_name",
            "send_time",
            F.col("status").alias("campaign_status"),
            C.whole("sends").alias("recipients"),
            C.whole("unique_opens").alias("unique_opens"),
            C.whole("unique_clicks").alias("unique_clicks"),
            C.amount("open_rate").alias("open_rate"),
            C.amount("click_rate").alias("click_rate"),
            C.whole("unsubscribes").alias("unsubscribes"),
            C.amount("revenue").alias("revenue"),
            F.col("date").alias("synced_date"),
        )


FACT_NAMES = (
    "orders", "daily_sales", "product_sales", "refunds", "customers",
    "inventory", "seller", "marketing", "email_campaigns",
)
PERIOD_COLUMN = {
    "orders": "order_date", "daily_sales": "order_date", "product_sales": "order_date", "refunds": "refund_date",
}
