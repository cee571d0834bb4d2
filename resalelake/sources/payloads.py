"""Landed API payloads to rows under the raw contracts.

Payloads arrive as JSON text (one document per row) or as already parsed structs. Arrays are opened with
``explode_outer``, so a document without children still yields its row; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resalelake.functions import columns as C
from resalelake.functions import rules as R
from resalelake.operators.dedup import best_row
from resalelake.operators.joins import attach
from resalelake.sources.contracts import conform

PAYLOAD_DDL = {
    "order": """id string, name string, created_at string, updated_at string, processed_at string, source_name string,
        currency string, financial_status string, test boolean, subtotal_price string, total_price string,
        total_discounts string, total_tax string, location_id string, customer struct<id: string>,
        shipping_address struct<country: string, province: string>, shipping_lines array<struct<price: string>>,
        line_items array<struct<id: string, price: string, product_id: string, quantity: bigint, sku: string,
            title: string, total_discount: string, vendor: string>>""",
    "refund": """id string, name string, refunds array<struct<id: string, created_at: string,
        order_adjustments: array<struct<kind: string, amount: string>>,
        refund_line_items: array<struct<id: string, quantity: bigint, subtotal: string, total_tax: string>>>>""",
    "customer": """id string, first_name string, last_name string, created_at string, updated_at string, currency string,
        orders_count bigint, total_spent string, tags string, note string,
        default_address struct<city: string, country: string, country_code: string>""",
    "product": """id string, title string, body_html string, handle string, status string, tags string, product_type string,
        vendor string, created_at string, updated_at string, images array<struct<src: string>>,
        variants array<struct<price: string, inventory_quantity: bigint, inventory_item_id: string>>""",
    "inventory_item": "id string, cost string",
    "metafields": """id string, title string, metafields array<struct<key: string, namespace: string, type: string,
        updated_at: string, value: string>>""",
    "ad_insight": """date_start string, campaign_id string, campaign_name string, adset_id string, adset_name string,
        ad_id string, ad_name string, spend string, impressions string, clicks string, reach string, account_currency string,
        actions array<struct<action_type: string, value: string>>,
        action_values array<struct<action_type: string, value: string>>""",
    "cost_report": """position bigint, date string, campaign_id string, campaign_name string, clicks string,
        cost_micros string, impressions string, conversions string, conversions_value string""",
}

_CAMPAIGN = """array<struct<id: string, attributes: struct<name: string, status: string, archived: boolean,
    send_strategy: struct<options_static: struct<datetime: string>>, send_time: string, created_at: string,
    updated_at: string>>>"""
_LIST = "array<struct<id: string, attributes: struct<name: string, created: string, updated: string>>>"
_MESSAGE = """array<struct<id: string, attributes: struct<content: struct<subject: string, from_email: string,
    from_label: string>>, relationships: struct<campaign: struct<data: struct<id: string>>>>>"""
_REPORT = """array<struct<groupings: struct<campaign_id: string>, statistics: struct<recipients: string, opens: string,
    opens_unique: string, open_rate: string, clicks: string, clicks_unique: string, click_rate: string,
    unsubscribes: string, conversions: string, conversion_value: string>>>"""


def payload_schema(kind: str) -> T.StructType:
    return T.StructType.fromDDL(PAYLOAD_DDL[kind])


#: Kinds whose documents have an id, without which they cannot be landed.
IDENTIFIED = ("order", "refund", "customer", "product", "inventory_item", "metafields")

_MARK = "_end_of_text"


def opened(texts: DataFrame, kind: str, text: str = "body") -> DataFrame:
    """Add ``document`` and ``reason``: null where the text is one whole JSON object that has an id, otherwise why it cannot
    be landed. Single fields of another type than declared are null, as anywhere else."""
    # The parser stops where the first value ends. In a list whose last element is a mark, a text that is more or less than one
    # value breaks the list, ends it before the mark or moves the mark.
    schema = T.StructType([*payload_schema(kind).fields, T.StructField(_MARK, T.BooleanType())])
    found = F.from_json(F.concat(F.lit("["), F.col(text), F.lit(f',{{"{_MARK}":true}}]')), T.ArrayType(schema))
    marked = F.get("_found", F.lit(1))[_MARK]
    whole = (F.size("_found") == 2) & marked & F.col("document").isNotNull() & F.ltrim(F.col(text)).startswith("{")
    unnamed = C.blank_to_null("document.id").isNull() if kind in IDENTIFIED else F.lit(False)
    reason = F.when(~F.coalesce(whole, F.lit(False)), "malformed").when(unnamed, "no id")
    return texts.withColumn("_found", found).withColumn("document", F.get("_found", F.lit(0))).withColumn("reason", reason).drop("_found")


def read_landing(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Readable documents of a JSON-lines landing folder under the payload's declared schema. The others are not rows;
    ``landing.land`` keeps them."""
    return parse(spark.read.text(path).where("trim(value) <> ''"), kind, "value")


def parse(texts: DataFrame, kind: str, text: str = "body") -> DataFrame:
    """Payload columns out of a text column, of readable documents."""
    return opened(texts, kind, text).where("reason IS NULL").select("document.*").drop(_MARK)


def _day_part(c: str | Column, fallback: date | None = None) -> Column:
    """Date part of ISO text, as written (no zone shift)."""
    day = F.split(C.col(c), "T")[0].try_cast("date")
    return day if fallback is None else F.coalesce(day, F.lit(fallback))


def _count(c: str | Column) -> Column:
    """Whole part of a number held as text, 0 when unreadable."""
    return F.coalesce(C.amount(c).cast("bigint"), F.lit(0).cast("bigint"))


def _cents(c: Column) -> Column:
    return F.round(c, 2).cast(R.MONEY)


def _quotient(a: Column, b: Column) -> Column:
    """Two-decimal quotient, 0 when the divisor is not positive."""
    return F.when(b > 0, F.round(F.try_divide(a.cast("double"), b.cast("double")).cast(R.RATIO), 2)).otherwise(0).cast(R.MONEY)


def _periods(day: Column) -> dict[str, Column]:
    return {
        "week": C.iso_week_text(day),
        "year": F.year(day).cast("string"),
        "year_month": C.year_month_text(day),
    }


def flatten_orders(orders: DataFrame, account: str, run_day: date, source: str = "shop") -> DataFrame:
    """One row per line item; an order without lines keeps one row with empty line columns."""
    day = _day_part("created_at", run_day)
    zero = F.lit(0).cast("bigint")
    quantity = F.aggregate(
        F.coalesce("line_items", F.array()), zero, lambda acc, li: acc + F.coalesce(li["quantity"], zero)
    )
    rows = orders.select("*", F.explode_outer("line_items").alias("li"))
    has_line = F.col("li").isNotNull()

    def line(value: Column) -> Column:
        return F.when(has_line, value)

    return conform(
        rows.select(
            F.lit(account).alias("account_name"),
            day.alias("date"),
            C.month_text(day).alias("month"),
            *[c.alias(name) for name, c in _periods(day).items()],
            C.source_app("source_name").alias("order_app_name"),
            C.text_or_blank("created_at").alias("order_created_at"),
            C.text_or_blank("currency").alias("order_currency"),
            F.upper(C.text_or_blank("financial_status")).alias("order_financial_status"),
            C.text_or_blank("id").alias("order_id"),
            C.text_or_blank("name").alias("order_name"),
            C.amount_or_zero("subtotal_price").alias("order_net_sales"),
            F.col("processed_at").alias("order_processed_at"),
            quantity.alias("order_quantity"),
            F.col("shipping_address.country").alias("order_shipping_address_country"),
            F.col("shipping_address.province").alias("order_shipping_address_province"),
            C.amount_or_zero(F.get("shipping_lines", 0)["price"]).alias("order_shipping_price"),
            C.amount_or_zero("subtotal_price").alias("order_subtotal_price"),
            C.true_false_text(F.col("test")).alias("order_test"),
            C.amount_or_zero("total_discounts").alias("order_total_discounts"),
            C.amount_or_zero("total_price").alias("order_total_price"),
            F.lit(source).alias("source"),
            C.amount_or_zero("total_tax").alias("order_total_tax_amount"),
            C.blank_to_null("location_id").alias("order_location_id"),
            C.store_name("location_id").alias("order_location_name"),
            C.blank_to_null("customer.id").alias("order_customer_id"),
            line(C.text_or_blank("li.id")).alias("line_item__id"),
            line(C.amount_or_zero("li.price")).alias("line_item__price"),
            line(C.text_or_blank("li.product_id")).alias("line_item__product_id"),
            line(F.coalesce("li.quantity", zero)).alias("line_item__quantity"),
            line(C.text_or_blank("li.sku")).alias("line_item__sku"),
            line(C.text_or_blank("li.title")).alias("line_item__title"),
            line(C.amount_or_zero("li.total_discount")).alias("line_item__total_discount"),
            line(C.text_or_blank("li.vendor")).alias("line_item__vendor"),
            F.lit(run_day).alias("ingested_at"),
        ),
        "orders",
    )


def _adjustment(kind: str) -> Column:
    hits = F.filter(F.coalesce("refund.order_adjustments", F.array()), lambda a: a["kind"] == kind)
    return C.amount_or_zero(F.get(hits, 0)["amount"])


def flatten_refunds(
    orders: DataFrame, account: str, run_day: date, source: str = "shop", id_prefix: str = "gid://shopify/Refund/"
) -> DataFrame:
    """One row per refund line; a refund without lines keeps one row. Adjustments repeat on every line."""
    opened = orders.select("id", "name", F.explode("refunds").alias("refund")).select(
        "*", F.explode_outer("refund.refund_line_items").alias("li")
    )
    day = _day_part("refund.created_at", run_day)
    has_line = F.col("li").isNotNull()
    quantity = F.coalesce("li.quantity", F.lit(0).cast("bigint"))
    return conform(
        opened.select(
            day.alias("date"),
            F.lit(account).alias("account_name"),
            C.text_or_blank("id").alias("order_id"),
            C.text_or_blank("name").alias("order_name"),
            F.lit(source).alias("source"),
            F.concat(F.lit(id_prefix), "refund.id").alias("order_refunds"),
            _adjustment("refund_discrepancy").alias("order_refund_discrepancy_amount"),
            _adjustment("shipping_refund").alias("order_total_shipping_refunded_price"),
            C.blank_to_null("li.id").alias("line_item__refunds"),
            F.when(has_line, quantity).alias("line_item__refundable_quantity"),
            F.when(has_line, C.amount_or_zero("li.subtotal")).alias("line_item__refunds_price"),
            F.when(has_line, quantity).alias("line_item__refunds_quantity"),
            F.when(has_line, C.amount_or_zero("li.subtotal")).alias("line_item__refunds_subtotal"),
            F.when(has_line, C.amount_or_zero("li.total_tax")).alias("line_item__refunds_total_tax"),
            *[c.alias(name) for name, c in _periods(day).items()],
        ),
        "refunds",
    )


def flatten_customers(customers: DataFrame, run_day: date) -> DataFrame:
    count = F.coalesce("orders_count", F.lit(0).cast("bigint"))
    spent = C.amount_or_zero("total_spent")
    return conform(
        customers.select(
            F.lit(run_day).alias("date"),
            C.text_or_blank("id").alias("customer_id"),
            C.text_or_blank("first_name").alias("customer_first_name"),
            C.text_or_blank("last_name").alias("customer_last_name"),
            C.text_or_blank("created_at").alias("customer_created_at"),
            C.text_or_blank("updated_at").alias("customer_updated_at"),
            C.text_or_blank("currency").alias("customer_currency"),
            C.text_or_blank("default_address.city").alias("customer_default_address_city"),
            C.text_or_blank("default_address.country").alias("customer_default_address_country"),
            C.text_or_blank("default_address.country_code").alias("customer_default_address_country_code"),
            count.alias("customer_orders_count"),
            _cents(spent).alias("customer_total_spent"),
            _quotient(spent, count).alias("customer_aov"),
            C.true_false_text(count > 1).alias("customer_is_returning"),
            C.text_or_blank("tags").alias("customer_tags"),
            C.text_or_blank("note").alias("customer_note"),
        ),
        "customers",
    )


def flatten_products(products: DataFrame, run_day: date, costs: DataFrame | None = None) -> DataFrame:
    """First variant's price, stock over all variants, first image. ``costs`` holds inventory items
    (id, cost); the item of the first variant supplies the cost, missing stays null."""
    zero = F.lit(0).cast("bigint")
    first = F.get("variants", 0)
    stock = F.aggregate(
        F.coalesce("variants", F.array()), zero, lambda acc, v: acc + F.coalesce(v["inventory_quantity"], zero)
    )
    rows = products.withColumn("item_id", C.blank_to_null(first["inventory_item_id"]))
    if costs is not None:
        known = costs.where("cost IS NOT NULL").groupBy(F.col("id").alias("item_id")).agg(F.max(C.amount("cost")).alias("item_cost"))
        rows = attach(rows, known, "item_id", spread=["id"])
    else:
        rows = rows.withColumn("item_cost", F.lit(None).cast(R.MONEY))
    return conform(
        rows.select(
            F.lit(run_day).alias("date"),
            C.text_or_blank("id").alias("product_id"),
            C.text_or_blank("title").alias("product_title"),
            C.text_or_blank("body_html").alias("product_description"),
            C.text_or_blank("handle").alias("product_handle"),
            C.text_or_blank(F.get("images", 0)["src"]).alias("product_image_src"),
            stock.alias("product_inventory_quantity"),
            _cents(C.amount_or_zero(first["price"])).alias("product_price"),
            F.upper(C.text_or_blank("status")).alias("product_status"),
            C.text_or_blank("tags").alias("product_tags"),
            C.text_or_blank("product_type").alias("product_type"),
            C.text_or_blank("created_at").alias("product_created_at_datetime"),
            C.text_or_blank("updated_at").alias("product_updated_at_datetime"),
            _cents(F.col("item_cost")).alias("product_variant_inventory_item_cost"),
            C.text_or_blank("vendor").alias("product_vendor"),
        ),
        "products",
    )


def flatten_metafields(products: DataFrame, run_day: date) -> DataFrame:
    rows = products.select("id", "title", F.explode("metafields").alias("m"))
    return conform(
        rows.select(
            F.lit(run_day).alias("date"),
            C.text_or_blank("id").alias("product_id"),
            C.text_or_blank("title").alias("product_title"),
            C.text_or_blank("m.key").alias("product_metafield_key"),
            C.text_or_blank("m.namespace").alias("product_metafield_namespace"),
            C.text_or_blank("m.type").alias("product_metafield_type"),
            F.col("m.updated_at").alias("product_metafield_update_at"),
            F.col("m.value").cast("string").alias("product_metafield_value"),
        ),
        "metafields",
    )


def _purchase(actions: str) -> Column:
    hits = F.filter(F.coalesce(actions, F.array()), lambda a: a["action_type"] == "purchase")
    return F.get(hits, 0)["value"]


def flatten_ad_insights(insights: DataFrame, synced_at: datetime, currency: str = "CAD") -> DataFrame:
    spend = C.amount_or_zero("spend")
    value = C.amount_or_zero(_purchase("action_values"))
    names = ("campaign_id", "campaign_name", "adset_id", "adset_name", "ad_id", "ad_name")
    return conform(
        insights.select(
            F.col("date_start").try_cast("date").alias("date"),
            *[C.text_or_blank(c).alias(c) for c in names],
            spend.alias("spend"),
            _count("impressions").alias("impressions"),
            _count("clicks").alias("clicks"),
            _count("reach").alias("reach"),
            _count(_purchase("actions")).alias("purchases"),
            value.alias("purchase_value"),
            _quotient(value, spend).alias("purchase_roas"),
            F.coalesce("account_currency", F.lit(currency)).alias("account_currency"),
            F.lit(synced_at).alias("synced_at"),
        ),
        "meta_ads",
    )


def flatten_cost_report(report: DataFrame, synced_at: datetime, currency: str = "CAD") -> DataFrame:
    """Campaign rows of a cost report; of repeated rows for a campaign and day the last one counts."""
    last = best_row(report, ["date", "campaign_id"], latest=["position"])
    cost = C.amount_or_zero("cost_micros").cast("decimal(28,10)") / F.lit(1000000)
    value = _cents(C.amount_or_zero("conversions_value"))
    blank = F.lit("")
    return conform(
        last.select(
            F.col("date").try_cast("date").alias("date"),
            "campaign_id",
            "campaign_name",
            *[blank.alias(c) for c in ("ad_group_id", "ad_group_name", "ad_id", "ad_name")],
            _cents(cost).alias("spend"),
            _count("impressions").alias("impressions"),
            _count("clicks").alias("clicks"),
            _cents(C.amount_or_zero("conversions")).alias("conversions"),
            value.alias("conversion_value"),
            _quotient(value, cost).alias("roas"),
            F.lit(currency).alias("account_currency"),
            F.lit(synced_at).alias("synced_at"),
        ),
        "google_ads",
    )


def _documents(responses: DataFrame, schema: str, text: str) -> DataFrame:
    """Elements of a response whose ``data`` is a list, one object, or text holding either."""
    body = F.coalesce(F.get_json_object(text, "$.data"), F.col(text))
    inner = F.coalesce(F.get_json_object(body, "$.data"), body)
    return responses.select(F.explode(F.from_json(inner, schema)).alias("d")).where(
        C.blank_to_null("d.id").isNotNull()
    )


def flatten_email_campaigns(responses: DataFrame, synced_at: datetime, text: str = "body") -> DataFrame:
    a = "d.attributes."
    return conform(
        _documents(responses, _CAMPAIGN, text).select(
            F.col("d.id").alias("campaign_id"),
            C.text_or_blank(a + "name").alias("campaign_name"),
            C.text_or_blank(a + "status").alias("status"),
            F.coalesce(a + "archived", F.lit(False)).alias("archived"),
            F.coalesce(C.blank_to_null(a + "send_strategy.options_static.datetime"), C.blank_to_null(a + "send_time")).alias("send_time"),
            F.col(a + "created_at").alias("created_at"),
            F.col(a + "updated_at").alias("updated_at"),
            F.lit(synced_at).alias("synced_at"),
        ),
        "email_campaigns",
    )


def flatten_email_lists(responses: DataFrame, run_day: date, synced_at: datetime, text: str = "body") -> DataFrame:
    return conform(
        _documents(responses, _LIST, text).select(
            F.lit(run_day).alias("date"),
            F.col("d.id").alias("list_id"),
            C.text_or_blank("d.attributes.name").alias("list_name"),
            F.col("d.attributes.created").alias("created"),
            F.col("d.attributes.updated").alias("updated"),
            F.lit(synced_at).alias("synced_at"),
        ),
        "email_lists",
    )


def flatten_email_messages(responses: DataFrame, synced_at: datetime, text: str = "body") -> DataFrame:
    content = "d.attributes.content."
    return conform(
        _documents(responses, _MESSAGE, text).select(
            F.col("d.id").alias("message_id"),
            C.text_or_blank("d.relationships.campaign.data.id").alias("campaign_id"),
            C.text_or_blank(content + "subject").alias("subject_line"),
            C.text_or_blank(content + "from_email").alias("from_email"),
            C.text_or_blank(content + "from_label").alias("from_label"),
            F.lit(synced_at).alias("synced_at"),
        ),
        "email_messages",
    )


def flatten_email_report(responses: DataFrame, run_day: date, synced_at: datetime, text: str = "body") -> DataFrame:
    """Rows of a campaign report. The list of results sits at one of three depths, and the whole
    document may itself be text inside ``data``."""
    paths = ("$.data.attributes.results", "$.attributes.results", "$.results")
    inner = F.get_json_object(text, "$.data")
    found = F.coalesce(*[F.get_json_object(src, p) for src in (F.col(text), inner) for p in paths])
    rows = responses.select(F.explode(F.from_json(found, _REPORT)).alias("r"))
    s = "r.statistics."
    none: Mapping[str, Column] = {"deliveries": F.lit(0), "bounces": F.lit(0), "campaign_name": F.lit("")}
    return conform(
        rows.select(
            F.lit(run_day).alias("date"),
            C.text_or_blank("r.groupings.campaign_id").alias("campaign_id"),
            _count(s + "recipients").alias("sends"),
            _count(s + "opens").alias("opens"),
            _count(s + "opens_unique").alias("unique_opens"),
            C.amount_or_zero(s + "open_rate").alias("open_rate"),
            _count(s + "clicks").alias("clicks"),
            _count(s + "clicks_unique").alias("unique_clicks"),
            C.amount_or_zero(s + "click_rate").alias("click_rate"),
            _count(s + "unsubscribes").alias("unsubscribes"),
            C.amount_or_zero(s + "conversion_value").alias("revenue"),
            _count(s + "conversions").alias("conversions"),
            *[c.alias(name) for name, c in none.items()],
            F.lit(synced_at).alias("synced_at"),
        ),
        "email_metrics",
    )
