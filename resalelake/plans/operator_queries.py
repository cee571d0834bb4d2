"""One registered query per operator, each over whole tables derived from the driver tables."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resalelake.functions import columns as C
from resalelake.functions import rules as R
from resalelake.operators import aggregate as A
from resalelake.operators import distinct, history, identity
from resalelake.operators import periods as P
from resalelake.operators.dedup import best_row, best_row_by, located_first
from resalelake.operators.filters import Filters
from resalelake.operators.joins import attach, hot_keys, match_or_keep
from resalelake.operators.reshape import pivot_attributes
from resalelake.plans import incremental, lattice, ledger, metrics, quality, warehouse
from resalelake.plans.facts import Facts, to_edge
from resalelake.session import released, shared_folder
from resalelake.sources import contracts, landing, payloads, sinks
from resalelake.sources.driver_tables import AS_OF, DriverTables
from resalelake.sources.raw import RawTables
from resalelake.streaming import changes, jobs

RUN_DAY = date(2001, 7, 16)
SYNCED = datetime(2001, 7, 16, 13, 0, tzinfo=timezone.utc)
JULY = P.this_month(AS_OF)
#: Every year an order can have.
YEARS = range(1995, 2002)


class Context:
    def __init__(self, spark: SparkSession, folder: str):
        self.tables = DriverTables(spark, folder)
        self.spark = self.tables.spark
        self.raw = self.tables.raw()
        self.facts = Facts(self.raw)

    def folder(self, label: str) -> str:
        return shared_folder(self.spark, label)

    def headers(self) -> DataFrame:
        """Order headers as ingested, before any choice of row (repeats included, lines left out)."""
        columns = [c for c in self.raw.orders.columns if not c.startswith("line_item__") and c != "order_quantity"]
        return self.raw.orders.select(*columns).distinct()


QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- sources -----------------------------------------------------------------

def _scan(table: str, columns: tuple[str, ...]):
    return lambda x: to_edge(getattr(x.raw, table).select(*columns))


SCANS = {
    "orders": ("order_id", "date", "ingested_at", "order_created_at", "order_processed_at", "order_app_name", "order_financial_status",
               "order_test", "order_net_sales", "order_total_price", "order_total_discounts", "order_shipping_price",
               "order_total_tax_amount", "order_quantity", "order_shipping_address_country", "order_shipping_address_province",
               "order_location_id", "order_location_name", "order_customer_id", "order_customer_last_visit_utm_source", "month",
               "week", "year", "year_month", "line_item__id", "line_item__product_id", "line_item__title", "line_item__sku",
               "line_item__vendor", "line_item__quantity", "line_item__price", "line_item__total_discount"),
    "products": ("date", "product_id", "product_title", "product_type", "product_vendor", "product_status", "product_tags",
                 "product_inventory_quantity", "product_price", "product_variant_inventory_item_cost", "product_updated_at_datetime"),
    "metafields": ("date", "product_id", "product_metafield_namespace", "product_metafield_key", "product_metafield_update_at",
                   "product_metafield_value"),
    "customers": ("date", "customer_id", "customer_first_name", "customer_last_name", "customer_created_at", "customer_updated_at",
                  "customer_default_address_country", "customer_orders_count", "customer_total_spent", "customer_aov",
                  "customer_is_returning", "customer_tags"),
    "refunds": ("date", "order_id", "order_refunds", "order_refund_discrepancy_amount", "order_total_shipping_refunded_price",
                "line_item__refunds_quantity", "line_item__refunds_subtotal", "line_item__refunds_total_tax", "week", "year", "year_month"),
    "meta_ads": ("date", "campaign_id", "adset_id", "ad_id", "ad_name", "spend", "impressions", "clicks", "reach", "purchases",
                 "purchase_value", "purchase_roas"),
    "google_ads": ("date", "campaign_id", "spend", "impressions", "clicks", "conversions", "conversion_value", "roas"),
    "email_campaigns": ("campaign_id", "campaign_name", "status", "send_time"),
    "email_metrics": ("date", "campaign_id", "sends", "unique_opens", "unique_clicks", "open_rate", "click_rate", "unsubscribes"),
    "email_lists": ("date", "list_id", "list_name", "created"),
    "email_messages": ("message_id", "campaign_id", "subject_line", "from_email", "from_label"),
}
QUERIES |= {f"s1_raw_{table}": _scan(table, columns) for table, columns in SCANS.items()}


def _documents(df: DataFrame, kind: str, **columns: str) -> DataFrame:
    """Rows as parsed documents under the payload's declared schema; fields not given are null."""
    fields = payloads.payload_schema(kind).fields
    return df.selectExpr(*[f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])


def order_payloads(x: Context) -> DataFrame:
    """One order document per line item; every third carries a wrapping line too, some have no lines."""
    joined = x.tables.table("orders").join(x.tables.table("lineitem"), F.expr("o_orderkey = l_orderkey"), "left")
    line = """named_struct('id', concat(l_orderkey, '-', l_linenumber), 'price', CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS STRING),
        'product_id', CAST(l_partkey AS STRING), 'quantity', CAST(l_quantity AS BIGINT), 'sku', concat('SKU-', l_partkey),
        'title', concat('Item ', l_partkey), 'total_discount', CAST(CAST(l_discount AS DECIMAL(18,4)) AS STRING), 'vendor', CAST(NULL AS STRING))"""
    wrap = """named_struct('id', concat(l_orderkey, '-', l_linenumber, '-w'), 'price', 'free', 'product_id', CAST(NULL AS STRING),
        'quantity', CAST(NULL AS BIGINT), 'sku', CAST(NULL AS STRING), 'title', 'Paper Bag', 'total_discount', CAST(NULL AS STRING),
        'vendor', 'house')"""
    return _documents(
        joined,
        "order",
        id="o_orderkey",
        name="concat('#', o_orderkey)",
        created_at="concat(CAST(o_orderdate AS DATE), 'T', lpad(o_orderkey % 24, 2, '0'), ':15:00-07:00')",
        updated_at="concat(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INT), 'T12:00:00Z')",
        source_name="CASE o_orderkey % 7 WHEN 0 THEN 'web' WHEN 1 THEN 'pos' WHEN 2 THEN 'mobile' WHEN 3 THEN 'shopify_draft_order' "
        "WHEN 4 THEN 'iphone' WHEN 5 THEN '3890849' END",
        financial_status="CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'paid' END",
        test="o_orderkey % 89 = 0",
        subtotal_price="CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS STRING)",
        total_tax="CASE WHEN o_orderkey % 4 = 0 THEN 'none' ELSE '1.25' END",
        location_id="CASE o_orderkey % 4 WHEN 0 THEN '61826072689' WHEN 1 THEN '42702532' WHEN 2 THEN '7' END",
        customer="CASE WHEN o_orderkey % 11 > 0 THEN named_struct('id', o_custkey) END",
        shipping_address="CASE WHEN o_custkey % 3 > 0 THEN named_struct('country', 'Canada', 'province', 'Ontario') END",
        shipping_lines="CASE WHEN o_orderkey % 2 = 0 THEN array(named_struct('price', '9.5'), named_struct('price', '100')) END",
        line_items=f"CASE WHEN l_orderkey IS NULL THEN NULL WHEN l_linenumber % 3 = 0 THEN array({line}, {wrap}) ELSE array({line}) END",
    )


@query
def s2_quarantine(x: Context) -> DataFrame:
    """Order documents as JSON lines, some cut off and some without id: the readable ones landed, the others kept with their
    place, those that a closing brace mends landed by a replay."""
    box, path = x.folder("letters"), x.folder("documents")
    orders = x.tables.table("orders")
    document = F.to_json(F.struct(
        F.when(F.expr("o_orderkey % 11 <> 0"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_totalprice").cast("decimal(18,4)").cast("string").alias("subtotal_price"),
        F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T12:00:00Z")).alias("created_at"),
    ))
    cut = F.expr("CASE WHEN o_orderkey % 7 = 0 THEN substring(doc, 1, length(doc) - 1) WHEN o_orderkey % 13 = 0 THEN concat(doc, ' and more') ELSE doc END")
    orders.withColumn("doc", document).select(cut.alias("value")).write.text(path)
    landed = landing.land(x.spark, "order", path, box)
    mended = landing.replay(x.spark, "order", box, "concat(body, '}')")
    parts = []
    for state, documents in (("landed", landed), ("replayed", mended)):
        rows = payloads.flatten_orders(documents, "fixture-store", RUN_DAY)
        key, value = F.col("order_id").cast("bigint"), F.col("order_net_sales").try_cast(R.MONEY)
        parts.append(rows.select(F.lit(state).alias("state"), key.alias("order_key"), value.alias("value"), F.lit(0).alias("no_line")))
    letters = landing.open_letters(x.spark, box)
    key = F.regexp_extract("body", "#([0-9]+)", 1).cast("bigint")
    no_line = F.when((F.col("line") >= 1) & F.col("file").isNotNull(), 0).otherwise(1)
    parts.append(letters.select(F.col("reason").alias("state"), key.alias("order_key"), F.lit(None).cast(R.MONEY).alias("value"), no_line.alias("no_line")))
    every = reduce(DataFrame.unionByName, parts).groupBy("state")
    return to_edge(every.agg(F.count(F.lit(1)).alias("documents"), F.sum("order_key").alias("order_keys"), F.sum("value").alias("value"), F.sum("no_line").alias("no_line")))


@query
def s2_flatten_orders(x: Context) -> DataFrame:
    flat = payloads.flatten_orders(order_payloads(x), "fixture-store", RUN_DAY)
    return to_edge(flat.drop("account_name", "source", "order_currency", "line_item__variant_unit_cost",
                             "order_customer_last_visit_utm_campaign", "order_customer_last_visit_utm_medium",
                             "order_customer_last_visit_utm_source"))


@query
def s2_flatten_landed_json(x: Context) -> DataFrame:
    """The same documents written to a landing folder as JSON lines, read back and flattened."""
    path = x.folder("landing")
    order_payloads(x).write.json(path, compression="gzip")
    flat = payloads.flatten_orders(payloads.read_landing(x.spark, "order", path), "fixture-store", RUN_DAY)
    return flat.groupBy("order_app_name", "order_location_name").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("order_id").alias("orders"), F.max("line_item__id").alias("last_line"))


@query
def s3_flatten_refunds(x: Context) -> DataFrame:
    line = "named_struct('id', concat(l_orderkey, '-', l_linenumber), 'quantity', CAST(l_quantity AS BIGINT), 'subtotal', CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS STRING), 'total_tax', '0.5')"
    other = "named_struct('id', '', 'quantity', CAST(NULL AS BIGINT), 'subtotal', 'n/a', 'total_tax', CAST(NULL AS STRING))"
    adjustments = "array(named_struct('kind', 'other', 'amount', '7'), named_struct('kind', 'shipping_refund', 'amount', '9.99'))"
    both = f"concat({adjustments}, array(named_struct('kind', 'refund_discrepancy', 'amount', '-1.5')))"
    docs = _documents(
        x.tables.table("lineitem").where("l_returnflag = 'R'"),
        "refund",
        id="l_orderkey",
        name="concat('#', l_orderkey)",
        refunds=f"""array(named_struct('id', l_orderkey * 10 + l_linenumber, 'created_at', concat(CAST(l_shipdate AS DATE), 'T03:00:00Z'),
            'order_adjustments', CASE l_orderkey % 3 WHEN 0 THEN {both} WHEN 1 THEN {adjustments} END,
            'refund_line_items', CASE l_linenumber % 3 WHEN 0 THEN array({line}, {other}) WHEN 1 THEN array({line}) END))""",
    )
    flat = payloads.flatten_refunds(docs, "fixture-store", RUN_DAY, id_prefix="gid://fixture/Refund/")
    return to_edge(flat.drop("account_name", "source", "line_item__refunds", "order_name"))


@query
def s4_flatten_customers(x: Context) -> DataFrame:
    docs = _documents(
        x.tables.table("customer"),
        "customer",
        id="c_custkey",
        first_name="CASE WHEN c_custkey % 7 > 0 THEN 'Customer' END",
        last_name="c_name",
        created_at="'2001-01-01T00:00:00Z'",
        orders_count="CASE WHEN c_custkey % 6 < 5 THEN c_custkey % 6 END",
        total_spent="CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE CAST(CAST(abs(c_acctbal) AS DECIMAL(18,4)) AS STRING) END",
        tags="c_mktsegment",
        note="CASE WHEN c_custkey % 4 = 0 THEN 'likes blue' END",
        default_address="CASE WHEN c_custkey % 3 > 0 THEN named_struct('city', concat('City ', c_nationkey), 'country', 'Canada', 'country_code', 'CA') END",
    )
    return to_edge(payloads.flatten_customers(docs, RUN_DAY))


def product_payloads(x: Context, kind: str = "product") -> DataFrame:
    first = "named_struct('price', CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS STRING), 'inventory_quantity', p_partkey % 4, 'inventory_item_id', p_partkey * 10)"
    second = "named_struct('price', '1', 'inventory_quantity', 2, 'inventory_item_id', p_partkey * 10 + 1)"
    return _documents(
        x.tables.table("part"),
        kind,
        id="p_partkey",
        title="p_name",
        status="CASE WHEN p_partkey % 13 = 0 THEN 'archived' ELSE 'active' END",
        tags="concat('size-', p_size)",
        product_type="p_type",
        vendor="p_brand",
        updated_at="'2001-07-14T10:00:00Z'",
        images="CASE WHEN p_partkey % 2 = 0 THEN array(named_struct('src', concat('img/', p_partkey)), named_struct('src', 'b')) END",
        variants=f"CASE p_partkey % 3 WHEN 0 THEN array({first}, {second}) WHEN 1 THEN array({first}) END",
        metafields="""CASE WHEN p_partkey % 10 < 9 THEN array(
            named_struct('key', 'contract_type', 'namespace', 'buy', 'type', 'text', 'updated_at', '2001-07-01T00:00:00Z', 'value', 'buyout'),
            named_struct('key', 'msrp', 'namespace', 'buy', 'type', 'number', 'updated_at', '2001-07-01T00:00:00Z', 'value', CAST(p_size AS STRING)),
            named_struct('key', 'condition', 'namespace', 'custom', 'type', 'text', 'updated_at', CAST(NULL AS STRING), 'value', CAST(NULL AS STRING))) END""",
    )


def inventory_items(x: Context) -> DataFrame:
    return x.tables.table("part").selectExpr(
        "CAST(p_partkey * 10 AS STRING) AS id",
        "CASE WHEN p_partkey % 5 = 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.4 AS STRING) END AS cost",
    )


@query
def s5_flatten_products(x: Context) -> DataFrame:
    return to_edge(payloads.flatten_products(product_payloads(x), RUN_DAY))


@query
def s6_enrich_product_costs(x: Context) -> DataFrame:
    flat = payloads.flatten_products(product_payloads(x), RUN_DAY, inventory_items(x))
    return to_edge(flat.select("product_id", "product_price", "product_variant_inventory_item_cost"))


@query
def s7_flatten_metafields(x: Context) -> DataFrame:
    return payloads.flatten_metafields(product_payloads(x, "metafields"), RUN_DAY)


@query
def s8_flatten_ad_insights(x: Context) -> DataFrame:
    bought = "array(named_struct('action_type', 'view', 'value', '9'), named_struct('action_type', 'purchase', 'value', {}))"
    docs = _documents(
        x.tables.table("events"),
        "ad_insight",
        date_start="make_date(2001, 7, day(ts))",
        campaign_id="concat('m', user_id % 12)",
        campaign_name="concat('Campaign ', user_id % 12)",
        ad_id="event_id",
        ad_name="event_type",
        spend="CASE WHEN event_id % 37 = 0 THEN '0' ELSE CAST(CAST(value AS DECIMAL(18,4)) AS STRING) END",
        impressions="CAST(event_id % 1000 AS STRING)",
        clicks="CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 50 AS STRING) END",
        account_currency="CASE WHEN event_id % 2 = 0 THEN 'USD' END",
        actions=f"CASE WHEN event_type = 'purchase' THEN {bought.format(repr('2'))} WHEN event_type = 'view' THEN array(named_struct('action_type', 'view', 'value', '9')) END",
        action_values=f"CASE WHEN event_type = 'purchase' THEN {bought.format('CAST(CAST(value AS DECIMAL(18,4)) * 3 AS STRING)')} END",
    )
    flat = payloads.flatten_ad_insights(docs, SYNCED)
    return to_edge(flat.drop("synced_at"))


@query
def s9_flatten_cost_report(x: Context) -> DataFrame:
    docs = _documents(
        x.tables.table("events"),
        "cost_report",
        position="event_id",
        date="CAST(make_date(2001, 7, day(ts)) AS STRING)",
        campaign_id="concat('g', user_id % 9)",
        campaign_name="concat('Search ', user_id % 9)",
        clicks="CAST(event_id % 40 AS STRING)",
        cost_micros="CAST(CAST(CAST(value AS DECIMAL(18,4)) * 1000000 AS BIGINT) AS STRING)",
        impressions="CAST(event_id % 900 AS STRING)",
        conversions="CASE WHEN event_type = 'purchase' THEN '1.505' ELSE '0' END",
        conversions_value="CAST(CAST(value AS DECIMAL(18,4)) * 2 AS STRING)",
    )
    flat = payloads.flatten_cost_report(docs, SYNCED)
    return to_edge(flat.drop("synced_at"))


def _responses(df: DataFrame, doc: str) -> DataFrame:
    """API responses around a document: a list, one object, or text holding a list."""
    listed = f"to_json(named_struct('data', array({doc})))"
    single = f"to_json(named_struct('data', {doc}))"
    return df.selectExpr(
        f"CASE key % 3 WHEN 0 THEN {listed} WHEN 1 THEN {single} ELSE to_json(named_struct('data', {listed})) END AS body"
    )


@query
def s10_flatten_email_campaigns(x: Context) -> DataFrame:
    users = x.tables.table("events").selectExpr("user_id AS key").distinct()
    doc = """named_struct('id', concat('e', key), 'attributes', named_struct('name', concat('Mail ', key),
        'status', CASE WHEN key % 4 = 0 THEN NULL ELSE 'Sent' END, 'archived', CASE WHEN key % 5 = 0 THEN true END,
        'send_strategy', named_struct('options_static', named_struct('datetime', CASE WHEN key % 2 = 0 THEN '2001-07-02T15:00:00Z' END)),
        'send_time', '2001-07-01T15:00:00Z', 'created_at', '2001-06-01T00:00:00Z'))"""
    return payloads.flatten_email_campaigns(_responses(users, doc), SYNCED).drop("synced_at")


@query
def s10_flatten_email_lists(x: Context) -> DataFrame:
    users = x.tables.table("events").selectExpr("user_id AS key").distinct()
    doc = "named_struct('id', concat('l', key), 'attributes', named_struct('name', CASE WHEN key % 4 > 0 THEN concat('List ', key) END, 'created', '2001-06-01T00:00:00Z'))"
    return payloads.flatten_email_lists(_responses(users, doc), RUN_DAY, SYNCED).drop("synced_at")


@query
def s10_flatten_email_messages(x: Context) -> DataFrame:
    users = x.tables.table("events").selectExpr("user_id AS key").distinct()
    doc = """named_struct('id', concat('msg-', key), 'attributes', named_struct('content', named_struct('subject', concat('News ', key),
        'from_email', 'shop@example.com', 'from_label', CASE WHEN key % 2 = 0 THEN 'Shop' END)),
        'relationships', named_struct('campaign', CASE WHEN key % 3 = 0 THEN NULL ELSE named_struct('data', named_struct('id', concat('e', key))) END))"""
    return payloads.flatten_email_messages(_responses(users, doc), SYNCED).drop("synced_at")


@query
def s11_flatten_email_report(x: Context) -> DataFrame:
    per_user = x.tables.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    results = """array(named_struct('groupings', named_struct('campaign_id', concat('e', user_id)), 'statistics', named_struct(
        'recipients', n * 100, 'opens', n * 50, 'opens_unique', n * 40, 'open_rate', '0.4', 'clicks', CAST(NULL AS STRING),
        'clicks_unique', n * 7, 'click_rate', 'bad', 'unsubscribes', n % 3, 'conversions', '2.9', 'conversion_value', '12.5')))"""
    deep = f"to_json(named_struct('data', named_struct('attributes', named_struct('results', {results}))))"
    mid = f"to_json(named_struct('attributes', named_struct('results', {results})))"
    flat = f"to_json(named_struct('results', {results}))"
    text = f"to_json(named_struct('data', {mid}))"
    docs = per_user.selectExpr(f"CASE user_id % 4 WHEN 0 THEN {deep} WHEN 1 THEN {mid} WHEN 2 THEN {flat} ELSE {text} END AS body")
    rows = payloads.flatten_email_report(docs, RUN_DAY, SYNCED)
    return to_edge(rows.drop("synced_at", "send_date", "campaign_name"))


# ---- sinks -------------------------------------------------------------------

_AD = ("date", "campaign_id", "ad_id", "spend", "clicks")


@query
def s13_append_sink(x: Context) -> DataFrame:
    path = x.folder("append")
    ads = x.raw.meta_ads.select(*_AD)
    sinks.append(ads.where("date < DATE '2001-07-10'"), path)
    sinks.append(ads.where("date >= DATE '2001-07-05'"), path)  # overlapping load, kept twice
    return to_edge(x.spark.read.schema(ads.schema).parquet(path).select(*_AD))


@query
def s14_replace_sink(x: Context) -> DataFrame:
    root = x.folder("replace")
    products = x.raw.products.select("product_id", "date", "product_price")
    sinks.replace(products.where("date < DATE '2001-07-01'"), root)
    sinks.replace(products.where("date >= DATE '2001-07-01'"), root)
    return to_edge(sinks.current(x.spark, root))


@query
def s15_replace_days_sink(x: Context) -> DataFrame:
    path = x.folder("days")
    ads = x.raw.meta_ads.select(*_AD)
    sinks.append(ads, path)
    corrected = ads.where("date >= DATE '2001-07-10'").withColumn("spend", (F.col("spend") * 2).cast(R.MONEY))
    # One asked day has no new rows and becomes empty; a rerun changes nothing.
    corrected, asked = corrected.where("date <> DATE '2001-07-12'"), P.Period(date(2001, 7, 10), date(2001, 7, 31))
    for _ in range(2):
        sinks.replace_days(corrected, path, asked=asked)
    return to_edge(x.spark.read.schema(ads.schema).parquet(path).select(*_AD))


@query
def s16_day_layout(x: Context) -> DataFrame:
    """Only the folders of the asked days are read."""
    path = x.folder("layout")
    ads = x.raw.google_ads.select("date", "campaign_id", "spend")
    sinks.append(ads, path)
    stored = x.spark.read.schema(ads.schema).parquet(path).where("date BETWEEN DATE '2001-07-03' AND DATE '2001-07-09'")
    return to_edge(stored.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("spend").alias("spend")))


@query
def s17_widen_table(x: Context) -> DataFrame:
    old = x.raw.customers.where("date < DATE '2001-07-01'").select("customer_id", "date")
    new = x.raw.customers.where("date >= DATE '2001-07-01'").select("customer_id", "date", "customer_tags")
    return contracts.widen(old, new)


@query
def s18_publish_facts(x: Context) -> DataFrame:
    """Facts built over written stages, published, and a card read from what was published."""
    stages, root = x.folder("stages"), x.folder("facts")
    warehouse.publish(warehouse.stage(x.raw, stages, ("headers",)), root, ("daily_sales", "marketing"))
    return metrics.marketing_efficiency(warehouse.PublishedFacts(x.spark, root), AS_OF)


@query
def s18_fact_views(x: Context) -> DataFrame:
    warehouse.expose(x.spark, x.facts, ("customers",), prefix="v_fact_")
    return x.spark.sql("SELECT purchase_segment, customer_type, count(*) AS customers FROM v_fact_customers GROUP BY ALL")


# ---- typing ------------------------------------------------------------------

@query
def t1_tolerant_cast(x: Context) -> DataFrame:
    return to_edge(x.headers().select("order_id", "date", "order_net_sales", C.amount("order_net_sales").alias("net_sales"),
                                      C.whole("order_total_price").alias("whole_total"),
                                      C.whole_from_text("order_net_sales").alias("whole_text")))


@query
def t2_strict_cast(x: Context) -> DataFrame:
    return x.raw.meta_ads.select("ad_id", F.col("spend").cast("double").alias("spend"), F.col("ad_id").cast("bigint").alias("ad_number"),
                                 F.col("impressions").cast("string").alias("impressions_text"))


@query
def t3_tolerant_date(x: Context) -> DataFrame:
    rows = x.raw.metafields.where("product_metafield_key = 'date'")
    return rows.select("product_id", "product_metafield_value", C.day_from_text("product_metafield_value").alias("buy_day"))


@query
def t4_instant(x: Context) -> DataFrame:
    return x.headers().select("order_id", "date", F.unix_seconds(C.instant("order_created_at")).alias("created_epoch"),
                              F.unix_seconds(C.instant("order_net_sales")).alias("not_a_time"))


@query
def t5_business_day(x: Context) -> DataFrame:
    day = C.business_day("order_created_at")
    return x.headers().groupBy(day.alias("local_day"), F.to_date(F.substring("order_created_at", 1, 10)).alias("utc_day")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def t6_coerce_with_default(x: Context) -> DataFrame:
    return to_edge(x.headers().groupBy("order_app_name").agg(F.sum(C.amount_or_zero("order_net_sales")).alias("total"),
                                                             F.count_if(C.amount_or_zero("order_net_sales") == 0).alias("zeros")))


@query
def t7_fixed_point(x: Context) -> DataFrame:
    price = C.amount("l_extendedprice") * C.amount("l_discount")
    two, four = price.cast("decimal(18,2)"), price.cast("decimal(18,4)")
    return to_edge(x.tables.table("lineitem").groupBy("l_returnflag").agg(F.sum(two).alias("cents"), F.sum(four).alias("mills")))


@query
def t8_blank_for_null(x: Context) -> DataFrame:
    return x.headers().select("order_id", "date", C.text_or_blank("order_shipping_address_country").alias("country"),
                              C.text_or_blank("order_location_name").alias("store"))


@query
def t9_null_for_blank(x: Context) -> DataFrame:
    return x.raw.customers.select("customer_id", "date", C.blank_to_null("customer_default_address_country").alias("country"))


@query
def t10_coalesce_chain(x: Context) -> DataFrame:
    cost = F.coalesce(C.amount("product_variant_inventory_item_cost"), (C.amount("product_price") * F.lit(0.5).cast("decimal(2,1)")).cast(R.MONEY))
    return to_edge(x.raw.products.select("product_id", "date", cost.alias("cost_or_half_price")))


@query
def t11_safe_ratio(x: Context) -> DataFrame:
    return x.raw.customers.select("customer_id", "date", C.ratio(F.col("customer_total_spent"), F.col("customer_orders_count"), 2).alias("per_order"),
                                  C.ratio(F.col("customer_orders_count"), F.col("customer_orders_count")).alias("one_or_null"))


@query
def t12_round_decimal(x: Context) -> DataFrame:
    half = (C.amount("p_retailprice") * F.lit(0.125).cast("decimal(4,3)")).cast(R.MONEY)
    return to_edge(x.tables.table("part").select("p_partkey", *[C.rounded(half, n).alias(f"round_{n}") for n in (0, 1, 2)]))


@query
def t13_three_valued_filter(x: Context) -> DataFrame:
    status = F.col("order_financial_status")
    return x.headers().agg(F.count_if(F.lower(status) != "cancelled").alias("passes"), F.count_if(F.lower(status) == "cancelled").alias("fails"),
                           F.count_if((F.lower(status) != "cancelled").isNull()).alias("unknown"))


# ---- projections, predicates, mappings ---------------------------------------

@query
def p1_valid_orders(x: Context) -> DataFrame:
    return x.headers().where(C.valid_order()).groupBy("order_financial_status", "order_test").agg(F.count(F.lit(1)).alias("n"))


@query
def p2_channel_mapping(x: Context) -> DataFrame:
    return x.headers().groupBy("order_app_name", C.sales_channel().alias("channel")).agg(F.count(F.lit(1)).alias("n"))


@query
def p3_source_app(x: Context) -> DataFrame:
    docs = order_payloads(x)
    return docs.groupBy("source_name", C.source_app("source_name").alias("app")).agg(F.count(F.lit(1)).alias("n"))


@query
def p4_store_names(x: Context) -> DataFrame:
    docs = order_payloads(x)
    return docs.groupBy("location_id", C.store_name("location_id").alias("store")).agg(F.count(F.lit(1)).alias("n"))


@query
def p5_real_lines(x: Context) -> DataFrame:
    return x.raw.orders.agg(F.count_if(C.real_line()).alias("lines"), F.count_if(F.col("line_item__id").isNull()).alias("empty_rows"))


@query
def p6_merchandise_titles(x: Context) -> DataFrame:
    return x.raw.orders.where(C.merchandise_line()).groupBy("line_item__vendor").agg(F.count(F.lit(1)).alias("n"))


@query
def p7_meaningful_refunds(x: Context) -> DataFrame:
    return x.raw.refunds.where(C.meaningful_refund()).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query
def p8_customer_segments(x: Context) -> DataFrame:
    segment = C.purchase_segment(C.whole("customer_orders_count"))
    return x.raw.customers.groupBy(C.customer_type("customer_is_returning").alias("customer_type"), segment.alias("purchase_segment")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def p9_age_buckets(x: Context) -> DataFrame:
    age = F.datediff("date", C.day_from_text("product_metafield_value"))
    rows = x.raw.metafields.where("product_metafield_key = 'date'")
    return rows.groupBy(C.bucket(age).alias("bucket"), C.bucket(age, unknown="unknown").alias("bucket_or_unknown")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def p10_bucket_order(x: Context) -> DataFrame:
    stock = x.facts.inventory().groupBy("aging_bucket").agg(F.count(F.lit(1)).alias("products"))
    return stock.withColumn("position", C.bucket_rank(F.col("aging_bucket"))).orderBy("position")


@query
def p11_owned_cost(x: Context) -> DataFrame:
    return to_edge(x.facts.inventory().groupBy("contract_type", "is_consignment").agg(F.sum("cost_excl_consignment").alias("owned"),
                                                                                      F.sum("cost_value").alias("all_cost")))


@query
def p12_extended_values(x: Context) -> DataFrame:
    return to_edge(x.facts.inventory().select("product_id", "retail_value", "cost_value"))


@query
def p13_profit_and_margin(x: Context) -> DataFrame:
    return to_edge(x.facts.orders().select("order_id", "gross_profit", "gross_margin_pct"))


def _with(x: Context, table: str, change) -> Facts:
    """Facts over raw tables of which one is changed."""
    return Facts(RawTables(lambda name: change(getattr(x.raw, name)) if name == table else getattr(x.raw, name)))


@query
def p12_extended_values_without_price(x: Context) -> DataFrame:
    """Stock of products without a price or cost, with half units and with negative stock."""
    facts = _with(x, "products", lambda df: df.withColumns({
        "product_price": F.expr("CASE WHEN CAST(product_id AS INT) % 7 > 0 THEN product_price END"),
        "product_inventory_quantity": F.expr("CASE CAST(product_id AS INT) % 3 WHEN 0 THEN product_inventory_quantity + 0.5 WHEN 1 THEN -product_inventory_quantity ELSE product_inventory_quantity END"),
    }))
    return to_edge(facts.inventory().select("product_id", "units_on_hand", "retail_value", "cost_value", "cost_excl_consignment"))


@query
def p13_margin_of_nothing(x: Context) -> DataFrame:
    """Orders that sold for nothing, for less than nothing or for an unreadable amount: profit is known or unknown, the margin only
    where there are sales."""
    facts = _with(x, "orders", lambda df: df.withColumn("order_net_sales", F.expr(
        "CASE CAST(order_id AS BIGINT) % 19 WHEN 0 THEN '0' WHEN 1 THEN '-10.5' WHEN 2 THEN 'free' ELSE order_net_sales END"
    )))
    return to_edge(facts.orders().select("order_id", "net_sales", "cogs", "gross_profit", "gross_margin_pct"))


@query
def p14_total_refunded(x: Context) -> DataFrame:
    return to_edge(x.facts.refunds().groupBy("order_id").agg(F.sum("total_refunded").alias("total_refunded"), F.sum("refund_tax").alias("refund_tax")))


@query
def p15_rename_to_common(x: Context) -> DataFrame:
    return x.raw.meta_ads.withColumnsRenamed({"adset_id": "ad_group_id", "purchases": "conversions"}).select("ad_id", "ad_group_id", "conversions")


@query
def p16_filter_slots(x: Context) -> DataFrame:
    picked = Filters(P.Period(date(2001, 1, 1), AS_OF), store_location=("Store 1", "Store 2"), channel="Retail", ship_province="Ontario")
    orders = x.facts.fact("orders", picked.period, {"order_id", "store_location", "channel", "ship_province", "net_sales", "order_date"})
    return to_edge(picked.apply(orders, "order_date").select("order_id", "order_date", "net_sales"))


@query
def p16_contract_slot(x: Context) -> DataFrame:
    return to_edge(Filters(contract_type="buyout", store_location="Store 3").apply(x.facts.inventory()).select("product_id", "retail_value"))


@query
def p17_relative_windows(x: Context) -> DataFrame:
    windows = {"mtd": JULY, "same_month_ly": P.same_month_last_year(AS_OF), "last_30": P.last_days(AS_OF, 30),
               "last_365": P.last_days(AS_OF, 365), "last_12_months": P.last_months(AS_OF, 12)}
    orders = x.facts.clean_orders(columns={"order_date"})
    return orders.agg(*[F.count_if(w.covers("order_date")).alias(name) for name, w in windows.items()])


@query
def p18_keywords(x: Context) -> DataFrame:
    found = quality.notes_with(x.raw.customers, "customer_note", R.SELLER_WORDS)
    return found.groupBy("date", "customer_note").agg(F.count(F.lit(1)).alias("n"))


# ---- joins -------------------------------------------------------------------

@query
def j1_line_cost(x: Context) -> DataFrame:
    lines = x.facts.clean_lines().select("order_id", "line_item__id", F.col("line_item__product_id").alias("product_id"))
    return to_edge(attach(lines, x.facts.unit_costs, "product_id", spread=["line_item__id"]))


@query
def j1_hot_product(x: Context) -> DataFrame:
    """A third of all lines are of one product: only that one is split, and its cost copied."""
    lines = x.facts.clean_lines().select("order_id", "line_item__id", F.expr(
        "CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '5' ELSE line_item__product_id END").alias("product_id"), "line_item__quantity")
    hot = hot_keys(lines, "product_id")
    priced = attach(lines, x.facts.unit_costs, "product_id", spread=["order_id", "line_item__id"], hot=hot)
    value = F.sum(F.col("line_item__quantity") * F.col("unit_cost")).cast(R.PRODUCT)
    return to_edge(priced.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"), value.alias("cost")).withColumn("hot", F.col("product_id").isin(hot)))


@query
def j2_order_lines(x: Context) -> DataFrame:
    header = x.facts.clean_orders(columns={"order_id", "channel"})
    units = F.coalesce("total_units", F.lit(0).cast(R.MONEY))
    return to_edge(header.join(x.facts.order_lines_total(), "order_id", "left").select("order_id", "channel", units.alias("total_units")))


@query
def j3_customer_preferences(x: Context) -> DataFrame:
    return x.facts.latest_customers().select("customer_id").join(x.facts.preferred(), "customer_id", "left")


@query
def j4_product_attributes(x: Context) -> DataFrame:
    attributes = pivot_attributes(x.raw.metafields, {"contract_type": ("buy", "contract_type"), "msrp": ("buy", "msrp")})
    return x.tables.table("part").selectExpr("CAST(p_partkey AS STRING) AS product_id").join(attributes, "product_id", "left")


@query
def j5_refund_parent(x: Context) -> DataFrame:
    return x.facts.refunds().select("order_id", "refund_id", "channel", "store_location", "financial_status")


@query
def j5_refund_of_missing_order(x: Context) -> DataFrame:
    """Refunds whose order never landed keep their amounts and have no channel, store or status."""
    facts = _with(x, "orders", lambda df: df.where("CAST(order_id AS BIGINT) % 23 <> 0"))
    found = facts.refunds().groupBy("channel", "store_location", "financial_status")
    return to_edge(found.agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("order_id").alias("orders"), F.sum("total_refunded").alias("total_refunded")))


@query
def j6_email_header(x: Context) -> DataFrame:
    return x.facts.email_campaigns().select("campaign_id", "campaign_name", "campaign_status")


@query
def j7_seller_location(x: Context) -> DataFrame:
    return x.facts.supplied_items().select("product_id", "seller_name", "store_location")


@query
def j7_seller_without_location(x: Context) -> DataFrame:
    """Products whose place is missing, blank, an empty list, plain text or a list of several."""
    place = F.expr("""CASE WHEN product_metafield_key <> 'location' THEN product_metafield_value ELSE CASE CAST(product_id AS INT) % 8
        WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '[]' WHEN 3 THEN 'Store 9' WHEN 4 THEN '["A","B"]' ELSE product_metafield_value END END""")
    facts = _with(x, "metafields", lambda df: df.withColumn("product_metafield_value", place))
    return facts.supplied_items().select("product_id", "seller_name", "store_location")


@query
def j8_item_channel(x: Context) -> DataFrame:
    return x.facts.supplied_items().groupBy("channel").agg(F.count(F.lit(1)).alias("items"))


@query
def j9_name_match(x: Context) -> DataFrame:
    sellers = x.facts.supplied_items().select("seller_name").distinct()
    buyers = identity.consignors(x.raw.customers).select("customer_id", "customer_first_name", "customer_last_name")
    return identity.match_by_name(sellers, buyers).select("seller_name", "customer_id")


@query
def j10_scalars_side_by_side(x: Context) -> DataFrame:
    orders = x.facts.clean_orders(columns={"net_sales"}).agg(F.sum("net_sales").alias("net_sales"))
    stock = x.facts.inventory().agg(F.sum("retail_value").alias("stock_value"))
    return to_edge(A.one_row([orders, stock]))


@query
def j11_orders_with_refunds(x: Context) -> DataFrame:
    orders = x.facts.clean_orders(columns={"channel"})
    joined = orders.join(x.facts.refunded_orders(), "order_id", "left")
    rate = C.ratio(F.count("refunded"), F.count("order_id"), 1, percent=True)
    return joined.groupBy("channel").agg(F.count("order_id").alias("orders"), F.count("refunded").alias("refunded"), rate.alias("rate_pct"))


@query
def j12_lookup(x: Context) -> DataFrame:
    regions = x.tables.table("region").selectExpr("r_regionkey AS n_regionkey", "r_name")
    nations = x.tables.table("nation").join(regions, "n_regionkey", "left").selectExpr("n_nationkey AS c_nationkey", "r_name")
    people = attach(x.tables.table("customer").select("c_custkey", "c_nationkey"), nations, "c_nationkey", spread=["c_custkey"])
    return people.groupBy("r_name").agg(F.count(F.lit(1)).alias("customers"))


@query
def j13_existence_flag(x: Context) -> DataFrame:
    return x.facts.seller().groupBy("is_also_buyer").agg(F.count(F.lit(1)).alias("n"))


@query
def j13_semi_and_anti(x: Context) -> DataFrame:
    orders = x.facts.clean_orders(columns={"order_id"})
    flagged = orders.join(x.facts.refunded_orders(), "order_id", "left")
    return flagged.agg(F.count("refunded").alias("refunded"), F.count_if(F.col("refunded").isNull()).alias("not_refunded"))


# ---- aggregations ------------------------------------------------------------

@query
def a1_grouped_sums(x: Context) -> DataFrame:
    d = x.facts.clean_orders(columns={"channel", "net_sales", "total_discounts"})
    return to_edge(d.groupBy("channel").agg(C.rounded(F.sum("net_sales")).alias("net_sales"), C.rounded(F.sum("total_discounts")).alias("discounts")))


@query
def a2_sum_of_products(x: Context) -> DataFrame:
    lines = x.facts.clean_lines()
    value = C.amount("line_item__price") * C.amount("line_item__quantity")
    return to_edge(lines.groupBy("line_item__product_id").agg(F.sum(value).cast(R.PRODUCT).alias("value")))


@query
def a3_distinct_count(x: Context) -> DataFrame:
    return x.raw.orders.groupBy("year").agg(F.countDistinct("order_id").alias("orders"), F.countDistinct("order_customer_id").alias("customers"))


@query
def a3_distinct_from_bitmaps(x: Context) -> DataFrame:
    """Distinct orders and customers per channel and month, and per channel over all time, from bitmaps kept per day and channel."""
    header = x.facts.clean_orders(columns={"order_date", "channel", "order_customer_id"}).where("order_date IS NOT NULL")
    numbers = {
        "orders": (F.col("order_id"), distinct.numbered(header.select(F.col("order_id").alias("member")), x.folder("order-numbers"))),
        "customers": (F.col("order_customer_id"), distinct.numbered(header.select(F.col("order_customer_id").alias("member")), x.folder("customer-numbers"))),
    }
    path = x.folder("bitmaps")
    made = distinct.cells(header, ["order_date", "channel"], numbers)
    made.write.parquet(path)
    stored = x.spark.read.schema(made.schema).parquet(path)
    monthly = distinct.counts(stored.withColumn("month", F.trunc("order_date", "month")), ["channel", "month"])
    whole = distinct.counts(stored, ["channel"]).withColumn("month", F.lit(None).cast("date"))
    return monthly.unionByName(whole)


@query
def a4_ratio_of_totals(x: Context) -> DataFrame:
    d = x.facts.clean_orders(columns={"year", "net_sales", "shipping_revenue"})
    return d.groupBy("year").agg(C.ratio(F.sum("net_sales"), F.count("order_id"), 2).alias("aov"),
                                 C.ratio(F.sum("shipping_revenue"), F.sum("net_sales"), 1, percent=True).alias("shipping_pct"))


@query
def a5_conditional_count(x: Context) -> DataFrame:
    return x.raw.customers.groupBy("date").agg(F.count_if(C.has_tag("customer_tags")).alias("tagged"),
                                               F.count_if(F.col("customer_orders_count") > 0).alias("buyers"))


@query
def a6_conditional_distinct(x: Context) -> DataFrame:
    late = F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))
    return x.tables.table("lineitem").groupBy("l_linestatus").agg(F.countDistinct(late).alias("returned_orders"), F.countDistinct("l_orderkey").alias("orders"))


@query
def a7_conditional_sum(x: Context) -> DataFrame:
    d = x.facts.clean_orders(columns={"year", "channel", "net_sales"})
    years = [str(y) for y in YEARS]
    return to_edge(d.groupBy("channel").agg(*[F.sum(F.when(F.col("year") == y, F.col("net_sales")).otherwise(F.lit(0).cast(R.MONEY))).alias(f"y{y}") for y in years]))


@query
def a7_year_pivot(x: Context) -> DataFrame:
    d = x.facts.clean_orders(columns={"year", "channel"})
    return d.groupBy("channel").pivot("year", [str(y) for y in YEARS]).agg(F.count("order_id"))


@query
def a8_extremes(x: Context) -> DataFrame:
    rows = x.raw.products.groupBy("product_vendor").agg(F.min("product_price").alias("low"), F.max("product_price").alias("high"),
                                                        C.mean(F.col("product_price"), 2).alias("mean"), F.count(F.lit(1)).alias("n"))
    return to_edge(rows)


@query
def a9_global_aggregate(x: Context) -> DataFrame:
    return to_edge(x.raw.refunds.agg(F.sum("line_item__refunds_subtotal").alias("subtotal"), F.count(F.lit(1)).alias("n"), F.max("date").alias("last_day")))


@query
def a10_rollup_of_cells(x: Context) -> DataFrame:
    """Totals over cells come from sums; the ratio is recomputed, never averaged."""
    d = x.facts.daily_sales(columns={"net_sales", "shipping_revenue"})
    return to_edge(d.groupBy("channel", "store_location").agg(F.sum("net_sales").alias("net_sales"),
                                                              C.ratio(F.sum("shipping_revenue"), F.sum("net_sales"), 1, percent=True).alias("shipping_pct")))


#: Cards over four facts and all grains, and the number each shows.
_CELL_CARDS = {
    "leadership_net_sales": "net_sales", "leadership_orders": "orders", "leadership_orders_by_sales_channel_pie": "orders",
    "leadership_orders_by_channel_and_province_table": "orders", "leadership_units_sold_by_day": "units", "retail_gross_profit": "gross_profit",
    "ecomm_sales_by_utm_source": "net_sales", "leadership_net_sales_mtd": "net_sales_mtd", "shipping_revenue_by_day": "shipping_revenue",
    "retail_vs_ecomm_sales": "net_sales", "leadership_refunded_units": "refunded_units", "leadership_refunded_value_by_day": "refunded_value",
    "marketing_spend_by_channel": "spend", "marketing_daily_spend_by_channel": "spend", "marketing_conversions_by_channel": "conversions",
}


@query
def a10_cards_from_cells(x: Context) -> DataFrame:
    """Cards answered from sums that were stored once, each from the smallest set of cells that has what it needs."""
    root = x.folder("cells")
    lattice.build(x.facts, root)
    stored, known = lattice.Lattice(x.spark, root), {c.key: c for c in metrics.tab_cards()}
    readers = Filters(P.Period(date(1995, 1, 1), date(2001, 12, 31)))
    parts = []
    for key, value in _CELL_CARDS.items():
        found = stored.run(known[key], AS_OF, readers)
        total = F.sum(F.col(value).cast("decimal(28,4)")).cast("double")
        parts.append(found.agg(F.lit(key).alias("card"), F.count(F.lit(1)).alias("rows"), total.alias("total")))
    return reduce(DataFrame.unionByName, parts)


@query
def a11_latest_known(x: Context) -> DataFrame:
    return x.headers().where("order_customer_id IS NOT NULL").groupBy("order_customer_id").agg(
        A.latest_known("order_location_name", "date", "order_id").alias("store"),
        A.latest_known("order_shipping_address_country", "date", "order_id").alias("country"))


@query
def a12_value_frequency(x: Context) -> DataFrame:
    return A.frequency(x.raw.metafields, ["product_metafield_namespace", "product_metafield_key", "product_metafield_value"])


@query
def a12_tag_frequency(x: Context) -> DataFrame:
    return quality.tag_frequency(x.raw.customers)


@query
def a13_share_of_total(x: Context) -> DataFrame:
    grouped = x.facts.clean_orders(columns={"channel"}).groupBy("channel").agg(F.count("order_id").alias("orders"))
    return A.share_of_total(grouped, "orders", "pct")


# ---- one row per key, windows ------------------------------------------------

@query
def d1_latest_row(x: Context) -> DataFrame:
    rows = x.raw.products.select("product_id", "product_updated_at_datetime", "date", "product_inventory_quantity")
    return to_edge(best_row(rows, ["product_id"], latest=["product_updated_at_datetime"]))


@query
def d2_preferred_then_latest(x: Context) -> DataFrame:
    rows = x.headers().select("order_id", "order_location_name", "date", "order_financial_status")
    return best_row(rows, ["order_id"], latest=["date"], prefer=[located_first()])


@query
def d3_composite_key(x: Context) -> DataFrame:
    lines = x.facts.clean_lines()
    return to_edge(lines.select("order_id", "line_item__id", "order_location_name", "date", "line_item__product_id", "line_item__quantity",
                                "line_item__price"))


@query
def d4_null_folded_key(x: Context) -> DataFrame:
    return to_edge(x.facts.clean_refunds().select("order_id", "order_refunds", "date", "line_item__refunds_subtotal", "line_item__refunds_quantity"))


@query
def d5_attribute_latest(x: Context) -> DataFrame:
    rows = x.raw.metafields.select("product_id", "product_metafield_namespace", "product_metafield_key", "product_metafield_update_at",
                                   "product_metafield_value")
    return best_row(rows, ["product_id", "product_metafield_namespace", "product_metafield_key"], latest=["product_metafield_update_at"])


@query
def d6_contract_report(x: Context) -> DataFrame:
    """Every column of the contract against orders as an export writes them: all text, one column under another name, one
    more than agreed, some amounts and days that are none."""
    rows = contracts.conform(x.raw.orders, "orders")
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    export = text.withColumns({
        "order_total_price": F.expr("CASE WHEN CAST(order_id AS BIGINT) % 13 = 0 THEN 'free' ELSE order_total_price END"),
        "ingested_at": F.expr("CASE WHEN CAST(order_id AS BIGINT) % 17 = 0 THEN 'soon' ELSE ingested_at END"),
        "coupon": F.expr("CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'X' END"),
    }).withColumnRenamed("order_subtotal_price", "order_subtotal")
    return contracts.contract_report(export, "orders")


@query
def d6_contract_check(x: Context) -> DataFrame:
    return contracts.cast_failures(x.raw.orders, {"order_net_sales": "decimal(18,4)", "order_created_at": "timestamp", "order_customer_id": "bigint"})


@query
def d7_raw_cleanup(x: Context) -> DataFrame:
    rows = x.raw.orders.select("order_id", "date", "line_item__id", "ingested_at", "order_location_name", "order_customer_id",
                               "line_item__product_id", "line_item__quantity", "line_item__price", "line_item__total_discount")
    return to_edge(incremental.one_per_day(rows))


@query
def w1_whole_result_window(x: Context) -> DataFrame:
    grouped = x.facts.inventory().where("units_on_hand > 0").groupBy("store_location").agg(F.count(F.lit(1)).alias("products"))
    return A.share_of_total(grouped, "products", "pct", digits=2)


@query
def w2_change_on_previous_period(x: Context) -> DataFrame:
    card = next(c for c in metrics.tab_cards() if c.key == "leadership_net_sales")
    return metrics.period_change(card, x.facts, AS_OF, P.Period(date(2001, 6, 16), AS_OF))


@query
def w3_cumulative_this_year_last_year(x: Context) -> DataFrame:
    return metrics.month_against_last_year(x.facts, AS_OF, cumulative=True)


@query
def w4_as_of_snapshot(x: Context) -> DataFrame:
    """Stock as known on an earlier day."""
    return to_edge(x.facts.inventory(as_of=date(2001, 6, 20)))


@query
def w4_daily_stock(x: Context) -> DataFrame:
    """Stock and its value by aging bucket as known on every day of two months, from one pass over all snapshots."""
    return to_edge(x.facts.daily_stock(P.Period(date(2001, 6, 1), date(2001, 7, 31))))


@query
def w4_snapshot_on_day_of_sale(x: Context) -> DataFrame:
    """What was known of each product on the day it was sold: the stock of the version that held then."""
    lines = x.facts.merchandise_lines(labels=("order_app_name",))
    sold = lines.select(F.col("line_item__product_id").cast("string").alias("product_id"), "order_date", "line_item__quantity")
    known = x.facts.inventory_versions().select("product_id", "snapshot_date", "units_on_hand", "valid_from", "valid_to")
    # The newest order is no older than the newest line, and found without lines.
    newest = x.raw.orders.agg(F.max(C.business_day("order_created_at", x.facts.zone))).first()[0]
    found = history.attach_as_of(sold.where("order_date IS NOT NULL"), known, ["product_id"], "order_date", newest)
    sums = found.groupBy(F.trunc("order_date", "month").alias("month"), "snapshot_date").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_item__quantity").alias("units_sold"), F.sum("units_on_hand").alias("units_on_hand")
    )
    return to_edge(sums)


@query
def w4_latest_row_on_day(x: Context) -> DataFrame:
    """The dashboards' own filter: products whose newest snapshot is of that day."""
    return to_edge(x.facts.inventory().where(F.col("snapshot_date") == F.lit(date(2001, 7, 14))).select("product_id", "units_on_hand", "retail_value"))


# ---- order, limit, union -----------------------------------------------------

@query
def o1_ordered_result(x: Context) -> DataFrame:
    return to_edge(x.facts.daily_sales(columns={"net_sales"}).orderBy(F.desc("net_sales"), "order_date"))


@query
def o2_top_n(x: Context) -> DataFrame:
    sold = x.facts.product_sales().groupBy("vendor").agg(F.sum("gross_revenue").alias("revenue"))
    return to_edge(sold.orderBy(F.desc("revenue"), "vendor").limit(15))


@query
def o3_top_after_filter(x: Context) -> DataFrame:
    return to_edge(quality.top_consignors(x.raw.customers))


@query
def u1_union_to_common_schema(x: Context) -> DataFrame:
    return to_edge(x.facts.marketing().groupBy("source", "date").agg(F.count(F.lit(1)).alias("ads"), F.sum("reach").alias("reach"),
                                                                     F.sum("conversions").alias("conversions")))


@query
def u2_union_of_totals(x: Context) -> DataFrame:
    sold = x.facts.merchandise_lines(labels=("order_app_name",)).agg(F.lit("sold").alias("kind"), F.sum("line_item__quantity").alias("units"))
    stock = x.facts.inventory().agg(F.lit("on hand").alias("kind"), F.sum("units_on_hand").cast("decimal(28,4)").alias("units"))
    return to_edge(sold.unionByName(stock))


@query
def u4_nested_stages(x: Context) -> DataFrame:
    best = x.facts.product_sales().groupBy("product_id").agg(F.sum("gross_revenue").alias("revenue"))
    stock = x.facts.inventory().select("product_id", "aging_bucket", "retail_value")
    joined = stock.join(best, "product_id", "left")
    return to_edge(joined.groupBy("aging_bucket").agg(F.sum("revenue").alias("revenue"), F.sum("retail_value").alias("retail_value"),
                                                      F.count_if(F.col("revenue").isNull()).alias("unsold")))


# ---- scalar functions --------------------------------------------------------

@query
def f1_strings(x: Context) -> DataFrame:
    c = x.raw.customers
    day = F.split("customer_created_at", "T")[0]
    return c.select("customer_id", "date", F.upper("customer_last_name").alias("upper_name"),
                    F.concat_ws("|", day, F.lpad("customer_id", 6, "0")).alias("packed"),
                    F.lower("customer_tags").like("%consignment%").alias("tagged"),
                    C.full_name("customer_first_name", "customer_last_name").alias("full_name"))


@query
def f2_regex(x: Context) -> DataFrame:
    return x.raw.refunds.groupBy("order_id").agg(F.max(C.trailing_id("order_refunds")).alias("refund_id"), F.max(C.trailing_id("order_name")).alias("no_match"))


@query
def f3_dates(x: Context) -> DataFrame:
    day = F.col("date")
    hours = C.whole_hours(C.instant("order_created_at"), C.instant("order_processed_at"))
    return x.headers().select("order_id", "date", F.trunc(day, "month").alias("month_start"), F.date_sub(day, 30).alias("month_ago"),
                              F.add_months(day, -12).alias("year_ago"), F.dayofmonth(day).alias("d"), F.month(day).alias("m"), F.year(day).alias("y"),
                              F.datediff(F.lit(AS_OF), day).alias("age"), hours.alias("hours"))


@query
def f4_week_number(x: Context) -> DataFrame:
    days = x.tables.table("orders").selectExpr("CAST(o_orderdate AS DATE) AS day").distinct()
    return days.select("day", C.iso_week_text(F.col("day")).alias("week"), C.year_month_text(F.col("day")).alias("year_month"),
                       C.month_text(F.col("day")).alias("month"))


@query
def f5_math(x: Context) -> DataFrame:
    spend = C.amount("spend")
    micros = (spend * F.lit(1000000)).cast("decimal(28,0)")
    back = (micros.cast("decimal(28,6)") / F.lit(1000000)).cast(R.MONEY)
    return to_edge(x.raw.google_ads.groupBy("campaign_id").agg(F.sum(back).alias("spend"), C.rounded(F.sum(spend * 2), 1).alias("twice")))


@query
def f6_conditionals(x: Context) -> DataFrame:
    size = F.when(F.col("p_size").between(1, 15), "small").when(F.col("p_size").isin(*range(16, 31)), "medium").otherwise("large")
    kind = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    return x.tables.table("part").groupBy(size.alias("size"), F.coalesce(kind, F.lit("none")).alias("brand")).agg(F.count(F.lit(1)).alias("n"))


@query
def f7_arrays(x: Context) -> DataFrame:
    docs = order_payloads(x)
    zero = F.lit(0).cast("bigint")
    units = F.aggregate(F.coalesce("line_items", F.array()), zero, lambda a, li: a + F.coalesce(li["quantity"], zero))
    bags = F.get(F.filter("line_items", lambda li: F.lower(li["title"]) == "paper bag"), 0)["id"]
    return docs.select("id", units.alias("units"), F.get("line_items", 0)["id"].alias("first_line"), bags.alias("bag_line"))


@query
def f8_json_and_maps(x: Context) -> DataFrame:
    events = x.tables.table("events")
    k = F.from_json("props", "k bigint")["k"]
    label = C.lookup("event_type", {"purchase": "sale", "view": "visit", "click": "visit"})
    return events.groupBy(label.alias("label")).agg(F.sum(k).alias("k"), F.max(F.get_json_object("props", "$.k")).alias("k_text"),
                                                    F.count(F.lit(1)).alias("n"))


# ---- reshaping and identity --------------------------------------------------

@query
def e1_attribute_pivot(x: Context) -> DataFrame:
    return pivot_attributes(x.raw.metafields, R.INVENTORY_ATTRIBUTES, newest=True)


@query
def e1_attribute_pivot_any_version(x: Context) -> DataFrame:
    return pivot_attributes(x.raw.metafields, R.SELLER_ATTRIBUTES, newest=False)


@query
def e2_first_quoted(x: Context) -> DataFrame:
    return x.raw.metafields.where("product_metafield_namespace = 'custom'").select(
        "product_id", "product_metafield_key", C.first_quoted("product_metafield_value").alias("value"))


@query
def e3_seller_rollup(x: Context) -> DataFrame:
    return identity.seller_rollup(x.facts.supplied_items())


@query
def e4_consignors(x: Context) -> DataFrame:
    return to_edge(identity.consignors(x.raw.customers).select("customer_id", "date", "customer_total_spent"))


@query
def e5_identity_by_id(x: Context) -> DataFrame:
    """Exact key: the customer id recorded with the item; a blank one is no id."""
    recorded = pivot_attributes(x.raw.metafields, R.SELLER_IDENTITY).where("seller_name <> ''")
    known = recorded.select("seller_name", F.nullif("seller_customer_id", F.lit("")).alias("seller_customer_id")).distinct()
    buyers = identity.consignors(x.raw.customers).select("customer_id", "customer_tags")
    return identity.match_by_id(known, buyers)


@query
def e5_identity_components(x: Context) -> DataFrame:
    """Who each key belongs to, when an item's seller name, recorded customer id and intake paper, and a customer's id and name,
    tie records together through any number of steps."""
    recorded = pivot_attributes(x.raw.metafields, R.SELLER_IDENTITY)
    paper = F.floor(F.col("product_id").cast("bigint") / 3).cast("string")  # three items come in on one paper
    sellers = recorded.select(F.col("seller_customer_id").alias("id"), C.name_key(F.col("seller_name")).alias("name"), paper.alias("paper"))
    buyers = x.facts.latest_customers().select(
        "customer_id", F.lower(C.full_name("customer_first_name", "customer_last_name")), F.lit(None).cast("string")
    ).toDF("id", "name", "paper")
    return identity.people(sellers.unionByName(buyers), {k: F.col(k) for k in ("id", "name", "paper")})


@query
def e5_seller_people(x: Context) -> DataFrame:
    """The seller fact with the person of each seller beside the published name match."""
    found = x.facts.seller(people=True)
    return found.select("seller_name", "contract_type", "store_location", "channel", "customer_id", "is_also_buyer", "person_id", "person_customers")


@query
def e6_preferred_store_and_channel(x: Context) -> DataFrame:
    return x.facts.preferred()


@query
def e7_inventory_to_sales_channel(x: Context) -> DataFrame:
    sold = best_row(x.facts.product_sales().select("product_id", "order_date", "channel", "store_location"), ["product_id"],
                    latest=["order_date", "channel", "store_location"])
    return x.facts.inventory().select("product_id", "store_location").withColumnRenamed("store_location", "stock_location").join(sold, "product_id", "left")


# ---- incremental and streaming -----------------------------------------------

@query
def i1_lookback_ingest(x: Context) -> DataFrame:
    """Two daily runs with overlapping look-back; the second replaces the days it covers."""
    path = x.folder("lookback")
    documents = order_payloads(x)
    columns = ["order_id", "date", "line_item__id", "order_financial_status", "order_net_sales"]
    runs = []
    for as_of in (date(2001, 7, 13), date(2001, 7, 15)):
        touched = incremental.recently_updated(documents, as_of)
        rows = payloads.flatten_orders(touched, "fixture-store", as_of).select(*columns)
        sinks.append(rows.withColumn("run_day", F.lit(as_of)), path, day="run_day")
        runs.append(as_of)
    landed = x.spark.read.parquet(path)
    return best_row(landed, ["order_id", "line_item__id"], latest=["run_day", "date"]).select("order_id", "line_item__id", "date", "run_day")


@query
def i1_refresh_months(x: Context) -> DataFrame:
    """Facts published from what had landed when May closed in the store's zone, then the later months refreshed."""
    root = x.folder("refresh")
    known = RawTables(lambda name: x.raw.orders.where("ingested_at < DATE '2001-06-02'"))
    warehouse.publish(Facts(known), root, ("daily_sales",))
    warehouse.refresh(x.facts, root, P.Period(date(2001, 6, 10)), ("daily_sales",))
    return to_edge(warehouse.PublishedFacts(x.spark, root).fact("daily_sales"))


@query
def i1_refresh_late_update(x: Context) -> DataFrame:
    """Published before orders of one month in four were ingested again; refreshed by what arrived since."""
    root = x.folder("late")
    today = date(2001, 9, 1)
    updated = x.raw.orders.withColumns(
        {
            "ingested_at": F.expr(f"CASE WHEN {_LATE} THEN DATE '{today}' ELSE ingested_at END"),
            "order_net_sales": F.expr(f"CASE WHEN {_LATE} THEN CAST(try_cast(order_net_sales AS DECIMAL(18,4)) * 2 AS STRING) ELSE order_net_sales END"),
        }
    )
    now = RawTables(lambda name: updated if name == "orders" else getattr(x.raw, name))
    warehouse.publish(x.facts, root, ("daily_sales",))
    warehouse.refresh(Facts(now), root, P.Period(today), ("daily_sales",))
    return to_edge(warehouse.PublishedFacts(x.spark, root).fact("daily_sales"))


@query
def i1_refresh_vanished(x: Context) -> DataFrame:
    """All orders of a month were withdrawn; after the refresh of that month nothing of it is left."""
    root = x.folder("vanished")
    rest = x.raw.orders.where("NOT (order_created_at >= '2000-04-03' AND order_created_at < '2000-06-03')")
    left = RawTables(lambda name: rest if name == "orders" else getattr(x.raw, name))
    warehouse.publish(x.facts, root, ("orders",))
    warehouse.refresh(Facts(left), root, P.Period(date(2000, 4, 1), date(2000, 6, 30)), ("orders",))
    published = warehouse.PublishedFacts(x.spark, root).fact("orders")
    return published.groupBy(F.trunc("order_date", "month").alias("month")).agg(F.count("order_id").alias("orders"))


#: Rows that land after the first build although their own dates are old: by raw table.
_OLD_BUT_NEW = {
    "orders": "substring(order_created_at, 1, 7) IN ('1999-11', '1997-02')",
    "refunds": "trunc(date, 'month') = DATE '1998-03-01'",
    "products": "CAST(product_id AS INT) % 15 = 0",
}
_LEDGER_FACTS = {
    "orders": ("order_date", "gross_profit"), "daily_sales": ("order_date", "net_sales"),
    "product_sales": ("order_date", "gross_profit"), "refunds": ("refund_date", "total_refunded"),
}


@query
def i1_ledger_refresh(x: Context) -> DataFrame:
    """Facts published, then late refunds, costs and orders land and the ledger of files says what to build again."""
    raw, root = x.folder("ledger-raw"), x.folder("ledger-facts")

    def land(late: bool) -> None:
        for table, old in _OLD_BUT_NEW.items():
            rows = contracts.conform(getattr(x.raw, table), table).where(F.coalesce(F.expr(old), F.lit(False)) == F.lit(late))
            rows.write.mode("append").option("compression", "zstd").parquet(f"{raw}/{table}")
            released(x.spark)

    land(late=False)
    books = ledger.Ledger(x.spark, raw, x.folder("ledger"))
    warehouse.refresh_arrived(books, root, tuple(_LEDGER_FACTS))
    land(late=True)
    warehouse.refresh_arrived(books, root, tuple(_LEDGER_FACTS))
    published, parts = warehouse.PublishedFacts(x.spark, root), []
    for name, (day, amount) in _LEDGER_FACTS.items():
        by_month = published.fact(name).groupBy(F.trunc(day, "month").alias("month"))
        sums = by_month.agg(F.count(F.lit(1)).alias("rows"), F.sum(amount).cast("double").alias("amount"))
        parts.append(sums.select(F.lit(name).alias("fact"), "month", "rows", "amount"))
    return reduce(DataFrame.unionByName, parts)


#: Orders of January, May and September, ingested again long after.
_LATE = "month IN ('01', '05', '09')"


def _landing(x: Context, df: DataFrame, label: str) -> str:
    path = x.folder(label)
    df.write.parquet(path)
    return path


_HEADER = ("order_id", "date", "order_created_at", "order_app_name", "order_financial_status", "order_test", "order_net_sales",
           "order_shipping_price")


@query
def i2_drop_repeats_stream(x: Context) -> DataFrame:
    """Everything ingested, and exact copies of a third of it, one file per micro-batch in no order of time."""
    rows = x.headers().select("ingested_at", *_HEADER)
    landing = _landing(x, rows.unionByName(rows.where("CAST(order_id AS BIGINT) % 3 = 0")).repartition(3), "repeats-in")
    stream = jobs.follow(x.spark, landing, rows.schema, files_per_batch=1)
    out = x.folder("repeats-out")
    jobs.drain(jobs.drop_repeats(stream, ["order_id", "ingested_at"]).drop(jobs.ARRIVED), out, x.folder("repeats-check"))
    return x.spark.read.schema(rows.schema).parquet(out).select("order_id", "ingested_at", "order_created_at", "order_app_name")


@query
def i2_latest_wins_stream(x: Context) -> DataFrame:
    """Late records update what is stored: each micro-batch is appended, and reading takes the newest row."""
    rows = x.raw.meta_ads.select("date", "campaign_id", "ad_id", "spend").withColumn("version", F.lit(1))
    later = rows.where("CAST(ad_id AS BIGINT) % 4 = 0").select("date", "campaign_id", "ad_id", (F.col("spend") + 1).cast(R.MONEY).alias("spend"), F.lit(2).alias("version"))
    first, second = _landing(x, rows, "wins-in"), _landing(x, later, "wins-late")
    table, check = x.folder("wins-table"), x.folder("wins-check")
    for source, name in ((first, "first"), (second, "late")):
        newest = changes.LatestRows(table, rows.schema, ["date", "ad_id"], ["version"], stream=name)
        stream = jobs.follow(x.spark, source, rows.schema).drop(jobs.ARRIVED)
        jobs.drain_each(stream, newest.step, f"{check}/{name}")
    return to_edge(newest.read(x.spark))


@query
def i3_status_history(x: Context) -> DataFrame:
    """One row per order and ingest day: an order ingested on two days keeps both."""
    rows = x.headers().select("order_id", "date", "order_financial_status", "order_location_name")
    daily = best_row(rows, ["order_id", "date"], prefer=[located_first()])
    return daily.groupBy("order_id").agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query
def i4_rolling_repull(x: Context) -> DataFrame:
    path = x.folder("repull")
    metrics_rows = x.raw.email_metrics.select("date", "campaign_id", F.col("sends").cast("bigint").alias("sends"))
    sinks.append(metrics_rows.withColumn("sends", F.lit(0).cast("bigint")), path)
    # The pull of one day came back empty: that day's rows go.
    incremental.repull(metrics_rows.where("date <> DATE '2001-07-20'"), path, date(2001, 8, 4), days=20)
    return x.spark.read.schema(metrics_rows.schema).parquet(path).groupBy("date").agg(F.sum("sends").alias("sends"), F.count(F.lit(1)).alias("n"))


@query
def i5_daily_sales_stream(x: Context) -> DataFrame:
    """The daily fact's sales from a stream of all ingested headers, late repeats included, in several micro-batches."""
    rows = x.headers().select("ingested_at", "order_processed_at", "order_subtotal_price", "order_location_name", *_HEADER)
    landing = _landing(x, rows.repartition(2), "sales-in")
    job = changes.DailySales(x.folder("sales"))
    jobs.drain_each(jobs.follow(x.spark, landing, rows.schema, files_per_batch=1), job.step, x.folder("sales-check"))
    return to_edge(job.read(x.spark))


@query
def i6_backfill_by_creation(x: Context) -> DataFrame:
    documents = order_payloads(x)
    chosen = incremental.created_between(documents, P.Period(date(2001, 1, 1), date(2001, 6, 30)))
    rows = payloads.flatten_orders(chosen, "fixture-store", RUN_DAY)
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("order_id").alias("orders"))


# ---- quality -----------------------------------------------------------------

@query
def v1_load_report(x: Context) -> DataFrame:
    return quality.load_report(x.raw.orders, "order_id", ["order_location_name", "order_customer_id"])


@query
def v1_consignor_report(x: Context) -> DataFrame:
    tagged = C.has_tag("customer_tags")
    return x.raw.customers.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct("customer_id").alias("unique_customers"),
                               F.count_if(F.col("customer_tags") != "").alias("has_tags"), F.count_if(tagged).alias("consignors"),
                               F.count_if(tagged & (F.col("customer_orders_count") > 0)).alias("consignor_buyers"))


@query
def v2_row_delta(x: Context) -> DataFrame:
    before = x.raw.orders.select("date", "order_id", "line_item__id")
    return quality.row_delta(before, before.distinct())


@query
def v3_cost_coverage(x: Context) -> DataFrame:
    return quality.coverage(x.raw.products, {"cost_pct": F.col("product_variant_inventory_item_cost").isNotNull()}, ["product_vendor"])


@query
def v3_location_coverage(x: Context) -> DataFrame:
    flags = {"store_pct": F.col("order_location_name").isNotNull(), "customer_pct": F.col("order_customer_id").isNotNull()}
    return quality.coverage(x.headers().withColumn("channel", C.sales_channel()), flags, ["channel"])


@query
def v4_reconcile(x: Context) -> DataFrame:
    ours = x.facts.clean_orders(columns={"year", "net_sales"}).select("year", F.col("net_sales").alias("value"))
    shop = x.tables.table("orders").selectExpr("CAST(year(o_orderdate) AS STRING) AS year", "CAST(o_totalprice AS DECIMAL(18,4)) AS value")
    return to_edge(quality.reconcile(ours, shop, "year", "value", 5.0))


@query
def v4_row_differences(x: Context) -> DataFrame:
    """The very orders in which an outside copy differs: some amounts and days are other ones, some orders are missing, some more."""
    ours = x.facts.clean_orders(columns={"order_date", "channel", "net_sales", "shipping_revenue"})
    key = F.col("order_id").cast("bigint")
    copy = ours.where(key % 701 != 0).withColumns({
        "net_sales": F.when(key % 501 == 0, F.col("net_sales") + 1).otherwise(F.col("net_sales")).cast(R.MONEY),
        "order_date": F.when(key % 601 == 0, F.date_add("order_date", 1)).otherwise(F.col("order_date")),
    })
    more = ours.where(key % 901 == 0).withColumn("order_id", F.concat("order_id", F.lit("-x")))
    return quality.row_differences(ours, copy.unionByName(more), ["order_id"], ["channel", "net_sales", "shipping_revenue"], "order_date")


@query
def v5_duplicates(x: Context) -> DataFrame:
    return quality.duplicates(x.raw.orders, ["order_id", "line_item__id"])


@query
def v6_overlap_summary(x: Context) -> DataFrame:
    return quality.overlap_summary(x.raw.customers)


# ---- corrected forms of known quirks -----------------------------------------

@query
def z1_refunds_on_source_day(x: Context) -> DataFrame:
    rows = x.facts.refunds(refund_date_mode="source_day")
    return to_edge(rows.groupBy("refund_date").agg(F.count(F.lit(1)).alias("n"), F.sum("total_refunded").alias("total_refunded")))


@query
def z2_dead_stock_without_undated(x: Context) -> DataFrame:
    stock = x.facts.inventory(unknown_bucket="unknown")
    return stock.groupBy("aging_bucket").agg(F.sum("units_on_hand").alias("units"))


@query
def z7_acquisition_cost_as_published(x: Context) -> DataFrame:
    return metrics.acquisition_cost_as_published(x.facts, AS_OF)


@query
def z8_adjustments_once_per_refund(x: Context) -> DataFrame:
    rows = x.facts.refunds(adjustments="first_line")
    return to_edge(rows.groupBy("order_id", "refund_id").agg(F.sum("refund_shipping").alias("shipping"), F.sum("refund_discrepancy").alias("discrepancy"),
                                                             F.sum("total_refunded").alias("total_refunded")))


@query
def z27_net_after_returns(x: Context) -> DataFrame:
    """Net sales with returns taken off, per month of sale and of refund."""
    sold = x.facts.clean_orders(columns={"order_date", "net_sales"}).select(F.trunc("order_date", "month").alias("month"), "net_sales")
    back = x.facts.refunds().select(F.trunc("refund_date", "month").alias("month"), F.col("total_refunded").alias("returned"))
    sold, back = sold.groupBy("month").agg(F.sum("net_sales").alias("net_sales")), back.groupBy("month").agg(F.sum("returned").alias("returned"))
    both = sold.unionByName(back, allowMissingColumns=True).groupBy("month").agg(F.sum("net_sales").alias("net_sales"), F.sum("returned").alias("returned"))
    zero = F.lit(0).cast(R.MONEY)
    return to_edge(both.withColumn("net_after_returns", F.coalesce("net_sales", zero) - F.coalesce("returned", zero)))


@query
def z11_refunds_by_line(x: Context) -> DataFrame:
    """Refunds with two lines of the same amounts, landed twice: one line by amounts, as published, two by the id of the line."""
    line = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,4)), CAST(l_quantity AS BIGINT), '{}')"
    item = """named_struct('id', {}, 'quantity', CAST(l_quantity AS BIGINT), 'subtotal', CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS STRING), 'total_tax', '0')"""
    a, b = (item.format(line.format(k)) for k in "ab")
    again = x.tables.table("lineitem").where("l_returnflag = 'R'").withColumn("later", F.explode(F.array(F.lit(0), F.lit(1))))
    docs = _documents(
        again, "refund", id="l_orderkey", name="concat('#', l_orderkey)",
        refunds=f"""array(named_struct('id', l_orderkey * 10 + l_linenumber, 'created_at', concat(CAST(l_shipdate AS DATE) + later, 'T03:00:00Z'),
            'order_adjustments', NULL, 'refund_line_items', CASE WHEN l_linenumber % 3 = 0 THEN array({a}, {b}) ELSE array({a}) END))""",
    )
    facts = Facts(RawTables(lambda name: payloads.flatten_refunds(docs, "fixture-store", RUN_DAY) if name == "refunds" else getattr(x.raw, name)))
    parts = []
    for by in ("amounts", "line"):
        sums = facts.clean_refunds(key=by).groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("line_item__refunds_subtotal").alias("subtotal"))
        parts.append(sums.withColumn("by", F.lit(by)))
    return to_edge(reduce(DataFrame.unionByName, parts))
