"""Raw tables derived from the synthetic star-schema tables, so every query has real input to grow with.

The star schema knows no shops, sellers or campaigns; the expressions below derive them from keys so
that each clean-up rule meets its hard cases: repeated ingests, missing stores, unreadable amounts,
orders without lines, undated stock, namesakes. ``FIXTURES.md`` lists the same expressions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resalelake.session import pin_runtime
from resalelake.sources.raw import RawTables

AS_OF = date(2001, 7, 15)

# table -> declared schema, columns that identify a row
TABLES = {
    "region": ("r_regionkey int, r_name string", ("r_regionkey",)),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", ("n_nationkey",)),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ("c_custkey",),
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ("p_partkey",),
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string",
        ("o_orderkey",),
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz",
        ("l_orderkey", "l_linenumber"),
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        ("event_id",),
    ),
}

# Tables that grow with orders; the others are small enough for one task.
SPREAD = ("orders", "lineitem", "events", "part", "customer")

#: Bytes of Parquet that a task multiplies: a product becomes up to 16 attribute rows, a customer up to two versions, an order up to
#: two for each of its lines. Clean-up sorts the rows of a task, so a task's memory follows these and not the size of a file.
DEALT = {"part": 1 << 20, "customer": 8 << 20, "orders": 2 << 20}

#: An order's key as the raw tables have it: orders are dealt out and meet their lines by it.
ORDER, LINE_ORDER = "CAST(o_orderkey AS STRING)", "CAST(l_orderkey AS STRING)"


def _select(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*[f"{c} AS {name}" for name, c in columns.items()])


def _periods(day: str) -> dict[str, str]:
    return {
        "week": f"CAST(weekofyear({day}) AS STRING)",
        "year": f"CAST(year({day}) AS STRING)",
        "year_month": f"concat_ws('|', CAST(year({day}) AS STRING), CAST(month({day}) AS STRING))",
    }


def _versions(df: DataFrame, when: str | None = None) -> DataFrame:
    """Two rows per input row, ``old`` 0 and 1; with ``when`` only matching rows get the second."""
    flags = "array(0, 1)" if when is None else f"CASE WHEN {when} THEN array(0, 1) ELSE array(0) END"
    return df.withColumn("old", F.expr(f"explode({flags})"))


class DriverTables:
    def __init__(self, spark: SparkSession, folder: str, spread: int | None = None):
        """``spread``: distribute each table's rows by key over so many tasks after reading. For single files of one
        row group, which one task would read and work on alone. Unless given, tables whose rows are multiplied are dealt
        out by their bytes (``DEALT``), the others not."""
        self.spark = pin_runtime(spark)
        self.folder = folder.rstrip("/")
        self.spread = spread

    def table(self, name: str) -> DataFrame:
        """A driver table under its declared schema."""
        schema, key = TABLES[name]
        df = self.spark.read.schema(schema).parquet(f"{self.folder}/{name}.parquet")
        if name not in SPREAD:
            return df
        tasks = self.spread or self._tasks(name)
        by = [F.expr(ORDER)] if name == "orders" else key
        return df.repartition(tasks, *by) if self.spread or tasks > 1 else df

    def _tasks(self, name: str) -> int:
        """How many tasks a table is dealt out to by its bytes."""
        if name not in DEALT:
            return 1
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return -(-files.getContentSummary(path).getLength() // DEALT[name])

    def orders(self) -> DataFrame:
        price = "CAST(o_totalprice AS DECIMAL(18,4))"
        day = "CAST(o_orderdate AS DATE)"
        items = self.table("lineitem")
        # Per-order quantity comes from its own partial aggregate instead of a window over the join.
        quantity = items.groupBy(F.expr(f"{LINE_ORDER} AS q_order")).agg(
            F.expr("CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS order_quantity")
        )
        # The repeated ingest comes two days later and lost its store. Exploding before the join
        # keeps one scan of each table, and lets header-only readers skip the line items.
        headers = _versions(self.table("orders"), "o_orderkey % 5 = 0")
        # Rows meet as they were read, and the raw columns are made of them afterwards, so the joins move few bytes. They
        # meet by the text that becomes order_id, so readers that choose rows by order find its rows in one task already.
        joined = headers.join(quantity, F.expr(f"{ORDER} = q_order"), "left").join(items, F.expr(f"{ORDER} = {LINE_ORDER}"), "left")
        return _select(
            joined,
            account_name="'fixture-store'",
            date=f"{day} + old * 2",
            ingested_at=f"{day} + old * 2",
            month=f"lpad(CAST(month({day}) AS STRING), 2, '0')",
            **_periods(day),
            source="'fixture'",
            order_id=ORDER,
            order_name="concat('#', CAST(o_orderkey AS STRING))",
            order_created_at="concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T', "
            "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':15:00Z')",
            order_processed_at="concat(CAST(CAST(o_orderdate AS DATE) + 2 AS STRING), 'T', "
            "lpad(CAST(o_orderkey % 20 AS STRING), 2, '0'), ':40:00Z')",
            order_app_name="CASE o_orderpriority WHEN '1-URGENT' THEN 'Point of Sale' "
            "WHEN '2-HIGH' THEN 'Online Store' WHEN '3-MEDIUM' THEN 'Shop' "
            "WHEN '4-NOT SPECIFIED' THEN 'Draft Orders' "
            "ELSE CASE WHEN o_orderkey % 2 = 0 THEN '3890849' ELSE '2329312' END END",
            order_currency="'CAD'",
            order_financial_status="CASE WHEN o_orderkey % 97 = 0 THEN 'CANCELLED' "
            "WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'PARTIALLY_REFUNDED' "
            "WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'PAID' END",
            order_test="CASE WHEN o_orderkey % 89 = 0 THEN 'True' WHEN o_orderkey % 7 = 0 THEN NULL "
            "ELSE 'False' END",
            order_net_sales=f"CASE WHEN o_orderkey % 211 = 0 THEN 'n/a' ELSE CAST({price} AS STRING) END",
            order_subtotal_price=price,
            order_total_price=f"CAST({price} * 1.12 AS DECIMAL(18,4))",
            order_total_discounts=f"CAST({price} * 0.05 AS DECIMAL(18,4))",
            order_shipping_price="CAST(o_orderkey % 30 AS DECIMAL(18,4))",
            order_total_tax_amount=f"CAST({price} * 0.12 AS DECIMAL(18,4))",
            order_shipping_address_country="CASE o_custkey % 4 WHEN 0 THEN 'United States' WHEN 1 THEN NULL "
            "ELSE 'Canada' END",
            order_shipping_address_province="CASE o_custkey % 5 WHEN 0 THEN 'Alberta' WHEN 1 THEN 'Ontario' "
            "WHEN 2 THEN NULL ELSE 'British Columbia' END",
            order_location_id="CASE WHEN old = 1 OR o_orderkey % 3 = 0 THEN NULL "
            "ELSE CAST(o_orderkey % 5 AS STRING) END",
            order_location_name="CASE WHEN old = 1 OR o_orderkey % 3 = 0 THEN NULL "
            "ELSE concat('Store ', CAST(o_orderkey % 5 AS STRING)) END",
            order_customer_id="CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
            order_customer_last_visit_utm_source="CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'google' "
            "WHEN 2 THEN 'meta' ELSE 'email' END",
            order_customer_last_visit_utm_medium="CAST(NULL AS STRING)",
            order_customer_last_visit_utm_campaign="CAST(NULL AS STRING)",
            order_quantity="order_quantity",
            line_item__id="concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
            line_item__product_id="CAST(l_partkey AS STRING)",
            line_item__title="CASE WHEN l_partkey % 50 = 0 THEN 'Gift Card' "
            "WHEN l_partkey % 50 = 1 THEN 'paper bag' ELSE concat('Item ', CAST(l_partkey AS STRING)) END",
            line_item__sku="concat('SKU-', CAST(l_partkey AS STRING))",
            line_item__vendor="concat('Brand#', CAST(l_partkey % 25 AS STRING))",
            line_item__quantity="CAST(l_quantity AS DECIMAL(18,4))",
            line_item__price="CAST(l_extendedprice AS DECIMAL(18,4))",
            line_item__total_discount="CAST(CAST(l_extendedprice AS DECIMAL(18,4)) "
            "* CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(18,4))",
            line_item__variant_unit_cost="CAST(NULL AS DECIMAL(18,4))",
        )

    def products(self) -> DataFrame:
        return _select(
            _versions(self.table("part")),
            date="CASE WHEN old = 1 THEN DATE '2001-06-14' ELSE DATE '2001-07-14' END",
            product_id="CAST(p_partkey AS STRING)",
            product_title="p_name",
            product_type="p_type",
            product_vendor="p_brand",
            product_status="CASE WHEN p_partkey % 13 = 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END",
            product_tags="concat('size-', CAST(p_size AS STRING))",
            product_inventory_quantity="CAST(p_partkey % 4 + old AS DECIMAL(18,4))",
            product_price="CAST(p_retailprice AS DECIMAL(18,4))",
            product_variant_inventory_item_cost="CASE WHEN p_partkey % 5 = 0 THEN "
            "CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.4 AS DECIMAL(18,4)) END",
            product_created_at_datetime="'2000-01-01T00:00:00Z'",
            product_updated_at_datetime="CASE WHEN old = 1 THEN '2001-06-14T10:00:00Z' "
            "ELSE '2001-07-14T10:00:00Z' END",
        )

    def metafields(self) -> DataFrame:
        slots = F.expr(
            "explode(array(named_struct('ns', 'buy', 'k', 'contract_type'), named_struct('ns', 'buy', 'k', 'date'), "
            "named_struct('ns', 'buy', 'k', 'seller_name'), named_struct('ns', 'buy', 'k', 'msrp'), "
            "named_struct('ns', 'buy', 'k', 'condition_notes'), named_struct('ns', 'buy', 'k', 'customer_id'), named_struct('ns', 'custom', 'k', 'condition'), "
            "named_struct('ns', 'custom', 'k', 'location')))"
        )
        base = self.table("part").where("p_partkey % 10 <> 9").withColumn("a", slots)
        return _select(
            _versions(base),
            date="DATE '2001-07-14'",
            product_id="CAST(p_partkey AS STRING)",
            product_title="p_name",
            product_metafield_namespace="a.ns",
            product_metafield_key="a.k",
            product_metafield_type="'text'",
            product_metafield_update_at="CASE WHEN old = 1 THEN '2001-05-01T00:00:00Z' "
            "ELSE '2001-07-01T00:00:00Z' END",
            product_metafield_value="CASE a.k "
            "WHEN 'contract_type' THEN CASE (p_partkey + old) % 4 WHEN 0 THEN 'consignment' "
            "WHEN 1 THEN 'buyout' WHEN 2 THEN 'store_credit' END "
            "WHEN 'date' THEN CASE WHEN p_partkey % 17 = 0 THEN 'unknown' "
            "ELSE CAST(DATE '2001-07-14' - CAST(p_partkey % 400 AS INT) AS STRING) END "
            "WHEN 'seller_name' THEN CASE WHEN p_partkey % 6 = 0 THEN '' "
            "ELSE concat(' CUSTOMER #', lpad(CAST(p_partkey % 300 AS STRING), 9, '0')) END "
            "WHEN 'msrp' THEN CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS STRING) "
            "WHEN 'condition_notes' THEN 'ok' "
            "WHEN 'customer_id' THEN CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_partkey % 300 AS STRING) END "
            "WHEN 'condition' THEN CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END "
            "ELSE concat('[\"Store ', CAST(p_partkey % 5 AS STRING), '\"]') END",
        )

    def customers(self) -> DataFrame:
        spent = "CASE WHEN c_custkey % 5 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(abs(c_acctbal) AS DECIMAL(18,4)) END"
        return _select(
            _versions(self.table("customer"), "c_custkey % 3 = 0"),
            date="CASE WHEN old = 1 THEN DATE '2001-06-14' ELSE DATE '2001-07-14' END",
            customer_id="CAST(c_custkey AS STRING)",
            customer_first_name="'Customer'",
            customer_last_name="concat('#', lpad(CAST(c_custkey AS STRING), 9, '0'))",
            customer_created_at="concat(CAST(DATE '1995-01-01' + CAST(c_custkey * 37 % 2390 AS INT) AS STRING), "
            "'T08:00:00Z')",
            customer_updated_at="CASE WHEN old = 1 THEN '2001-06-14T09:00:00Z' ELSE '2001-07-14T09:00:00Z' END",
            customer_currency="'CAD'",
            customer_default_address_city="concat('City ', CAST(c_nationkey AS STRING))",
            customer_default_address_country="CASE WHEN c_nationkey % 6 = 0 THEN '' "
            "ELSE concat('NATION_', CAST(c_nationkey AS STRING)) END",
            customer_default_address_country_code="concat('N', CAST(c_nationkey AS STRING))",
            customer_orders_count="CAST(c_custkey % 5 AS DECIMAL(18,4))",
            customer_total_spent=spent,
            customer_aov="CASE WHEN c_custkey % 5 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(ROUND(CAST("
            "CAST(CAST(abs(c_acctbal) AS DECIMAL(18,4)) AS DOUBLE) / (c_custkey % 5) "
            "AS DECIMAL(28,10)), 2) AS DECIMAL(18,4)) END",
            customer_is_returning="CASE WHEN c_custkey % 5 > 1 THEN 'True' ELSE 'False' END",
            customer_tags="CASE WHEN c_custkey % 4 = 0 THEN 'vip, Cognito-Consignment-Update' ELSE 'vip' END",
            customer_note="CASE c_custkey % 6 WHEN 0 THEN 'Wants to CONSIGN bags' "
            "WHEN 1 THEN concat('May sell to us: ', c_mktsegment) WHEN 2 THEN NULL ELSE c_mktsegment END",
        )

    def refunds(self) -> DataFrame:
        day = "(CAST(l_shipdate AS DATE) + 10)"
        price = "CAST(l_extendedprice AS DECIMAL(18,4))"
        return _select(
            self.table("lineitem").where("l_returnflag = 'R'"),
            date=day,
            account_name="'fixture-store'",
            order_id="CAST(l_orderkey AS STRING)",
            order_name="concat('#', CAST(l_orderkey AS STRING))",
            source="'fixture'",
            order_refunds="concat('gid://fixture/Refund/', CAST(l_orderkey * 10 + l_linenumber % 2 AS STRING))",
            order_refund_discrepancy_amount="CASE WHEN l_orderkey % 8 = 0 THEN CAST(1.5 AS DECIMAL(18,4)) "
            "ELSE CAST(0 AS DECIMAL(18,4)) END",
            order_total_shipping_refunded_price="CASE WHEN l_orderkey % 6 = 0 THEN CAST(9.99 AS DECIMAL(18,4)) "
            "ELSE CAST(0 AS DECIMAL(18,4)) END",
            line_item__refunds_quantity="CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,4)) END",
            line_item__refunds_subtotal="CASE WHEN l_linenumber = 7 THEN NULL "
            f"WHEN l_linenumber = 6 THEN CAST(0 AS DECIMAL(18,4)) ELSE {price} END",
            line_item__refunds_total_tax="CASE WHEN l_linenumber = 7 THEN NULL "
            f"ELSE CAST({price} * CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)) END",
            **_periods(day),
        )

    def meta_ads(self) -> DataFrame:
        bought = "CASE WHEN event_type = 'purchase' THEN {} ELSE {} END"
        zero = "CAST(0 AS DECIMAL(18,4))"
        return _select(
            self.table("events").where("event_id % 2 = 0"),
            date="make_date(2001, 7, day(ts))",
            campaign_id="concat('m', CAST(user_id % 12 AS STRING))",
            campaign_name="concat('Campaign ', CAST(user_id % 12 AS STRING))",
            adset_id="CAST(user_id AS STRING)",
            adset_name="concat('Set ', CAST(user_id AS STRING))",
            ad_id="CAST(event_id AS STRING)",
            ad_name="event_type",
            spend="CAST(value AS DECIMAL(18,4))",
            impressions="event_id % 1000",
            clicks="event_id % 50",
            reach="event_id % 700",
            purchases=bought.format("1L", "0L"),
            purchase_value=bought.format("CAST(CAST(value AS DECIMAL(18,4)) * 3 AS DECIMAL(18,4))", zero),
            purchase_roas=bought.format("CAST(3 AS DECIMAL(18,4))", zero),
            account_currency="'CAD'",
        )

    def google_ads(self) -> DataFrame:
        bought = "CASE WHEN event_type = 'purchase' THEN {} ELSE {} END"
        return _select(
            self.table("events").where("event_id % 2 = 1"),
            date="make_date(2001, 7, day(ts))",
            campaign_id="concat('g', CAST(user_id % 9 AS STRING))",
            campaign_name="concat('Search ', CAST(user_id % 9 AS STRING))",
            ad_group_id="''",
            ad_group_name="''",
            ad_id="''",
            ad_name="''",
            spend="CAST(value AS DECIMAL(18,4))",
            impressions="event_id % 900",
            clicks="event_id % 40",
            conversions=bought.format("CAST(1.5 AS DECIMAL(18,4))", "CAST(0 AS DECIMAL(18,4))"),
            conversion_value=bought.format(
                "CAST(CAST(value AS DECIMAL(18,4)) * 2 AS DECIMAL(18,4))", "CAST(0 AS DECIMAL(18,4))"
            ),
            roas="CASE WHEN event_id % 31 = 0 THEN 'n/a' ELSE '2.0' END",
            account_currency="'CAD'",
        )

    def email_campaigns(self) -> DataFrame:
        return _select(
            _versions(self.table("events").select("user_id").distinct()),
            campaign_id="concat('e', CAST(user_id AS STRING))",
            campaign_name="concat('Mail ', CAST(user_id AS STRING), CASE WHEN old = 1 THEN ' draft' ELSE '' END)",
            status="CASE WHEN old = 1 THEN 'Draft' ELSE 'Sent' END",
            send_time="CASE WHEN old = 1 THEN '2001-06-01T15:00:00Z' "
            "ELSE concat('2001-07-', lpad(CAST(user_id % 14 + 1 AS STRING), 2, '0'), 'T15:00:00Z') END",
        )

    def email_metrics(self) -> DataFrame:
        daily = self.table("events").groupBy("user_id", F.expr("CAST(ts AS DATE) AS d")).agg(F.count(F.lit(1)).alias("n"))
        return _select(
            daily,
            date="make_date(2001, 7, day(d))",
            campaign_id="concat('e', CAST(user_id + 2 AS STRING))",
            sends="n * 100",
            unique_opens="n * 40",
            unique_clicks="n * 7",
            open_rate="CAST(0.4 AS DECIMAL(18,4))",
            click_rate="CAST(CAST(user_id % 10 AS DECIMAL(18,4)) * 0.01 AS DECIMAL(18,4))",
            unsubscribes="n % 3",
            revenue="CAST(0 AS DECIMAL(18,4))",
        )

    def email_lists(self) -> DataFrame:
        """One list per event type."""
        return _select(
            self.table("events").groupBy("event_type").agg(F.min("user_id").alias("owner")),
            date="DATE '2001-07-14'",
            list_id="concat('list-', event_type)",
            list_name="event_type",
            created="concat('2001-07-', lpad(CAST(owner % 14 + 1 AS STRING), 2, '0'), 'T00:00:00Z')",
        )

    def email_messages(self) -> DataFrame:
        """One message per sent campaign."""
        return _select(
            self.table("events").select("user_id").distinct(),
            message_id="concat('msg-', CAST(user_id AS STRING))",
            campaign_id="concat('e', CAST(user_id AS STRING))",
            subject_line="concat('News ', CAST(user_id AS STRING))",
            from_email="'shop@example.com'",
            from_label="'Shop'",
        )

    def raw(self) -> RawTables:
        return RawTables(lambda name: getattr(self, name)())
