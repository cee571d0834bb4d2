"""Declared schemas of the raw tables, and the check that data keeps to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_M = "decimal(18,4)"

RAW_DDL = {
    "orders": f"""
        account_name string, date date, line_item__id string, line_item__price {_M},
        line_item__product_id string, line_item__quantity {_M}, line_item__sku string,
        line_item__title string, line_item__total_discount {_M}, line_item__variant_unit_cost {_M},
        line_item__vendor string, month string, order_app_name string, order_created_at string,
        order_currency string, order_customer_last_visit_utm_campaign string,
        order_customer_last_visit_utm_medium string, order_customer_last_visit_utm_source string,
        order_financial_status string, order_id string, order_name string, order_net_sales string,
        order_processed_at string, order_quantity {_M}, order_shipping_address_country string,
        order_shipping_address_province string, order_shipping_price {_M}, order_subtotal_price {_M},
        order_test string, order_total_discounts {_M}, order_total_price {_M}, source string,
        week string, year string, year_month string, order_total_tax_amount {_M},
        order_location_id string, order_location_name string, order_customer_id string,
        ingested_at date""",
    "customers": f"""
        date date, customer_id string, customer_first_name string, customer_last_name string,
        customer_created_at string, customer_updated_at string, customer_currency string,
        customer_default_address_city string, customer_default_address_country string,
        customer_default_address_country_code string, customer_orders_count {_M},
        customer_total_spent {_M}, customer_aov {_M}, customer_is_returning string, customer_tags string,
        customer_note string""",
    "products": f"""
        date date, product_id string, product_title string, product_description string,
        product_handle string, product_image_src string, product_inventory_quantity {_M},
        product_price {_M}, product_status string, product_tags string, product_type string,
        product_created_at_datetime string, product_updated_at_datetime string,
        product_variant_inventory_item_cost {_M}, product_vendor string""",
    "metafields": """
        date date, product_id string, product_title string, product_metafield_key string,
        product_metafield_namespace string, product_metafield_type string,
        product_metafield_update_at string, product_metafield_value string""",
    "refunds": f"""
        date date, account_name string, order_id string, order_name string, source string,
        order_refunds string, order_refund_discrepancy_amount {_M},
        order_total_shipping_refunded_price {_M}, line_item__refunds string,
        line_item__refundable_quantity {_M}, line_item__refunds_price {_M},
        line_item__refunds_quantity {_M}, line_item__refunds_subtotal {_M},
        line_item__refunds_total_tax {_M}, week string, year string, year_month string""",
    "meta_ads": f"""
        date date, campaign_id string, campaign_name string, adset_id string, adset_name string,
        ad_id string, ad_name string, spend {_M}, impressions bigint, clicks bigint, reach bigint,
        purchases bigint, purchase_value {_M}, purchase_roas {_M}, account_currency string,
        synced_at timestamp""",
    "google_ads": f"""
        date date, campaign_id string, campaign_name string, ad_group_id string, ad_group_name string,
        ad_id string, ad_name string, spend {_M}, impressions bigint, clicks bigint,
        conversions {_M}, conversion_value {_M}, roas string, account_currency string,
        synced_at timestamp""",
    "email_campaigns": """
        campaign_id string, campaign_name string, status string, archived boolean, send_time string,
        created_at string, updated_at string, synced_at timestamp""",
    "email_lists": """
        date date, list_id string, list_name string, created string, updated string,
        synced_at timestamp""",
    "email_messages": """
        message_id string, campaign_id string, subject_line string, from_email string,
        from_label string, synced_at timestamp""",
    "email_metrics": f"""
        date date, campaign_id string, campaign_name string, send_date date, sends bigint,
        deliveries bigint, opens bigint, unique_opens bigint, open_rate {_M}, clicks bigint,
        unique_clicks bigint, click_rate {_M}, unsubscribes bigint, bounces bigint, revenue {_M},
        conversions bigint, synced_at timestamp""",
}


def contract(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_DDL[table])


def scan(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a landed raw table under its contract; nothing is inferred."""
    return spark.read.schema(contract(table)).format(fmt).load(path)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the contract: declared order, tolerant casts, missing columns as null, extras dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in contract(table).fields
        ]
    )


def widen(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows that carry new columns; older rows read null there."""
    return old.unionByName(new, allowMissingColumns=True)


def schema_differences(df: DataFrame, table: str) -> dict[str, str]:
    """Columns that are missing, unexpected or differently typed (schema only, reads no data)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract(table).fields}
    out = {name: "missing" for name in want if name not in have}
    out |= {name: "unexpected" for name in have if name not in want}
    out |= {
        name: f"{have[name].simpleString()} instead of {want[name].simpleString()}"
        for name in want
        if name in have and have[name] != want[name]
    }
    return out


def unreadable(c: str, target: str | T.DataType) -> Column:
    """True where text is present but cannot be read as the target type."""
    return F.col(c).isNotNull() & F.col(c).try_cast(target).isNull()


def cast_failures(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """One row per checked column: filled values and values that will not cast. One pass over the table."""
    counted = [
        F.struct(F.lit(c).alias("column_name"), F.count(c).alias("filled"), F.count_if(unreadable(c, t)).alias("unreadable"))
        for c, t in targets.items()
    ]
    return df.agg(F.array(*counted).alias("found")).select(F.inline("found"))


def contract_report(df: DataFrame, table: str) -> DataFrame:
    """One row per column of the contract or the data, in one pass: ok, missing, unexpected or of another type, and how many
    values are filled and how many of those would be lost by the cast to the contract's type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract(table).fields}
    found = []
    for name in [*want, *[c for c in have if c not in want]]:
        declared, actual = want.get(name), have.get(name)
        status = "missing" if actual is None else "unexpected" if declared is None else "ok" if declared == actual else "type"
        lost = F.count_if(unreadable(f"`{name}`", declared)) if status == "type" else F.lit(0)
        found.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(status).alias("status"),
                F.lit(declared.simpleString() if declared else None).cast("string").alias("expected"),
                F.lit(actual.simpleString() if actual else None).cast("string").alias("found"),
                F.count(F.lit(1)).alias("rows"),
                (F.lit(0) if actual is None else F.count(F.col(f"`{name}`"))).cast("bigint").alias("filled"),
                lost.cast("bigint").alias("unreadable"),
            )
        )
    return df.agg(F.array(*found).alias("found")).select(F.inline("found"))
