"""Clean-up stages and facts as plain SQL over the raw tables, written independently of the Spark code."""

from oracles.fixtures import DEC, RAW


def day(ts: str) -> str:
    """Store-zone calendar day of ISO text."""
    return f"CAST(timezone('America/Vancouver', TRY_CAST({ts} AS TIMESTAMPTZ)) AS DATE)"


def money(x: str, n: int = 2) -> str:
    return f"CAST(ROUND({x}, {n}) AS DOUBLE)"


def ratio(a: str, b: str, n: int | None = None, pct: bool = False) -> str:
    q = f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)" + (" * 100" if pct else "")
    return q if n is None else f"CAST(ROUND(CAST({q} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def num(x: str) -> str:
    return f"TRY_CAST({x} AS {DEC})"


CHANNEL = """CASE order_app_name WHEN 'Point of Sale' THEN 'Retail' WHEN 'Online Store' THEN 'Ecomm' WHEN 'Shop' THEN 'Ecomm'
    WHEN 'Draft Orders' THEN 'Draft' WHEN '3890849' THEN 'Gorgias' ELSE 'Other' END"""
VALID = "lower(coalesce(order_test, 'false')) = 'false' AND lower(order_financial_status) <> 'cancelled'"
LOCATED = "(order_location_name IS NOT NULL) DESC"
LINE_TIES = """line_item__product_id DESC NULLS LAST, line_item__quantity DESC NULLS LAST, line_item__price DESC NULLS LAST,
    line_item__total_discount DESC NULLS LAST"""
REFUND_TIES = """account_name DESC NULLS LAST, order_name DESC NULLS LAST, source DESC NULLS LAST, order_refunds DESC NULLS LAST,
    order_refund_discrepancy_amount DESC NULLS LAST, order_total_shipping_refunded_price DESC NULLS LAST,
    line_item__refunds_quantity DESC NULLS LAST, line_item__refunds_subtotal DESC NULLS LAST, line_item__refunds_total_tax DESC NULLS LAST"""

CTE = dict(RAW)

CTE["clean_orders"] = f"""
SELECT order_id, order_name, {day('order_created_at')} AS order_date, order_currency, order_app_name AS sales_channel,
  {CHANNEL} AS channel, lower(order_financial_status) AS financial_status,
  order_shipping_address_country AS ship_country, order_shipping_address_province AS ship_province,
  order_location_id AS store_location_id, order_location_name AS store_location, order_customer_id,
  order_created_at AS order_created_ts, order_processed_at AS order_processed_ts,
  {num('order_net_sales')} AS net_sales, {num('order_subtotal_price')} AS subtotal_revenue, {num('order_total_price')} AS gross_revenue,
  {num('order_total_discounts')} AS total_discounts, {num('order_shipping_price')} AS shipping_revenue, {num('order_total_tax_amount')} AS total_tax,
  order_customer_last_visit_utm_source AS utm_source, order_customer_last_visit_utm_medium AS utm_medium,
  order_customer_last_visit_utm_campaign AS utm_campaign, year, week, year_month, order_quantity, date AS raw_date
FROM raw_orders WHERE {VALID}
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {LOCATED}, date DESC NULLS LAST) = 1
"""

CTE["clean_lines"] = f"""
SELECT * FROM raw_orders
WHERE {VALID} AND line_item__id IS NOT NULL AND line_item__id <> ''
QUALIFY row_number() OVER (PARTITION BY order_id, line_item__id
  ORDER BY {LOCATED}, order_created_at DESC NULLS LAST, date DESC NULLS LAST, {LINE_TIES}) = 1
"""

CTE["merch_lines"] = f"""
SELECT *, {day('order_created_at')} AS order_date, {CHANNEL} AS channel FROM raw_orders
WHERE {VALID} AND line_item__id IS NOT NULL AND line_item__id <> '' AND line_item__product_id IS NOT NULL
  AND lower(coalesce(line_item__title, '')) NOT IN ('gift card', 'paper bag', '')
QUALIFY row_number() OVER (PARTITION BY order_id, line_item__id
  ORDER BY {LOCATED}, order_created_at DESC NULLS LAST, date DESC NULLS LAST, {LINE_TIES}) = 1
"""

CTE["unit_costs"] = f"""
SELECT product_id, {num('product_variant_inventory_item_cost')} AS unit_cost FROM raw_products WHERE product_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_updated_at_datetime DESC) = 1
"""

CTE["order_totals"] = f"""
SELECT l.order_id, SUM({num('l.line_item__quantity')}) AS total_units,
  SUM({num('l.line_item__quantity')} * coalesce(c.unit_cost, {num('l.line_item__variant_unit_cost')}, 0)) AS cogs
FROM clean_lines l LEFT JOIN unit_costs c ON l.line_item__product_id = c.product_id GROUP BY l.order_id
"""

CTE["fact_orders"] = f"""
SELECT o.* EXCLUDE (order_quantity, raw_date), coalesce(t.total_units, 0) AS total_units,
  CAST(coalesce(t.cogs, 0) AS DECIMAL(28,8)) AS cogs,
  o.net_sales - CAST(coalesce(t.cogs, 0) AS DECIMAL(28,8)) AS gross_profit,
  {ratio('(o.net_sales - CAST(coalesce(t.cogs, 0) AS DECIMAL(28,8)))', 'o.net_sales')} AS gross_margin_pct
FROM clean_orders o LEFT JOIN order_totals t ON o.order_id = t.order_id
"""

CTE["fact_daily"] = f"""
SELECT order_date, channel, ship_country, ship_province, store_location,
  ROUND(SUM(net_sales), 2) AS net_sales, ROUND(SUM(total_discounts), 2) AS total_discounts,
  ROUND(SUM(shipping_revenue), 2) AS shipping_revenue, ROUND(SUM(gross_revenue), 2) AS gross_revenue,
  SUM(order_quantity) AS total_units, {ratio('SUM(net_sales)', 'COUNT(DISTINCT order_id)', 2)} AS aov
FROM clean_orders GROUP BY ALL
"""

CTE["fact_products_sold"] = f"""
SELECT o.order_date, o.line_item__product_id AS product_id, o.line_item__sku AS sku, o.line_item__title AS product_title,
  o.line_item__vendor AS vendor, o.channel, o.order_shipping_address_country AS ship_country,
  o.order_shipping_address_province AS ship_province, o.order_location_name AS store_location,
  SUM(line_item__quantity) AS units_sold, ROUND(SUM(line_item__price * line_item__quantity), 2) AS gross_revenue,
  ROUND(SUM(line_item__total_discount), 2) AS total_line_discounts,
  ROUND(SUM(coalesce(c.unit_cost, line_item__variant_unit_cost, 0) * line_item__quantity), 2) AS cost,
  ROUND(SUM((line_item__price - coalesce(c.unit_cost, line_item__variant_unit_cost, 0)) * line_item__quantity), 2) AS gross_profit,
  {ratio('SUM((line_item__price - coalesce(c.unit_cost, line_item__variant_unit_cost, 0)) * line_item__quantity)',
         'SUM(line_item__price * line_item__quantity)', 1, True)} AS gross_margin_pct
FROM merch_lines o LEFT JOIN unit_costs c ON o.line_item__product_id = c.product_id
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
"""

CTE["clean_refunds"] = f"""
SELECT *, NULLIF(regexp_extract(order_refunds, '/([0-9]+)$', 1), '') AS refund_id
FROM raw_refunds
WHERE order_id IS NOT NULL AND (line_item__refunds_subtotal > 0 OR order_refund_discrepancy_amount <> 0 OR order_total_shipping_refunded_price <> 0)
QUALIFY row_number() OVER (
  PARTITION BY order_id, coalesce(order_refunds, 'NO_REFUND'), coalesce(line_item__refunds_subtotal, 0), coalesce(line_item__refunds_quantity, 0)
  ORDER BY date DESC, {REFUND_TIES}) = 1
"""

CTE["parent_orders"] = f"""
SELECT order_id, {CHANNEL} AS channel, lower(order_financial_status) AS financial_status, order_currency AS currency,
  order_shipping_address_country AS ship_country, order_shipping_address_province AS ship_province, order_location_name AS store_location
FROM raw_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {LOCATED}, order_created_at DESC NULLS LAST, date DESC) = 1
"""

CTE["fact_refunds"] = f"""
SELECT CAST(timezone('America/Vancouver', CAST(CAST(r.date AS STRING) || 'T00:00:00Z' AS TIMESTAMPTZ)) AS DATE) AS refund_date,
  r.refund_id, r.order_id, r.order_name, o.channel, o.financial_status, o.currency, o.ship_country, o.ship_province, o.store_location,
  r.line_item__refunds_quantity AS refunded_units, ROUND(r.line_item__refunds_subtotal, 2) AS refund_subtotal,
  ROUND(r.order_total_shipping_refunded_price, 2) AS refund_shipping, ROUND(r.order_refund_discrepancy_amount, 2) AS refund_discrepancy,
  ROUND(r.line_item__refunds_total_tax, 2) AS refund_tax,
  ROUND(coalesce(r.line_item__refunds_subtotal, 0) + coalesce(r.order_refund_discrepancy_amount, 0)
    + coalesce(r.order_total_shipping_refunded_price, 0), 2) AS total_refunded, r.week, r.year, r.year_month
FROM clean_refunds r LEFT JOIN parent_orders o ON r.order_id = o.order_id
"""

CTE["preferred"] = """
SELECT order_customer_id AS customer_id,
  arg_max(store_location, struct_pack(d := raw_date, o := order_id)) FILTER (WHERE store_location IS NOT NULL) AS store_location,
  arg_max(channel, struct_pack(d := raw_date, o := order_id)) AS channel
FROM clean_orders WHERE order_customer_id IS NOT NULL GROUP BY order_customer_id
"""

CTE["latest_customers"] = """
SELECT * FROM raw_customers WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_updated_at DESC) = 1
"""

CTE["fact_customers"] = f"""
SELECT c.customer_id, c.customer_first_name AS first_name, c.customer_last_name AS last_name, c.customer_created_at, c.customer_updated_at,
  c.customer_default_address_city AS city, c.customer_default_address_country AS country, c.customer_default_address_country_code AS country_code,
  CAST(ROUND(c.customer_orders_count, 0) AS BIGINT) AS orders_count, {num('c.customer_total_spent')} AS total_spent, {num('c.customer_aov')} AS aov,
  CASE WHEN lower(c.customer_is_returning) = 'true' THEN 'Returning' ELSE 'New' END AS customer_type,
  CASE WHEN c.customer_orders_count = 0 THEN 'No Orders' WHEN c.customer_orders_count = 1 THEN 'One-time' WHEN c.customer_orders_count >= 2 THEN 'Repeat' END AS purchase_segment,
  p.store_location, p.channel
FROM latest_customers c LEFT JOIN preferred p ON c.customer_id = p.customer_id
"""

CTE["latest_products"] = """
SELECT * FROM raw_products WHERE product_id IS NOT NULL AND lower(product_status) = 'active'
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_updated_at_datetime DESC) = 1
"""

CTE["latest_metafields"] = """
SELECT * FROM raw_metafields WHERE product_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_id, product_metafield_namespace, product_metafield_key
  ORDER BY product_metafield_update_at DESC, date DESC, product_metafield_value DESC NULLS LAST) = 1
"""


def attribute(ns: str, key: str) -> str:
    return f"MAX(product_metafield_value) FILTER (WHERE product_metafield_namespace = '{ns}' AND product_metafield_key = '{key}')"


QUOTED = "NULLIF(regexp_extract({}, '\"([^\"]+)\"', 1), '')"

CTE["attributes"] = f"""
SELECT product_id, {attribute('buy', 'contract_type')} AS contract_type, {attribute('buy', 'date')} AS buy_date,
  {attribute('buy', 'seller_name')} AS seller_name, {attribute('buy', 'msrp')} AS msrp, {attribute('custom', 'condition')} AS condition_grade,
  {QUOTED.format(attribute('custom', 'location'))} AS store_location
FROM latest_metafields GROUP BY product_id
"""


def inventory(products: str) -> str:
    return f"""
SELECT *, CASE WHEN days_in_inventory <= 30 THEN '0-30 days' WHEN days_in_inventory <= 60 THEN '31-60 days' WHEN days_in_inventory <= 90 THEN '61-90 days'
    WHEN days_in_inventory <= 180 THEN '91-180 days' ELSE '180+ days' END AS aging_bucket
FROM (
  SELECT p.product_id, p.product_title, p.product_type, p.product_vendor, p.product_status, p.product_tags, p.date AS snapshot_date,
    CAST(ROUND(p.product_inventory_quantity, 0) AS BIGINT) AS units_on_hand, p.product_price AS retail_price,
    p.product_variant_inventory_item_cost AS unit_cost,
    ROUND(p.product_price * CAST(ROUND(p.product_inventory_quantity, 0) AS INT), 2) AS retail_value,
    ROUND(p.product_variant_inventory_item_cost * CAST(ROUND(p.product_inventory_quantity, 0) AS INT), 2) AS cost_value,
    CASE WHEN lower(m.contract_type) <> 'consignment' THEN ROUND(p.product_variant_inventory_item_cost * CAST(ROUND(p.product_inventory_quantity, 0) AS INT), 2) ELSE 0 END AS cost_excl_consignment,
    m.contract_type, coalesce(lower(m.contract_type) = 'consignment', FALSE) AS is_consignment, m.buy_date, m.seller_name, {num('m.msrp')} AS msrp,
    m.condition_grade, m.store_location, CAST(datediff('day', TRY_CAST(m.buy_date AS DATE), p.date) AS INT) AS days_in_inventory,
    p.product_created_at_datetime, p.product_updated_at_datetime
  FROM {products} p LEFT JOIN attributes m ON p.product_id = m.product_id
)
"""


CTE["fact_inventory"] = inventory("latest_products")

CTE["supplied"] = f"""
SELECT a.product_id, a.seller_name, a.contract_type, a.buy_date, {QUOTED.format('a.location_text')} AS store_location, s.channel
FROM (
  SELECT product_id, {attribute('buy', 'seller_name')} AS seller_name, {attribute('buy', 'contract_type')} AS contract_type,
    {attribute('buy', 'date')} AS buy_date, {attribute('custom', 'location')} AS location_text
  FROM raw_metafields GROUP BY product_id
) a
LEFT JOIN (
  SELECT product_id, channel FROM fact_products_sold
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_date DESC NULLS LAST, channel DESC) = 1
) s ON a.product_id = s.product_id
WHERE a.seller_name IS NOT NULL AND a.seller_name <> ''
"""

CTE["seller_summary"] = """
SELECT seller_name, contract_type, store_location, channel, COUNT(*) AS total_items_supplied,
  COUNT(*) FILTER (WHERE contract_type = 'consignment') AS consignment_items,
  COUNT(*) FILTER (WHERE contract_type = 'buyout') AS buyout_items,
  COUNT(*) FILTER (WHERE contract_type = 'store_credit') AS store_credit_items,
  MIN(buy_date) AS first_buy_date, MAX(buy_date) AS last_buy_date
FROM supplied GROUP BY seller_name, contract_type, store_location, channel
"""

CTE["consignors"] = """
SELECT * FROM raw_customers WHERE lower(customer_tags) LIKE '%cognito-consignment%'
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY date DESC) = 1
"""

CTE["fact_seller"] = """
SELECT s.*, c.customer_id, c.customer_first_name, c.customer_last_name, CAST(ROUND(c.customer_orders_count, 0) AS BIGINT) AS buyer_orders_count,
  c.customer_total_spent AS buyer_total_spent, c.customer_aov AS buyer_aov, c.customer_id IS NOT NULL AS is_also_buyer
FROM seller_summary s LEFT JOIN consignors c
  ON lower(trim(s.seller_name)) = lower(trim(c.customer_first_name) || ' ' || trim(c.customer_last_name))
"""

CTE["fact_marketing"] = f"""
SELECT 'Meta' AS source, date, campaign_id, campaign_name, adset_id AS ad_group_id, adset_name AS ad_group_name, ad_id, ad_name, spend,
  impressions, clicks, reach, purchases AS conversions, purchase_value AS conversion_value, purchase_roas AS roas, account_currency
FROM raw_meta_ads
UNION ALL
SELECT 'Google', date, campaign_id, campaign_name, ad_group_id, ad_group_name, ad_id, ad_name, spend, impressions, clicks, NULL,
  CAST(ROUND(conversions, 0) AS BIGINT), conversion_value, {num('roas')}, account_currency
FROM raw_google_ads
"""

CTE["fact_email"] = """
SELECT m.campaign_id, c.campaign_name, c.send_time, c.status AS campaign_status, m.sends AS recipients, m.unique_opens, m.unique_clicks,
  m.open_rate, m.click_rate, m.unsubscribes, m.revenue, m.date AS synced_date
FROM (SELECT * FROM raw_email_metrics QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY date DESC) = 1) m
LEFT JOIN (SELECT * FROM raw_email_campaigns QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY send_time DESC) = 1) c
  ON m.campaign_id = c.campaign_id
"""


def needs(sql: str) -> list[str]:
    """Named stages a statement mentions, directly or through other stages, in definition order."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found = {name for name in CTE if name in words}
    todo = list(found)
    while todo:
        words = set(CTE[todo.pop()].replace("(", " ").replace(")", " ").replace(",", " ").split())
        more = {name for name in CTE if name in words} - found
        found |= more
        todo += more
    return [name for name in CTE if name in found]


def full(sql: str) -> str:
    """A complete statement: the stages it needs, then the statement."""
    names = needs(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in names) + "\n" + sql.strip()


def edge(table: str, decimals: str, sql: str | None = None) -> str:
    """A whole table with its decimal columns handed out as doubles."""
    swaps = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in decimals.split())
    return f"SELECT * REPLACE ({swaps}) FROM {sql or table}"


EDGE = {
    "fact_orders": "net_sales subtotal_revenue gross_revenue total_discounts shipping_revenue total_tax total_units cogs gross_profit",
    "fact_daily": "net_sales total_discounts shipping_revenue gross_revenue total_units",
    "fact_products_sold": "units_sold gross_revenue total_line_discounts cost gross_profit",
    "fact_refunds": "refunded_units refund_subtotal refund_shipping refund_discrepancy refund_tax total_refunded",
    "fact_customers": "total_spent aov",
    "fact_inventory": "retail_price unit_cost retail_value cost_value cost_excl_consignment msrp",
    "fact_seller": "buyer_total_spent buyer_aov",
    "fact_marketing": "spend conversion_value roas",
    "fact_email": "open_rate click_rate revenue",
}
