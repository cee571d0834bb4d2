"""Raw tables as plain SQL over the driver tables (the same rules as FIXTURES.md)."""

DEC = "DECIMAL(18,4)"


def dec(x: str) -> str:
    return f"CAST({x} AS {DEC})"


RAW = {}

RAW["raw_headers"] = f"""
SELECT o.o_orderkey, s.old, 'fixture-store' AS account_name,
  CAST(o.o_orderdate AS DATE) + s.old * 2 AS date, CAST(o.o_orderdate AS DATE) + s.old * 2 AS ingested_at,
  lpad(CAST(month(o.o_orderdate) AS STRING), 2, '0') AS month,
  CAST(weekofyear(CAST(o.o_orderdate AS DATE)) AS STRING) AS week,
  CAST(year(o.o_orderdate) AS STRING) AS year,
  CAST(year(o.o_orderdate) AS STRING) || '|' || CAST(month(o.o_orderdate) AS STRING) AS year_month,
  'fixture' AS source,
  CAST(o.o_orderkey AS STRING) AS order_id, '#' || CAST(o.o_orderkey AS STRING) AS order_name,
  CAST(CAST(o.o_orderdate AS DATE) AS STRING) || 'T' || lpad(CAST(o.o_orderkey % 24 AS STRING), 2, '0') || ':15:00Z' AS order_created_at,
  CAST(CAST(o.o_orderdate AS DATE) + 2 AS STRING) || 'T' || lpad(CAST(o.o_orderkey % 20 AS STRING), 2, '0') || ':40:00Z' AS order_processed_at,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Point of Sale' WHEN '2-HIGH' THEN 'Online Store' WHEN '3-MEDIUM' THEN 'Shop'
    WHEN '4-NOT SPECIFIED' THEN 'Draft Orders' ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN '3890849' ELSE '2329312' END END AS order_app_name,
  'CAD' AS order_currency,
  CASE WHEN o.o_orderkey % 97 = 0 THEN 'CANCELLED' WHEN o.o_orderkey % 101 = 0 THEN NULL WHEN o.o_orderstatus = 'P' THEN 'PARTIALLY_REFUNDED'
    WHEN o.o_orderstatus = 'O' THEN 'PENDING' ELSE 'PAID' END AS order_financial_status,
  CASE WHEN o.o_orderkey % 89 = 0 THEN 'True' WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE 'False' END AS order_test,
  CASE WHEN o.o_orderkey % 211 = 0 THEN 'n/a' ELSE CAST({dec('o.o_totalprice')} AS STRING) END AS order_net_sales,
  {dec('o.o_totalprice')} AS order_subtotal_price,
  {dec(dec('o.o_totalprice') + ' * 1.12')} AS order_total_price,
  {dec(dec('o.o_totalprice') + ' * 0.05')} AS order_total_discounts,
  {dec('o.o_orderkey % 30')} AS order_shipping_price,
  {dec(dec('o.o_totalprice') + ' * 0.12')} AS order_total_tax_amount,
  CASE o.o_custkey % 4 WHEN 0 THEN 'United States' WHEN 1 THEN NULL ELSE 'Canada' END AS order_shipping_address_country,
  CASE o.o_custkey % 5 WHEN 0 THEN 'Alberta' WHEN 1 THEN 'Ontario' WHEN 2 THEN NULL ELSE 'British Columbia' END AS order_shipping_address_province,
  CASE WHEN s.old = 1 OR o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(o.o_orderkey % 5 AS STRING) END AS order_location_id,
  CASE WHEN s.old = 1 OR o.o_orderkey % 3 = 0 THEN NULL ELSE 'Store ' || CAST(o.o_orderkey % 5 AS STRING) END AS order_location_name,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_custkey AS STRING) END AS order_customer_id,
  CASE o.o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'google' WHEN 2 THEN 'meta' ELSE 'email' END AS order_customer_last_visit_utm_source,
  CAST(NULL AS STRING) AS order_customer_last_visit_utm_medium,
  CAST(NULL AS STRING) AS order_customer_last_visit_utm_campaign
FROM orders o CROSS JOIN (VALUES (0), (1)) s(old)
WHERE s.old = 0 OR o.o_orderkey % 5 = 0
"""

RAW["raw_orders"] = f"""
SELECT h.* EXCLUDE (o_orderkey, old), q.order_quantity,
  CASE WHEN l.l_linenumber IS NULL THEN NULL ELSE CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) END AS line_item__id,
  CAST(l.l_partkey AS STRING) AS line_item__product_id,
  CASE WHEN l.l_partkey IS NULL THEN NULL WHEN l.l_partkey % 50 = 0 THEN 'Gift Card' WHEN l.l_partkey % 50 = 1 THEN 'paper bag'
    ELSE 'Item ' || CAST(l.l_partkey AS STRING) END AS line_item__title,
  'SKU-' || CAST(l.l_partkey AS STRING) AS line_item__sku,
  'Brand#' || CAST(l.l_partkey % 25 AS STRING) AS line_item__vendor,
  {dec('l.l_quantity')} AS line_item__quantity,
  {dec('l.l_extendedprice')} AS line_item__price,
  {dec(dec('l.l_extendedprice') + ' * ' + dec('l.l_discount'))} AS line_item__total_discount,
  CAST(NULL AS {DEC}) AS line_item__variant_unit_cost
FROM raw_headers h
LEFT JOIN (SELECT l_orderkey, {dec('SUM(' + dec('l_quantity') + ')')} AS order_quantity FROM lineitem GROUP BY l_orderkey) q ON h.o_orderkey = q.l_orderkey
LEFT JOIN lineitem l ON h.o_orderkey = l.l_orderkey
"""

RAW["raw_products"] = f"""
SELECT CASE WHEN s.old = 1 THEN DATE '2001-06-14' ELSE DATE '2001-07-14' END AS date,
  CAST(p.p_partkey AS STRING) AS product_id, p.p_name AS product_title, p.p_type AS product_type, p.p_brand AS product_vendor,
  CASE WHEN p.p_partkey % 13 = 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS product_status,
  'size-' || CAST(p.p_size AS STRING) AS product_tags,
  {dec('p.p_partkey % 4 + s.old')} AS product_inventory_quantity,
  {dec('p.p_retailprice')} AS product_price,
  CASE WHEN p.p_partkey % 5 = 0 THEN {dec(dec('p.p_retailprice') + ' * 0.4')} END AS product_variant_inventory_item_cost,
  '2000-01-01T00:00:00Z' AS product_created_at_datetime,
  CASE WHEN s.old = 1 THEN '2001-06-14T10:00:00Z' ELSE '2001-07-14T10:00:00Z' END AS product_updated_at_datetime
FROM part p CROSS JOIN (VALUES (0), (1)) s(old)
"""

RAW["raw_metafields"] = f"""
SELECT DATE '2001-07-14' AS date, CAST(p.p_partkey AS STRING) AS product_id, p.p_name AS product_title,
  a.ns AS product_metafield_namespace, a.k AS product_metafield_key, 'text' AS product_metafield_type,
  CASE WHEN s.old = 1 THEN '2001-05-01T00:00:00Z' ELSE '2001-07-01T00:00:00Z' END AS product_metafield_update_at,
  CASE a.k
    WHEN 'contract_type' THEN CASE (p.p_partkey + s.old) % 4 WHEN 0 THEN 'consignment' WHEN 1 THEN 'buyout' WHEN 2 THEN 'store_credit' END
    WHEN 'date' THEN CASE WHEN p.p_partkey % 17 = 0 THEN 'unknown' ELSE CAST(DATE '2001-07-14' - CAST(p.p_partkey % 400 AS INT) AS STRING) END
    WHEN 'seller_name' THEN CASE WHEN p.p_partkey % 6 = 0 THEN '' ELSE ' CUSTOMER #' || lpad(CAST(p.p_partkey % 300 AS STRING), 9, '0') END
    WHEN 'msrp' THEN CAST({dec('p.p_retailprice')} AS STRING)
    WHEN 'condition_notes' THEN 'ok'
    WHEN 'customer_id' THEN CASE WHEN p.p_partkey % 4 = 0 THEN '' ELSE CAST(p.p_partkey % 300 AS STRING) END
    WHEN 'condition' THEN CASE p.p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END
    ELSE '["Store ' || CAST(p.p_partkey % 5 AS STRING) || '"]' END AS product_metafield_value
FROM part p
CROSS JOIN (VALUES ('buy','contract_type'), ('buy','date'), ('buy','seller_name'), ('buy','msrp'), ('buy','condition_notes'), ('buy','customer_id'),
                   ('custom','condition'), ('custom','location')) a(ns, k)
CROSS JOIN (VALUES (0), (1)) s(old)
WHERE p.p_partkey % 10 <> 9
"""

RAW["raw_customers"] = f"""
SELECT CASE WHEN s.old = 1 THEN DATE '2001-06-14' ELSE DATE '2001-07-14' END AS date,
  CAST(c.c_custkey AS STRING) AS customer_id, 'Customer' AS customer_first_name,
  '#' || lpad(CAST(c.c_custkey AS STRING), 9, '0') AS customer_last_name,
  CAST(DATE '1995-01-01' + CAST(c.c_custkey * 37 % 2390 AS INT) AS STRING) || 'T08:00:00Z' AS customer_created_at,
  CASE WHEN s.old = 1 THEN '2001-06-14T09:00:00Z' ELSE '2001-07-14T09:00:00Z' END AS customer_updated_at,
  'CAD' AS customer_currency, 'City ' || CAST(c.c_nationkey AS STRING) AS customer_default_address_city,
  CASE WHEN c.c_nationkey % 6 = 0 THEN '' ELSE 'NATION_' || CAST(c.c_nationkey AS STRING) END AS customer_default_address_country,
  'N' || CAST(c.c_nationkey AS STRING) AS customer_default_address_country_code,
  {dec('c.c_custkey % 5')} AS customer_orders_count,
  CASE WHEN c.c_custkey % 5 = 0 THEN {dec('0')} ELSE {dec('abs(c.c_acctbal)')} END AS customer_total_spent,
  CASE WHEN c.c_custkey % 5 = 0 THEN {dec('0')} ELSE {dec('ROUND(CAST(CAST(' + dec('abs(c.c_acctbal)') + ' AS DOUBLE) / (c.c_custkey % 5) AS DECIMAL(28,10)), 2)')} END AS customer_aov,
  CASE WHEN c.c_custkey % 5 > 1 THEN 'True' ELSE 'False' END AS customer_is_returning,
  CASE WHEN c.c_custkey % 4 = 0 THEN 'vip, Cognito-Consignment-Update' ELSE 'vip' END AS customer_tags,
  CASE c.c_custkey % 6 WHEN 0 THEN 'Wants to CONSIGN bags' WHEN 1 THEN 'May sell to us: ' || c.c_mktsegment WHEN 2 THEN NULL ELSE c.c_mktsegment END AS customer_note
FROM customer c CROSS JOIN (VALUES (0), (1)) s(old)
WHERE s.old = 0 OR c.c_custkey % 3 = 0
"""

RAW["raw_refunds"] = f"""
SELECT *, CAST(weekofyear(date) AS STRING) AS week, CAST(year(date) AS STRING) AS year,
  CAST(year(date) AS STRING) || '|' || CAST(month(date) AS STRING) AS year_month
FROM (
  SELECT CAST(l.l_shipdate AS DATE) + 10 AS date, 'fixture-store' AS account_name, CAST(l.l_orderkey AS STRING) AS order_id,
    '#' || CAST(l.l_orderkey AS STRING) AS order_name, 'fixture' AS source,
    'gid://fixture/Refund/' || CAST(l.l_orderkey * 10 + l.l_linenumber % 2 AS STRING) AS order_refunds,
    CASE WHEN l.l_orderkey % 8 = 0 THEN {dec('1.5')} ELSE {dec('0')} END AS order_refund_discrepancy_amount,
    CASE WHEN l.l_orderkey % 6 = 0 THEN {dec('9.99')} ELSE {dec('0')} END AS order_total_shipping_refunded_price,
    CASE WHEN l.l_linenumber = 7 THEN NULL ELSE {dec('l.l_quantity')} END AS line_item__refunds_quantity,
    CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_linenumber = 6 THEN {dec('0')} ELSE {dec('l.l_extendedprice')} END AS line_item__refunds_subtotal,
    CASE WHEN l.l_linenumber = 7 THEN NULL ELSE {dec(dec('l.l_extendedprice') + ' * ' + dec('l.l_tax'))} END AS line_item__refunds_total_tax
  FROM lineitem l WHERE l.l_returnflag = 'R'
)
"""

RAW["raw_meta_ads"] = f"""
SELECT make_date(2001, 7, day(e.ts)) AS date, 'm' || CAST(e.user_id % 12 AS STRING) AS campaign_id,
  'Campaign ' || CAST(e.user_id % 12 AS STRING) AS campaign_name, CAST(e.user_id AS STRING) AS adset_id,
  'Set ' || CAST(e.user_id AS STRING) AS adset_name, CAST(e.event_id AS STRING) AS ad_id, e.event_type AS ad_name,
  {dec('e.value')} AS spend, e.event_id % 1000 AS impressions, e.event_id % 50 AS clicks, e.event_id % 700 AS reach,
  CAST(CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS purchases,
  CASE WHEN e.event_type = 'purchase' THEN {dec(dec('e.value') + ' * 3')} ELSE {dec('0')} END AS purchase_value,
  CASE WHEN e.event_type = 'purchase' THEN {dec('3')} ELSE {dec('0')} END AS purchase_roas, 'CAD' AS account_currency
FROM events e WHERE e.event_id % 2 = 0
"""

RAW["raw_google_ads"] = f"""
SELECT make_date(2001, 7, day(e.ts)) AS date, 'g' || CAST(e.user_id % 9 AS STRING) AS campaign_id,
  'Search ' || CAST(e.user_id % 9 AS STRING) AS campaign_name, '' AS ad_group_id, '' AS ad_group_name, '' AS ad_id, '' AS ad_name,
  {dec('e.value')} AS spend, e.event_id % 900 AS impressions, e.event_id % 40 AS clicks,
  CASE WHEN e.event_type = 'purchase' THEN {dec('1.5')} ELSE {dec('0')} END AS conversions,
  CASE WHEN e.event_type = 'purchase' THEN {dec(dec('e.value') + ' * 2')} ELSE {dec('0')} END AS conversion_value,
  CASE WHEN e.event_id % 31 = 0 THEN 'n/a' ELSE '2.0' END AS roas, 'CAD' AS account_currency
FROM events e WHERE e.event_id % 2 = 1
"""

RAW["raw_email_campaigns"] = """
SELECT 'e' || CAST(e.user_id AS STRING) AS campaign_id,
  'Mail ' || CAST(e.user_id AS STRING) || CASE WHEN s.old = 1 THEN ' draft' ELSE '' END AS campaign_name,
  CASE WHEN s.old = 1 THEN 'Draft' ELSE 'Sent' END AS status,
  CASE WHEN s.old = 1 THEN '2001-06-01T15:00:00Z' ELSE '2001-07-' || lpad(CAST(e.user_id % 14 + 1 AS STRING), 2, '0') || 'T15:00:00Z' END AS send_time
FROM (SELECT DISTINCT user_id FROM events) e CROSS JOIN (VALUES (0), (1)) s(old)
"""

RAW["raw_email_metrics"] = f"""
SELECT make_date(2001, 7, day(e.d)) AS date, 'e' || CAST(e.user_id + 2 AS STRING) AS campaign_id,
  e.n * 100 AS sends, e.n * 40 AS unique_opens, e.n * 7 AS unique_clicks, {dec('0.4')} AS open_rate,
  {dec(dec('e.user_id % 10') + ' * 0.01')} AS click_rate, e.n % 3 AS unsubscribes, {dec('0')} AS revenue
FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE)) e
"""

RAW["raw_email_lists"] = """
SELECT DATE '2001-07-14' AS date, 'list-' || event_type AS list_id, event_type AS list_name,
  '2001-07-' || lpad(CAST(min(user_id) % 14 + 1 AS STRING), 2, '0') || 'T00:00:00Z' AS created
FROM events GROUP BY event_type
"""

RAW["raw_email_messages"] = """
SELECT DISTINCT 'msg-' || CAST(user_id AS STRING) AS message_id, 'e' || CAST(user_id AS STRING) AS campaign_id,
  'News ' || CAST(user_id AS STRING) AS subject_line, 'shop@example.com' AS from_email, 'Shop' AS from_label
FROM events
"""
