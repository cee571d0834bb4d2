"""SQL for the operator queries."""

from oracles import cards
from oracles.cards import AS_OF, CATALOGUE, last30, mtd
from oracles.facts import CHANNEL, EDGE, LOCATED, QUOTED, VALID, attribute, day, edge, full, inventory, money, num, ratio
from oracles.fixtures import dec


def dbl(names: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in names.split())


def dsum(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def isum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def wk(d: str) -> str:
    return (
        f"CAST(weekofyear({d}) AS STRING) AS week, CAST(year({d}) AS STRING) AS year, "
        f"CAST(year({d}) AS STRING) || '|' || CAST(month({d}) AS STRING) AS year_month"
    )


def utc_day(x: str) -> str:
    return f"CAST(CAST({x} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS DATE)"


H = "raw_headers"
SQL: dict[str, str] = {}

# ---- sources -----------------------------------------------------------------

ORDER_AMOUNTS = "order_total_price order_total_discounts order_shipping_price order_total_tax_amount order_quantity line_item__quantity line_item__price line_item__total_discount"
SQL["s1_raw_orders"] = f"""SELECT order_id, date, ingested_at, order_created_at, order_processed_at, order_app_name, order_financial_status,
  order_test, order_net_sales, {dbl(ORDER_AMOUNTS)}, order_shipping_address_country, order_shipping_address_province, order_location_id,
  order_location_name, order_customer_id, order_customer_last_visit_utm_source, month, week, year, year_month, line_item__id,
  line_item__product_id, line_item__title, line_item__sku, line_item__vendor FROM raw_orders"""
SQL["s1_raw_products"] = f"""SELECT date, product_id, product_title, product_type, product_vendor, product_status, product_tags,
  {dbl('product_inventory_quantity product_price product_variant_inventory_item_cost')}, product_updated_at_datetime FROM raw_products"""
SQL["s1_raw_metafields"] = """SELECT date, product_id, product_metafield_namespace, product_metafield_key, product_metafield_update_at,
  product_metafield_value FROM raw_metafields"""
SQL["s1_raw_customers"] = f"""SELECT date, customer_id, customer_first_name, customer_last_name, customer_created_at, customer_updated_at,
  customer_default_address_country, {dbl('customer_orders_count customer_total_spent customer_aov')}, customer_is_returning, customer_tags FROM raw_customers"""
REFUND_AMOUNTS = "order_refund_discrepancy_amount order_total_shipping_refunded_price line_item__refunds_quantity line_item__refunds_subtotal line_item__refunds_total_tax"
SQL["s1_raw_refunds"] = f"SELECT date, order_id, order_refunds, {dbl(REFUND_AMOUNTS)}, week, year, year_month FROM raw_refunds"
SQL["s1_raw_meta_ads"] = f"""SELECT date, campaign_id, adset_id, ad_id, ad_name, impressions, clicks, reach, purchases,
  {dbl('spend purchase_value purchase_roas')} FROM raw_meta_ads"""
SQL["s1_raw_google_ads"] = f"SELECT date, campaign_id, impressions, clicks, roas, {dbl('spend conversions conversion_value')} FROM raw_google_ads"
SQL["s1_raw_email_campaigns"] = "SELECT campaign_id, campaign_name, status, send_time FROM raw_email_campaigns"
SQL["s1_raw_email_metrics"] = f"""SELECT date, campaign_id, sends, unique_opens, unique_clicks, unsubscribes, {dbl('open_rate click_rate')}
  FROM raw_email_metrics"""
SQL["s1_raw_email_lists"] = "SELECT date, list_id, list_name, created FROM raw_email_lists"
SQL["s1_raw_email_messages"] = "SELECT message_id, campaign_id, subject_line, from_email, from_label FROM raw_email_messages"

DOCS = "(SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)"
APP = """CASE o_orderkey % 7 WHEN 0 THEN 'Online Store' WHEN 1 THEN 'Point of Sale' WHEN 2 THEN 'Shop' WHEN 3 THEN 'Draft Orders'
  WHEN 4 THEN 'Shop' WHEN 5 THEN '3890849' ELSE 'Unknown' END"""
LOC = "CASE o_orderkey % 4 WHEN 0 THEN '61826072689' WHEN 1 THEN '42702532' WHEN 2 THEN '7' END"
STORE = "CASE o_orderkey % 4 WHEN 0 THEN '79 Yorkville, Toronto' WHEN 1 THEN '1025 Howe Street, Vancouver' WHEN 2 THEN 'Unknown Location' END"
DOC_BASE = f"""d AS date, lpad(CAST(month(d) AS STRING), 2, '0') AS month, {wk('d')}, {APP} AS order_app_name,
  CAST(d AS STRING) || 'T' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':15:00-07:00' AS order_created_at,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'PAID' END AS order_financial_status, CAST(o_orderkey AS STRING) AS order_id,
  '#' || CAST(o_orderkey AS STRING) AS order_name, CAST({dec('o_totalprice')} AS STRING) AS order_net_sales, CAST(NULL AS STRING) AS order_processed_at,
  CAST(coalesce(CAST(l_quantity AS BIGINT), 0) AS DOUBLE) AS order_quantity,
  CASE WHEN o_custkey % 3 > 0 THEN 'Canada' END AS order_shipping_address_country, CASE WHEN o_custkey % 3 > 0 THEN 'Ontario' END AS order_shipping_address_province,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN 9.5 ELSE 0 END AS DOUBLE) AS order_shipping_price, CAST({dec('o_totalprice')} AS DOUBLE) AS order_subtotal_price,
  CASE WHEN o_orderkey % 89 = 0 THEN 'True' ELSE 'False' END AS order_test, CAST(0 AS DOUBLE) AS order_total_discounts, CAST(0 AS DOUBLE) AS order_total_price,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1.25 END AS DOUBLE) AS order_total_tax_amount, {LOC} AS order_location_id, {STORE} AS order_location_name,
  CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_custkey AS STRING) END AS order_customer_id, DATE '2001-07-16' AS ingested_at"""
LINE_ID = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
SQL["s2_quarantine"] = f"""
SELECT state, count(*) AS documents, {isum('k')} AS order_keys, {dsum("CASE WHEN state IN ('landed', 'replayed') THEN v END")} AS value, CAST(0 AS BIGINT) AS no_line
FROM (SELECT o_orderkey AS k, {dec('o_totalprice')} AS v,
  CASE WHEN o_orderkey % 7 = 0 THEN CASE WHEN o_orderkey % 11 = 0 THEN 'malformed' ELSE 'replayed' END
    WHEN o_orderkey % 13 = 0 THEN 'malformed' WHEN o_orderkey % 11 = 0 THEN 'no id' ELSE 'landed' END AS state FROM orders)
GROUP BY state"""
SQL["s2_flatten_orders"] = f"""
SELECT {DOC_BASE}, {LINE_ID} AS line_item__id, CAST({dec('l_extendedprice')} AS DOUBLE) AS line_item__price, CAST(l_partkey AS STRING) AS line_item__product_id,
  CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS line_item__quantity, 'SKU-' || CAST(l_partkey AS STRING) AS line_item__sku,
  'Item ' || CAST(l_partkey AS STRING) AS line_item__title, CAST({dec('l_discount')} AS DOUBLE) AS line_item__total_discount,
  CASE WHEN l_orderkey IS NOT NULL THEN '' END AS line_item__vendor
FROM {DOCS}
UNION ALL
SELECT {DOC_BASE}, {LINE_ID} || '-w', 0.0::DOUBLE, '', 0.0::DOUBLE, '', 'Paper Bag', 0.0::DOUBLE, 'house'
FROM {DOCS} WHERE l_linenumber % 3 = 0"""

SQL["s2_flatten_landed_json"] = f"""SELECT {APP} AS order_app_name, {STORE} AS order_location_name,
  count(*) + count(*) FILTER (WHERE l_linenumber % 3 = 0) AS rows, count(DISTINCT o_orderkey) AS orders,
  max({LINE_ID} || CASE WHEN l_linenumber % 3 = 0 THEN '-w' ELSE '' END) AS last_line
  FROM {DOCS} GROUP BY 1, 2"""

SQL["s3_flatten_refunds"] = f"""
SELECT d AS date, CAST(l_orderkey AS STRING) AS order_id, 'gid://fixture/Refund/' || CAST(l_orderkey * 10 + l_linenumber AS STRING) AS order_refunds,
  CAST(CASE WHEN l_orderkey % 3 = 0 THEN -1.5 ELSE 0 END AS DOUBLE) AS order_refund_discrepancy_amount,
  CAST(CASE WHEN l_orderkey % 3 < 2 THEN 9.99 ELSE 0 END AS DOUBLE) AS order_total_shipping_refunded_price,
  CAST(q AS DOUBLE) AS line_item__refundable_quantity, CAST(s AS DOUBLE) AS line_item__refunds_price, CAST(q AS DOUBLE) AS line_item__refunds_quantity,
  CAST(s AS DOUBLE) AS line_item__refunds_subtotal, CAST(t AS DOUBLE) AS line_item__refunds_total_tax, {wk('d')}
FROM (
  SELECT *, CASE WHEN l_linenumber % 3 < 2 THEN CAST(l_quantity AS BIGINT) END AS q, CASE WHEN l_linenumber % 3 < 2 THEN {dec('l_extendedprice')} END AS s,
    CASE WHEN l_linenumber % 3 < 2 THEN 0.5 END AS t, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT *, 0, 0, 0, CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber % 3 = 0
)"""

SQL["s4_flatten_customers"] = f"""
SELECT DATE '2001-07-16' AS date, CAST(c_custkey AS STRING) AS customer_id, CASE WHEN c_custkey % 7 > 0 THEN 'Customer' ELSE '' END AS customer_first_name,
  c_name AS customer_last_name, '2001-01-01T00:00:00Z' AS customer_created_at, '' AS customer_updated_at, '' AS customer_currency,
  CASE WHEN c_custkey % 3 > 0 THEN 'City ' || CAST(c_nationkey AS STRING) ELSE '' END AS customer_default_address_city,
  CASE WHEN c_custkey % 3 > 0 THEN 'Canada' ELSE '' END AS customer_default_address_country,
  CASE WHEN c_custkey % 3 > 0 THEN 'CA' ELSE '' END AS customer_default_address_country_code,
  CAST(n AS DOUBLE) AS customer_orders_count, {money('s')} AS customer_total_spent,
  CAST(CASE WHEN n > 0 THEN ROUND(CAST(CAST(s AS DOUBLE) / n AS DECIMAL(28,10)), 2) ELSE 0 END AS DOUBLE) AS customer_aov,
  CASE WHEN n > 1 THEN 'True' ELSE 'False' END AS customer_is_returning, c_mktsegment AS customer_tags,
  CASE WHEN c_custkey % 4 = 0 THEN 'likes blue' ELSE '' END AS customer_note
FROM (SELECT *, CASE WHEN c_custkey % 6 < 5 THEN c_custkey % 6 ELSE 0 END AS n,
  CASE WHEN c_custkey % 13 = 0 THEN {dec('0')} ELSE {dec('abs(c_acctbal)')} END AS s FROM customer)"""

SQL["s5_flatten_products"] = f"""
SELECT DATE '2001-07-16' AS date, CAST(p_partkey AS STRING) AS product_id, p_name AS product_title, '' AS product_description, '' AS product_handle,
  CASE WHEN p_partkey % 2 = 0 THEN 'img/' || CAST(p_partkey AS STRING) ELSE '' END AS product_image_src,
  CAST(CASE p_partkey % 3 WHEN 0 THEN p_partkey % 4 + 2 WHEN 1 THEN p_partkey % 4 ELSE 0 END AS DOUBLE) AS product_inventory_quantity,
  CASE WHEN p_partkey % 3 < 2 THEN {money(dec('p_retailprice'))} ELSE 0 END AS product_price,
  CASE WHEN p_partkey % 13 = 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS product_status, 'size-' || CAST(p_size AS STRING) AS product_tags, p_type AS product_type,
  '' AS product_created_at_datetime, '2001-07-14T10:00:00Z' AS product_updated_at_datetime, CAST(NULL AS DOUBLE) AS product_variant_inventory_item_cost,
  p_brand AS product_vendor FROM part"""
SQL["s6_enrich_product_costs"] = f"""
SELECT CAST(p_partkey AS STRING) AS product_id, CASE WHEN p_partkey % 3 < 2 THEN {money(dec('p_retailprice'))} ELSE 0 END AS product_price,
  CASE WHEN p_partkey % 3 < 2 AND p_partkey % 5 = 0 THEN {money(dec(dec('p_retailprice') + ' * 0.4'))} END AS product_variant_inventory_item_cost FROM part"""
SQL["s7_flatten_metafields"] = """
SELECT DATE '2001-07-16' AS date, CAST(p_partkey AS STRING) AS product_id, p_name AS product_title, m.k AS product_metafield_key,
  m.ns AS product_metafield_namespace, m.t AS product_metafield_type, m.u AS product_metafield_update_at,
  CASE m.k WHEN 'contract_type' THEN 'buyout' WHEN 'msrp' THEN CAST(p_size AS STRING) END AS product_metafield_value
FROM part CROSS JOIN (VALUES ('contract_type', 'buy', 'text', '2001-07-01T00:00:00Z'), ('msrp', 'buy', 'number', '2001-07-01T00:00:00Z'),
  ('condition', 'custom', 'text', NULL)) m(k, ns, t, u) WHERE p_partkey % 10 < 9"""
SQL["s8_flatten_ad_insights"] = f"""
SELECT date, campaign_id, campaign_name, '' AS adset_id, '' AS adset_name, ad_id, ad_name, CAST(s AS DOUBLE) AS spend, impressions, clicks, CAST(0 AS BIGINT) AS reach,
  CAST(CASE WHEN ad_name = 'purchase' THEN 2 ELSE 0 END AS BIGINT) AS purchases, CAST(v AS DOUBLE) AS purchase_value,
  CAST(CASE WHEN s > 0 THEN ROUND(CAST(CAST(v AS DOUBLE) / CAST(s AS DOUBLE) AS DECIMAL(28,10)), 2) ELSE 0 END AS DOUBLE) AS purchase_roas, account_currency
FROM (SELECT make_date(2001, 7, day(ts)) AS date, 'm' || CAST(user_id % 12 AS STRING) AS campaign_id, 'Campaign ' || CAST(user_id % 12 AS STRING) AS campaign_name,
  CAST(event_id AS STRING) AS ad_id, event_type AS ad_name, CASE WHEN event_id % 37 = 0 THEN {dec('0')} ELSE {dec('value')} END AS s,
  CASE WHEN event_type = 'purchase' THEN {dec(dec('value') + ' * 3')} ELSE {dec('0')} END AS v, event_id % 1000 AS impressions,
  CASE WHEN event_id % 5 > 0 THEN event_id % 50 ELSE 0 END AS clicks, CASE WHEN event_id % 2 = 0 THEN 'USD' ELSE 'CAD' END AS account_currency FROM events)"""
SQL["s9_flatten_cost_report"] = f"""
SELECT date, campaign_id, campaign_name, '' AS ad_group_id, '' AS ad_group_name, '' AS ad_id, '' AS ad_name, {money('s')} AS spend, impressions, clicks,
  CAST(conversions AS DOUBLE) AS conversions, {money('v')} AS conversion_value,
  CAST(CASE WHEN s > 0 THEN ROUND(CAST(CAST(ROUND(v, 2) AS DOUBLE) / CAST(s AS DOUBLE) AS DECIMAL(28,10)), 2) ELSE 0 END AS DECIMAL(18,4))::STRING AS roas,
  'CAD' AS account_currency
FROM (SELECT make_date(2001, 7, day(ts)) AS date, 'g' || CAST(user_id % 9 AS STRING) AS campaign_id, 'Search ' || CAST(user_id % 9 AS STRING) AS campaign_name,
  {dec('value')} AS s, {dec(dec('value') + ' * 2')} AS v, event_id % 900 AS impressions, event_id % 40 AS clicks,
  CASE WHEN event_type = 'purchase' THEN 1.51 ELSE 0 END AS conversions FROM events
  QUALIFY row_number() OVER (PARTITION BY make_date(2001, 7, day(ts)), user_id % 9 ORDER BY event_id DESC) = 1)"""
KEYS = "(SELECT DISTINCT user_id AS k FROM events)"
SQL["s10_flatten_email_campaigns"] = f"""
SELECT 'e' || CAST(k AS STRING) AS campaign_id, 'Mail ' || CAST(k AS STRING) AS campaign_name, CASE WHEN k % 4 = 0 THEN '' ELSE 'Sent' END AS status,
  k % 5 = 0 AS archived, CASE WHEN k % 2 = 0 THEN '2001-07-02T15:00:00Z' ELSE '2001-07-01T15:00:00Z' END AS send_time,
  '2001-06-01T00:00:00Z' AS created_at, CAST(NULL AS STRING) AS updated_at FROM {KEYS}"""
SQL["s10_flatten_email_lists"] = f"""
SELECT DATE '2001-07-16' AS date, 'l' || CAST(k AS STRING) AS list_id, CASE WHEN k % 4 > 0 THEN 'List ' || CAST(k AS STRING) ELSE '' END AS list_name,
  '2001-06-01T00:00:00Z' AS created, CAST(NULL AS STRING) AS updated FROM {KEYS}"""
SQL["s10_flatten_email_messages"] = f"""
SELECT 'msg-' || CAST(k AS STRING) AS message_id, CASE WHEN k % 3 = 0 THEN '' ELSE 'e' || CAST(k AS STRING) END AS campaign_id,
  'News ' || CAST(k AS STRING) AS subject_line, 'shop@example.com' AS from_email, CASE WHEN k % 2 = 0 THEN 'Shop' ELSE '' END AS from_label FROM {KEYS}"""
SQL["s11_flatten_email_report"] = """
SELECT DATE '2001-07-16' AS date, 'e' || CAST(user_id AS STRING) AS campaign_id, n * 100 AS sends, 0::BIGINT AS deliveries, n * 50 AS opens, n * 40 AS unique_opens,
  CAST(0.4 AS DOUBLE) AS open_rate, 0::BIGINT AS clicks, n * 7 AS unique_clicks, CAST(0 AS DOUBLE) AS click_rate, n % 3 AS unsubscribes, 0::BIGINT AS bounces,
  CAST(12.5 AS DOUBLE) AS revenue, 2::BIGINT AS conversions FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)"""

AD = "date, campaign_id, ad_id, clicks, CAST(spend AS DOUBLE) AS spend"
SQL["s13_append_sink"] = f"""SELECT {AD} FROM raw_meta_ads WHERE date < DATE '2001-07-10' UNION ALL
  SELECT {AD} FROM raw_meta_ads WHERE date >= DATE '2001-07-05'"""
SQL["s14_replace_sink"] = "SELECT product_id, date, CAST(product_price AS DOUBLE) AS product_price FROM raw_products WHERE date >= DATE '2001-07-01'"
SQL["s15_replace_days_sink"] = """SELECT date, campaign_id, ad_id, clicks,
  CAST(CASE WHEN date >= DATE '2001-07-10' THEN spend * 2 ELSE spend END AS DOUBLE) AS spend FROM raw_meta_ads WHERE date <> DATE '2001-07-12'"""
SQL["s16_day_layout"] = f"""SELECT date, count(*) AS n, {dsum('spend')} AS spend FROM raw_google_ads
  WHERE date BETWEEN DATE '2001-07-03' AND DATE '2001-07-09' GROUP BY date"""
SQL["s17_widen_table"] = "SELECT customer_id, date, CASE WHEN date >= DATE '2001-07-01' THEN customer_tags END AS customer_tags FROM raw_customers"
SQL["s18_publish_facts"] = CATALOGUE["cat_mer_marketing_efficiency_ratio"]
SQL["s18_fact_views"] = "SELECT purchase_segment, customer_type, count(*) AS customers FROM fact_customers GROUP BY ALL"

# ---- typing ------------------------------------------------------------------

SQL["t1_tolerant_cast"] = f"""SELECT order_id, date, order_net_sales, CAST({num('order_net_sales')} AS DOUBLE) AS net_sales,
  CAST(ROUND(order_total_price, 0) AS BIGINT) AS whole_total,
  CASE WHEN regexp_full_match(order_net_sales, '[0-9]+') THEN TRY_CAST(order_net_sales AS BIGINT) END AS whole_text FROM {H}"""
SQL["t2_strict_cast"] = """SELECT ad_id, CAST(spend AS DOUBLE) AS spend, CAST(ad_id AS BIGINT) AS ad_number,
  CAST(impressions AS STRING) AS impressions_text FROM raw_meta_ads"""
SQL["t3_tolerant_date"] = """SELECT product_id, product_metafield_value, TRY_CAST(product_metafield_value AS DATE) AS buy_day
  FROM raw_metafields WHERE product_metafield_key = 'date'"""
SQL["t4_instant"] = f"""SELECT order_id, date, CAST(epoch(CAST(order_created_at AS TIMESTAMPTZ)) AS BIGINT) AS created_epoch,
  CAST(NULL AS BIGINT) AS not_a_time FROM {H}"""
SQL["t5_business_day"] = f"SELECT {day('order_created_at')} AS local_day, CAST(left(order_created_at, 10) AS DATE) AS utc_day, count(*) AS n FROM {H} GROUP BY 1, 2"
SQL["t6_coerce_with_default"] = f"""SELECT order_app_name, {dsum(f"coalesce({num('order_net_sales')}, 0)")} AS total,
  count(*) FILTER (WHERE coalesce({num('order_net_sales')}, 0) = 0) AS zeros FROM {H} GROUP BY 1"""
PRODUCT = f"{dec('l_extendedprice')} * {dec('l_discount')}"
SQL["t7_fixed_point"] = f"""SELECT l_returnflag, {dsum(f'CAST({PRODUCT} AS DECIMAL(18,2))')} AS cents, {dsum(f'CAST({PRODUCT} AS DECIMAL(18,4))')} AS mills
  FROM lineitem GROUP BY 1"""
SQL["t8_blank_for_null"] = f"SELECT order_id, date, coalesce(order_shipping_address_country, '') AS country, coalesce(order_location_name, '') AS store FROM {H}"
SQL["t9_null_for_blank"] = "SELECT customer_id, date, NULLIF(customer_default_address_country, '') AS country FROM raw_customers"
SQL["t10_coalesce_chain"] = f"""SELECT product_id, date,
  CAST(coalesce(product_variant_inventory_item_cost, {dec('product_price * 0.5')}) AS DOUBLE) AS cost_or_half_price FROM raw_products"""
SQL["t11_safe_ratio"] = f"""SELECT customer_id, date, {ratio('customer_total_spent', 'customer_orders_count', 2)} AS per_order,
  {ratio('customer_orders_count', 'customer_orders_count')} AS one_or_null FROM raw_customers"""
EIGHTH = dec(dec("p_retailprice") + " * 0.125")
SQL["t12_round_decimal"] = f"SELECT p_partkey, {money(EIGHTH, 0)} AS round_0, {money(EIGHTH, 1)} AS round_1, {money(EIGHTH, 2)} AS round_2 FROM part"
SQL["t13_three_valued_filter"] = f"""SELECT count(*) FILTER (WHERE order_financial_status <> 'CANCELLED') AS passes,
  count(*) FILTER (WHERE order_financial_status = 'CANCELLED') AS fails, count(*) FILTER (WHERE order_financial_status IS NULL) AS unknown FROM {H}"""

# ---- projections, predicates, mappings ---------------------------------------

SQL["p1_valid_orders"] = f"SELECT order_financial_status, order_test, count(*) AS n FROM {H} WHERE {VALID} GROUP BY 1, 2"
SQL["p2_channel_mapping"] = f"SELECT order_app_name, {CHANNEL} AS channel, count(*) AS n FROM {H} GROUP BY 1, 2"
SQL["p3_source_app"] = f"""SELECT CASE o_orderkey % 7 WHEN 0 THEN 'web' WHEN 1 THEN 'pos' WHEN 2 THEN 'mobile' WHEN 3 THEN 'shopify_draft_order'
  WHEN 4 THEN 'iphone' WHEN 5 THEN '3890849' END AS source_name, {APP} AS app, count(*) AS n FROM {DOCS} GROUP BY 1, 2"""
SQL["p4_store_names"] = f"SELECT {LOC} AS location_id, {STORE} AS store, count(*) AS n FROM {DOCS} GROUP BY 1, 2"
SQL["p5_real_lines"] = "SELECT count(line_item__id) AS lines, count(*) FILTER (WHERE line_item__id IS NULL) AS empty_rows FROM raw_orders"
SQL["p6_merchandise_titles"] = """SELECT line_item__vendor, count(*) AS n FROM raw_orders
  WHERE line_item__id IS NOT NULL AND lower(line_item__title) NOT IN ('gift card', 'paper bag') GROUP BY 1"""
SQL["p7_meaningful_refunds"] = """SELECT date, count(*) AS n FROM raw_refunds
  WHERE line_item__refunds_subtotal > 0 OR order_refund_discrepancy_amount <> 0 OR order_total_shipping_refunded_price <> 0 GROUP BY 1"""
SQL["p8_customer_segments"] = """SELECT CASE WHEN customer_is_returning = 'True' THEN 'Returning' ELSE 'New' END AS customer_type,
  CASE WHEN customer_orders_count = 0 THEN 'No Orders' WHEN customer_orders_count = 1 THEN 'One-time' ELSE 'Repeat' END AS purchase_segment,
  count(*) AS n FROM raw_customers GROUP BY 1, 2"""
BUCKET = """CASE WHEN a <= 30 THEN '0-30 days' WHEN a <= 60 THEN '31-60 days' WHEN a <= 90 THEN '61-90 days' WHEN a <= 180 THEN '91-180 days' ELSE '180+ days' END"""
SQL["p9_age_buckets"] = f"""SELECT {BUCKET} AS bucket, CASE WHEN a IS NULL THEN 'unknown' ELSE {BUCKET} END AS bucket_or_unknown, count(*) AS n
  FROM (SELECT datediff('day', TRY_CAST(product_metafield_value AS DATE), date) AS a FROM raw_metafields WHERE product_metafield_key = 'date') GROUP BY 1, 2"""
SQL["p10_bucket_order"] = """SELECT aging_bucket, count(*) AS products, CASE aging_bucket WHEN '0-30 days' THEN 1 WHEN '31-60 days' THEN 2
  WHEN '61-90 days' THEN 3 WHEN '91-180 days' THEN 4 ELSE 5 END AS position FROM fact_inventory GROUP BY 1"""
SQL["p11_owned_cost"] = f"SELECT contract_type, is_consignment, {dsum('cost_excl_consignment')} AS owned, {dsum('cost_value')} AS all_cost FROM fact_inventory GROUP BY 1, 2"
SQL["p12_extended_values"] = f"SELECT product_id, {dbl('retail_value cost_value')} FROM fact_inventory"
SQL["p13_profit_and_margin"] = "SELECT order_id, CAST(gross_profit AS DOUBLE) AS gross_profit, gross_margin_pct FROM fact_orders"
_BARE = """(SELECT * REPLACE (CASE WHEN CAST(product_id AS INT) % 7 > 0 THEN product_price END AS product_price,
    CASE CAST(product_id AS INT) % 3 WHEN 0 THEN product_inventory_quantity + 0.5 WHEN 1 THEN -product_inventory_quantity ELSE product_inventory_quantity END
      AS product_inventory_quantity) FROM latest_products)"""
SQL["p12_extended_values_without_price"] = f"""SELECT product_id, units_on_hand, {dbl('retail_value cost_value cost_excl_consignment')} FROM ({inventory(_BARE)})"""
_NET = "CASE CAST(order_id AS BIGINT) % 19 WHEN 0 THEN 0 WHEN 1 THEN -10.5 WHEN 2 THEN NULL ELSE net_sales END"
SQL["p13_margin_of_nothing"] = f"""SELECT order_id, {dbl('net_sales cogs')}, CAST(net_sales - cogs AS DOUBLE) AS gross_profit, {ratio('(net_sales - cogs)', 'net_sales')} AS gross_margin_pct
  FROM (SELECT order_id, CAST({_NET} AS DECIMAL(18,4)) AS net_sales, cogs FROM fact_orders)"""
SQL["p14_total_refunded"] = f"SELECT order_id, {dsum('total_refunded')} AS total_refunded, {dsum('refund_tax')} AS refund_tax FROM fact_refunds GROUP BY 1"
SQL["p15_rename_to_common"] = "SELECT ad_id, adset_id AS ad_group_id, purchases AS conversions FROM raw_meta_ads"
SQL["p16_filter_slots"] = f"""SELECT order_id, order_date, CAST(net_sales AS DOUBLE) AS net_sales FROM clean_orders
  WHERE order_date BETWEEN DATE '2001-01-01' AND {AS_OF} AND store_location IN ('Store 1', 'Store 2') AND channel = 'Retail' AND ship_province = 'Ontario'"""
SQL["p16_contract_slot"] = """SELECT product_id, CAST(retail_value AS DOUBLE) AS retail_value FROM fact_inventory
  WHERE contract_type = 'buyout' AND store_location = 'Store 3'"""
SQL["p17_relative_windows"] = f"""SELECT count(*) FILTER (WHERE {mtd('order_date')}) AS mtd,
  count(*) FILTER (WHERE date_trunc('month', order_date) = date_trunc('month', {AS_OF} - INTERVAL 1 YEAR)) AS same_month_ly,
  count(*) FILTER (WHERE {last30('order_date')}) AS last_30, count(*) FILTER (WHERE order_date >= {AS_OF} - INTERVAL 365 DAY) AS last_365,
  count(*) FILTER (WHERE order_date >= {AS_OF} - INTERVAL 12 MONTH) AS last_12_months FROM clean_orders"""
SQL["p18_keywords"] = """SELECT date, customer_note, count(*) AS n FROM raw_customers
  WHERE regexp_matches(lower(customer_note), 'seller|consign|buyout|sell to us|supplier|vendor') GROUP BY 1, 2"""
SQL["a12_tag_frequency"] = """SELECT tag, count(DISTINCT customer_id) AS customers
  FROM (SELECT customer_id, trim(unnest(string_split(customer_tags, ','))) AS tag FROM latest_customers) WHERE tag <> '' GROUP BY 1"""

# ---- joins -------------------------------------------------------------------

SQL["j1_line_cost"] = """SELECT l.order_id, l.line_item__id, l.line_item__product_id AS product_id, CAST(c.unit_cost AS DOUBLE) AS unit_cost
  FROM clean_lines l LEFT JOIN unit_costs c ON l.line_item__product_id = c.product_id"""
SQL["j1_hot_product"] = """SELECT l.p AS product_id, count(*) AS lines, CAST(SUM(l.q * c.unit_cost) AS DOUBLE) AS cost, l.p = '5' AS hot
  FROM (SELECT CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '5' ELSE line_item__product_id END AS p, line_item__quantity AS q FROM clean_lines) l
  LEFT JOIN unit_costs c ON l.p = c.product_id GROUP BY 1"""
SQL["j2_order_lines"] = """SELECT o.order_id, o.channel, CAST(coalesce(t.total_units, 0) AS DOUBLE) AS total_units
  FROM clean_orders o LEFT JOIN order_totals t ON o.order_id = t.order_id"""
SQL["j3_customer_preferences"] = """SELECT c.customer_id, p.store_location, p.channel FROM latest_customers c LEFT JOIN preferred p
  ON c.customer_id = p.customer_id"""
SQL["j4_product_attributes"] = """SELECT CAST(p.p_partkey AS STRING) AS product_id, a.contract_type, a.msrp FROM part p
  LEFT JOIN attributes a ON CAST(p.p_partkey AS STRING) = a.product_id"""
SQL["j5_refund_parent"] = "SELECT order_id, refund_id, channel, store_location, financial_status FROM fact_refunds"
_MISSING = "CAST(order_id AS BIGINT) % 23 = 0"
SQL["j5_refund_of_missing_order"] = f"""SELECT channel, store_location, financial_status, count(*) AS lines, count(DISTINCT order_id) AS orders, {dsum('total_refunded')} AS total_refunded
  FROM (SELECT order_id, total_refunded, CASE WHEN NOT {_MISSING} THEN channel END AS channel, CASE WHEN NOT {_MISSING} THEN store_location END AS store_location,
    CASE WHEN NOT {_MISSING} THEN financial_status END AS financial_status FROM fact_refunds) GROUP BY 1, 2, 3"""
SQL["j6_email_header"] = "SELECT campaign_id, campaign_name, campaign_status FROM fact_email"
SQL["j7_seller_location"] = "SELECT product_id, seller_name, store_location FROM supplied"
SQL["j7_seller_without_location"] = """SELECT product_id, seller_name, CASE WHEN CAST(product_id AS INT) % 8 = 4 THEN 'A' WHEN CAST(product_id AS INT) % 8 > 4 THEN store_location END AS store_location
  FROM supplied"""
SQL["j8_item_channel"] = "SELECT channel, count(*) AS items FROM supplied GROUP BY 1"
SQL["j9_name_match"] = """SELECT s.seller_name, c.customer_id FROM (SELECT DISTINCT seller_name FROM supplied) s LEFT JOIN consignors c
  ON lower(trim(s.seller_name)) = lower(trim(c.customer_first_name) || ' ' || trim(c.customer_last_name))"""
SQL["j10_scalars_side_by_side"] = f"""SELECT a.net_sales, b.stock_value FROM (SELECT {dsum('net_sales')} AS net_sales FROM clean_orders) a,
  (SELECT {dsum('retail_value')} AS stock_value FROM fact_inventory) b"""
SQL["j11_orders_with_refunds"] = f"""SELECT o.channel, count(DISTINCT o.order_id) AS orders, count(DISTINCT r.order_id) AS refunded,
  {ratio('count(DISTINCT r.order_id)', 'count(DISTINCT o.order_id)', 1, True)} AS rate_pct
  FROM clean_orders o LEFT JOIN clean_refunds r ON o.order_id = r.order_id GROUP BY 1"""
SQL["j12_lookup"] = """SELECT r_name, count(*) AS customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""
SQL["j13_existence_flag"] = "SELECT is_also_buyer, count(*) AS n FROM fact_seller GROUP BY 1"
SQL["j13_semi_and_anti"] = """SELECT count(*) FILTER (WHERE order_id IN (SELECT order_id FROM clean_refunds)) AS refunded,
  count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM clean_refunds)) AS not_refunded FROM clean_orders"""

# ---- aggregations ------------------------------------------------------------

SQL["a1_grouped_sums"] = f"SELECT channel, {money('SUM(net_sales)')} AS net_sales, {money('SUM(total_discounts)')} AS discounts FROM clean_orders GROUP BY 1"
SQL["a2_sum_of_products"] = f"SELECT line_item__product_id, {dsum('line_item__price * line_item__quantity')} AS value FROM clean_lines GROUP BY 1"
SQL["a3_distinct_count"] = "SELECT year, count(DISTINCT order_id) AS orders, count(DISTINCT order_customer_id) AS customers FROM raw_orders GROUP BY 1"
SQL["a3_distinct_from_bitmaps"] = """SELECT channel, CAST(date_trunc('month', order_date) AS DATE) AS month, what,
    count(DISTINCT CASE WHEN what = 'orders' THEN order_id ELSE order_customer_id END) AS members
  FROM (SELECT * FROM clean_orders WHERE order_date IS NOT NULL), (VALUES ('orders'), ('customers')) w(what)
  GROUP BY GROUPING SETS ((channel, date_trunc('month', order_date), what), (channel, what)) HAVING members > 0"""
SQL["a4_ratio_of_totals"] = f"""SELECT year, {ratio('SUM(net_sales)', 'count(DISTINCT order_id)', 2)} AS aov,
  {ratio('SUM(shipping_revenue)', 'SUM(net_sales)', 1, True)} AS shipping_pct FROM clean_orders GROUP BY 1"""
SQL["a5_conditional_count"] = """SELECT date, count(*) FILTER (WHERE customer_tags ILIKE '%cognito-consignment%') AS tagged,
  count(*) FILTER (WHERE customer_orders_count > 0) AS buyers FROM raw_customers GROUP BY 1"""
SQL["a6_conditional_distinct"] = """SELECT l_linestatus, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned_orders,
  count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1"""
YEARS = ", ".join(dsum(f"CASE WHEN year = '{y}' THEN net_sales ELSE 0 END") + f" AS y{y}" for y in range(1995, 2002))
SQL["a7_conditional_sum"] = f"SELECT channel, {YEARS} FROM clean_orders GROUP BY 1"
SQL["a7_year_pivot"] = "SELECT channel, " + ", ".join(
    f"NULLIF(count(*) FILTER (WHERE year = '{y}'), 0) AS \"{y}\"" for y in range(1995, 2002)) + " FROM clean_orders GROUP BY 1"
SQL["a8_extremes"] = f"""SELECT product_vendor, CAST(min(product_price) AS DOUBLE) AS low, CAST(max(product_price) AS DOUBLE) AS high,
  {ratio('SUM(product_price)', 'count(product_price)', 2)} AS mean, count(*) AS n FROM raw_products GROUP BY 1"""
SQL["a9_global_aggregate"] = f"SELECT {dsum('line_item__refunds_subtotal')} AS subtotal, count(*) AS n, max(date) AS last_day FROM raw_refunds"
SQL["a10_rollup_of_cells"] = f"""SELECT channel, store_location, {dsum('net_sales')} AS net_sales,
  {ratio('SUM(shipping_revenue)', 'SUM(net_sales)', 1, True)} AS shipping_pct FROM fact_daily GROUP BY 1, 2"""
LATEST = "arg_max({0}, struct_pack(d := date, o := order_id)) FILTER (WHERE {0} IS NOT NULL)"
SQL["a11_latest_known"] = f"""SELECT order_customer_id, {LATEST.format('order_location_name')} AS store,
  {LATEST.format('order_shipping_address_country')} AS country FROM {H} WHERE order_customer_id IS NOT NULL GROUP BY 1"""
SQL["a12_value_frequency"] = """SELECT product_metafield_namespace, product_metafield_key, product_metafield_value, count(*) AS occurrences
  FROM raw_metafields GROUP BY 1, 2, 3"""
SQL["a13_share_of_total"] = f"SELECT channel, count(*) AS orders, {ratio('count(*)', '(SUM(count(*)) OVER ())', 1, True)} AS pct FROM clean_orders GROUP BY 1"

# ---- one row per key, windows ------------------------------------------------

SQL["d1_latest_row"] = """SELECT product_id, product_updated_at_datetime, date, CAST(product_inventory_quantity AS DOUBLE) AS product_inventory_quantity
  FROM raw_products QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_updated_at_datetime DESC) = 1"""
SQL["d2_preferred_then_latest"] = f"""SELECT order_id, order_location_name, date, order_financial_status FROM {H}
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {LOCATED}, date DESC) = 1"""
SQL["d3_composite_key"] = f"""SELECT order_id, line_item__id, order_location_name, date, line_item__product_id,
  {dbl('line_item__quantity line_item__price')} FROM clean_lines"""
SQL["d4_null_folded_key"] = f"SELECT order_id, order_refunds, date, {dbl('line_item__refunds_subtotal line_item__refunds_quantity')} FROM clean_refunds"
SQL["d5_attribute_latest"] = """SELECT product_id, product_metafield_namespace, product_metafield_key, product_metafield_update_at, product_metafield_value
  FROM latest_metafields"""
SQL["d6_contract_check"] = f"""
SELECT 'order_net_sales' AS column_name, count(order_net_sales) AS filled, count(*) FILTER (WHERE order_net_sales IS NOT NULL AND {num('order_net_sales')} IS NULL) AS unreadable FROM raw_orders
UNION ALL SELECT 'order_created_at', count(order_created_at), count(*) FILTER (WHERE order_created_at IS NOT NULL AND TRY_CAST(order_created_at AS TIMESTAMPTZ) IS NULL) FROM raw_orders
UNION ALL SELECT 'order_customer_id', count(order_customer_id), count(*) FILTER (WHERE order_customer_id IS NOT NULL AND TRY_CAST(order_customer_id AS BIGINT) IS NULL) FROM raw_orders"""
_TEXT_COLUMNS = """account_name line_item__id line_item__product_id line_item__sku line_item__title line_item__vendor month order_app_name order_created_at
  order_currency order_customer_last_visit_utm_campaign order_customer_last_visit_utm_medium order_customer_last_visit_utm_source order_financial_status
  order_id order_name order_net_sales order_processed_at order_shipping_address_country order_shipping_address_province order_test source week year
  year_month order_location_id order_location_name order_customer_id""".split()
_AMOUNT_COLUMNS = """line_item__price line_item__quantity line_item__total_discount line_item__variant_unit_cost order_quantity order_shipping_price
  order_total_discounts order_total_price order_total_tax_amount""".split()
_LOST = {"order_total_price": 13, "ingested_at": 17}


def _report(name: str, status: str, expected: str, found: str, filled: str) -> str:
    lost = f"count(*) FILTER (WHERE CAST(order_id AS BIGINT) % {_LOST[name]} = 0)" if name in _LOST else "CAST(0 AS BIGINT)"
    return (
        f"SELECT '{name}' AS column_name, '{status}' AS status, {expected} AS expected, {found} AS found, count(*) AS rows, {filled} AS filled, "
        f"{lost} AS unreadable FROM raw_orders"
    )


SQL["d6_contract_report"] = " UNION ALL ".join(
    [_report(c, "ok", "'string'", "'string'", f"count({c})") for c in _TEXT_COLUMNS]
    + [_report(c, "type", "'decimal(18,4)'", "'string'", f"count({c})") for c in _AMOUNT_COLUMNS]
    + [_report(c, "type", "'date'", "'string'", f"count({c})") for c in ("date", "ingested_at")]
    + [_report("order_subtotal_price", "missing", "'decimal(18,4)'", "NULL", "CAST(0 AS BIGINT)")]
    + [_report("order_subtotal", "unexpected", "NULL", "'string'", "count(order_subtotal_price)")]
    + [_report("coupon", "unexpected", "NULL", "'string'", "count(*) FILTER (WHERE CAST(order_id AS BIGINT) % 2 = 0)")]
)
SQL["d7_raw_cleanup"] = f"""SELECT order_id, date, line_item__id, ingested_at, order_location_name, order_customer_id, line_item__product_id,
  {dbl('line_item__quantity line_item__price line_item__total_discount')} FROM raw_orders
  QUALIFY row_number() OVER (PARTITION BY order_id, date, line_item__id ORDER BY {LOCATED}, (order_customer_id IS NOT NULL) DESC, ingested_at DESC,
    line_item__product_id DESC NULLS LAST, line_item__quantity DESC NULLS LAST, line_item__price DESC NULLS LAST,
    line_item__total_discount DESC NULLS LAST) = 1"""
SQL["w1_whole_result_window"] = f"""SELECT store_location, count(*) AS products, {ratio('count(*)', '(SUM(count(*)) OVER ())', 2, True)} AS pct
  FROM fact_inventory WHERE units_on_hand > 0 GROUP BY 1"""
SQL["w2_change_on_previous_period"] = f"""SELECT value, previous, value - previous AS change, {ratio('(value - previous)', 'previous', 1, True)} AS change_pct
  FROM (SELECT {money("SUM(net_sales) FILTER (WHERE order_date BETWEEN DATE '2001-06-16' AND DATE '2001-07-15')")} AS value,
    {money("SUM(net_sales) FILTER (WHERE order_date BETWEEN DATE '2001-05-17' AND DATE '2001-06-15')")} AS previous FROM clean_orders)"""
SQL["w3_cumulative_this_year_last_year"] = f"""SELECT day_of_month, CAST(SUM(a) OVER w AS DOUBLE) AS this_year, CAST(SUM(b) OVER w AS DOUBLE) AS last_year
  FROM (SELECT CAST(day(order_date) AS INT) AS day_of_month, SUM(CASE WHEN year(order_date) = 2001 THEN net_sales ELSE 0 END) AS a,
    SUM(CASE WHEN year(order_date) = 2000 THEN net_sales ELSE 0 END) AS b
    FROM fact_daily WHERE channel = 'Retail' AND month(order_date) = month({AS_OF}) GROUP BY 1)
  WINDOW w AS (ORDER BY day_of_month ROWS UNBOUNDED PRECEDING)"""
INVENTORY_EDGE = "retail_price unit_cost retail_value cost_value cost_excl_consignment msrp"
EARLY = """(SELECT * FROM raw_products WHERE date <= DATE '2001-06-20' AND product_id IS NOT NULL AND lower(product_status) = 'active'
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_updated_at_datetime DESC) = 1)"""
SQL["w4_as_of_snapshot"] = edge("", INVENTORY_EDGE, f"({inventory(EARLY)})")
SQL["w4_daily_stock"] = f"""SELECT day, aging_bucket, count(*) AS products, CAST(sum(units_on_hand) AS BIGINT) AS units_on_hand, {dsum('retail_value')} AS retail_value,
  {dsum('coalesce(cost_value, 0)')} AS cost_value, {dsum('coalesce(cost_excl_consignment, 0)')} AS cost_excl_consignment,
  CAST(coalesce(sum(days_in_inventory), 0) AS BIGINT) AS days_in_inventory
  FROM (SELECT CAST(d AS DATE) AS day, f.* FROM generate_series(DATE '2001-06-01', DATE '2001-07-31', INTERVAL 1 DAY) t(d)
    JOIN ({inventory("(SELECT * FROM raw_products WHERE product_id IS NOT NULL AND lower(product_status) = 'active')")}) f ON f.snapshot_date <= CAST(d AS DATE)
    QUALIFY row_number() OVER (PARTITION BY d, product_id ORDER BY product_updated_at_datetime DESC, snapshot_date DESC) = 1)
  GROUP BY 1, 2"""
SQL["w4_snapshot_on_day_of_sale"] = f"""SELECT CAST(date_trunc('month', l.order_date) AS DATE) AS month, v.snapshot_date, count(*) AS lines,
  {dsum('line_item__quantity')} AS units_sold, CAST(sum(v.units_on_hand) AS BIGINT) AS units_on_hand
  FROM (SELECT * FROM merch_lines WHERE order_date IS NOT NULL) l
  ASOF LEFT JOIN ({inventory("(SELECT * FROM raw_products WHERE product_id IS NOT NULL AND lower(product_status) = 'active')")}) v
    ON l.line_item__product_id = v.product_id AND l.order_date >= v.snapshot_date
  GROUP BY 1, 2"""
SQL["w4_latest_row_on_day"] = """SELECT product_id, units_on_hand, CAST(retail_value AS DOUBLE) AS retail_value FROM fact_inventory
  WHERE snapshot_date = DATE '2001-07-14'"""

# ---- order, limit, union -----------------------------------------------------

SQL["o1_ordered_result"] = "SELECT order_date, channel, ship_country, ship_province, store_location, CAST(net_sales AS DOUBLE) AS net_sales FROM fact_daily"
SQL["o2_top_n"] = f"SELECT vendor, {dsum('gross_revenue')} AS revenue FROM fact_products_sold GROUP BY 1 ORDER BY SUM(gross_revenue) DESC, vendor LIMIT 15"
SQL["o3_top_after_filter"] = f"""SELECT customer_id, customer_first_name, customer_last_name, {dbl('customer_orders_count customer_total_spent')}
  FROM latest_customers WHERE customer_tags ILIKE '%cognito-consignment%' AND customer_orders_count > 0
  ORDER BY latest_customers.customer_total_spent DESC, customer_id LIMIT 10"""
SQL["u1_union_to_common_schema"] = f"""SELECT source, date, count(*) AS ads, {isum('reach')} AS reach, {isum('conversions')} AS conversions
  FROM fact_marketing GROUP BY 1, 2"""
SQL["u2_union_of_totals"] = f"""SELECT 'sold' AS kind, {dsum('line_item__quantity')} AS units FROM merch_lines
  UNION ALL SELECT 'on hand', {dsum('units_on_hand')} FROM fact_inventory"""
SQL["u4_nested_stages"] = f"""SELECT i.aging_bucket, {dsum('b.revenue')} AS revenue, {dsum('i.retail_value')} AS retail_value,
  count(*) FILTER (WHERE b.revenue IS NULL) AS unsold
  FROM fact_inventory i LEFT JOIN (SELECT product_id, SUM(gross_revenue) AS revenue FROM fact_products_sold GROUP BY 1) b ON i.product_id = b.product_id GROUP BY 1"""

# ---- scalar functions --------------------------------------------------------

SQL["f1_strings"] = """SELECT customer_id, date, upper(customer_last_name) AS upper_name,
  split_part(customer_created_at, 'T', 1) || '|' || lpad(customer_id, 6, '0') AS packed, lower(customer_tags) LIKE '%consignment%' AS tagged,
  trim(customer_first_name) || ' ' || trim(customer_last_name) AS full_name FROM raw_customers"""
SQL["f2_regex"] = """SELECT order_id, max(NULLIF(regexp_extract(order_refunds, '/([0-9]+)$', 1), '')) AS refund_id,
  max(NULLIF(regexp_extract(order_name, '/([0-9]+)$', 1), '')) AS no_match FROM raw_refunds GROUP BY 1"""
SQL["f3_dates"] = f"""SELECT order_id, date, CAST(date_trunc('month', date) AS DATE) AS month_start, date - 30 AS month_ago,
  CAST(date - INTERVAL 12 MONTH AS DATE) AS year_ago, CAST(day(date) AS INT) AS d, CAST(month(date) AS INT) AS m, CAST(year(date) AS INT) AS y,
  CAST(datediff('day', date, {AS_OF}) AS INT) AS age,
  datesub('hour', CAST(order_created_at AS TIMESTAMPTZ), CAST(order_processed_at AS TIMESTAMPTZ)) AS hours FROM {H}"""
SQL["f4_week_number"] = f"""SELECT DISTINCT d AS day, CAST(weekofyear(d) AS STRING) AS week,
  CAST(year(d) AS STRING) || '|' || CAST(month(d) AS STRING) AS year_month, lpad(CAST(month(d) AS STRING), 2, '0') AS month
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)"""
SQL["f5_math"] = f"SELECT campaign_id, {dsum('spend')} AS spend, {money('SUM(spend * 2)', 1)} AS twice FROM raw_google_ads GROUP BY 1"
SQL["f6_conditionals"] = """SELECT CASE WHEN p_size BETWEEN 1 AND 15 THEN 'small' WHEN p_size BETWEEN 16 AND 30 THEN 'medium' ELSE 'large' END AS size,
  coalesce(NULLIF(p_brand, 'Brand#1'), 'none') AS brand, count(*) AS n FROM part GROUP BY 1, 2"""
SQL["f7_arrays"] = f"""SELECT CAST(o_orderkey AS STRING) AS id, coalesce(CAST(l_quantity AS BIGINT), 0) AS units, {LINE_ID} AS first_line,
  CASE WHEN l_linenumber % 3 = 0 THEN {LINE_ID} || '-w' END AS bag_line FROM {DOCS}"""
SQL["f8_json_and_maps"] = f"""SELECT CASE event_type WHEN 'purchase' THEN 'sale' WHEN 'view' THEN 'visit' WHEN 'click' THEN 'visit' END AS label,
  {isum("CAST(json_extract_string(props, '$.k') AS BIGINT)")} AS k, max(json_extract_string(props, '$.k')) AS k_text, count(*) AS n FROM events GROUP BY 1"""

# ---- reshaping and identity --------------------------------------------------

SQL["e1_attribute_pivot"] = f"""SELECT product_id, {attribute('buy', 'contract_type')} AS contract_type, {attribute('buy', 'date')} AS buy_date,
  {attribute('buy', 'seller_name')} AS seller_name, {attribute('buy', 'msrp')} AS msrp, {attribute('custom', 'condition')} AS condition_grade,
  {attribute('custom', 'location')} AS location_text FROM latest_metafields GROUP BY product_id"""
SQL["e1_attribute_pivot_any_version"] = f"""SELECT product_id, {attribute('buy', 'seller_name')} AS seller_name, {attribute('buy', 'contract_type')} AS contract_type,
  {attribute('buy', 'date')} AS buy_date, {attribute('custom', 'location')} AS location_text FROM raw_metafields GROUP BY product_id"""
SQL["e2_first_quoted"] = f"""SELECT product_id, product_metafield_key, {QUOTED.format('product_metafield_value')} AS value
  FROM raw_metafields WHERE product_metafield_namespace = 'custom'"""
SQL["e3_seller_rollup"] = "SELECT * FROM seller_summary"
SQL["e4_consignors"] = "SELECT customer_id, date, CAST(customer_total_spent AS DOUBLE) AS customer_total_spent FROM consignors"
SQL["e5_identity_by_id"] = f"""SELECT s.seller_name, s.k AS seller_customer_id, c.customer_id, c.customer_tags
  FROM (SELECT DISTINCT seller_name, NULLIF(k, '') AS k FROM (SELECT {attribute('buy', 'seller_name')} AS seller_name, {attribute('buy', 'customer_id')} AS k
    FROM latest_metafields GROUP BY product_id) WHERE seller_name <> '') s LEFT JOIN consignors c ON s.k = c.customer_id"""


def closure(paper: str) -> str:
    """Smallest key reachable from each key over records that share keys."""
    return f"""(WITH RECURSIVE records AS (
    SELECT CASE WHEN k <> '' THEN 'id:' || k END AS a, CASE WHEN trim(seller_name) <> '' THEN 'name:' || lower(trim(seller_name)) END AS b, {paper} AS c
    FROM (SELECT product_id, {attribute('buy', 'seller_name')} AS seller_name, {attribute('buy', 'customer_id')} AS k FROM latest_metafields GROUP BY product_id)
    UNION ALL SELECT 'id:' || customer_id, 'name:' || lower(trim(customer_first_name) || ' ' || trim(customer_last_name)), NULL FROM latest_customers),
  keyed AS (SELECT list_filter([a, b, c], lambda k: k IS NOT NULL) AS keys FROM records),
  pairs AS (SELECT DISTINCT x, unnest(keys) AS y FROM (SELECT keys, unnest(keys) AS x FROM keyed)),
  reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x)
  SELECT x AS key, min(y) AS person_id FROM reach GROUP BY x)"""


SQL["e5_identity_components"] = f"SELECT key, person_id FROM {closure("'paper:' || CAST(CAST(product_id AS BIGINT) // 3 AS STRING)")}"
SQL["e5_seller_people"] = f"""SELECT s.seller_name, s.contract_type, s.store_location, s.channel, s.customer_id, s.is_also_buyer, p.person_id, n.person_customers
  FROM fact_seller s LEFT JOIN {closure('NULL')} p ON p.key = 'name:' || lower(trim(s.seller_name))
  LEFT JOIN (SELECT person_id, count(*) AS person_customers FROM {closure('NULL')} WHERE key LIKE 'id:%' GROUP BY person_id) n ON p.person_id = n.person_id"""
SQL["e6_preferred_store_and_channel"] = "SELECT * FROM preferred"
SQL["e7_inventory_to_sales_channel"] = """SELECT i.product_id, i.store_location AS stock_location, s.order_date, s.channel, s.store_location
  FROM fact_inventory i LEFT JOIN (SELECT product_id, order_date, channel, store_location FROM fact_products_sold
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_date DESC, channel DESC, store_location DESC NULLS LAST) = 1) s ON i.product_id = s.product_id"""

# ---- incremental and streaming -----------------------------------------------

SQL["i1_lookback_ingest"] = f"""SELECT DISTINCT CAST(o_orderkey AS STRING) AS order_id, id AS line_item__id, d AS date,
  CASE WHEN u >= DATE '2001-07-13' THEN DATE '2001-07-15' ELSE DATE '2001-07-13' END AS run_day
  FROM (SELECT *, d + CAST(o_orderkey % 3 AS INT) AS u, {LINE_ID} AS id FROM {DOCS}
    UNION ALL SELECT *, d + CAST(o_orderkey % 3 AS INT), {LINE_ID} || '-w' FROM {DOCS} WHERE l_linenumber % 3 = 0)
  WHERE u BETWEEN DATE '2001-07-11' AND DATE '2001-07-15'"""
SQL["i1_refresh_months"] = edge("fact_daily", EDGE["fact_daily"])
SQL["i1_refresh_late_update"] = f"""SELECT order_date, channel, ship_country, ship_province, store_location,
  CAST(ROUND(SUM(late), 2) AS DOUBLE) AS net_sales, CAST(ROUND(SUM(total_discounts), 2) AS DOUBLE) AS total_discounts,
  CAST(ROUND(SUM(shipping_revenue), 2) AS DOUBLE) AS shipping_revenue, CAST(ROUND(SUM(gross_revenue), 2) AS DOUBLE) AS gross_revenue,
  CAST(SUM(order_quantity) AS DOUBLE) AS total_units, {ratio('SUM(late)', 'COUNT(DISTINCT order_id)', 2)} AS aov
  FROM (SELECT *, CASE WHEN substr(order_created_ts, 6, 2) IN ('01', '05', '09') THEN net_sales * 2 ELSE net_sales END AS late FROM clean_orders)
  GROUP BY 1, 2, 3, 4, 5"""
SQL["i1_refresh_vanished"] = """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS orders FROM clean_orders
  WHERE NOT (order_created_ts >= '2000-04-03' AND order_created_ts < '2000-06-03') GROUP BY 1"""
SQL["i1_ledger_refresh"] = " UNION ALL ".join(
    f"SELECT '{fact}' AS fact, CAST(date_trunc('month', {d}) AS DATE) AS month, count(*) AS rows, {dsum(v)} AS amount FROM {table} WHERE {d} IS NOT NULL GROUP BY 2"
    for fact, table, d, v in (
        ("orders", "fact_orders", "order_date", "gross_profit"), ("daily_sales", "fact_daily", "order_date", "net_sales"),
        ("product_sales", "fact_products_sold", "order_date", "gross_profit"), ("refunds", "fact_refunds", "refund_date", "total_refunded"),
    )
)
SQL["i2_drop_repeats_stream"] = f"SELECT order_id, ingested_at, order_created_at, order_app_name FROM {H}"
SQL["i2_latest_wins_stream"] = """SELECT date, campaign_id, ad_id, CAST(CASE WHEN CAST(ad_id AS BIGINT) % 4 = 0 THEN spend + 1 ELSE spend END AS DOUBLE) AS spend,
  CASE WHEN CAST(ad_id AS BIGINT) % 4 = 0 THEN 2 ELSE 1 END AS version FROM raw_meta_ads"""
SQL["i3_status_history"] = f"SELECT order_id, count(*) AS days, min(date) AS first_day, max(date) AS last_day FROM {H} GROUP BY 1"
SQL["i4_rolling_repull"] = f"""SELECT date, {isum("CASE WHEN date > DATE '2001-07-15' THEN sends ELSE 0 END")} AS sends, count(*) AS n FROM raw_email_metrics WHERE date <> DATE '2001-07-20' GROUP BY 1"""
SQL["i5_daily_sales_stream"] = f"""SELECT order_date, channel, {dsum('net_sales')} AS net_sales, {dsum('shipping_revenue')} AS shipping_revenue,
  count(*) AS orders FROM clean_orders GROUP BY 1, 2"""
SQL["i6_backfill_by_creation"] = f"""SELECT d AS date, count(*) + count(*) FILTER (WHERE l_linenumber % 3 = 0) AS rows, count(DISTINCT o_orderkey) AS orders
  FROM {DOCS} WHERE d BETWEEN DATE '2001-01-01' AND DATE '2001-06-30' GROUP BY 1"""

# ---- quality -----------------------------------------------------------------

SQL["v1_load_report"] = """SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_keys, count(order_location_name) AS has_order_location_name,
  count(order_customer_id) AS has_order_customer_id, min(date) AS earliest, max(date) AS latest FROM raw_orders"""
SQL["v1_consignor_report"] = """SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS unique_customers, count(*) FILTER (WHERE customer_tags <> '') AS has_tags,
  count(*) FILTER (WHERE customer_tags ILIKE '%cognito-consignment%') AS consignors,
  count(*) FILTER (WHERE customer_tags ILIKE '%cognito-consignment%' AND customer_orders_count > 0) AS consignor_buyers FROM raw_customers"""
SQL["v2_row_delta"] = """SELECT date, count(*) AS rows_before, count(DISTINCT (order_id, line_item__id)) AS rows_after,
  count(DISTINCT (order_id, line_item__id)) - count(*) AS net_change FROM raw_orders GROUP BY 1"""
SQL["v3_cost_coverage"] = f"""SELECT product_vendor, count(*) AS rows, {ratio('count(product_variant_inventory_item_cost)', 'count(*)', 1, True)} AS cost_pct
  FROM raw_products GROUP BY 1"""
SQL["v3_location_coverage"] = f"""SELECT {CHANNEL} AS channel, count(*) AS rows, {ratio('count(order_location_name)', 'count(*)', 1, True)} AS store_pct,
  {ratio('count(order_customer_id)', 'count(*)', 1, True)} AS customer_pct FROM {H} GROUP BY 1"""
SQL["v4_reconcile"] = f"""SELECT year, CAST(a AS DOUBLE) AS ours, CAST(b AS DOUBLE) AS theirs, CAST(a - b AS DOUBLE) AS difference,
  {ratio('(a - b)', 'b', 2, True)} AS difference_pct, abs({ratio('(a - b)', 'b', 2, True)}) <= 5 AS within_tolerance
  FROM (SELECT year, SUM(net_sales) AS a FROM clean_orders GROUP BY 1)
  JOIN (SELECT CAST(year(o_orderdate) AS STRING) AS year, SUM({dec('o_totalprice')}) AS b FROM orders GROUP BY 1) USING (year)"""
SQL["v4_row_differences"] = """SELECT order_id, 'changed' AS status, 1 AS ours, 1 AS theirs FROM clean_orders
  WHERE CAST(order_id AS BIGINT) % 701 <> 0 AND ((CAST(order_id AS BIGINT) % 501 = 0 AND net_sales IS NOT NULL) OR (CAST(order_id AS BIGINT) % 601 = 0 AND order_date IS NOT NULL))
  UNION ALL SELECT order_id, 'extra', 1, 0 FROM clean_orders WHERE CAST(order_id AS BIGINT) % 701 = 0
  UNION ALL SELECT order_id || '-x', 'missing', 0, 1 FROM clean_orders WHERE CAST(order_id AS BIGINT) % 901 = 0"""
SQL["v5_duplicates"] = "SELECT order_id, line_item__id, count(*) AS copies FROM raw_orders GROUP BY 1, 2 HAVING count(*) > 1"
SQL["v6_overlap_summary"] = f"""SELECT count(*) AS consignors, count(*) FILTER (WHERE customer_orders_count > 0) AS also_buyers,
  {ratio('count(*) FILTER (WHERE customer_orders_count > 0)', 'count(*)', 1, True)} AS also_buyers_pct
  FROM latest_customers WHERE customer_tags ILIKE '%cognito-consignment%'"""

# ---- corrected forms of known quirks -----------------------------------------

SQL["z1_refunds_on_source_day"] = f"""SELECT date AS refund_date, count(*) AS n, {dsum('''ROUND(coalesce(line_item__refunds_subtotal, 0)
  + coalesce(order_refund_discrepancy_amount, 0) + coalesce(order_total_shipping_refunded_price, 0), 2)''')} AS total_refunded FROM clean_refunds GROUP BY 1"""
SQL["z2_dead_stock_without_undated"] = f"""SELECT CASE WHEN days_in_inventory IS NULL THEN 'unknown' ELSE aging_bucket END AS aging_bucket,
  {isum('units_on_hand')} AS units FROM fact_inventory GROUP BY 1"""
SQL["z7_acquisition_cost_as_published"] = f"""SELECT CAST(CASE WHEN c.n > 0 THEN ROUND(m.s, 2) END AS DOUBLE) AS cac
  FROM (SELECT SUM(spend) AS s FROM fact_marketing WHERE {last30('date')}) m,
  (SELECT count(*) AS n FROM fact_customers WHERE customer_type = 'New' AND {last30(utc_day('customer_created_at'))}) c"""
SQL["z8_adjustments_once_per_refund"] = f"""SELECT order_id, refund_id, {dsum('ROUND(ship, 2)')} AS shipping, {dsum('ROUND(disc, 2)')} AS discrepancy,
  {dsum('ROUND(coalesce(line_item__refunds_subtotal, 0) + disc + ship, 2)')} AS total_refunded
  FROM (SELECT *, CASE WHEN first THEN order_total_shipping_refunded_price ELSE 0 END AS ship, CASE WHEN first THEN order_refund_discrepancy_amount ELSE 0 END AS disc
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id, coalesce(order_refunds, 'NO_REFUND')
      ORDER BY coalesce(line_item__refunds_subtotal, 0), coalesce(line_item__refunds_quantity, 0)) = 1 AS first FROM clean_refunds))
  GROUP BY 1, 2"""
SQL["z27_net_after_returns"] = f"""SELECT month, CAST(a AS DOUBLE) AS net_sales, CAST(b AS DOUBLE) AS returned, CAST(coalesce(a, 0) - coalesce(b, 0) AS DOUBLE) AS net_after_returns
  FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(net_sales) AS a FROM clean_orders GROUP BY 1)
  FULL JOIN (SELECT CAST(date_trunc('month', refund_date) AS DATE) AS month, SUM(total_refunded) AS b FROM fact_refunds GROUP BY 1) USING (month)"""


_LINES = f"""SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, {dec('l_extendedprice')} AS s, CAST(l_quantity AS BIGINT) AS q FROM lineitem WHERE l_returnflag = 'R'"""
SQL["z11_refunds_by_line"] = f"""SELECT CAST(l_orderkey AS STRING) AS order_id, count(*) AS lines, CAST(SUM(s) AS DOUBLE) AS subtotal, 'amounts' AS by
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, s, q FROM ({_LINES})) GROUP BY l_orderkey
  UNION ALL SELECT CAST(l_orderkey AS STRING), CAST(SUM(CASE WHEN l_linenumber % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT), CAST(SUM(CASE WHEN l_linenumber % 3 = 0 THEN 2 * s ELSE s END) AS DOUBLE), 'line'
  FROM ({_LINES}) GROUP BY l_orderkey"""


_CELL_CARDS = """leadership_net_sales=net_sales leadership_orders=orders leadership_orders_by_sales_channel_pie=orders
  leadership_orders_by_channel_and_province_table=orders leadership_units_sold_by_day=units retail_gross_profit=gross_profit ecomm_sales_by_utm_source=net_sales
  leadership_net_sales_mtd=net_sales_mtd shipping_revenue_by_day=shipping_revenue retail_vs_ecomm_sales=net_sales leadership_refunded_units=refunded_units
  leadership_refunded_value_by_day=refunded_value marketing_spend_by_channel=spend marketing_daily_spend_by_channel=spend marketing_conversions_by_channel=conversions"""


def _cells() -> str:
    card = cards.statements()
    pairs = [p.split("=") for p in _CELL_CARDS.split()]
    return " UNION ALL ".join(
        f"SELECT '{key}' AS card, count(*) AS rows, CAST(sum(CAST({v} AS DECIMAL(28,4))) AS DOUBLE) AS total FROM ({card[key]})" for key, v in pairs
    )


def statements() -> dict[str, str]:
    return {key: full(sql) for key, sql in SQL.items()} | {"a10_cards_from_cells": _cells()}
