"""SQL for every card, written against the fact stages.

Placeholders: {d} the period a reader picked (all days that any fixture has), {mtd} the report month.
"""

from oracles.facts import full, money, ratio

AS_OF = "DATE '2001-07-15'"


def history(c: str) -> str:
    return f"{c} BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"


def mtd(c: str) -> str:
    return f"date_trunc('month', {c}) = date_trunc('month', {AS_OF})"


def last30(c: str) -> str:
    return f"{c} >= {AS_OF} - INTERVAL 30 DAY"


def pick(cols: str, table: str, *where: str, tail: str = "") -> str:
    cond = f" WHERE {' AND '.join(w for w in where if w)}" if any(where) else ""
    return f"SELECT {cols} FROM {table}{cond} {tail}"


def total(c: str) -> str:
    """Exact decimal total as double."""
    return f"CAST(SUM({c}) AS DOUBLE)"


def count_of(c: str) -> str:
    return f"CAST(SUM({c}) AS BIGINT)"


def avg(c: str, n: int, times: int = 1) -> str:
    t = f" * {times}" if times != 1 else ""
    return f"CAST(ROUND(CAST(CAST(SUM({c}) AS DOUBLE) / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0){t} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def pct_where(test: str) -> str:
    return ratio(f"COUNT(*) FILTER (WHERE {test})", "COUNT(*)", 1, True)


NET = money("SUM(net_sales)")
ORDERS = "COUNT(DISTINCT order_id)"
AOV = ratio("SUM(net_sales)", ORDERS, 2)
MARGIN = ratio("SUM(gross_profit)", "SUM(net_sales)", 1, True)
UPT = ratio("SUM(total_units)", ORDERS, 2)
PROFIT = money("SUM(gross_profit)")
SHIP = money("SUM(shipping_revenue)")
SHIP_PCT = ratio("SUM(shipping_revenue)", "SUM(net_sales)", 1, True)
VALUE = money("SUM(retail_value)")
OWNED = money("SUM(cost_excl_consignment)")
UNITS = count_of("units_on_hand")
SPEND = money("SUM(spend)")
SENT = "CAST(TRY_CAST(send_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS DATE)"

O, D, R, I, U, S, M, E, PS = (
    "fact_orders", "fact_daily", "fact_refunds", "fact_inventory", "fact_customers", "fact_seller", "fact_marketing", "fact_email",
    "fact_products_sold",
)
od, rd = history("order_date"), history("refund_date")
om, rm = mtd("order_date"), mtd("refund_date")
RETAIL, ECOMM = "channel = 'Retail'", "channel = 'Ecomm'"
DATED, GRADED, STOCK, BUYERS = "days_in_inventory IS NOT NULL", "condition_grade IS NOT NULL", "units_on_hand > 0", "orders_count > 0"

TABS = {
    "leadership_orders": pick(f"{ORDERS} AS orders", O, od),
    "leadership_units_sold": pick(f"{total('total_units')} AS units_sold", O, od),
    "leadership_net_sales": pick(f"{NET} AS net_sales", O, od),
    "leadership_refunded_units": pick(f"{total('refunded_units')} AS refunded_units", R, rd),
    "leadership_orders_by_sales_channel_pie": pick(f"channel, {ORDERS} AS orders", O, od, tail="GROUP BY channel"),
    "leadership_orders_by_channel_and_province_table": pick(f"ship_province, channel, {ORDERS} AS orders", O, od, tail="GROUP BY 1, 2"),
    "leadership_net_sales_mtd": pick(f"{NET} AS net_sales_mtd", O, om),
    "leadership_gross_profit_mtd": pick(f"{PROFIT} AS gross_profit_mtd", O, om),
    "leadership_gross_margin_pct_mtd": pick(f"{MARGIN} AS gross_margin_pct", O, om),
    "leadership_aov_mtd": pick(f"{AOV} AS aov_mtd", O, om),
    "leadership_total_orders_mtd": pick(f"{ORDERS} AS orders_mtd", O, om),
    "leadership_total_units_sold_mtd": pick(f"{total('total_units')} AS units_mtd", O, om),
    "leadership_total_inventory_retail_value": pick(f"{VALUE} AS inventory_retail_value", I),
    "leadership_total_inventory_cost_excl_consignment": pick(f"{OWNED} AS inventory_cost", I),
    "leadership_sell_through_rate_30_days": f"""SELECT {ratio('s.u', '(s.u + k.u)', 1, True)} AS sell_through_pct
        FROM (SELECT SUM(units_sold) AS u FROM {PS} WHERE {last30('order_date')}) s, (SELECT SUM(units_on_hand) AS u FROM {I}) k""",
    "leadership_return_orders_mtd": pick(f"{ORDERS} AS return_orders_mtd", R, rm),
    "leadership_refunded_units_mtd": pick(f"{total('refunded_units')} AS refunded_units_mtd", R, rm),
    "leadership_refunded_value_mtd": pick(f"{money('SUM(total_refunded)')} AS refunded_value_mtd", R, rm),
    "leadership_net_sales_daily_trend": pick(f"order_date, {NET} AS net_sales", D, od, tail="GROUP BY 1"),
    "leadership_net_sales_by_channel_over_time": pick(f"order_date, channel, {NET} AS net_sales", D, od, tail="GROUP BY 1, 2"),
    "leadership_orders_by_day": pick(f"order_date, {ORDERS} AS orders", O, od, tail="GROUP BY 1"),
    "leadership_aov_by_day": pick(f"order_date, {AOV} AS aov", O, od, tail="GROUP BY 1"),
    "leadership_units_sold_by_day": pick(f"order_date, {total('total_units')} AS units", O, od, tail="GROUP BY 1"),
    "leadership_gross_margin_pct_by_day": pick(f"order_date, {MARGIN} AS margin_pct", O, od, tail="GROUP BY 1"),
    "leadership_returns_by_day": pick(f"refund_date, {ORDERS} AS return_orders", R, rd, tail="GROUP BY 1"),
    "leadership_refunded_value_by_day": pick(f"refund_date, {money('SUM(total_refunded)')} AS refunded_value", R, rd, tail="GROUP BY 1"),
    "inventory_units_on_hand": pick(f"{UNITS} AS units_on_hand", I),
    "inventory_on_hand_retail_value": pick(f"{VALUE} AS retail_value", I),
    "inventory_on_hand_cost_excl_consignment": pick(f"{OWNED} AS cost", I),
    "inventory_pct_consignment_in_stock": pick(f"{pct_where('is_consignment')} AS pct_consignment", I),
    "inventory_units_by_location": pick(f"store_location, {UNITS} AS units", I, "store_location IS NOT NULL", tail="GROUP BY 1"),
    "inventory_pct_aging_over_90_days": pick(f"{pct_where('days_in_inventory > 90')} AS pct_over_90", I, DATED),
    "inventory_products_by_aging_bucket": pick("aging_bucket, COUNT(*) AS products", I, DATED, tail="GROUP BY 1"),
    "inventory_retail_value_by_aging_bucket": pick(f"aging_bucket, {VALUE} AS retail_value", I, DATED, tail="GROUP BY 1"),
    "inventory_dead_stock_units_180_days": pick(f"{UNITS} AS dead_stock_units", I, "aging_bucket = '180+ days'"),
    "inventory_avg_days_in_inventory": pick(f"{avg('days_in_inventory', 0)} AS avg_days", I, DATED),
    "inventory_products_by_condition_grade": pick("condition_grade, COUNT(*) AS products", I, GRADED, tail="GROUP BY 1"),
    "inventory_retail_value_by_condition_grade": pick(f"condition_grade, {VALUE} AS retail_value", I, GRADED, tail="GROUP BY 1"),
    "inventory_condition_grade_summary_table": pick(
        f"condition_grade, COUNT(*) AS products, {UNITS} AS units, {VALUE} AS retail_value, {avg('days_in_inventory', 0)} AS avg_days_in_stock",
        I, GRADED, tail="GROUP BY 1"),
    "inventory_full_inventory_table": pick(
        "product_title, product_vendor, product_type, units_on_hand, CAST(retail_price AS DOUBLE) AS retail_price, CAST(unit_cost AS DOUBLE) AS unit_cost, "
        "CAST(retail_value AS DOUBLE) AS retail_value, contract_type, condition_grade, store_location, seller_name, buy_date, days_in_inventory, aging_bucket", I),
    "inventory_product_sales_table": pick(
        "order_date, product_title, sku, vendor, channel, store_location, CAST(units_sold AS DOUBLE) AS units_sold, CAST(gross_revenue AS DOUBLE) AS gross_revenue, "
        "CAST(cost AS DOUBLE) AS cost, CAST(gross_profit AS DOUBLE) AS gross_profit, gross_margin_pct", PS, od),
    "retail_net_sales": pick(f"{NET} AS net_sales", O, RETAIL, od),
    "retail_gross_profit": pick(f"{PROFIT} AS gross_profit", O, RETAIL, od),
    "retail_aov": pick(f"{AOV} AS aov", O, RETAIL, od),
    "retail_orders": pick(f"{ORDERS} AS orders", O, RETAIL, od),
    "retail_units_sold": pick(f"{total('total_units')} AS units", O, RETAIL, od),
    "retail_return_orders": pick(f"{ORDERS} AS return_orders", R, RETAIL, rd),
    "retail_sales_by_day": pick(f"order_date, {NET} AS net_sales", D, RETAIL, od, tail="GROUP BY 1"),
    "retail_orders_by_day": pick(f"order_date, {ORDERS} AS orders", O, RETAIL, od, tail="GROUP BY 1"),
    "retail_vs_ecomm_sales": pick(f"order_date, channel, {NET} AS net_sales", D, "channel IN ('Retail', 'Ecomm')", od, tail="GROUP BY 1, 2"),
    "ecomm_net_sales": pick(f"{NET} AS net_sales", O, ECOMM, od),
    "ecomm_orders": pick(f"{ORDERS} AS orders", O, ECOMM, od),
    "ecomm_aov": pick(f"{AOV} AS aov", O, ECOMM, od),
    "ecomm_units_sold": pick(f"{total('total_units')} AS units", O, ECOMM, od),
    "ecomm_gross_profit": pick(f"{PROFIT} AS gross_profit", O, ECOMM, od),
    "ecomm_return_orders": pick(f"{ORDERS} AS return_orders", R, ECOMM, rd),
    "ecomm_sales_by_day": pick(f"order_date, {NET} AS net_sales", D, ECOMM, od, tail="GROUP BY 1"),
    "ecomm_orders_by_day": pick(f"order_date, {ORDERS} AS orders", O, ECOMM, od, tail="GROUP BY 1"),
    "ecomm_sales_by_utm_source": pick(f"coalesce(utm_source, '(none)') AS utm_source, {NET} AS net_sales", O, ECOMM, od, tail="GROUP BY 1"),
    "customers_new_vs_returning_customers": pick("customer_type, COUNT(*) AS customers", U, BUYERS, tail="GROUP BY 1"),
    "customers_purchase_segments": pick("purchase_segment, COUNT(*) AS customers", U, tail="GROUP BY 1"),
    "customers_repeat_customers": pick("COUNT(*) AS repeat_customers", U, "purchase_segment = 'Repeat'"),
    "customers_average_customer_ltv": pick(f"{avg('total_spent', 2)} AS avg_ltv", U, BUYERS),
    "customers_top_20_customers_by_spend": pick(
        f"first_name || ' ' || last_name AS customer, orders_count, {money('total_spent')} AS total_spent, {money('aov')} AS aov, store_location, channel",
        U, tail="ORDER BY total_spent DESC NULLS LAST, customer LIMIT 20"),
    "supplier_items_supplied_by_contract_type": pick(f"contract_type, {count_of('total_items_supplied')} AS items", S, tail="GROUP BY 1"),
    "supplier_top_20_sellers_by_units": pick(
        f"seller_name, store_location, {count_of('total_items_supplied')} AS items_supplied", S,
        tail="GROUP BY 1, 2 ORDER BY items_supplied DESC, seller_name NULLS FIRST, store_location NULLS FIRST LIMIT 20"),
    "supplier_sellers_who_also_buy_table": pick(
        f"seller_name, total_items_supplied, contract_type, store_location, buyer_orders_count, {money('buyer_total_spent')} AS buyer_total_spent",
        S, "is_also_buyer"),
    "supplier_sellers_by_contract_type": pick("contract_type, COUNT(DISTINCT seller_name) AS sellers", S, tail="GROUP BY 1"),
    "shipping_revenue": pick(f"{SHIP} AS shipping_revenue", O, od),
    "shipping_total_orders": pick(f"{ORDERS} AS orders", O, od),
    "shipping_orders_by_channel": pick(f"channel, {ORDERS} AS orders", O, od, tail="GROUP BY 1"),
    "shipping_revenue_by_day": pick(f"order_date, {SHIP} AS shipping_revenue", D, od, tail="GROUP BY 1"),
    "shipping_returns_by_channel": pick(f"channel, {ORDERS} AS return_orders", R, rd, tail="GROUP BY 1"),
    "marketing_total_marketing_spend": pick(f"{SPEND} AS total_spend", M, history("date")),
    "marketing_spend_by_channel": pick(f"source, {SPEND} AS spend", M, history("date"), tail="GROUP BY 1"),
    "marketing_roas_by_channel": pick(f"source, {ratio('SUM(conversion_value)', 'SUM(spend)', 2)} AS roas", M, history("date"), tail="GROUP BY 1"),
    "marketing_daily_spend_by_channel": pick(f"date, source, {SPEND} AS spend", M, history("date"), tail="GROUP BY 1, 2"),
    "marketing_conversions_by_channel": pick(f"source, {count_of('conversions')} AS conversions", M, history("date"), tail="GROUP BY 1"),
    "marketing_total_email_sends": pick(f"{count_of('recipients')} AS total_sends", E, history(SENT)),
    "marketing_avg_open_rate": pick(f"{avg('open_rate', 1, 100)} AS avg_open_rate", E, history(SENT)),
    "marketing_avg_click_rate": pick(f"{avg('click_rate', 1, 100)} AS avg_click_rate", E, history(SENT)),
    "marketing_campaign_performance_table": pick(
        f"campaign_name, {SENT} AS send_date, recipients, unique_opens, unique_clicks, {money('open_rate * 100', 1)} AS open_rate_pct, "
        f"{money('click_rate * 100', 1)} AS click_rate_pct, unsubscribes, CAST(revenue AS DOUBLE) AS revenue", E, history(SENT)),
}

STOCK_COST = f"(SELECT SUM(cost_excl_consignment) AS c FROM {I} WHERE {STOCK}) k"
YEAR_COGS = f"(SELECT SUM(cogs) AS c FROM {O} WHERE order_date >= {AS_OF} - INTERVAL 365 DAY) s"

CATALOGUE = {
    "cat_net_sales_mtd": pick(f"{NET} AS net_sales_mtd", D, om),
    "cat_total_inventory_retail_value": pick(f"{VALUE} AS total_retail_value", I, STOCK),
    "cat_total_inventory_cost_excl_consignment": pick(f"{OWNED} AS total_cost_excl_consignment", I, STOCK),
    "cat_sell_through_rate_30_days": f"""SELECT {ratio('SUM(a)', '(SUM(a) + SUM(b))', 1, True)} AS sell_through_pct FROM (
        SELECT SUM(units_sold) AS a, 0 AS b FROM {PS} WHERE {last30('order_date')}
        UNION ALL SELECT 0, SUM(units_on_hand) FROM {I} WHERE {STOCK})""",
    "cat_inventory_turnover_annual": f"SELECT {ratio('s.c', 'k.c', 2)} AS inventory_turnover FROM {YEAR_COGS}, {STOCK_COST}",
    "cat_days_inventory_outstanding_dio":
        f"SELECT {ratio('365', '(' + ratio('s.c', 'k.c') + ')', 0)} AS dio_days FROM {YEAR_COGS}, {STOCK_COST}",
    "cat_active_customers_12_months": pick(
        "COUNT(DISTINCT customer_id) AS active_customers", U, BUYERS,
        f"CAST(CAST(customer_updated_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS DATE) >= {AS_OF} - INTERVAL 12 MONTH"),
    "cat_repeat_purchase_rate": pick(pct_where("customer_type = 'Returning'") + " AS repeat_rate_pct", U, BUYERS),
    "cat_customer_ltv": pick(f"{avg('total_spent', 2)} AS avg_ltv", U, BUYERS),
    "cat_net_sales_by_channel_mtd": pick(f"channel, {NET} AS net_sales", D, om, tail="GROUP BY 1"),
    "cat_retail_net_sales_mtd": pick(f"{NET} AS retail_net_sales", D, RETAIL, om),
    "cat_retail_cogs_mtd": pick(f"{money('SUM(cogs)')} AS retail_cogs", O, RETAIL, om),
    "cat_retail_upt_mtd": pick(f"{UPT} AS upt", O, RETAIL, om),
    "cat_retail_units_sold_mtd": pick(f"{total('units_sold')} AS units_sold", PS, RETAIL, om),
    "cat_retail_returns_mtd": pick(f"{ORDERS} AS return_orders, {money('SUM(refund_subtotal)')} AS refund_value", R, RETAIL, rm),
    "cat_retail_mtd_vs_ly": f"""SELECT CAST(day(order_date) AS INT) AS day_of_month,
        {total(f"CASE WHEN year(order_date) = year({AS_OF}) THEN net_sales ELSE 0 END")} AS this_year,
        {total(f"CASE WHEN year(order_date) = year({AS_OF}) - 1 THEN net_sales ELSE 0 END")} AS last_year
        FROM {D} WHERE {RETAIL} AND month(order_date) = month({AS_OF}) GROUP BY 1""",
    "cat_ecomm_net_sales_mtd": pick(f"{NET} AS ecomm_net_sales", D, ECOMM, om),
    "cat_ecomm_upt_mtd": pick(f"{UPT} AS upt", O, ECOMM, om),
    "cat_ecomm_return_rate_mtd": f"""SELECT {ratio('COUNT(DISTINCT r.order_id)', 'COUNT(DISTINCT o.order_id)', 1, True)} AS return_rate_pct
        FROM {O} o LEFT JOIN {R} r ON o.order_id = r.order_id WHERE o.channel = 'Ecomm' AND {mtd('o.order_date')}""",
    "cat_ecomm_shipping_pct_of_sales_mtd": pick(f"{SHIP_PCT} AS shipping_pct", D, ECOMM, om),
    "cat_ecomm_sales_by_utm_source": pick(
        f"coalesce(utm_source, 'Direct') AS source, {NET} AS net_sales, {ORDERS} AS orders", O, ECOMM, last30("order_date"), tail="GROUP BY 1"),
    "cat_new_vs_returning_customers": pick(
        f"customer_type, COUNT(*) AS total_customers, {ratio('COUNT(*)', '(SUM(COUNT(*)) OVER ())', 1, True)} AS pct", U, BUYERS, tail="GROUP BY 1"),
    "cat_purchase_segments": pick(f"purchase_segment, COUNT(*) AS customers, {avg('total_spent', 2)} AS avg_spent", U, BUYERS, tail="GROUP BY 1"),
    "cat_aov_by_customer_type": pick(f"customer_type, {avg('aov', 2)} AS avg_aov", U, BUYERS, tail="GROUP BY 1"),
    "cat_top_20_customers_by_spend": pick(
        f"first_name || ' ' || last_name AS customer_name, city, country, orders_count, {money('total_spent')} AS total_spent, {money('aov')} AS aov",
        U, BUYERS, tail="ORDER BY total_spent DESC NULLS LAST, customer_name LIMIT 20"),
    "cat_customers_by_country": pick(
        f"country, COUNT(*) AS customers, {money('SUM(total_spent)')} AS total_spent", U, BUYERS, "country <> ''",
        tail="GROUP BY 1 ORDER BY customers DESC, country LIMIT 15"),
    "cat_units_on_hand": pick(f"{UNITS} AS units_on_hand", I, STOCK),
    "cat_pct_consignment_in_stock": pick(f"{pct_where('is_consignment')} AS consignment_pct", I, STOCK),
    "cat_inventory_aging_breakdown": pick(
        f"aging_bucket, COUNT(*) AS products, {UNITS} AS units, {VALUE} AS retail_value, "
        f"{ratio('COUNT(*)', '(SUM(COUNT(*)) OVER ())', 1, True)} AS pct_products", I, STOCK, tail="GROUP BY 1"),
    "cat_pct_aging_over_90_days": pick(pct_where("aging_bucket IN ('91-180 days', '180+ days')") + " AS aging_over_90_pct", I, STOCK),
    "cat_condition_grade_distribution": pick(
        f"coalesce(condition_grade, 'Unknown') AS condition_grade, COUNT(*) AS products, {UNITS} AS units", I, STOCK, tail="GROUP BY 1"),
    "cat_inventory_by_location": pick(
        f"coalesce(store_location, 'Unknown') AS location, COUNT(*) AS products, {UNITS} AS units, {VALUE} AS retail_value", I, STOCK, tail="GROUP BY 1"),
    "cat_contract_type_distribution": pick(
        f"coalesce(contract_type, 'Unknown') AS contract_type, COUNT(*) AS products, {UNITS} AS units, {VALUE} AS retail_value", I, STOCK, tail="GROUP BY 1"),
    "cat_top_vendors_by_inventory_value": pick(
        f"product_vendor, COUNT(*) AS products, {UNITS} AS units, {VALUE} AS retail_value", I, STOCK, "product_vendor <> ''",
        tail="GROUP BY 1 ORDER BY SUM(retail_value) DESC, product_vendor LIMIT 20"),
    "cat_total_unique_sellers": pick("COUNT(DISTINCT seller_name) AS total_sellers", S),
    "cat_sellers_also_buyers": pick(
        "COUNT(DISTINCT CASE WHEN is_also_buyer THEN seller_name END) AS seller_buyers, COUNT(DISTINCT seller_name) AS total_sellers, "
        + ratio("COUNT(DISTINCT CASE WHEN is_also_buyer THEN seller_name END)", "COUNT(DISTINCT seller_name)", 1, True) + " AS pct", S),
    "cat_top_20_sellers_by_units_supplied": pick(
        f"seller_name, contract_type, {count_of('total_items_supplied')} AS units_supplied, MIN(first_buy_date) AS first_supply_date, "
        f"MAX(last_buy_date) AS last_supply_date, is_also_buyer, {money('buyer_total_spent')} AS also_spent_as_buyer", S,
        tail="GROUP BY seller_name, contract_type, is_also_buyer, buyer_total_spent "
             "ORDER BY units_supplied DESC, seller_name, contract_type NULLS FIRST, also_spent_as_buyer NULLS FIRST LIMIT 20"),
    "cat_items_by_contract_type": pick(
        f"contract_type, COUNT(DISTINCT seller_name) AS sellers, {count_of('total_items_supplied')} AS items", S, tail="GROUP BY 1"),
    "cat_seller_buyer_balance_top_20": pick(
        f"seller_name, {count_of('total_items_supplied')} AS items_sold_to_us, {money('buyer_total_spent')} AS spent_buying_from_us, "
        "buyer_orders_count AS purchase_orders", S, "is_also_buyer",
        tail="GROUP BY seller_name, buyer_total_spent, buyer_orders_count ORDER BY items_sold_to_us DESC, seller_name, spent_buying_from_us, purchase_orders LIMIT 20"),
    "cat_roas_by_channel_mtd": pick(
        f"source, {ratio('SUM(conversion_value)', 'SUM(spend)', 2)} AS roas, {SPEND} AS spend, {money('SUM(conversion_value)')} AS conversion_value",
        M, mtd("date"), tail="GROUP BY 1"),
    "cat_cac_last_30_days": f"""SELECT {ratio('m.s', 'c.n', 2)} AS cac
        FROM (SELECT SUM(spend) AS s FROM {M} WHERE {last30('date')}) m,
        (SELECT COUNT(DISTINCT customer_id) AS n FROM {U} WHERE customer_type = 'New' AND {last30("CAST(CAST(customer_created_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS DATE)")}) c""",
    "cat_mer_marketing_efficiency_ratio": f"""SELECT {ratio('s.n', 'm.s', 2)} AS mer
        FROM (SELECT SUM(net_sales) AS n FROM {D} WHERE {om}) s, (SELECT SUM(spend) AS s FROM {M} WHERE {mtd('date')}) m""",
    "cat_email_campaigns_performance": pick(
        f"campaign_name, {SENT} AS send_date, recipients AS sends, unique_opens, {money('open_rate * 100', 1)} AS open_rate_pct, unique_clicks, "
        f"{money('click_rate * 100', 2)} AS click_rate_pct, unsubscribes, CAST(revenue AS DOUBLE) AS revenue", E),
    "cat_avg_email_open_rate": pick(f"{avg('open_rate', 1, 100)} AS avg_open_rate", E),
    "cat_avg_email_click_rate": pick(f"{avg('click_rate', 2, 100)} AS avg_click_rate", E),
    "cat_total_email_sends": pick(f"{count_of('recipients')} AS total_sends", E),
    "cat_shipping_pct_of_sales_mtd": pick(f"{SHIP_PCT} AS shipping_pct", D, om),
    "cat_avg_order_processing_time": pick(
        avg("datesub('hour', CAST(order_created_ts AS TIMESTAMPTZ), CAST(order_processed_ts AS TIMESTAMPTZ))", 1) + " AS avg_processing_hrs",
        O, last30("order_date"), "order_processed_ts IS NOT NULL", "order_created_ts IS NOT NULL"),
    "cat_orders_by_channel_mtd": pick(f"channel, {ORDERS} AS orders, {NET} AS net_sales, {SHIP} AS shipping_revenue", O, om, tail="GROUP BY 1"),
    "cat_shipping_revenue_trend_30_days": pick(
        f"order_date, {SHIP} AS shipping_revenue, {NET} AS net_sales, {SHIP_PCT} AS shipping_pct", D, last30("order_date"), tail="GROUP BY 1"),
    "cat_refunds_by_channel_mtd": pick(f"channel, {ORDERS} AS refund_orders, {money('SUM(refund_subtotal)')} AS refund_value", R, rm, tail="GROUP BY 1"),
}

LY = f"date_trunc('month', order_date) = date_trunc('month', {AS_OF} - INTERVAL 1 YEAR)"
WINDOWED = {
    "cat_net_sales_daily_trend": pick(f"order_date, {NET} AS net_sales", D, last30("order_date"), tail="GROUP BY 1"),
    "cat_retail_ly_net_sales": pick(f"{NET} AS retail_net_sales_ly", D, RETAIL, LY),
    "cat_retail_gross_profit_mtd": pick(f"{PROFIT} AS retail_gross_profit", O, RETAIL, om),
    "cat_retail_aov_mtd": pick(f"{AOV} AS retail_aov", O, RETAIL, om),
    "cat_retail_aov_ly": pick(f"{AOV} AS retail_aov_ly", O, RETAIL, LY),
    "cat_retail_daily_sales": pick(f"order_date, {NET} AS net_sales", D, RETAIL, last30("order_date"), tail="GROUP BY 1"),
    "cat_ecomm_total_orders_mtd": pick(f"{ORDERS} AS total_orders", O, ECOMM, om),
    "cat_ecomm_aov_mtd": pick(f"{AOV} AS ecomm_aov", O, ECOMM, om),
    "cat_total_marketing_spend_mtd": pick(f"{SPEND} AS total_spend", M, mtd("date")),
    "cat_spend_by_channel_mtd": pick(f"source, {SPEND} AS spend", M, mtd("date"), tail="GROUP BY 1"),
    "cat_daily_spend_by_channel": pick(f"date, source, {SPEND} AS spend", M, last30("date"), tail="GROUP BY 1, 2"),
}


def statements() -> dict[str, str]:
    return {key: full(sql) for key, sql in {**TABS, **CATALOGUE, **WINDOWED}.items()}
