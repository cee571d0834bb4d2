"""Flatteners over JSON text, with the shapes the APIs really send."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest

from resalelake.sources import contracts, payloads

RUN = date(2026, 6, 16)
NOW = datetime(2026, 6, 16, 13, tzinfo=timezone.utc)


@pytest.fixture()
def docs(spark, tmp_path):
    def land(kind, *documents):
        (tmp_path / "in.json").write_text("\n".join(json.dumps(d) for d in documents))
        return payloads.read_landing(spark, kind, str(tmp_path))

    return land


@pytest.fixture()
def texts(spark):
    return lambda *bodies: spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "body string")


def test_orders(docs):
    full = {
        "id": 1, "name": "#1", "created_at": "2026-06-15T23:30:00-07:00", "source_name": "pos", "financial_status": "paid",
        "test": False, "subtotal_price": "100.50", "total_price": "112", "total_tax": "x", "location_id": 42702532,
        "customer": {"id": 9}, "shipping_address": {"country": "Canada", "province": "Ontario"},
        "shipping_lines": [{"price": "9.5"}, {"price": "1"}],
        "line_items": [
            {"id": 11, "price": "60.25", "product_id": 5, "quantity": 2, "title": "Bag", "vendor": "V"},
            {"id": 12, "quantity": None, "price": None},
        ],
    }
    bare = {"id": 2, "source_name": None, "location_id": 3, "line_items": []}
    df = payloads.flatten_orders(docs("order", full, bare), "shop", RUN)
    assert contracts.schema_differences(df, "orders") == {}
    first, second, empty = df.orderBy("order_id", "line_item__id").collect()
    assert (first.date, first.week, first.year_month, first.month) == (date(2026, 6, 15), "25", "2026|6", "06")
    assert (first.order_app_name, first.order_location_name, first.order_customer_id) == ("Point of Sale", "1025 Howe Street, Vancouver", "9")
    assert (first.order_quantity, first.order_shipping_price, first.order_total_tax_amount) == (2, Decimal("9.5"), 0)
    assert (first.line_item__price, first.line_item__quantity, first.line_item__sku) == (Decimal("60.25"), 2, "")
    assert (second.line_item__id, second.line_item__product_id, second.line_item__quantity) == ("12", "", 0)
    assert (empty.line_item__id, empty.line_item__quantity, empty.order_quantity) == (None, None, 0)
    assert (empty.date, empty.order_app_name, empty.order_location_name) == (RUN, "Unknown", "Unknown Location")
    assert (empty.order_customer_id, empty.order_shipping_address_country, empty.order_financial_status) == (None, None, "")


def test_refunds(docs):
    doc = {"id": 7, "name": "#7", "refunds": [
        {"id": 70, "created_at": "2026-06-01T00:00:00Z", "order_adjustments": [{"kind": "shipping_refund", "amount": "-5"}],
         "refund_line_items": [{"quantity": 1, "subtotal": "10", "total_tax": "1"}, {"quantity": 2, "subtotal": "20"}]},
        {"id": 71, "created_at": "2026-06-02T00:00:00Z", "order_adjustments": [{"kind": "refund_discrepancy", "amount": "3"}]},
    ]}
    df = payloads.flatten_refunds(docs("refund", doc, {"id": 8, "refunds": []}), "shop", RUN)
    a, b, c = df.orderBy("order_refunds", "line_item__refunds_subtotal").collect()
    assert [r.order_total_shipping_refunded_price for r in (a, b, c)] == [-5, -5, 0]  # repeated on each line
    assert (c.order_refund_discrepancy_amount, c.line_item__refunds_quantity) == (3, None)
    assert (b.line_item__refunds_total_tax, a.order_refunds.endswith("/70")) == (0, True)


def test_customers(docs):
    rows = docs("customer", {"id": 1, "orders_count": 3, "total_spent": "10.00", "tags": "vip"}, {"id": 2, "orders_count": None})
    one, two = payloads.flatten_customers(rows, RUN).orderBy("customer_id").collect()
    assert (one.customer_aov, one.customer_is_returning, two.customer_aov, two.customer_is_returning) == (Decimal("3.33"), "True", 0, "False")
    assert (two.customer_first_name, two.customer_default_address_city) == ("", "")


def test_products_and_costs(spark, docs):
    rows = docs(
        "product",
        {"id": 1, "status": "active", "variants": [{"price": "5.005", "inventory_quantity": 2, "inventory_item_id": 10}, {"inventory_quantity": 3}],
         "images": [{"src": "a"}, {"src": "b"}]},
        {"id": 2, "variants": [{"price": "1", "inventory_item_id": 20}]},
        {"id": 3},
    )
    costs = spark.createDataFrame([("10", "2.50"), ("20", None), ("99", "1")], "id string, cost string")
    one, two, three = payloads.flatten_products(rows, RUN, costs).orderBy("product_id").collect()
    assert (one.product_inventory_quantity, one.product_price, one.product_image_src) == (5, Decimal("5.01"), "a")
    assert [r.product_variant_inventory_item_cost for r in (one, two, three)] == [Decimal("2.5"), None, None]
    assert (three.product_price, three.product_inventory_quantity, three.product_status) == (0, 0, "")


def test_metafields_keep_falsy_values(docs):
    rows = docs("metafields", {"id": 1, "metafields": [{"key": "a", "namespace": "n", "value": "0"}, {"key": "b", "namespace": "n"}]}, {"id": 2})
    got = [(r.product_metafield_key, r.product_metafield_value) for r in payloads.flatten_metafields(rows, RUN).orderBy("product_metafield_key").collect()]
    assert got == [("a", "0"), ("b", None)]


def test_ad_insights(docs):
    bought = {"date_start": "2026-06-01", "ad_id": "1", "spend": "3", "actions": [{"action_type": "click", "value": "8"}, {"action_type": "purchase", "value": "2"}],
              "action_values": [{"action_type": "purchase", "value": "10"}]}
    one, two = payloads.flatten_ad_insights(docs("ad_insight", bought, {"date_start": "2026-06-01", "ad_id": "2"}), NOW).orderBy("ad_id").collect()
    assert (one.purchases, one.purchase_value, one.purchase_roas) == (2, 10, Decimal("3.33"))
    assert (two.purchases, two.spend, two.purchase_roas, two.account_currency) == (0, 0, 0, "CAD")


def test_cost_report_last_row_wins(docs):
    rows = docs("cost_report", {"position": 1, "date": "2026-06-01", "campaign_id": "g", "cost_micros": "1"},
                {"position": 2, "date": "2026-06-01", "campaign_id": "g", "cost_micros": "2345000", "conversions": "1.505", "conversions_value": "5"})
    (row,) = payloads.flatten_cost_report(rows, NOW).collect()
    assert (row.spend, row.conversions, row.conversion_value, row.roas) == (Decimal("2.35"), Decimal("1.51"), 5, "2.1300")


def test_email_documents_in_every_wrapping(texts):
    doc = {"id": "c1", "attributes": {"name": "N", "send_strategy": {"options_static": {"datetime": "T1"}}, "send_time": "T2"}}
    other = {"id": "c2", "attributes": {"send_time": "T2"}}
    responses = texts({"data": [doc, {"attributes": {}}]}, {"data": other}, {"data": json.dumps({"data": [doc]})}, "not json", {"data": json.dumps([other])})
    rows = payloads.flatten_email_campaigns(responses, NOW).orderBy("campaign_id").collect()
    assert [(r.campaign_id, r.campaign_name, r.send_time) for r in rows] == [("c1", "N", "T1")] * 2 + [("c2", "", "T2")] * 2


def test_email_report_paths(texts):
    results = [{"groupings": {"campaign_id": "c"}, "statistics": {"recipients": 10, "open_rate": 0.25, "conversions": "2.9", "clicks": None}}]
    mid = {"attributes": {"results": results}}
    rows = payloads.flatten_email_report(texts({"data": mid}, mid, {"results": results}, {"data": json.dumps(mid)}, {"data": {}}), RUN, NOW).collect()
    assert [(r.campaign_id, r.sends, r.open_rate, r.conversions, r.clicks) for r in rows] == [("c", 10, Decimal("0.25"), 2, 0)] * 4
