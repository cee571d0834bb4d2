"""Facts and cards on tiny raw tables: one case per known quirk."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from resalelake.operators.filters import Filters
from resalelake.operators.periods import Period
from resalelake.plans import metrics
from resalelake.plans.facts import Facts
from resalelake.sources.contracts import conform, contract
from resalelake.sources.raw import RawTables

DAY = date(2026, 6, 10)


@pytest.fixture()
def facts(spark):
    def build(**tables):
        def load(name):
            rows = tables.get(name, [])
            if not rows:
                return spark.createDataFrame([], contract(name))
            names = sorted({k for r in rows for k in r})
            text = ", ".join(f"{n} string" for n in names)
            flat = [tuple(None if r.get(n) is None else str(r.get(n)) for n in names) for r in rows]
            return conform(spark.createDataFrame(flat, text), name)

        return Facts(RawTables(load))

    return build


def order(oid, line=None, **more):
    base = {
        "order_id": oid, "date": DAY, "order_created_at": "2026-06-10T18:00:00Z", "order_app_name": "Point of Sale",
        "order_financial_status": "PAID", "order_test": "False", "order_net_sales": "100", "order_total_price": "112",
        "line_item__id": line, "ingested_at": DAY,
    }
    if line:
        base |= {"line_item__product_id": "p1", "line_item__quantity": 1, "line_item__price": 100, "line_item__title": "Bag"}
    return base | more


def product(pid, updated="2026-06-01", **more):
    base = {"product_id": pid, "date": DAY, "product_status": "ACTIVE", "product_updated_at_datetime": updated}
    return base | {"product_price": "10", "product_inventory_quantity": "2"} | more


def field(pid, ns, key, value, updated="2026-06-01"):
    return {"product_id": pid, "product_metafield_namespace": ns, "product_metafield_key": key, "product_metafield_value": value,
            "product_metafield_update_at": updated, "date": DAY}


def test_order_fact(facts):
    built = facts(
        orders=[
            order("1", "a", order_location_name=None, date=date(2026, 6, 12), order_financial_status="REFUNDED"),
            order("1", "a", order_location_name="S"),
            order("1", "b", line_item__quantity=3, line_item__product_id="p2", line_item__variant_unit_cost=7),
            order("2", order_financial_status=None), order("3", order_test="True"), order("4", order_financial_status="CANCELLED"),
            order("5", order_net_sales="0"),
        ],
        products=[product("p1", product_variant_inventory_item_cost=40), product("p1", "2026-07-01", product_variant_inventory_item_cost=30),
                  product("p2", product_variant_inventory_item_cost=9), product("p2", "2026-07-01")],
    )
    rows = {r.order_id: r for r in built.orders().collect()}
    assert set(rows) == {"1", "5"}  # null status, tests and cancelled orders are out
    assert (rows["1"].store_location, rows["1"].financial_status) == ("S", "paid")  # the located row wins over the newer
    # newest cost of p1 is 30; newest cost row of p2 is null, so the line's own cost counts
    assert (rows["1"].total_units, rows["1"].cogs, rows["1"].gross_profit, rows["1"].gross_margin_pct) == (4, 51, 49, 0.49)
    assert (rows["5"].cogs, rows["5"].gross_margin_pct) == (0, None)


def test_product_sales_exclusions_and_margin(facts):
    built = facts(
        orders=[order("1", "a", line_item__price="100", line_item__quantity=2), order("1", "b", line_item__title="Gift Card"),
                order("1", "c", line_item__title=None), order("1", "d", line_item__price=None, line_item__quantity=5)],
        products=[product("p1", product_variant_inventory_item_cost=25)],
    )
    (row,) = built.product_sales().collect()
    # the line without a price adds units and cost but neither revenue nor profit
    assert (row.units_sold, row.gross_revenue, row.cost, row.gross_profit, row.gross_margin_pct) == (7, 200, 175, 150, 75.0)


def test_daily_sales_uses_the_store_clock(facts):
    late = order("1", order_created_at="2026-06-10T06:30:00Z")
    (row,) = facts(orders=[late]).daily_sales().collect()
    assert (row.order_date, row.channel, row.aov) == (date(2026, 6, 9), "Retail", 100.0)


def test_period_is_pushed_without_changing_results(facts):
    built = facts(orders=[order(str(i), "a", order_created_at=f"2026-06-{i:02d}T06:30:00Z") for i in range(1, 29)])
    period = Period(date(2026, 6, 9), date(2026, 6, 12))
    for name in ("orders", "daily_sales", "product_sales"):
        whole = built.fact(name).where(period.covers("order_date"))
        assert sorted(map(str, built.fact(name, period).collect())) == sorted(map(str, whole.collect()))


def refund(oid, rid, subtotal, qty, **more):
    base = {"order_id": oid, "order_refunds": f"gid://x/Refund/{rid}", "date": DAY, "line_item__refunds_subtotal": subtotal,
            "line_item__refunds_quantity": qty}
    return base | {"order_refund_discrepancy_amount": 0, "order_total_shipping_refunded_price": 0} | more


def test_refund_quirks(facts):
    ship = {"order_total_shipping_refunded_price": "9.99"}
    built = facts(
        orders=[order("1", order_test="True", order_location_name="S")],
        refunds=[refund("1", 5, 10, 1, **ship), refund("1", 5, 20, 1, **ship), refund("1", 5, 20, 1, **ship),
                 refund("1", 6, None, None), refund("2", 7, 3, 1), refund(None, 8, 3, 1)],
    )
    rows = built.refunds().orderBy("order_id", "refund_subtotal").collect()
    # equal lines collapse, lines without money and without an order are out
    assert [(r.order_id, r.refund_id, r.total_refunded) for r in rows] == [
        ("1", "5", Decimal("19.99")), ("1", "5", Decimal("29.99")), ("2", "7", Decimal("3.00")),
    ]
    assert rows[0].refund_date == date(2026, 6, 9)  # the stored day read as UTC midnight
    assert (rows[0].channel, rows[0].store_location) == ("Retail", "S")  # test orders still lend their attributes
    assert rows[2].channel is None
    assert {r.refund_date for r in built.refunds(refund_date_mode="source_day").collect()} == {DAY}
    once = [r.refund_shipping for r in built.refunds(adjustments="first_line").orderBy("order_id", "refund_subtotal").collect()]
    assert once == [Decimal("9.99"), 0, 0]


def test_inventory_quirks(facts):
    built = facts(
        products=[product("1"), product("2", product_variant_inventory_item_cost=4), product("3", product_variant_inventory_item_cost=4),
                  product("4", product_status="archived"),
                  product("5", "2026-05-01", date=date(2026, 5, 1), product_inventory_quantity=9), product("5", "2026-06-01")],
        metafields=[field("2", "buy", "contract_type", "Consignment"), field("3", "buy", "contract_type", "buyout"),
                    field("3", "buy", "date", "2026-05-01"), field("3", "buy", "date", "2026-01-01", "2025-01-01"),
                    field("3", "custom", "location", '["79 Yorkville, Toronto"]')],
    )
    rows = {r.product_id: r for r in built.inventory().collect()}
    assert set(rows) == {"1", "2", "3", "5"}
    assert [rows[i].cost_excl_consignment for i in "123"] == [0, 0, 8]
    assert (rows["3"].days_in_inventory, rows["3"].aging_bucket, rows["3"].store_location) == (40, "31-60 days", "79 Yorkville, Toronto")
    assert rows["1"].aging_bucket == "180+ days"
    assert built.inventory(unknown_bucket="undated").where("product_id = '1'").first().aging_bucket == "undated"
    card = next(c for c in metrics.tab_cards() if c.key == "inventory_units_on_hand")
    assert metrics.run(card, built, DAY, Filters(snapshot_date=DAY, contract_type="buyout")).first()[0] == 2
    assert metrics.run(card, built, DAY, Filters(snapshot_date=date(2026, 5, 1))).first()[0] is None
    earlier = {r.product_id: r.units_on_hand for r in built.inventory(as_of=date(2026, 5, 2)).collect()}
    assert earlier == {"5": 9} and rows["5"].units_on_hand == 2


def test_customer_preferences_ignore_nulls(facts):
    person = {"customer_id": "c", "date": DAY, "customer_updated_at": "2026-06-01", "customer_orders_count": 2, "customer_is_returning": "True"}
    built = facts(
        customers=[person, person | {"customer_updated_at": "2026-05-01", "customer_orders_count": 1}],
        orders=[order("1", order_customer_id="c", order_location_name="S", date=date(2026, 6, 1)),
                order("2", order_customer_id="c", date=date(2026, 6, 5), order_app_name="Shop")],
    )
    (row,) = built.customers().collect()
    assert (row.store_location, row.channel, row.purchase_segment, row.customer_type) == ("S", "Ecomm", "Repeat", "Returning")


def test_sellers_and_their_channel(facts):
    built = facts(
        metafields=[field("p1", "buy", "seller_name", " Ann Lee"), field("p1", "buy", "contract_type", "buyout"),
                    field("p2", "buy", "seller_name", " Ann Lee"), field("p2", "buy", "contract_type", "buyout"), field("p3", "buy", "seller_name", "")],
        orders=[order("1", "a")],
        customers=[{"customer_id": str(i), "date": DAY, "customer_first_name": "ann", "customer_last_name": "LEE",
                    "customer_tags": tag, "customer_total_spent": 5} for i, tag in enumerate(("Cognito-Consignment-update", "vip", "x, cognito-consignment"))],
    )
    rows = sorted((r.channel or "", r.total_items_supplied, r.buyout_items, r.customer_id) for r in built.seller().collect())
    assert rows == [("", 1, 1, "0"), ("", 1, 1, "2"), ("Retail", 1, 1, "0"), ("Retail", 1, 1, "2")]


def test_marketing_rounds_fractional_conversions(facts):
    built = facts(google_ads=[{"date": DAY, "spend": 1, "conversions": "1.5", "roas": "n/a"}], meta_ads=[{"date": DAY, "spend": 2, "purchases": 1}])
    rows = {r.source: r for r in built.marketing().collect()}
    assert (rows["Google"].conversions, rows["Google"].roas, rows["Google"].reach) == (2, None, None)


def test_acquisition_cost_fixed_and_as_published(facts):
    people = [{"customer_id": str(i), "date": DAY, "customer_updated_at": "x", "customer_created_at": "2026-06-05T00:00:00Z", "customer_is_returning": "False"}
              for i in range(4)]
    built = facts(customers=people, meta_ads=[{"date": DAY, "spend": 30}, {"date": DAY, "spend": 10}])
    assert metrics.acquisition_cost(built, DAY).first().cac == 10.0
    assert metrics.acquisition_cost_as_published(built, DAY).first().cac == 40.0


def test_cards_follow_window_and_filters(facts):
    built = facts(orders=[order("1", order_location_name="A"), order("2", order_location_name="B"),
                          order("3", order_created_at="2026-05-10T18:00:00Z")])
    cards = {c.key: c for c in metrics.tab_cards()}
    assert metrics.run(cards["leadership_net_sales"], built, DAY).first()[0] == 300.0
    assert metrics.run(cards["leadership_net_sales_mtd"], built, DAY).first()[0] == 200.0
    assert metrics.run(cards["retail_orders"], built, DAY, Filters(store_location="A")).first()[0] == 1
    change = metrics.period_change(cards["leadership_net_sales"], built, DAY, Period(date(2026, 6, 1), date(2026, 6, 30))).first()
    assert tuple(change) == (200.0, 100.0, 100.0, 100.0)


def test_every_card_has_a_distinct_key():
    cards = [*metrics.tab_cards(), *metrics.catalogue_cards(), *metrics.windowed_cards()]
    keys = [c.key for c in cards] + list(metrics.SPECIAL)
    assert len(keys) == len(set(keys)) == 144


def test_header_readers_never_touch_line_items(spark):
    from resalelake.sources.driver_tables import DriverTables

    card = next(c for c in metrics.tab_cards() if c.key == "leadership_net_sales")
    df = metrics.run(card, Facts(DriverTables(spark, "/root/testdata/sf0.001").raw()), date(2001, 7, 15))
    assert not any("lineitem" in f for f in df.inputFiles())
    assert df.agg(F.count(F.lit(1))).first()[0] == 1
