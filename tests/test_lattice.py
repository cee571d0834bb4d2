"""Cards from stored cells: equal to the same cards from facts, from the smallest set that can answer, without reading facts."""

from datetime import date

import pytest

from resalelake.operators.filters import Filters
from resalelake.operators.periods import Period
from resalelake.plans import lattice, metrics
from resalelake.plans.facts import Facts
from resalelake.plans.registry import HISTORY
from resalelake.sources.driver_tables import AS_OF, DriverTables

CARDS = {c.key: c for c in [*metrics.tab_cards(), *metrics.catalogue_cards(), *metrics.windowed_cards()]}
READERS = {
    "months": HISTORY,
    "days": Filters(Period(date(2001, 5, 3), date(2001, 6, 20))),
    "store": Filters(Period(date(2000, 1, 1), date(2000, 12, 31)), store_location=("Store 1", "Store 2")),
    "everything": Filters(),
}


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    from resalelake.plans import stages

    return stages.stage(DriverTables(spark, "/root/testdata/sf0.001").raw(), str(tmp_path_factory.mktemp("st")), buckets=2)


@pytest.fixture(scope="module")
def cells(spark, facts, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lattice"))
    lattice.build(facts, root)
    return lattice.Lattice(spark, root)


def offered(card, filters):
    return all(getattr(filters, f) is None or f in card.slots for f in ("store_location", "channel"))


@pytest.mark.parametrize("reader", READERS)
def test_same_cards(spark, facts, cells, reader):
    filters, answered = READERS[reader], 0
    for card in CARDS.values():
        if not offered(card, filters):
            continue
        got = cells.run(card, AS_OF, filters)
        if got is None:
            continue
        answered += 1
        if reader != "months" and answered % 3:
            continue  # a third of them for the other readers
        want = metrics.run(card, facts, AS_OF, filters)
        assert got.columns == want.columns and got.dtypes == want.dtypes, card.key
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), card.key
    assert answered >= (45 if reader != "store" else 15)


def test_router(facts, cells):
    small = cells.route(CARDS["leadership_net_sales"], AS_OF, HISTORY)
    assert (small.time, small.dimensions) == (lattice.MONTH, frozenset())
    assert cells.route(CARDS["leadership_net_sales"], AS_OF, READERS["days"]).time == "order_date"
    assert cells.route(CARDS["leadership_net_sales"], AS_OF, READERS["store"]).dimensions == {"channel", "store_location"}
    assert cells.route(CARDS["retail_sales_by_day"], AS_OF, HISTORY).time == "order_date"
    assert cells.route(CARDS["ecomm_sales_by_utm_source"], AS_OF, HISTORY).dimensions == {"channel", "utm_source"}
    for key in ("leadership_return_orders_mtd", "cat_avg_order_processing_time", "inventory_units_on_hand", "inventory_product_sales_table"):
        assert cells.run(CARDS[key], AS_OF, HISTORY) is None
    with pytest.raises(ValueError):
        cells.run(CARDS["leadership_net_sales_mtd"], AS_OF, Filters(ship_province="Ontario"))
    files = cells.run(CARDS["leadership_orders_by_day"], AS_OF, HISTORY).inputFiles()
    assert files and all("/orders/" in f and "/order_date/" in f for f in files)
