"""Column helpers on literal values, with nulls, bad text and clock changes."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from resalelake.functions import columns as C


def test_tolerant_casts(evaluate):
    values = ["", " 7 ", "12.0", "12.6", "n/a", None]
    assert evaluate(values, C.amount("v")) == [None, Decimal(7), Decimal(12), Decimal("12.6"), None, None]
    assert evaluate(values, C.whole_from_text("v")) == [None, 7, None, None, None, None]
    assert evaluate(values, C.amount_or_zero("v"))[4:] == [0, 0]


def test_whole_rounds_half_away_from_zero(evaluate):
    assert evaluate(["12.4", "12.5", "12.6", "-12.5"], C.whole("v")) == [12, 13, 13, -13]


def test_business_day_over_clock_changes(evaluate):
    values = [
        "2026-07-01T06:59:00Z", "2026-07-01T07:01:00Z",  # summer: seven hours
        "2026-01-10T07:59:00Z", "2026-01-10T08:01:00Z",  # winter: eight hours
        "2026-03-08T07:59:00Z", "2026-03-09T06:59:00Z",  # clocks go forward on 8 March
        "2026-11-01T06:59:00Z", "2026-11-02T07:59:00Z",  # clocks go back on 1 November
        "2026-07-01T00:30:00-07:00", "soon", None,
    ]
    assert evaluate(values, C.business_day("v")) == [
        date(2026, 6, 30), date(2026, 7, 1), date(2026, 1, 9), date(2026, 1, 10),
        date(2026, 3, 7), date(2026, 3, 8), date(2026, 10, 31), date(2026, 11, 1),
        date(2026, 7, 1), None, None,
    ]


def test_day_from_text(evaluate):
    assert evaluate(["2026-01-05", "unknown", "", None], C.day_from_text("v")) == [date(2026, 1, 5), None, None, None]


def test_iso_week_and_periods(evaluate):
    day = F.col("v").cast("date")
    got = evaluate(["2026-01-01", "2026-06-15"], C.iso_week_text(day), C.year_month_text(day), C.month_text(day))
    assert got == [("1", "2026|1", "01"), ("25", "2026|6", "06")]


def test_ratio_is_null_on_zero_and_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (None, 1), (201, 200)], "a int, b int")
    got = [r[0] for r in df.select(C.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [None, None, None, 1.01]  # 1.005 rounds up, unlike binary rounding


def test_channels(evaluate):
    values = ["Point of Sale", "Online Store", "Shop", "Draft Orders", "3890849", "2329312", None]
    assert evaluate(values, C.sales_channel("v")) == ["Retail", "Ecomm", "Ecomm", "Draft", "Gorgias", "Other", "Other"]


def test_source_apps_and_stores(evaluate):
    assert evaluate(["pos", "iphone", "custom", "", None], C.source_app("v")) == [
        "Point of Sale", "Shop", "custom", "Unknown", "Unknown",
    ]
    assert evaluate(["61822697585", "42702532", "1", "", None], C.store_name("v")) == [
        "Courtney's Closet", "1025 Howe Street, Vancouver", "Unknown Location", None, None,
    ]


def test_age_buckets(evaluate):
    values = ["0", "30", "31", "60", "61", "90", "91", "180", "181", "-3", None]
    age = F.col("v").cast("int")
    labels = ["0-30 days"] * 2 + ["31-60 days"] * 2 + ["61-90 days"] * 2 + ["91-180 days"] * 2 + ["180+ days", "0-30 days"]
    assert evaluate(values, C.bucket(age)) == [*labels, "180+ days"]
    assert evaluate(values, C.bucket(age, unknown="undated")) == [*labels, "undated"]
    assert evaluate(["0-30 days", "180+ days", "91-180 days"], C.bucket_rank(F.col("v"))) == [1, 5, 4]


def test_text_extraction(evaluate):
    assert evaluate(['["A"]', '["A","B"]', "[]", "plain", None], C.first_quoted("v")) == ["A", "A", None, None, None]
    assert evaluate(["gid://x/Refund/12", "12", "a/b", None], C.trailing_id("v")) == ["12", None, None, None]


def test_words_and_tags(evaluate):
    assert evaluate(["Will SELL TO US", "vendors", "shopper", None], C.has_word("v", ("sell to us", "vendor"))) == [
        True, True, False, False,
    ]
    assert evaluate(["vip, Cognito-Consignment-Update", "vip", None], C.has_tag("v")) == [True, False, None]


def test_valid_order_drops_unknown_status(spark):
    rows = [("PAID", None), ("Cancelled", "False"), (None, "False"), ("PAID", "True"), ("PAID", "false")]
    df = spark.createDataFrame(rows, "order_financial_status string, order_test string")
    assert df.where(C.valid_order()).count() == 2


def test_consigned_stock_carries_no_cost(spark):
    rows = [("consignment", Decimal(5)), ("Buyout", Decimal(5)), (None, Decimal(5))]
    df = spark.createDataFrame(rows, "contract_type string, cost decimal(18,4)")
    got = [tuple(r) for r in df.select(C.owned_value(F.col("cost")), C.is_consignment()).collect()]
    assert got == [(0, True), (5, False), (0, False)]
