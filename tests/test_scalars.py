import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, money, text
from ledgerloom.functions.similarity import edit_similarity, matching_blocks_ratio, token_set_score
from ledgerloom.operators.layout import unit_and_category
from ledgerloom.operators.worksheet import Rules, expense_type, type_category

from tests.helpers import d


def values(spark, items, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i INT, x STRING")
    out = df.orderBy("i").select(*[e.alias(f"c{n}") for n, e in enumerate(exprs)]).collect()
    return [r[0] if len(exprs) == 1 else tuple(r) for r in out]


def test_vendor_key(spark):
    cases = {
        "POS PURCHASE  HOME DEPOT #1234": "home depot",
        "Check Card Purchase Cafe *AB12 Paris": "cafe paris",
        "deposit deposit slip 42": "deposit slip",
        "ACME, Inc.  77 Store": "acme inc store",
        "01/05 Online Payment": "01/05 online payment",
        "shop #12éx now": "shop now",
        "a *#12 b": "a",
        "   ": "",
        None: "",
    }
    assert values(spark, list(cases), text.vendor_key(F.col("x"))) == list(cases.values())


def test_vendor_key_can_drop_a_leading_date(spark):
    assert values(spark, ["01/05 Online Payment 123 To X"], text.vendor_key(F.col("x"), strip_leading_date=True)) == [
        "online payment to x"
    ]


def test_money(spark):
    got = values(spark, ["$1,234.50", " -12 ", "", "cancelled", None, "$"], money.parse_money(F.col("x")))
    assert got == [d("1234.50"), d("-12.00"), None, None, None, None]


def test_cash_amount_treats_zero_as_missing(spark):
    df = spark.sql("SELECT CAST(a AS DECIMAL(18,2)) a, CAST(b AS DECIMAL(18,2)) b FROM VALUES (5, 7), (0, 7), (NULL, NULL) AS t(a, b)")
    got = [r[0] for r in df.select(money.cash_amount(F.col("a"), F.col("b"))).collect()]
    assert got == [d("5"), d("7"), d("0")]


def test_worksheet_date(spark):
    got = values(spark, ["1/5/25", "12/31/1999", "2/30/24", "1/2", "x/1/2", " 3 / 4 / 70 ", ""], dates.worksheet_date(F.col("x")))
    assert got == [dt.date(2025, 1, 5), dt.date(1999, 12, 31), None, None, None, dt.date(2070, 3, 4), None]


def test_flexible_date(spark):
    got = values(spark, ["1/5/2024", "1/5/24", "7/4", "2/30", "soon", None], dates.flexible_date(F.col("x"), 2023))
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2023, 7, 4), None, None, None]


def test_other_dates(spark):
    assert values(spark, ["Jan 5, 2024", "Foo 5, 2024"], dates.month_day_year(F.col("x"))) == [dt.date(2024, 1, 5), None]
    assert values(spark, ["01/31/2024", "1/31/2024", "02/31/2024"], dates.us_date(F.col("x"))) == [dt.date(2024, 1, 31), None, None]
    assert values(spark, ["2024-01-05", "2024-01-05 00:00:00", "1/5/24"], dates.cell_date(F.col("x"))) == [
        dt.date(2024, 1, 5), dt.date(2024, 1, 5), None]


def test_year_in_period(spark):
    df = spark.sql("SELECT m, DATE'2024-12-07' s, DATE'2025-01-06' e FROM VALUES (12), (1) AS t(m)")
    assert [r[0] for r in df.select(dates.year_in_period(F.col("m"), F.col("s"), F.col("e"))).collect()] == [2024, 2025]


def test_lookup_and_status(spark):
    c, labels = F.col("x"), {"Water": "Services", "Security Deposits": None}
    got = values(spark, ["Water", "Security Deposits", "Moon", None], text.lookup(c, labels), text.map_status(c, labels))
    assert got == [("Services", "mapped"), (None, "excluded"), (None, "unknown"), (None, "unknown")]


def test_expense_type_prefers_exact_then_first_rule(spark):
    rules = Rules(expense_types=(("paint", "Colour"), ("soap", "Wash"), ("paint and soap", "Both")))
    got = values(spark, ["paint", "Soap for paint", "Paint and soap", "??", None], expense_type(F.col("x"), rules))
    assert got == ["Colour", "Colour", "Both", None, None]
    assert values(spark, ["paint"], expense_type(F.col("x"), Rules())) == [None]


def test_worksheet_types(spark):
    got = values(spark, [" Elm ", "All Cottages", "garage", "Boat"], *type_category(F.col("x"), Rules({"elm": "S1"}, ("garage",), ("all cottages",))))
    assert got == [("STR", "S1"), ("STR - Split", None), ("Skip", None), (None, None)]


def test_unit_and_category(spark):
    got = values(
        spark,
        ["102 - Rent Income - Jan", "1/2  Upper - repair (ia) - door", "Transfer to reserve", "Security Deposits Clearing - x",
         "Waterworks", "Water-bill", "lower-Sewer", ""],
        *unit_and_category(F.col("x")),
    )
    assert got == [("102", "Rent Income"), ("1/2 upper", "Repair (IA)"), (None, None), (None, "Security Deposits Clearing"),
                   (None, None), (None, "Water"), ("lower", "Sewer"), (None, None)]


def test_similarity(spark):
    df = spark.createDataFrame([("Acme Corp", "ACME corp"), ("abc", "xyz")], "a STRING, b STRING")
    got = [tuple(r) for r in df.select(matching_blocks_ratio("a", "b"), edit_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [(1.0, 1.0), (0.0, 0.0)]


@pytest.mark.parametrize("a,b,score", [
    ("home depot", "depot home store", 1.0), ("", "x", 0.0), ("abc", "abc", 1.0), ("new york mets", "new york yankees", 16 / 21),
])
def test_token_set(a, b, score):
    assert token_set_score(a, b) == pytest.approx(score)
    assert token_set_score(b, a) == pytest.approx(score)


def test_share(spark):
    df = spark.sql("SELECT CAST(100 AS DECIMAL(18,2)) a")
    assert df.select(money.share(F.col("a"), 3)).first()[0] == d("33.3333333333")
