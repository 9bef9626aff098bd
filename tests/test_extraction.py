import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import guards, pm_text, statement
from ledgerloom.operators.card import CardStatements
from ledgerloom.operators.cashflow import CashFlowPages
from ledgerloom.operators.checking import CheckingStatements
from ledgerloom.operators.cleaning import clean_text, undouble_headings
from ledgerloom.operators.layout import OwnerStatements, words_to_lines
from tests.helpers import d, one, rows

CHECKING = """CUSTOMER SERVICE INFORMATION
December 30, 2023throughJanuary 31, 2024
Account Number:
000000123450000
*start*summary
CHECKING SUMMARY
INSTANCES AMOUNT
Beginning Balance $100.00
Deposits and Additions 2 60.00
Checks Paid 2 -15.00
Electronic Withdrawals 1 -5.00
Ending Balance 5 $140.00
*end*summary
*start*deposits and additions
DEPOSITS AND ADDITIONS
DATE DESCRIPTION AMOUNT
lost before the first date
12/31 Orig CO Name:Aa $1,050.00
Descr:Payment Sec:CCD
Trn: 1Tc
01/02 broken start without amount
belongs to the broken one
01/03 Plain 10.00
Total Deposits and Additions $60.00
*end*electro0nic withdraw1al /17 01/17 Leaked prefix 7.00
Page of
1 6
December 30, 2023throughJanuary 31, 2024
DEPOSITS AND ADDITIONS
(continued)
CHECKS PAID
DATE
1025 ^ 01/23 $10.00
*^ 01/24 5.00
If you see a description in the Checks Paid section
ELECTRONIC WITHDRAWALS
02/30 impossible day 1.00
01/05 Payment -$5.00
FEES
01/06 Service fee 2.50
DAILY ENDING BALANCE
01/31 9.00
"""


@pytest.fixture(scope="module")
def checking(spark):
    return spark.createDataFrame([(1, "A", CHECKING), (2, "A", "nothing here"), (3, "A", CHECKING.replace("CHECKING SUMMARY", "X"))],
                                 "doc_id INT, account STRING, text STRING")


def test_checking_rows(checking):
    got = rows(CheckingStatements(checking).transactions(), "section", "date", "description", "amount", "check_number")
    assert got == sorted([
        ("deposits", dt.date(2024, 12, 31), "Orig CO Name:Aa Descr:Payment Sec:CCD Trn: 1Tc", d("1050.00"), None),
        ("deposits", dt.date(2024, 1, 3), "Plain", d("10.00"), None),
        ("deposits", dt.date(2024, 1, 17), "Leaked prefix", d("7.00"), None),
        ("checks_paid", dt.date(2024, 1, 23), "Check #1025", d("-10.00"), "1025"),
        ("checks_paid", dt.date(2024, 1, 24), "Check #(unknown)", d("-5.00"), None),
        ("electronic_withdrawals", dt.date(2024, 1, 5), "Payment", d("-5.00"), None),
        ("fees", dt.date(2024, 1, 6), "Service fee", d("-2.50"), None),
    ], key=repr)


def test_checking_year_by_period(checking):
    got = rows(CheckingStatements(checking, year_rule="period").transactions().filter("description LIKE 'Orig%'"), "date")
    assert got == [(dt.date(2023, 12, 31),)]


def test_checking_summary_errors_and_warnings(checking):
    parsed = CheckingStatements(checking)
    st = parsed.statements().first()
    assert (st.beginning, st.ending, st.total_deposits, st.total_checks_paid, st.total_fees) == (
        d("100.00"), d("140.00"), d("60.00"), d("-15.00"), None)
    assert st.instance_counts == {"deposits": 2, "checks_paid": 2, "electronic_withdrawals": 1, "fees": None, "total": 5}
    assert rows(parsed.errors(), "doc_id", "error") == [(2, "no statement period"), (3, "no checking summary")]
    warned = rows(parsed.warnings(), "section", "warning", "record")
    assert ("deposits", "unreadable first line", "01/02 broken start without amount\nbelongs to the broken one") in warned
    assert ("electronic_withdrawals", "invalid date", "02/30 impossible day 1.00") in warned
    assert ("checks_paid", "check number missing", "*^ 01/24 5.00") in warned
    bad = rows(guards.section_checks(parsed.statements(), parsed.transactions()).filter("NOT ok"), "check")
    assert bad == [("balance",), ("count_deposits",)]
    with pytest.raises(guards.GuardError):
        guards.enforce(guards.section_checks(parsed.statements(), parsed.transactions()))


def test_clean_text_is_idempotent_and_eats_plain_check_numbers(spark):
    df = spark.createDataFrame([("1025 01/23 10.00\n\n\n\nab 1 01/05 x\nPage of\n1 6\n",)], "t STRING")
    once = df.select(clean_text(F.col("t")).alias("t"))
    assert once.first()[0] == "01/23 10.00\n\n01/05 x\n"
    assert once.select(clean_text(F.col("t"))).first()[0] == once.first()[0]
    kept = df.select(clean_text(F.col("t"), keep_plain_check_rows=True)).first()[0]
    assert kept == "1025 01/23 10.00\n\n01/05 x\n"


def test_undouble(spark):
    df = spark.createDataFrame([(["AACCCCOOUUNNTT SSUUMMMMAARRYY", "INTEREST CHARGES", " ((CCOONNTT))", "MMiixxeedd", "AABB COFFEE"],)], "l ARRAY<STRING>")
    assert df.select(undouble_headings(F.col("l"))).first()[0] == [
        "ACCOUNT SUMMARY", "INTEREST CHARGES", " ((CONT))", "MMiixxeedd", "AABB COFFEE"]


def test_card(spark):
    text = """AACCCCOOUUNNTT SSUUMMMMAARRYY
Previous Balance $10.00
Payment, Credits -$1,200.75
Purchases +$30.00
Opening/Closing Date 12/07/24 - 01/06/25
12/29 Payment Thank You - Web -1,200.75
01/05 TOY *KITE Shop 41.30
13/45 bad date 1.00
J
TRANSACTIONS THIS CYCLE (CARD 4001) $1159.45-
01/06 LATE .50
TRANSACTIONS THIS CYCLE (CARD 4002) $0.50
01/06 after all 1.00
"""
    docs = spark.createDataFrame([(1, "CC", text), (2, "CC", "Opening/Closing Date 12/07/24 - 01/06/25"), (3, "CC", "New Balance $1.00")],
                                 "doc_id INT, account STRING, text STRING")
    parsed = CardStatements(docs, ("4001", "4002"))
    assert rows(parsed.transactions(), "date", "description", "amount", "cardholder") == sorted([
        (dt.date(2024, 12, 29), "Payment Thank You - Web", d("-1200.75"), "4001"),
        (dt.date(2025, 1, 5), "TOY *KITE Shop", d("41.30"), "4001"),
        (dt.date(2025, 1, 6), "LATE", d("0.50"), "4002"),
    ], key=repr)
    assert sorted(r[0] for r in rows(parsed.warnings(), "reason")) == ["invalid date", "no active cardholder"]
    st = parsed.statements().first()
    assert (st.payments_credits, st.purchases_total, st.fees_charged) == (d("-1200.75"), d("30.00"), None)
    assert st.cycle_totals == {"4001": d("-1159.45"), "4002": d("0.50")}
    assert rows(parsed.errors(), "doc_id", "error") == [(2, "no account summary"), (3, "no opening/closing date")]
    assert rows(guards.cycle_checks(parsed.statements(), parsed.transactions()).filter("NOT ok")) == []


def test_generic_rollover_and_totals(spark):
    text = "Beginning balance: $1,000.00\n 12/30  Shop   A   -5.00   995.00\n01/02 Shop B $6.00\n02/30 Bad 1.00\n"
    docs = spark.createDataFrame([(1, "A", 2023, text)], "doc_id INT, account STRING, statement_year INT, text STRING")
    assert rows(statement.transactions(docs), "date", "description", "amount", "balance") == [
        (dt.date(2023, 12, 30), "Shop A", d("-5.00"), d("995.00")), (dt.date(2024, 1, 2), "Shop B", d("6.00"), None)]
    assert one(statement.header_totals(docs), "beginning", "ending") == (d("1000.00"), None)


def test_pm_text_longest_category(spark):
    text = "01/02/2024 May rent Rental Income 10.00\n01/03/2024  Fix - REPAIRS -5.00\n01/04/2024 Management Fee 3.00\n01/05/2024 Odd   New Thing   4.00\n"
    docs = spark.createDataFrame([(1, "L1", text)], "doc_id INT, property_id STRING, text STRING")
    got = rows(pm_text.entries(docs, ["Rental Income", "Income", "Repairs", "Fee", "Management Fee"]), "description", "pm_category", "amount")
    assert got == sorted([("May rent", "Rental Income", d("10.00")), ("Fix", "Repairs", d("-5.00")), ("Management", "Fee", d("3.00")),
                          ("Odd", "New Thing", d("4.00"))], key=repr)


HEAD = [("Date", 43), ("Payee", 90), ("/", 110), ("Payer", 115), ("Type", 156), ("Reference", 191), ("Description", 249),
        ("Cash", 460), ("In", 475), ("Cash", 500), ("Out", 515), ("Balance", 535)]


def page(words, doc=1, number=1):
    return [(doc, number, i, t, float(x), float(y)) for i, (t, x, y) in enumerate(words)]


@pytest.fixture(scope="module")
def owner_words(spark):
    head = [(t, x, 80) for t, x in HEAD]
    first = page(
        [("Consolidated", 40, 10), ("Summary", 80, 10), ("Cash", 40, 12), ("In", 60, 12), ("300.00", 300, 12),
         ("SW", 40, 20), ("12", 55, 20), ("Elm", 70, 20), ("Cash", 40, 30), ("In", 60, 30), ("310.00", 300, 30)]
        + head
        + [("02/11/2024", 43, 100), ("Doe", 90, 100), ("eCheck", 156, 100), ("R1", 191, 100), ("305", 249, 100), ("-", 260, 100), ("Rent", 265, 100),
           ("Income", 280, 100), ("310.00", 460, 100), ("9.00", 535, 100),
           ("tie", 90, 110),  # as near to the row above as to the row below
           ("01/18/2024", 43, 120), ("Check", 156, 120), ("Water", 249, 120), ("spill", 455, 120), ("40.00", 500, 120),
           ("below", 249, 132), ("Beginning", 249, 135), ("Cash", 270, 135), ("Balance", 290, 135), ("as", 300, 135), ("of", 310, 135),
           ("far", 249, 170), ("01/19/2024", 43, 220), ("no", 249, 220), ("amount", 270, 220),
           ("Total", 43, 300), ("310.00", 454, 300), ("40.00", 495, 300), ("Cash", 40, 320), ("Out", 60, 320), ("-40.00", 300, 320)]
    )
    second = page([("Cash", 40, 10), ("Flow", 60, 10), ("-", 80, 10), ("12", 90, 10), ("Month", 100, 10), ("SW", 40, 20), ("34", 50, 20), ("Oak", 60, 20)], number=2)
    other = page([("hello", 1, 1)], doc=2)
    return spark.createDataFrame(first + second + other, "doc_id INT, page INT, word_no INT, text STRING, x0 DOUBLE, top DOUBLE")


@pytest.mark.parametrize("spread", [False, True])
def test_owner_statement(owner_words, spread):
    parsed = OwnerStatements(owner_words, (("elm", "L1"), ("oak", "L2")), "SW ", spread=spread)
    got = rows(parsed.transactions(), "property", "date", "payee", "reference", "description", "cash_in", "cash_out", "unit", "category")
    assert got == sorted([
        ("L1", dt.date(2024, 2, 11), "Doe tie", "R1", "305 - Rent Income", d("310.00"), None, "305", "Rent Income"),
        ("L1", dt.date(2024, 1, 18), "tie", None, "Water below", None, d("40.00"), None, "Water"),
    ], key=repr)
    assert rows(parsed.warnings(), "date", "description") == [(dt.date(2024, 1, 19), "no amount")]
    assert rows(parsed.properties(), "name", "cash_in", "cash_out", "total_cash_in_printed", "total_cash_out_printed") == [
        ("L1", d("310.00"), d("-40.00"), d("310.00"), d("40.00"))]
    report = parsed.reports().filter("doc_id = 1").first()
    assert report.consolidated_cash_in == d("300.00") and report.consolidated_cash_out is None
    assert rows(parsed.errors(), "doc_id") == [(2,)]
    docs = owner_words.select("doc_id").unionByName(owner_words.sparkSession.createDataFrame([(3,)], "doc_id INT"))
    assert rows(parsed.errors(docs)) == [(2, "no property sections"), (3, "no extractable text")]


def test_long_documents_scan_only_lines_that_change_the_state(spark, monkeypatch):
    """Both ways of walking agree on every line; page by page, only headings, totals and markers are scanned."""
    from ledgerloom.operators import layout

    rng, words = random.Random(4), []
    texts = ["SW 12 Elm St", "SW 34 Oak Ave", "Total 5.00 6.00", "Total", "Consolidated Summary", "Rent Roll", "Cash Flow - 12 Month", "SW elsewhere"]
    for doc in range(1, 5):
        for number in range(1, 9):
            if rng.random() < 0.2:
                continue
            for line in range(12):
                if rng.random() < 0.12:
                    words += [(doc, number, i, t, float(x), 10.0 * line) for i, (t, x) in enumerate(HEAD)]
                else:
                    text = rng.choice(texts[:-2] if number < 7 else texts) if rng.random() < 0.25 else "02/11/2024 Doe Cash In 3.00"
                    words += [(doc, number, i, t, 40.0 + 60 * i, 10.0 * line) for i, t in enumerate(text.split())]
    table = spark.createDataFrame(words, "doc_id INT, page INT, word_no INT, text STRING, x0 DOUBLE, top DOUBLE").cache()
    scanned, scan = [], layout.running_last
    monkeypatch.setattr(layout, "running_last", lambda df, **x: (scanned.append((x["spread"], df.count())), scan(df, **x))[1])
    walked = [OwnerStatements(table, (("elm", "L1"), ("oak", "L2")), "SW ", spread=spread) for spread in (False, True)]
    names = ["doc_id", "page", "y", "property", "before", "outside", "opens", "is_total", "block", "consolidated", "ended"]
    one_way, other_way = (rows(w._walked, *names) for w in walked)
    assert one_way == other_way and len({r[4] for r in one_way}) == 3
    assert rows(walked[0].transactions(), "doc_id", "page", "y", "property", "cash_in") == rows(walked[1].transactions(), "doc_id", "page", "y", "property", "cash_in")
    assert max(n for spread, n in scanned if spread) < len(one_way) / 2


def test_lines_round_half_to_even(spark):
    words = spark.createDataFrame(page([("b", 2, 2.5), ("a", 1, 2.4), ("c", 1, 3.5)]), "doc_id INT, page INT, word_no INT, text STRING, x0 DOUBLE, top DOUBLE")
    assert rows(words_to_lines(words), "y", "line") == [(2, "a b"), (4, "c")]


PAGE_1 = """Cash Flow - 12 Month
Properties:SW X - 12 Elm St, IA
Period Range: Jan 2024 to Dec 2024
Income
Rent Income 1.00 2.00 100.00
Rent Income 1.00 2.00 120.00
Total Operating 1.00 120.00
Income
Expense
HVAC (Heat, 0.00 1.00 1,410.20
Ventilation, Air)
Lawn and Snow 80.25 963.00

Care
Total Repairs 1.00 9.00
ignored continuation
Odd 5.00
Odd b 6.00
c"""
PAGE_2 = """Cash Flow - 12 Month
Odd 7.00
b
c
Water 5.00
Acme PM
not part of water
Total Expense 0.00 3.00
stray
Net Income 0.00 -1.00"""


@pytest.mark.parametrize("spread", [False, True])
def test_cashflow(spark, spread):
    pages = spark.createDataFrame(
        [(1, 0, "cover"), (1, 1, PAGE_1), (1, 2, PAGE_2), (1, 3, "Rent Roll"), (1, 4, "Cash Flow 12 Month\nIncome\nLate Fee 1.00"), (2, 1, None)],
        "doc_id INT, page_no INT, text STRING",
    )
    parsed = CashFlowPages(pages, ("Acme PM",), spread=spread)
    got = rows(parsed.items(), "group_page", "side", "category", "amount")
    assert got == sorted([
        (1, "income", "Rent Income", d("120.00")),
        (1, "expense", "HVAC (Heat, Ventilation, Air)", d("1410.20")),
        (1, "expense", "Lawn and Snow Care", d("963.00")),
        # "Odd 7.00" first replaces "Odd", then becomes "Odd b" and finally replaces "Odd b c".
        (1, "expense", "Odd b c", d("7.00")),
        (1, "expense", "Water", d("5.00")),
        (4, "income", "Late Fee", d("1.00")),
    ], key=repr)
    assert rows(parsed.totals(), "group_page", "total_income", "total_expense", "net_income") == [(1, d("120.00"), d("3.00"), d("-1.00"))]
    assert rows(parsed.metadata, "group_page", "property", "period") == [(1, "12 Elm St, IA", "Jan 2024 to Dec 2024")]
