"""Render ledger rows as the documents the extractors read.

A document covers one period and one block of 2,048 transaction numbers, so no document grows with the data:
more data means more documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import TOTAL
from ledgerloom.scale import durable
from workload.adapters import CARDS, LTR_PROPERTIES, PAYER

BLOCK = 2048
#: printed on every card statement
PREVIOUS_BALANCE = "820.40"
PROPERTY_RULES = (("elm st", "L1"), ("oak ave", "L2"), ("pine rd", "L3"))
PROPERTY_TITLES = {"L1": "SW 12 Elm St", "L2": "SW 34 Oak Ave", "L3": "SW 56 Pine Rd"}


def money(c: Column) -> Column:
    return F.format_number(c.cast(TOTAL), 2)


def month_day(d: Column) -> Column:
    return F.date_format(d, "MM/dd")


def month_doc(d: Column, txn_id: Column) -> Column:
    return ((F.year(d) * 100 + F.month(d)).cast("bigint") * 10_000_000_000 + F.floor(txn_id / BLOCK)).cast("bigint")


def two_month_doc(d: Column, txn_id: Column) -> Column:
    """December and January share a document."""
    period = F.floor((F.year(d) * 12 + F.month(d)) / 2)
    return (period * 10_000_000_000 + F.floor(txn_id / BLOCK)).cast("bigint")


def _ordered_lines(*order: str) -> Column:
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(*order, "line"))), lambda x: x["line"]), "\n"
    )


def generic_statements(ledger: DataFrame) -> DataFrame:
    """``docs(doc_id, account, statement_year, text)``; every second row prints a balance."""
    amount = F.when(F.col("amount") < 0, F.concat(F.lit("-"), money(-F.col("amount")))).otherwise(
        F.concat(F.lit("$"), money(F.col("amount")))
    )
    balance = F.when(F.col("txn_id") % 2 == 0, F.concat(F.lit("   "), money(F.abs("amount") + 100))).otherwise("")
    rows = ledger.select(
        two_month_doc(F.col("date"), F.col("txn_id")).alias("doc_id"), "date", "txn_id", "amount",
        F.concat(F.lit("  "), month_day(F.col("date")), F.lit("  "), F.regexp_replace("description", " ", "  "),
                 F.lit("   "), amount, balance).alias("line"),
    )
    plus = F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(0))
    minus = F.sum(F.when(F.col("amount") < 0, -F.col("amount")).otherwise(0))
    docs = rows.groupBy("doc_id").agg(
        F.year(F.min("date")).alias("statement_year"), plus.alias("plus"), minus.alias("minus"),
        _ordered_lines("date", "txn_id").alias("body"),
    )
    head = F.concat(
        F.lit("Your Bank\nBeginning Balance: $1,000.00\nTotal Deposits   $"), money(F.col("plus")),
        F.lit("\ntotal withdrawals: "), money(F.col("minus")), F.lit("\nDate  Description  Amount  Balance\n"),
    )
    tail = F.concat(
        F.lit("\n99/99 not a row 1.00\n02/30 no such day 5.00\nEnding Balance "),
        F.when(F.col("plus") - F.col("minus") + 1000 < 0, "-").otherwise(""),
        money(F.abs(F.col("plus") - F.col("minus") + 1000)), F.lit("\r\n"),
    )
    return docs.select("doc_id", F.lit("checking-1").alias("account"), "statement_year",
                       F.concat(head, F.col("body"), tail).alias("text"))


def checking_section(amount: Column, txn_id: Column) -> Column:
    return (
        F.when(amount > 0, "deposits").when(txn_id % 3 == 0, "checks_paid")
        .when(txn_id % 3 == 1, "electronic_withdrawals").otherwise("fees")
    )


def checking_statements(ledger: DataFrame) -> DataFrame:
    """``docs(doc_id, account, text)``: summary block, four sections, wrapped records, artifacts of the text layer.

    Every fifth block prints a wrong count of deposits, every seventh a wrong ending balance.
    """
    section = checking_section(F.col("amount"), F.col("txn_id"))
    value = money(F.abs("amount"))
    check_no = F.when(F.col("txn_id") % 13 == 0, "").otherwise(
        F.concat((F.lit(1000) + F.col("txn_id") % 9000).cast("string"), F.lit(" "))
    )
    marker = F.when(F.col("txn_id") % 2 == 0, "*^ ").otherwise("^ ")
    more = F.when(F.col("txn_id") % 4 == 0, F.concat(F.lit("\nDescr:Payment Sec:Web\nInd Name:Sample Trn: "),
                                                     F.col("txn_id").cast("string"), F.lit("Tc"))).otherwise("")
    line = F.when(
        section == "checks_paid", F.concat(check_no, marker, month_day(F.col("date")), F.lit(" "), value)
    ).otherwise(
        F.concat(month_day(F.col("date")), F.lit(" "), F.col("description"), F.lit(" $"), value, more)
    )
    rows = ledger.select(
        month_doc(F.col("date"), F.col("txn_id")).alias("doc_id"), "date", "txn_id", "amount",
        section.alias("section"), line.alias("line"),
    )
    names = ("deposits", "checks_paid", "electronic_withdrawals", "fees")
    aggs = []
    for s in names:
        here = F.col("section") == s
        aggs += [
            F.sum(F.when(here, F.abs("amount")).otherwise(0)).alias(f"sum_{s}"),
            F.count_if(here).alias(f"n_{s}"),
            F.array_join(F.transform(
                F.array_sort(F.collect_list(F.when(here, F.struct("date", "txn_id", "line")))), lambda x: x["line"]
            ), "\n").alias(f"body_{s}"),
        ]
    docs = rows.groupBy("doc_id").agg(F.min("date").alias("d"), F.sum("amount").alias("net"),
                                      F.count(F.lit(1)).alias("n"), *aggs)
    block = F.col("doc_id") % 10_000_000_000
    first, last = F.trunc("d", "month"), F.last_day("d")
    period = F.concat(F.date_format(first, "MMMM d, yyyy"), F.lit("through"), F.date_format(last, "MMMM d, yyyy"))
    ending = F.col("net") + 1000 + F.when(block % 7 == 0, F.lit(5)).otherwise(F.lit(0))
    ending_text = F.concat(F.when(ending < 0, "-").otherwise(""), F.lit("$"), money(F.abs(ending)))
    footer = F.concat(F.lit("\nPage of\n1 6\n"), period, F.lit("\nAccount Number:\n000000123450000\n"))
    header = F.concat(
        F.lit("CUSTOMER SERVICE INFORMATION\n"), period, F.lit("\nAccount Number:\n000000123450000\n*start*summary\n"),
        F.lit("CHECKING SUMMARY\nINSTANCES AMOUNT\nBeginning Balance $1,000.00\nDeposits and Additions "),
        (F.col("n_deposits") + F.when(block % 5 == 0, 1).otherwise(0)).cast("string"), F.lit(" "), money(F.col("sum_deposits")),
        F.lit("\nChecks Paid "), F.col("n_checks_paid").cast("string"), F.lit(" -"), money(F.col("sum_checks_paid")),
        F.lit("\nElectronic Withdrawals "), F.col("n_electronic_withdrawals").cast("string"), F.lit(" -"),
        money(F.col("sum_electronic_withdrawals")),
        F.lit("\nFees "), F.col("n_fees").cast("string"), F.lit(" -"), money(F.col("sum_fees")),
        F.lit("\nEnding Balance "), F.col("n").cast("string"), F.lit(" "), ending_text, F.lit("\n*end*summary\n"),
    )

    def total(label: str, s: str) -> Column:
        return F.concat(F.lit(f"\nTotal {label} $"), money(F.col(f"sum_{s}")))

    text = F.concat(
        header,
        F.lit("*start*deposits and additions\nDEPOSITS AND ADDITIONS\nDATE DESCRIPTION AMOUNT\n"), F.col("body_deposits"),
        total("Deposits and Additions", "deposits"), F.lit("\n*end*deposits and additions"), footer,
        F.lit("*start*checks paid section3\nCHECKS PAID\nDATE\nCHECK NO. DESCRIPTION PAID AMOUNT\n"), F.col("body_checks_paid"),
        total("Checks Paid", "checks_paid"),
        F.lit("\nIf you see a description in the section, it means less.\n*end*checks^ paid sectio n3An image may be available\n"),
        F.lit("ELECTRONIC WITHDRAWALS\nDATE DESCRIPTION AMOUNT\n"), F.col("body_electronic_withdrawals"),
        F.lit("\n05/05 a broken start line\nlost continuation 12.00"),
        total("Electronic Withdrawals", "electronic_withdrawals"), footer,
        F.lit("ELECTRONIC WITHDRAWALS\n(continued)\nFEES\nDATE DESCRIPTION AMOUNT\n"), F.col("body_fees"), total("Fees", "fees"),
        F.lit("\nDAILY ENDING BALANCE\n01/31 12.00\n"),
    )
    return docs.select("doc_id", F.lit("checking-1").alias("account"), text.alias("text"))


def card_statements(ledger: DataFrame) -> DataFrame:
    """``docs(doc_id, account, text)``: two cardholders, dates twenty years later, two months per statement.

    Every sixth block prints a wrong subtotal for the second card.
    """
    late = F.make_date(F.year("date") + 20, F.month("date"), F.dayofmonth("date"))
    rows = ledger.select("txn_id", late.alias("date"), "description", (-F.col("amount")).alias("amount"))
    sign = F.when(F.col("amount") < 0, "-").otherwise("")
    rows = rows.select(
        two_month_doc(F.col("date"), F.col("txn_id")).alias("doc_id"), "date", "txn_id", "amount",
        (F.col("txn_id") % 2).alias("card"),
        F.concat(month_day(F.col("date")), F.lit(" "), F.col("description"), F.lit(" "), sign, money(F.abs("amount"))).alias("line"),
    )
    aggs = []
    for i in range(len(CARDS)):
        here = F.col("card") == i
        aggs += [
            F.sum(F.when(here, F.col("amount")).otherwise(0)).alias(f"sum_{i}"),
            F.array_join(F.transform(
                F.array_sort(F.collect_list(F.when(here, F.struct("date", "txn_id", "line")))), lambda x: x["line"]
            ), "\n").alias(f"body_{i}"),
        ]
    docs = rows.groupBy("doc_id").agg(
        F.sum(F.when(F.col("amount") < 0, F.col("amount")).otherwise(0)).alias("credits"),
        F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(0)).alias("purchases"), *aggs,
    )
    months = F.floor(F.col("doc_id") / 10_000_000_000) * 2 - 1
    start = F.make_date(F.floor(months / 12).cast("int"), (months % 12 + 1).cast("int"), F.lit(1))
    docs = docs.withColumns({"start": start, "end": F.last_day(F.add_months(start, 1))})
    wrong = F.when(F.col("doc_id") % 10_000_000_000 % 6 == 0, F.lit(1)).otherwise(F.lit(0))

    def subtotal(i: int) -> Column:
        v = F.col(f"sum_{i}") + (wrong if i else F.lit(0))
        return F.concat(F.lit(f"\nJ DOE\nTRANSACTIONS THIS CYCLE (CARD {CARDS[i]}) $"), money(F.abs(v)),
                        F.when(v < 0, "-").otherwise(""), F.lit("\nINCLUDING PAYMENTS RECEIVED\n"))

    text = F.concat(
        F.lit(f"AACCCCOOUUNNTT SSUUMMMMAARRYY\nPrevious Balance ${PREVIOUS_BALANCE}\nPayment, Credits -$"), money(-F.col("credits")),
        F.lit("\nPurchases +$"), money(F.col("purchases")),
        F.lit("\nCash Advances $0.00\nBalance Transfers $0.00\nFees Charged +$40.00\nInterest Charged $0.00\nNew Balance $655.15\n"),
        F.lit("Opening/Closing Date "), F.date_format("start", "MM/dd/yy"), F.lit(" - "), F.date_format("end", "MM/dd/yy"),
        F.lit("\nAACCCCOOUUNNTT AACCTTIIVVIITTYY ((CCOONNTTIINNUUEEDD))\nDate of\nTransaction Merchant Name or Transaction Description $ Amount\n"),
        F.col("body_0"), subtotal(0), F.lit("TRANSACTIONS THIS CYCLE (CARD 9999) $7.00\n"), F.col("body_1"), subtotal(1),
        F.lit("03/03 after both blocks 9.99\n2031 Totals\nTotal fees charged in 2031 $80.00\nIINNTTEERREESSTT CCHHAARRGGEESS\n"),
    )
    return docs.select("doc_id", F.lit("card-1").alias("account"), text.alias("text"))


def pm_text_reports(ledger: DataFrame) -> DataFrame:
    """``docs(doc_id, property_id, text)``: wide rows, and rows whose column gaps collapsed."""
    category = F.element_at(
        F.array(*[F.lit(c) for c in ("Rental Income", "Repairs", "Management Fee", "Property Tax", "Legal")]),
        (F.col("txn_id") % 5 + 1).cast("int"),
    )
    gap = F.when(F.col("txn_id") % 2 == 0, "   ").otherwise(" ")
    label = F.when(F.col("txn_id") % 2 == 0, category).otherwise(F.upper(category))
    value = F.concat(F.when(F.col("amount") < 0, "-").otherwise("$"), money(F.abs("amount")))
    rows = ledger.select(
        (F.col("txn_id") % 3).alias("p"),
        (month_doc(F.col("date"), F.col("txn_id")) * 3 + F.col("txn_id") % 3).alias("doc_id"), "date", "txn_id", "amount",
        F.concat(F.date_format("date", "MM/dd/yyyy"), F.lit(" "), F.col("description"), gap, label, gap, value).alias("line"),
    )
    docs = rows.groupBy("doc_id", "p").agg(
        _ordered_lines("date", "txn_id").alias("body"),
        F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(0)).alias("plus"),
        F.sum(F.when(F.col("amount") < 0, -F.col("amount")).otherwise(0)).alias("minus"),
    )
    text = F.concat(
        F.lit("Owner report\nDate  Description  Category  Amount\n"), F.col("body"),
        F.lit("\n01/01/2020 nothing known 1.00\n01/02/2020 Legal 2.00\nTotal Income: $"), money(F.col("plus")),
        F.lit("\nTotal Expenses: $"), money(F.col("minus")), F.lit("\nNet to Owner: "),
        F.when(F.col("plus") < F.col("minus"), "-").otherwise(""), money(F.abs(F.col("plus") - F.col("minus"))), F.lit("\n"),
    )
    return docs.select("doc_id", F.concat(F.lit("L"), (F.col("p") + 1).cast("string")).alias("property_id"), text.alias("text"))


_ROWS_PER_PAGE = 15
_ROW_GAP = 40.0
_TOP = 100.0
_HEAD = (("Date", 43), ("Payee", 90), ("/", 110), ("Payer", 115), ("Type", 156), ("Reference", 191), ("Description", 249),
         ("Cash", 460), ("In", 475), ("Cash", 500), ("Out", 515), ("Balance", 535))


def _word(text: Column | str, x: float, top: Column | float) -> Column:
    return F.struct(
        (F.lit(text) if isinstance(text, str) else text).alias("text"), F.lit(float(x)).alias("x0"),
        (F.lit(float(top)) if isinstance(top, (int, float)) else top).cast("double").alias("top"),
    )


def _spread(text: Column, x: float, top: Column, step: float = 18.0) -> Column:
    return F.transform(
        F.split(text, " "),
        lambda w, i: F.struct(w.alias("text"), (F.lit(x) + i * step).alias("x0"), top.cast("double").alias("top")),
    )


def layout_rows(ledger: DataFrame) -> DataFrame:
    """Rows of owner statements with their place on the page.

    Cash in for deposits, cash out otherwise; some payees wrap above and below, some descriptions wrap below.
    """
    category = F.element_at(
        F.array(*[F.lit(c) for c in ("Rent Income", "Water", "Repair (IA)", "HVAC (Heat, Ventilation, Air)", "Late Fee")]),
        (F.col("txn_id") % 5 + 1).cast("int"),
    )
    unit = F.element_at(F.array(*[F.lit(u) for u in ("102", "1/2 upper", "")]), (F.col("txn_id") % 3 + 1).cast("int"))
    rows = ledger.select(
        month_doc(F.col("date"), F.col("txn_id")).alias("doc_id"), (F.floor(F.col("txn_id") / 7) % 3).cast("int").alias("p"),
        "date", "txn_id", "amount", category.alias("category"), unit.alias("unit"),
    )
    place = Window.partitionBy("doc_id", "p").orderBy("date", "txn_id")
    return rows.withColumn("r", F.row_number().over(place) - 1).withColumns(
        {
            "page": (F.col("p") * 1000 + F.floor(F.col("r") / _ROWS_PER_PAGE) + 1).cast("int"),
            "top": F.lit(_TOP) + (F.col("r") % _ROWS_PER_PAGE) * _ROW_GAP,
        }
    )


def layout_words(ledger: DataFrame) -> DataFrame:
    """``words(doc_id, page, word_no, text, x0, top)`` of owner statements."""
    rows = durable(layout_rows(ledger))
    top = F.col("top")
    ref = F.concat(F.lit("R"), F.col("txn_id").cast("string"))
    head = F.when(F.col("unit") == "", F.col("category")).otherwise(F.concat_ws(" - ", "unit", "category"))
    value = money(F.abs("amount"))
    cash = F.when(F.col("amount") > 0, _word(value, 460, top)).otherwise(_word(value, 500, top))
    words = F.concat(
        F.array(
            _word(F.date_format("date", "MM/dd/yyyy"), 43, top), _word("Doe", 90, top), _word("Check", 156, top),
            _word(ref, 191, top), cash, _word(money(F.abs("amount") + 1), 535, top),
        ),
        _spread(head, 230.0, top),
        F.when(F.col("txn_id") % 4 == 0, F.array(_word("Jane", 90, top - 12))).otherwise(F.array().cast("array<struct<text:string,x0:double,top:double>>")),
        F.when(F.col("txn_id") % 4 == 1, F.array(_word("LLC", 90, top + 12), _word("rest", 230, top + 12.3))).otherwise(
            F.array().cast("array<struct<text:string,x0:double,top:double>>")),
    )
    body = rows.select("doc_id", "page", words.alias("words"))
    # Section head, table head on every page, total after the last row, appendix at the end.
    sections = rows.groupBy("doc_id", "p").agg(
        F.max("page").alias("last_page"),
        F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(0)).alias("cin"),
        F.sum(F.when(F.col("amount") <= 0, -F.col("amount")).otherwise(0)).alias("cout"),
    )
    title = F.element_at(F.array(*[F.lit(PROPERTY_TITLES[p]) for p in LTR_PROPERTIES]), F.col("p") + 1)
    wrong = F.when(F.col("doc_id") % 10_000_000_000 % 4 == 0, F.lit(1)).otherwise(F.lit(0))
    heads = sections.select(
        "doc_id", (F.col("p") * 1000 + 1).cast("int").alias("page"),
        F.concat(
            _spread(title, 40.0, F.lit(20.0)),
            F.array(_word("Beginning", 40, 30), _word("Balance", 80, 30), _word("500.00", 300, 30)),
            F.array(_word("Cash", 40, 40), _word("In", 80, 40), _word(money(F.col("cin")), 300, 40)),
            F.array(_word("Cash", 40, 50), _word("Out", 80, 50), _word(F.concat(F.lit("-"), money(F.col("cout"))), 300, 50)),
            F.array(_word("Ending", 40, 60), _word("Cash", 80, 60), _word("Balance", 110, 60),
                    _word(F.concat(F.when(F.col("cin") - F.col("cout") + 500 < 0, "-").otherwise(""),
                                   money(F.abs(F.col("cin") - F.col("cout") + 500))), 300, 60)),
        ).alias("words"),
    )
    tables = rows.select("doc_id", "page").distinct().select(
        "doc_id", "page", F.array(*[_word(t, x, 80) for t, x in _HEAD]).alias("words")
    )
    totals = sections.select(
        "doc_id", F.col("last_page").alias("page"),
        F.array(_word("Total", 43, 730), _word(money(F.col("cin") + wrong), 454, 730), _word(money(F.col("cout")), 495, 730)).alias("words"),
    )
    docs = sections.groupBy("doc_id").agg(F.sum("cin").alias("cin"), F.sum("cout").alias("cout"), F.count(F.lit(1)).alias("n"))
    cover = docs.select(
        "doc_id", F.lit(0).alias("page"),
        F.concat(
            _spread(F.lit("Owner Statement Jan 1, 2024 - Jan 31, 2024"), 40.0, F.lit(10.0)),
            _spread(F.lit("Consolidated Summary"), 40.0, F.lit(20.0)),
            F.array(_word("Beginning", 40, 30), _word("Balance", 80, 30), _word(money(F.col("n") * 500), 300, 30)),
            F.array(_word("Cash", 40, 40), _word("In", 80, 40), _word(money(F.col("cin")), 300, 40)),
            F.array(_word("Cash", 40, 50), _word("Out", 80, 50), _word(F.concat(F.lit("-"), money(F.col("cout"))), 300, 50)),
        ).alias("words"),
    )
    appendix = docs.select(
        "doc_id", F.lit(9999).alias("page"),
        F.concat(_spread(F.lit("Cash Flow - 12 Month"), 40.0, F.lit(60.0)), _spread(F.lit(PROPERTY_TITLES["L1"]), 40.0, F.lit(80.0)),
                 F.array(_word("01/01/2024", 43, 95), _word("5.00", 460, 95))).alias("words"),
    )
    parts = body
    for other in (heads, tables, totals, cover, appendix):
        parts = parts.unionByName(other)
    return parts.select("doc_id", "page", F.posexplode("words").alias("word_no", "w")).select(
        "doc_id", "page", "word_no", "w.text", "w.x0", "w.top"
    )


def cashflow_pages(totals: DataFrame) -> DataFrame:
    """``pages(doc_id, page_no, text)`` from ``totals(year, property, side, category, amount)``.

    One document per year; per property one page of income and one of expenses, with a wrapped label, subtotals and
    a page in between that is not part of the appendix.
    """
    wrapped = {"HVAC (Heat, Ventilation, Air)": ("HVAC (Heat,", "Ventilation, Air)")}
    name = F.lit(None).cast("string")
    tail = F.lit("")
    for full, (start, rest) in wrapped.items():
        name = F.when(F.col("category") == full, start).otherwise(name)
        tail = F.when(F.col("category") == full, "\n" + rest).otherwise(tail)
    name = F.coalesce(name, F.col("category"))
    rows = totals.withColumn(
        "line", F.concat(name, F.lit(" 0.00 1,000.00 -5.25 "), F.when(F.col("amount") < 0, "-").otherwise(""), money(F.abs("amount")), tail)
    )
    income, expense = F.col("side") == "income", F.col("side") == "expense"

    def body(here: Column) -> Column:
        return F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(here, F.struct("category", "line")))), lambda x: x["line"]), "\n")

    sheets = rows.groupBy("year", "property").agg(
        body(income).alias("inc"), body(expense).alias("exp"),
        F.sum(F.when(income, F.col("amount")).otherwise(0)).alias("ti"),
        F.sum(F.when(expense, F.col("amount")).otherwise(0)).alias("te"),
    )
    no = F.substring("property", 2, 5).cast("int") * 3
    head = F.concat(F.lit("Cash Flow - 12 Month\n"), F.lit(PAYER), F.lit("\n"))
    first = F.concat(
        head, F.lit("Properties:SW "), F.col("property"), F.lit(" - "), F.col("property"), F.lit(" Elm St, IA\nPeriod Range: Jan "),
        F.col("year").cast("string"), F.lit(" to Dec "), F.col("year").cast("string"),
        F.lit("\nAccount Name Jan Feb Total\nOperating Income & Expense\nIncome\n"), F.col("inc"),
        F.lit("\nTotal Operating 1.00 "), money(F.col("ti")), F.lit("\nIncome"),
    )
    second = F.concat(
        head, F.lit("Expense\n"), F.col("exp"), F.lit("\nTotal Repairs Cleaning 1.00 99.00\nTotal Operating 1.00 "), money(F.col("te")),
        F.lit("\nExpense\nNOI - Net 1.00 2.00\nOperating\nIncome\nOther Items\nPrepaid Rent 1.00 3.00\nNet Other Items 1.00 3.00\nTotal Income 0.00 "),
        money(F.col("ti")), F.lit("\nTotal Expense 0.00 "), money(F.col("te")), F.lit("\nNet Income 0.00 "),
        F.when(F.col("ti") < F.col("te"), "-").otherwise(""), money(F.abs(F.col("ti") - F.col("te"))),
        F.lit("\nCash Flow 1.00 4.00\nActual Ending 1.00"),
    )
    doc = F.col("year").cast("bigint").alias("doc_id")
    return (
        sheets.select(doc, no.alias("page_no"), first.alias("text"))
        .unionByName(sheets.select(doc, (no + 1).alias("page_no"), second.alias("text")))
        .unionByName(sheets.select(doc, (no + 2).alias("page_no"), F.lit("Rent Roll\nUnit 1 12.00").alias("text")))
    )
