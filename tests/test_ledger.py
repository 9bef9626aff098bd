import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.fixed_values import STR_LAYOUT
from ledgerloom.operators import categorize, guards, learning, review, rollup, verify, worksheet
from ledgerloom.plans import pipeline
from ledgerloom.schemas import VENDOR_MAP
from ledgerloom.sources import documents, sinks, tables
from tests.helpers import d, one, rows
from tests.test_extraction import CHECKING

DAY = dt.date(2024, 3, 1)
REVIEW = "description STRING, category STRING, property STRING, expense_type STRING, year INT, seq INT"


def test_learning_fold(spark):
    prior = spark.createDataFrame([("acme", "STR", 0.95, 3, [2022], False, "S1", "", "review")], VENDOR_MAP)
    new = spark.createDataFrame([
        ("ACME #1", "LTR", "", "Supplies", 2024, 1), ("Acme", "STR", "S2", "", 2024, 2), ("Blue", "STR", "", "", 2024, 3),
        ("Blue", "Skip", "", "", 2024, 4), ("Blue", "STR - Split", "", "", 2024, 5), ("", "STR", "", "", 2024, 6), ("Gone", "", "", "", 2024, 7),
    ], REVIEW)
    learned = learning.learn_from_reviews(prior, new)
    assert rows(learned) == sorted([
        ("acme", "STR", 0.95, 5, [2022, 2024], True, "S2", "Supplies", "review"),
        ("blue", "STR", 0.9, 1, [2024], False, "", "", "review"),
    ], key=repr)
    # Ambiguity never goes away, and the same inputs give the same map.
    again = learning.learn_from_reviews(learned, new.filter("description = 'Acme'"))
    assert rows(again.filter("vendor = 'acme'"), "ambiguous", "occurrences") == [(True, 6)]
    assert rows(learning.learn_from_reviews(prior, new)) == rows(learned)


def test_vendor_decisions_add_counts(spark):
    prior = spark.createDataFrame([("acme", "STR", 0.95, 3, [2022], False, "S1", "", "review")], VENDOR_MAP)
    typed = spark.createDataFrame([("acme", "STR", "", "Utilities", 4), ("new", "Split", "", "", 9), ("blue", "LTR", "L1", "", None)],
                                  "vendor STRING, category STRING, property STRING, expense_type STRING, count BIGINT")
    assert rows(learning.learn_from_vendor_decisions(prior, typed, year=2024), "vendor", "occurrences", "property", "expense_type") == [
        ("acme", 7, "S1", "Utilities"), ("blue", 1, "L1", "")]


def test_pm_report_counts_first_seen_vendors(spark):
    prior = spark.createDataFrame([("acme", "Water", 0.95, 3, [2022], False, "", "", "x")], VENDOR_MAP)
    txns = spark.createDataFrame([("Acme", "Sewer", 2024, 1), ("Blue", "Water", 2024, 2), ("Blue", "", 2024, 3), (None, "Water", 2024, 4)],
                                 "payee STRING, category STRING, year INT, seq INT")
    assert one(learning.pm_learning_report(prior, txns), "total_transactions", "categories_seen", "vendors_learned") == (4, 2, 1)
    assert rows(learning.learn_from_pm(prior, txns), "vendor", "category", "ambiguous") == [("acme", "Water", True), ("blue", "Water", False)]


def test_categorize_buckets(spark):
    vm = spark.createDataFrame([
        ("sure", "STR", 0.9, 1, [], False, "S1", "HOA", "r"), ("flag", "STR", 0.9, 1, [], True, "", "", "r"),
        ("weak", "LTR", 0.7, 1, [], False, "", "", "r"), ("blank", "", 0.9, 1, [], False, "", "", "r")], VENDOR_MAP)
    txns = spark.createDataFrame([(i, x) for i, x in enumerate(["Sure", "Flag", "Weak #1", "Blank", "Other"])], "id INT, description STRING")
    tagged = categorize.categorize(txns, vm)
    assert rows(tagged, "vendor", "category", "confidence", "property", "source") == sorted([
        ("sure", "STR", 0.9, "S1", "auto"), ("flag", "STR", 0.9, "", "ambiguous"), ("weak", "LTR", 0.7, "", "ambiguous"),
        ("blank", "", 0.9, "", "ambiguous"), ("other", "", 0.0, "", "unknown")], key=repr)
    assert rows(categorize.bucket_counts(tagged), "source", "rows") == [("ambiguous", 3), ("auto", 1), ("unknown", 1)]
    assert rows(categorize.review_queue(tagged), "vendor", "queue_part") == sorted(
        [("flag", 0), ("weak", 0), ("blank", 0), ("other", 1)], key=repr)


def test_sign_can_be_aligned_at_union(spark):
    a = spark.createDataFrame([(d("-5.00"),)], "amount DECIMAL(18,2)")
    b = spark.createDataFrame([(d("7.00"),)], "amount DECIMAL(18,2)")
    assert rows(categorize.union_sources([(a, "checking", 1), (b, "card", -1)]), "kind", "amount", "raw_amount") == [
        ("card", d("-7.00"), d("7.00")), ("checking", d("-5.00"), d("-5.00"))]


@pytest.fixture(scope="module")
def queue(spark):
    return spark.createDataFrame([
        (1, dt.date(2024, 1, 9), "Blue #1", d("-5.00"), "B"), (2, dt.date(2024, 1, 3), "Acme", d("-1.00"), "B"),
        (3, dt.date(2024, 1, 2), "Blue #2", d("2.00"), "A"), (4, dt.date(2024, 1, 1), "#99", d("3.00"), "A")],
        "ord BIGINT, date DATE, description STRING, amount DECIMAL(18,2), account STRING")


def test_review_tables_and_round_trip(spark, queue):
    prefills = spark.createDataFrame([(1, "STR", "S1", ""), (3, "STR", "S1", ""), (2, "LTR", "", "HOA")],
                                     "ord BIGINT, category STRING, property STRING, expense_type STRING")
    vendors = review.vendor_table(queue, prefills)
    assert rows(vendors, "vendor_ord", "vendor", "count", "total_amount", "sample_description", "accounts", "category", "property") == [
        (0, "blue", 2, d("7.00"), "Blue #1", "A, B", "STR", "S1"), (1, "acme", 1, d("1.00"), "Acme", "B", "LTR", ""),
        (2, "(unknown)", 1, d("3.00"), "#99", "A", "", "")]
    assert len(review.vendor_sheet(vendors).columns) == 10
    table = review.transaction_table(queue, year=2024, prefills=prefills)
    assert rows(table, "row_id", "ord", "vendor", "category") == [
        ("2024-0001", 3, "blue", "STR"), ("2024-0002", 1, "blue", "STR"), ("2024-0003", 2, "acme", "LTR"), ("2024-0004", 4, "(unknown)", "")]
    assert len(review.transaction_sheet(table).columns) == 10
    assert one(review.prefill_count(table)) == (4, 3)
    typed_vendors = spark.createDataFrame([(1, "blue ", 2, "STR", "S1", ""), (2, "blue", 2, " LTR ", "", "HOA"), (3, "acme", 1, " ", "", "")],
                                          "row_no INT, vendor STRING, count BIGINT, category STRING, property STRING, expense_type STRING")
    typed_rows = spark.createDataFrame([(1, "2024-0002", "Personal", "", ""), (2, "2024-0004", "STR", "S2", "")],
                                       "row_no INT, row_id STRING, category STRING, property STRING, expense_type STRING")
    resolved, vm = pipeline.apply_review(table, learning.empty_map(table), typed_vendors, typed_rows, year=2024)
    assert rows(resolved, "ord", "category", "property", "expense_type", "source") == [
        (1, "Personal", "", "", "review_override"), (3, "LTR", "", "HOA", "review_vendor"), (4, "STR", "S2", "", "review_override")]
    assert rows(vm, "vendor", "category", "occurrences") == [("blue", "LTR", 2)]


def test_consensus_needs_full_agreement(spark, queue):
    split = spark.createDataFrame([(1, "STR", "S1", ""), (3, "STR", "S2", "")], "ord BIGINT, category STRING, property STRING, expense_type STRING")
    assert rows(review.prefill_consensus(queue, split)) == []


WORKSHEET = "date STRING, cost STRING, source STRING, type STRING, description STRING"


def test_worksheet(spark):
    sheet = spark.createDataFrame([
        ("1/5/24", "$10.00", "x", "Elm", "Cleaning"), ("", "8", "x", "All Cottages", "Odd"), ("1/5/23", "9", "x", "Elm", "HOA"),
        ("1/5/24", "", "x", "Elm", "HOA"), ("1/5/24", "4.00", "x", "Garage", "HOA"), ("1/5/24", "5", "x", "Boat", "HOA")], WORKSHEET)
    c = worksheet.classify(sheet, year=2024, rules=worksheet.Rules({"elm": "S1"}, ("garage",), ("all cottages",), {"garage": ("STR - Split", "other")}, (("cleaning", "Housekeeping"), ("hoa", "Dues"))))
    assert rows(worksheet.to_items(c, ["S1", "S2"])) == sorted([
        ("S1", "Housekeeping", d("10.0000000000")), ("S1", "other", d("4.0000000000")), ("S2", "other", d("4.0000000000")),
        ("S1", "other", d("2.0000000000")), ("S2", "other", d("2.0000000000"))], key=repr)
    assert rows(worksheet.unmapped_descriptions(c)) == [("Odd", 1)]
    assert one(worksheet.counters(c)) == (6, 2, 2)


ITEM = "property STRING, template_category STRING, amount DECIMAL(28,10)"


def test_rollup_signs_and_drops(spark):
    items = spark.createDataFrame([("S1", "HOA", d("-5")), ("S1", "HOA", d("2")), ("", "HOA", d("1")), ("S1", " ", d("1")), ("S1", "HOA", None)], ITEM)
    assert one(rollup.rollup(items), "amount")[0] == d("7")
    assert one(rollup.rollup(items, sign="net"), "amount")[0] == d("-3")
    assert rollup.dropped_items(items).count() == 3


def test_split_adds_back(spark):
    tagged = spark.createDataFrame([(1, "LTR - Split", "", d("-100.00"), ""), (2, "LTR", "L2", d("7.00"), None), (3, "LTR", "", d("9.00"), "HOA")],
                                   "id INT, category STRING, property STRING, amount DECIMAL(18,2), expense_type STRING")
    items = rollup.tagged_items(tagged, "LTR", ["L1", "L2", "L3"])
    assert rows(rollup.rollup(items)) == sorted([("L1", "other", d("33.3333333333")), ("L2", "other", d("40.3333333333")), ("L3", "other", d("33.3333333333"))], key=repr)
    shares = spark.createDataFrame([(1, d("33.3333333333"))] * 3, "source_id INT, amount DECIMAL(28,10)")
    original = tagged.select(F.col("id").alias("source_id"), "amount").filter("source_id = 1").withColumn("amount", -F.col("amount"))
    guards.enforce(guards.split_checks(original, shares))
    with pytest.raises(guards.GuardError):
        guards.enforce(guards.split_checks(original, shares.limit(2)))


def test_layouts(spark):
    totals = spark.createDataFrame([("S1", "HOA", d("5")), ("S1", "Travel", d("0")), ("S1", "Nope", d("1"))], ITEM)
    assert rows(rollup.on_fixed_layout(totals, STR_LAYOUT)) == [("S1", 32, "HOA", d("5.0000000000"))]
    layout = spark.createDataFrame([("S1", 3, " hoa "), ("S1", 9, "HOA"), ("S2", 4, "nope")], "sheet STRING, row_no INT, label STRING")
    cells, unmatched = rollup.on_scanned_layout(totals, layout)
    assert rows(cells, "property", "row_no") == [("S1", 3)]
    assert rows(unmatched, "template_category") == [("Nope",)]


def test_template_keeps_formulas(spark):
    cells = spark.createDataFrame([("S1", 1, "C", "Label"), ("S1", 1, "D", "12"), ("S1", 2, "D", "=SUM(D1:D1)"), ("S1", 3, "D", None)],
                                  "sheet STRING, row_no INT, col STRING, value STRING")
    assert rows(rollup.cleared_template(cells), "row_no", "col", "value") == sorted(
        [(1, "C", "Label"), (1, "D", None), (2, "D", "=SUM(D1:D1)"), (3, "D", None)], key=repr)


def test_compare(spark):
    cells = spark.createDataFrame([("S1", 5, "Sales", "100.00"), ("S1", 20, "", "1000"), ("S1", 21, "x", "=SUM(1)"), ("S1", 22, "y", "n/a"), ("S2", 20, "z", "3.00"),
                                   ("S1", 23, "w", None), ("S1", 24, "v", "12 units")], "sheet STRING, row_no INT, label STRING, raw STRING")
    gen = spark.createDataFrame([("S1", 5, 101.5), ("S1", 20, 1019.0)], "sheet STRING, row_no INT, generated DOUBLE")
    got = verify.compare(verify.filed_cells(cells), gen)
    assert rows(got, "sheet", "row_no", "label", "delta", "within_tolerance") == sorted([
        ("S1", 5, "Sales", 1.5, False), ("S1", 20, "Row 20", 19.0, True), ("S2", 20, "z", -3.0, True)], key=repr)
    assert one(verify.summary(got), "matched", "total") == (2, 3)
    text = [r[0] for r in verify.report_lines(got).orderBy("section", "sheet", "row_no").select("line").collect()]
    assert text[2] == "| S1 | 5 | Sales | 100.00 | 101.50 | +1.50 | **NO** |" and text[-1] == "**2/3 cells within tolerance (66.7%)**"
    assert one(verify.summary(got.limit(0)), "matched", "total", "percent") == (0, 0, 0.0)


def test_duplicates(spark):
    txns = spark.createDataFrame([(1, DAY, d("1"), " Ab "), (2, DAY, d("1"), "ab"), (3, DAY, d("2"), "ab")], "ord INT, date DATE, amount DECIMAL(18,2), description STRING")
    assert rows(guards.duplicate_groups(txns), "copies", "first_ord", "last_ord") == [(2, 1, 2)]
    assert rows(guards.duplicate_members(txns), "ord") == [(1,), (2,)]
    with pytest.raises(guards.GuardError):
        guards.enforce_empty(guards.duplicate_groups(txns))


def test_platform(spark):
    total = lambda v: spark.createDataFrame([(d(v),)], "total DECIMAL(18,2)")
    guards.enforce(guards.platform_check(total("1000"), total("1500")))
    with pytest.raises(guards.GuardError):
        guards.enforce(guards.platform_check(total("1000"), total("1500.01")))


def test_routing(spark):
    files = spark.createDataFrame([("/a/b/20240131-STATEMENTS-12-.pdf",), ("/a/pm-1.pdf",), ("/pm-x/other.pdf",), ("Owner  Packet.pdf",)], "path STRING")
    rules = (("statements-12", "checking"), ("^pm-", "report"), (r"owner\s*packet", "report"), ("never", "card"))
    assert rows(documents.route_files(files, rules), "name", "doc_type") == sorted([
        ("20240131-STATEMENTS-12-.pdf", "checking"), ("pm-1.pdf", "report"), ("other.pdf", "unknown"), ("Owner  Packet.pdf", "report")], key=repr)
    assert rows(documents.count_by_type(files, rules), "doc_type", "files") == [("card", 0), ("checking", 1), ("report", 2), ("unknown", 1)]


def test_pages(spark):
    pages = spark.createDataFrame([(1, 2, "b"), (1, 1, "a\na"), (1, 3, None), (2, 1, "  x \n")], "doc_id INT, page_no INT, text STRING")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id INT")
    assert rows(documents.full_text(pages)) == [(1, "a\na\nb\n"), (2, "  x \n")]
    assert rows(documents.needs_ocr(docs, pages), "doc_id") == [(1,), (2,), (3,)]
    assert documents.page_lines(pages).count() == 5


def test_tabs(spark):
    tabs = spark.createDataFrame([("A", 1, "2024 Earnings"), ("A", 2, "'24 earnings"), ("B", 1, " 2024 EARNINGS "), ("C", 1, "notes")], "property STRING, position INT, title STRING")
    assert rows(documents.pick_tab(tabs, 2024)) == [("A", "'24 earnings"), ("B", " 2024 EARNINGS "), ("C", None)]


def test_earnings_and_prior_sheets(spark):
    raw = spark.createDataFrame([("S1", ["1/2", "1/5/24", " $1,200.00 ", "web "]), ("S1", ["1/2", "x", "cancelled"]), ("S1", [" ", "", " "]), ("S1", ["1/1", "2"])],
                                "property STRING, cells ARRAY<STRING>")
    assert one(tables.earnings_by_position(raw, year=2023), "property", "stay_start", "stay_end", "platform", "net_payout") == (
        "S1", dt.date(2023, 1, 2), dt.date(2024, 1, 5), "web", d("1200.00"))
    assert tables.earnings_by_header({"S1": spark.createDataFrame([("1",)], "x STRING")}) is None
    assert tables.prior_entries([spark.createDataFrame([("1",)], "Date STRING")]) is None
    assert tables.find_column(["Net", "net_payout"], ("net_payout", "net")) == "net_payout"


def test_interest(spark):
    nested = spark.createDataFrame([({2024: {"S1": d("5.00"), "L1": d("7.00")}, 2023: {"S1": d("1.00")}},)], "by_year MAP<INT, MAP<STRING, DECIMAL(18,2)>>")
    got = tables.interest_by_year(nested, year=2024)
    assert rows(rollup.interest_items(got, year=2024, members=["L1"])) == [("L1", "Interest expense", d("-7.0000000000"))]
    assert tables.interest_by_year(nested, year=2020).count() == 0


def test_vendor_map_is_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "map")
    assert tables.load_vendor_map(spark, path).count() == 0
    sinks.save_vendor_map(spark.createDataFrame([("b", "STR", 0.9, 1, [2023], False, "", "", "r"), ("a", "LTR", 0.9, 1, [2023], False, "", "", "r")], VENDOR_MAP), path)
    loaded = tables.load_vendor_map(spark, path)
    new = spark.createDataFrame([("B", "STR", "", "", 2024, 1)], REVIEW)
    sinks.save_vendor_map(learning.learn_from_reviews(loaded, new), path)
    assert rows(tables.load_vendor_map(spark, path), "vendor", "occurrences", "learned_from") == [("a", 1, [2023]), ("b", 2, [2023, 2024])]


def test_text_of_many_pages(spark):
    pages = spark.range(3000).selectExpr("id % 2 AS doc_id", "CAST((id * 7919) % 3000 AS INT) AS page_no", "CAST((id * 7919) % 3000 AS STRING) AS text").filter("page_no <> 40")
    got = {r["doc_id"]: r["text"].split("\n") for r in documents.full_text(pages).collect()}
    assert sorted(map(int, got[0] + got[1])) == [k for k in range(3000) if k != 40] and all(list(map(int, t)) == sorted(map(int, t)) for t in got.values())


def test_vendor_map_stores_changes_only(spark, tmp_path):
    path = str(tmp_path / "map")
    entry = lambda v, n: (v, "STR", 0.9, n, [2023, 2024], False, "", None, "r")
    state = {f"v{k:03d}": 1 for k in range(300)}
    sizes, want_sizes = [], []
    for step in range(12):
        if step:
            changed = [f"v{(17 * step + k) % 300:03d}" for k in range(10)] + [f"new{step}"]
            for v in changed:
                state[v] = state.get(v, 0) + 1
            gone = state.pop(f"v{299 - step:03d}", None)
            want_sizes.append(len(state) if step == 9 else len(set(changed) & set(state)) + (gone is not None))
        sinks.save_vendor_map(spark.createDataFrame([entry(*x) for x in state.items()], VENDOR_MAP), path)
        assert {r["vendor"]: r["occurrences"] for r in tables.load_vendor_map(spark, path).collect()} == state
        name = tables.map_changes(spark, path)[-1][1]
        stored = [r["vendor"] for f in sorted((tmp_path / "map" / "versions" / name).glob("part-*.parquet")) for r in spark.read.parquet(str(f)).collect()]
        assert stored == sorted(stored)
        sizes.append(len(stored))
    assert sizes == [300, *want_sizes]
    assert tables.load_vendor_map(spark, path).columns == spark.createDataFrame([], VENDOR_MAP).columns


def test_detail_replaces_only_its_properties(spark, tmp_path):
    path = str(tmp_path / "detail")
    make = lambda p, v: spark.createDataFrame([(p, "2024-01-01", v)], "property STRING, date STRING, notes STRING")
    sinks.write_detail(make("L1", "old").unionByName(make("L2", "keep")), path)
    sinks.write_detail(make("L1", "new"), path)
    assert rows(spark.read.parquet(path), "property", "notes") == [("L1", "new"), ("L2", "keep")]


def test_review_rows_prefer_the_year(spark, tmp_path):
    old = spark.createDataFrame([("old",)], "v STRING")
    sinks.write_stage(old, f"{tmp_path}/vendors")
    assert rows(tables.read_review_rows(spark, str(tmp_path), "vendors", 2024)) == [("old",)]
    sinks.write_stage(old.withColumn("v", F.lit("new")), f"{tmp_path}/vendors_2024")
    assert rows(tables.read_review_rows(spark, str(tmp_path), "vendors", 2024)) == [("new",)]
    assert tables.read_review_rows(spark, str(tmp_path), "other", 2024) is None


def test_pipeline(spark):
    docs = spark.createDataFrame([(1, "A", CHECKING)], "doc_id INT, account STRING, text STRING")
    cards = spark.createDataFrame([(7, "CC", "New Balance $1.00\nOpening/Closing Date 01/07/24 - 02/06/24\n01/09 Shop 5.00\n01/10 Payment Thank You -9.00\n")],
                                  "doc_id INT, account STRING, text STRING")
    business = pipeline.Business(["S1"], ["L1"], cards=("4001",), payout_patterns=("orig co",), card_sign=-1)
    with pytest.raises(guards.GuardError):
        pipeline.ingest(docs, cards, business)
    ledger = pipeline.ingest(docs, cards, business, strict=False)
    assert ledger.count() == 9 and ledger.select("txn_id").distinct().count() == 9
    vm = spark.createDataFrame([("shop", "STR", 0.9, 1, [2023], False, "S1", "Supplies", "r")], VENDOR_MAP)
    tagged, skipped = pipeline.tag(ledger, vm, business)
    assert rows(skipped, "kind") == [("card",), ("checking",)]
    assert rows(tagged.filter("source = 'auto'"), "description", "amount", "property") == [("Shop", d("-5.00"), "S1")]
    none = tagged.filter("source = 'none'")
    earnings = tables.empty_earnings(spark)
    interest = spark.createDataFrame([(2024, "L1", d("7.00"))], "year INT, property STRING, amount DECIMAL(18,2)")
    cash = spark.createDataFrame([("L1 St", "Jan 2024 to Dec 2024", "expense", "Water", d("3.00"))],
                                 "property STRING, period STRING, side STRING, category STRING, amount DECIMAL(18,2)")
    business = pipeline.Business(["S1"], ["L1"], aliases={"L1 St": "L1"}, cashflow_labels={"Water": "Services"})
    st, lt = pipeline.build(tagged.filter("source = 'auto'"), none, business, year=2024, earnings=earnings, interest=interest, cashflow=cash,
                            double_counted=ledger.filter("description = 'Plain'"))
    assert rows(st) == [("S1", "Supplies", d("5.0000000000"))]
    assert rows(lt) == [("L1", "Interest expense", d("7.0000000000")), ("L1", "Services", d("3.0000000000"))]
    filed = spark.createDataFrame([("S1", 29, "Supplies", "5.00")], "sheet STRING, row_no INT, label STRING, raw STRING")
    assert one(pipeline.check_filing(filed, st), "within_tolerance") == (True,)
