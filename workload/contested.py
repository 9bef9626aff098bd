"""Linkage where many rows compete, against the sequential rule written as recursive SQL; sinks written and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import guards, matching
from ledgerloom.operators.cashflow import CashFlowPages
from ledgerloom.operators.layout import OwnerStatements
from ledgerloom.plans import pipeline
from ledgerloom.scale import durable, shared_folder
from ledgerloom.sources import sinks, tables
from workload import maps, render, rules
from workload.adapters import LTR_PROPERTIES, PAYER, PAYOUT, STR_PROPERTIES, Source
from workload.queries import _CF_LABEL, CASHFLOW_SQL, DOUBLE_SQL, LAYOUT_SQL, double_counted
from workload.registry import ORACLES, QUERIES, query

#: rows per group of rows that can compete; half of them seek, half are offered
GROUP = 40


LEDGER_ROWS = f"SELECT txn_id, txn_id // {GROUP} AS g, txn_id % {GROUP} AS k, description FROM <<ledger>> AS x"


def sequential_sql(seekers: str, offers: str, fits: str, score: str, rows: str = LEDGER_ROWS, scores: str = "", scored: str = "") -> str:
    return rules.sequential_sql(seekers, offers, fits, score, rows, scores, scored).replace("AS MATERIALIZED (", "AS (")


def grouped(s: Source) -> DataFrame:
    return s.adapter("ledger").select(
        "txn_id", F.floor(F.col("txn_id") / GROUP).alias("g"), (F.col("txn_id") % GROUP).alias("k"), "description"
    )


def day(number: Column) -> Column:
    return F.date_add(F.lit("1990-01-01").cast("date"), number.cast("int"))


seeks, offered = "txn_id % 2 = 0", "txn_id % 2 = 1"


# Payments of customers: different texts that share words in another order.
PAYMENTS = "SELECT c_custkey AS id, c_mktsegment AS segment, n_name AS nation FROM <<customer>> AS c JOIN <<nation>> AS n ON c_nationkey = n_nationkey"
PAYMENT_ROWS = f"SELECT *, id // {GROUP} AS g, id % {GROUP} AS k FROM ({PAYMENTS}) AS p"
BANK_TEXT, SHEET_TEXT = "segment || ' ' || nation || ' ' || CAST(id AS STRING)", "nation || ' *' || CAST(id AS STRING) || ' ' || segment"

# The longest common substring, the first in a and then in b, and again left and right of it; lengths and places in one number.
_LONGEST = """list_max(list_transform(list_filter(range(0, length(a) * length(a)),
      lambda x: x // length(a) + x % length(a) + 1 <= length(a) AND contains(b, substr(a, x // length(a) + 1, x % length(a) + 1))),
      lambda x: (x % length(a) + 1) * 1000 - (x // length(a) + 1)))"""
BLOCKS_SQL = f"""
parts AS (
  SELECT q_id, w_id, a, b, CAST(0 AS BIGINT) AS matched FROM q JOIN w USING (g) WHERE abs(size - cost) <= 0.5
  UNION ALL
  SELECT q_id, w_id, CASE side WHEN 0 THEN substr(a, 1, i - 1) ELSE substr(a, i + n) END,
    CASE side WHEN 0 THEN substr(b, 1, strpos(b, substr(a, i, n)) - 1) ELSE substr(b, strpos(b, substr(a, i, n)) + n) END, CASE side WHEN 0 THEN n ELSE 0 END
  FROM (SELECT *, (best + 999) // 1000 AS n, (best + 999) // 1000 * 1000 - best AS i FROM (SELECT *, {_LONGEST} AS best FROM parts) AS x WHERE best IS NOT NULL) AS y, (VALUES (0), (1)) AS v(side)
),
ratios AS (SELECT q_id, w_id, sum(matched) AS matched FROM parts GROUP BY q_id, w_id),"""


@query("match_date_amount_contested", sequential_sql(
    f"SELECT id AS q_id, g, 100 + k % 5 * 0.25 AS size, lower({BANK_TEXT}) AS a FROM l WHERE id % 2 = 0",
    f"SELECT id AS w_id, g, 100 + k % 7 * 0.25 AS cost, lower({SHEET_TEXT}) AS b FROM l WHERE id % 2 = 1",
    "abs(size - cost) <= 0.5", "2.0::DOUBLE * matched / (length(a) + length(b))", PAYMENT_ROWS, BLOCKS_SQL, "JOIN ratios USING (q_id, w_id)"))
def _(s: Source) -> DataFrame:
    """Whole texts, compared by matching blocks."""
    rows = s.sql(PAYMENTS).select("*", F.floor(F.col("id") / GROUP).alias("g"), (F.col("id") % GROUP).alias("k"))
    return matching.match_date_amount(*payments(rows, "id % 2 = 0", lambda m: 100 + F.col("k") % m * 0.25))


def payments(rows: DataFrame, seeking: str, money: Callable[[int], Column]) -> tuple[DataFrame, DataFrame]:
    """Bank rows and worksheet rows of one day per ``g``."""
    side = lambda keep, m, amount, text, id, order, name: rows.filter(keep).select(
        F.col("id").alias(id), F.col("id").alias(order), day(F.col("g")).alias("date"), money(m).cast("decimal(18,2)").alias(amount), F.expr(text).alias(name))
    return side(seeking, 5, "amount", BANK_TEXT, "q_id", "q_ord", "description"), side(f"NOT ({seeking})", 7, "cost", SHEET_TEXT, "w_id", "w_ord", "source")


_CROWD = "CASE WHEN id % 3 < 2 THEN -1 ELSE id // 40 END"


CROWDED_SQL = sequential_sql(
    f"SELECT id AS q_id, g, lower({BANK_TEXT}) AS a FROM l WHERE id // 3 % 7 = 0",
    f"SELECT id AS w_id, g, lower({SHEET_TEXT}) AS b FROM l WHERE id // 3 % 7 > 0",
    "true", "1 - CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b))", f"SELECT *, {_CROWD} AS g FROM ({PAYMENTS}) AS p")


def crowded(s: Source) -> tuple[DataFrame, DataFrame]:
    """Two thirds of all rows, with different texts, on one date and amount."""
    crowd = F.when(F.col("id") % 3 < 2, F.lit(-1)).otherwise(F.floor(F.col("id") / 40)).cast("bigint")
    return payments(s.sql(PAYMENTS).select("*", crowd.alias("g")), "floor(id / 3) % 7 = 0", lambda m: F.lit(100))


@query("match_date_amount_crowded", CROWDED_SQL)
def _(s: Source) -> DataFrame:
    """The crowded date's pairs are made in bands of their upper bounds."""
    return matching.match_date_amount(*crowded(s), similarity="edit", all_pairs=10_000)


@query("match_date_amount_component", CROWDED_SQL)
def _(s: Source) -> DataFrame:
    """All pairs while they are few; one component, settled in rounds beyond ``matching.COMPONENT_ROWS``."""
    return matching.match_date_amount(*crowded(s), similarity="edit")


@query("match_edit_contested", sequential_sql(
    "SELECT txn_id AS q_id, g, 100 + k % 5 * 0.25 AS size, lower(description) AS a FROM l WHERE txn_id % 2 = 0",
    "SELECT txn_id AS w_id, g, 100 + k % 7 * 0.25 AS cost, lower(description) AS b FROM l WHERE txn_id % 2 = 1",
    "abs(size - cost) <= 0.5", "1 - CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b))"))
def _(s: Source) -> DataFrame:
    rows = grouped(s)
    money = lambda m: (F.lit(100) + F.col("k") % m * F.lit(0.25)).cast("decimal(18,2)")
    q = rows.filter(seeks).select(
        F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), day(F.col("g")).alias("date"), money(5).alias("amount"), "description")
    w = rows.filter(offered).select(
        F.col("txn_id").alias("w_id"), F.col("txn_id").alias("w_ord"), day(F.col("g")).alias("date"), money(7).alias("cost"), F.col("description").alias("source"))
    return matching.match_date_amount(q, w, similarity="edit")


# Words that both sides share, and one word of each side that has no letter in common with the other side's.
SHARED = "CASE k % 3 WHEN 0 THEN 'acme corp' WHEN 1 THEN 'blue hut' ELSE 'ox quay' END"
_FULL = "(length(f) + 1 + {0})"
_BETWEEN = f"greatest(1 - (own + theirs) / CAST({_FULL.format('own')} + {_FULL.format('theirs')} AS DOUBLE), 2.0::DOUBLE * length(f) / (length(f) + {_FULL.format('least(own, theirs)')}))"


@query("match_fuzzy_between", sequential_sql(
    f"SELECT txn_id AS q_id, g, k % 6 AS day, {SHARED} AS f, 1 + k % 7 AS own FROM l WHERE txn_id % 2 = 0",
    f"SELECT txn_id AS w_id, g, k % 6 AS paid, {SHARED} AS h, 1 + k % 9 AS theirs FROM l WHERE txn_id % 2 = 1",
    f"f = h AND abs(day - paid) <= 3 AND {_BETWEEN} >= 0.72", _BETWEEN))
def _(s: Source) -> DataFrame:
    """Scores between the threshold and 1 decide who gets whom."""
    rows = grouped(s).select("txn_id", day(F.col("k") % 6).alias("date"), F.col("g").cast("decimal(18,2)").alias("amount"), "k", F.expr(SHARED).alias("f"))
    own = lambda letter, m: F.concat("f", F.lit(" "), F.repeat(F.lit(letter), (1 + F.col("k") % m).cast("int"))).alias("description")
    q = rows.filter(seeks).select(F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), "date", "amount", own("i", 7))
    w = rows.filter(offered).select(F.col("txn_id").alias("w_id"), F.col("txn_id").alias("w_ord"), "date", "amount", own("z", 9))
    return matching.match_fuzzy(q, w).select("q_id", "w_id")


# Words of one family contain each other (score 1); words of different families share no word and hardly a letter.
FAMILY = "CASE k % 5 WHEN 0 THEN 'acme' WHEN 1 THEN 'acme corp' WHEN 2 THEN 'blue' WHEN 3 THEN 'blue hut' ELSE 'zzyx' END"


@query("match_fuzzy_contested", sequential_sql(
    f"SELECT txn_id AS q_id, g, k % 6 AS day, left({FAMILY}, 4) AS a FROM l WHERE txn_id % 2 = 0",
    f"SELECT txn_id AS w_id, g, k % 6 AS paid, left({FAMILY}, 4) AS b FROM l WHERE txn_id % 2 = 1",
    "a = b AND abs(day - paid) <= 3", "0"))
def _(s: Source) -> DataFrame:
    rows = grouped(s).select("txn_id", day(F.col("k") % 6).alias("date"), F.col("g").cast("decimal(18,2)").alias("amount"), F.expr(FAMILY).alias("description"))
    q = rows.filter(seeks).select(F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), "date", "amount", "description")
    w = rows.filter(offered).select(F.col("txn_id").alias("w_id"), F.col("txn_id").alias("w_ord"), "date", "amount", "description")
    return matching.match_fuzzy(q, w).select("q_id", "w_id")


@query("double_count_contested", sequential_sql(
    "SELECT txn_id AS q_id, g, k % 9 AS day, k % 3 * 0.4 AS a FROM l WHERE txn_id % 2 = 0",
    "SELECT txn_id AS w_id, g, k % 7 AS paid, k % 3 * 0.4 AS b FROM l WHERE txn_id % 2 = 1",
    "abs(day - paid) <= 5 AND abs(a - b) <= 0.5", "0"))
def _(s: Source) -> DataFrame:
    money = (F.col("g") * 10 + 1 + F.col("k") % 3 * F.lit(0.4)).cast("decimal(18,2)")
    rows = grouped(s)
    deposits = rows.filter(seeks).select(
        F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), day(F.col("k") % 9).alias("date"), money.alias("amount"), F.lit(f"ACH {PAYER} payout").alias("description"))
    payouts = rows.filter(offered).select(
        F.col("txn_id").alias("ord"), F.col("txn_id").cast("string").alias("reference"), day(F.col("k") % 7).alias("date"), money.alias("cash_out"), F.lit(PAYOUT).alias("category"))
    pairs = matching.double_counts(deposits, payouts, payer=PAYER)
    return pairs.select("q_id", F.col("reference").cast("long").alias("w_id"))


@query("double_count_strict", DOUBLE_SQL)
def _(s: Source) -> DataFrame:
    """Strict mode: any double count is an error, which carries all of them."""
    pairs = double_counted(s)[1]
    try:
        guards.enforce_empty(pairs)
    except guards.GuardError as error:
        return error.failed
    return pairs


@query("duplicates_strict", ORACLES["duplicates"])
def _(s: Source) -> DataFrame:
    """Strict mode: any group of duplicates is an error, which carries all of them."""
    groups = guards.duplicate_groups(s.adapter("ledger_lines"))
    try:
        guards.enforce_empty(groups)
    except guards.GuardError as error:
        return error.failed
    return groups


@query("pm_layout_errors", f"""
SELECT doc_id, 'no property sections' AS error FROM (SELECT DISTINCT doc_id FROM ({LAYOUT_SQL}) AS x) AS d WHERE doc_id % 2 = 0
UNION ALL SELECT -doc_id, 'no extractable text' FROM (SELECT DISTINCT doc_id FROM ({LAYOUT_SQL}) AS x) AS d""")
def _(s: Source) -> DataFrame:
    """Owner statements whose property headings are illegible, and documents without any words."""
    words = render.layout_words(s.adapter("ledger"))
    spoilt = durable(words.withColumn("text", F.when((F.col("doc_id") % 2 == 0) & (F.col("text") == "SW"), "??").otherwise(F.col("text"))))
    listed = words.select("doc_id").distinct()
    return OwnerStatements(spoilt, render.PROPERTY_RULES, "SW ").errors(listed.unionByName(listed.select((-F.col("doc_id")).alias("doc_id"))))


@query("pm_layout_long", ORACLES["pm_layout"])
def _(s: Source) -> DataFrame:
    """The way of very long documents: states are carried from page to page, no task holds a document."""
    statements = OwnerStatements(durable(render.layout_words(s.adapter("ledger"))), render.PROPERTY_RULES, "SW ", spread=True)
    return statements.transactions().select(
        "doc_id", "property", "date", "payee", "txn_type", "reference", "description", "cash_in", "cash_out", "balance", "unit", "category")


@query("cashflow_long", ORACLES["cashflow"])
def _(s: Source) -> DataFrame:
    """The same for cash-flow pages."""
    pages = CashFlowPages(durable(render.cashflow_pages(s.sql(CASHFLOW_SQL))), (PAYER,), spread=True)
    return pages.summaries().select("doc_id", "property", "period", "side", "category", "amount")


@query("build_year", f"""
SELECT property, template_category, CAST(round(sum(abs(amount)), 2) AS DOUBLE) AS amount FROM (
  SELECT CASE property WHEN 'L1' THEN 'L1' ELSE property || ' Elm St, IA' END AS property, {_CF_LABEL} AS template_category, amount
  FROM ({CASHFLOW_SQL}) AS c WHERE year = 1998 AND {_CF_LABEL} IS NOT NULL
  UNION ALL
  SELECT 'L1', 'Deposits', amount FROM <<deposits>> AS d WHERE q_id NOT IN (SELECT q_id FROM ({DOUBLE_SQL}) AS x)
) AS i GROUP BY property, template_category""")
def _(s: Source) -> DataFrame:
    """Long-term totals of a whole build: parsed cash-flow pages, and deposits without those that repeat owner payouts."""
    deposits, pm_txns = durable(s.adapter("deposits")), durable(s.adapter("pm_txn"))
    booked = deposits.select("date", "description", "amount", F.lit("LTR").alias("category"), F.lit("L1").alias("property"), F.lit("Deposits").alias("expense_type"))
    business = pipeline.Business(
        STR_PROPERTIES, LTR_PROPERTIES, pm_payer=PAYER, pm_labels=maps.PM_LABELS, cashflow_labels=maps.CASHFLOW_LABELS, aliases={"L1 Elm St, IA": "L1"})
    built = pipeline.build_year(
        booked, booked.limit(0), business, year=1998, earnings=tables.empty_earnings(s.spark),
        interest=s.spark.createDataFrame([], "year INT, property STRING, amount DECIMAL(18,2)"), deposits=deposits,
        pm_txns=pm_txns.withColumn("description", F.col("reference")), cashflow_pages=durable(render.cashflow_pages(s.sql(CASHFLOW_SQL))))
    return built.ltr_totals


# ---------------------------------------------------------------- sinks


def place(s: Source, name: str) -> str:
    return f"{shared_folder(s.spark)}/{name}-{uuid.uuid4().hex}"


@query("stage_tables", "SELECT txn_id, CAST(date AS STRING) AS date, CAST(amount AS DOUBLE) AS amount, account FROM <<ledger>> AS l")
def _(s: Source) -> DataFrame:
    """A year's stages stored, stored again, and read with their schema; a stage that has not run is empty."""
    root = place(s, "stages") + "/{year}"
    rows = s.adapter("ledger").select("txn_id", "date", "amount", "account")
    pipeline.store_year(root, 1998, ledger=rows.filter("txn_id % 2 = 0"))
    pipeline.store_year(root, 1998, ledger=rows)
    schema = "txn_id LONG, date DATE, amount DECIMAL(18,2), account STRING"
    stored = tables.read_stage(s.spark, tables.stage_path(root, "ledger", 1998), schema)
    return stored.unionByName(tables.read_stage(s.spark, tables.stage_path(root, "ledger", 1999), schema))


@query("appended_rows", "SELECT txn_id, account FROM <<ledger>> AS l")
def _(s: Source) -> DataFrame:
    path, rows = place(s, "appended"), s.adapter("ledger").select("txn_id", "account")
    for part in (0, 1, 2):
        sinks.append_rows(rows.filter(F.col("txn_id") % 3 == part), path)
    return s.spark.read.parquet(path)


def review_sink(name: str, order: list[str]) -> None:
    @query(f"{name}_sink", ORACLES[name])
    def _(s: Source) -> DataFrame:
        """Written for people and read back: the year's own table is preferred to the shared one."""
        root = place(s, "review")
        rows = durable(QUERIES[name](s.spark, s.folder))
        sinks.write_review(rows.limit(0), f"{root}/{name}", order=order)
        sinks.write_review(rows, f"{root}/{name}_1998", order=order)
        own = tables.read_review_rows(s.spark, root, name, 1998)
        return own.unionByName(tables.read_review_rows(s.spark, root, name, 1997))


review_sink("review_vendors", ["vendor"])
review_sink("review_transactions", ["row_id"])


@query("pm_detail_sink", ORACLES["pm_detail"])
def _(s: Source) -> DataFrame:
    """Audit rows by property; writing some properties again replaces those alone."""
    path = place(s, "detail")
    rows = durable(QUERIES["pm_detail"](s.spark, s.folder))
    first = rows.agg(F.min("property")).first()[0]
    sinks.write_detail(rows.withColumn("notes", F.when(F.col("property") == first, "old").otherwise(F.col("notes"))), path)
    sinks.write_detail(rows.filter(F.col("property") == first), path)
    return s.spark.read.parquet(path).select(*rows.columns)


@query("compare_report_sink", f"SELECT line, count(*) AS n FROM ({ORACLES['compare_report']}) AS r GROUP BY line")
def _(s: Source) -> DataFrame:
    path = place(s, "report")
    sinks.write_report(QUERIES["compare_report"](s.spark, s.folder), path)
    return s.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))
