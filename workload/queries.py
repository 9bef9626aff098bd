"""One registered query per operator family."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions.money import MONEY, TOTAL, cash_amount
from ledgerloom.functions.text import lookup, map_status, vendor_key
from ledgerloom.operators import categorize, guards, learning, matching, review, rollup, verify, worksheet
from ledgerloom.operators import statement as generic
from ledgerloom.operators.card import CardStatements
from ledgerloom.operators.cashflow import CashFlowPages
from ledgerloom.operators.checking import CheckingStatements
from ledgerloom.operators.layout import OwnerStatements
from ledgerloom.operators import pm_text
from ledgerloom.plans import pipeline
from ledgerloom.scale import durable, shared_folder
from ledgerloom.sources import documents, sinks, tables
from workload import maps, render, rules
from workload.adapters import CARDS, LTR_PROPERTIES, PAYER, STR_PROPERTIES, Source
from workload.registry import query

SPLIT_YEAR = 1998
PAYOUT_PATTERNS = ("furniture kenya", "household peru")
CARD_PATTERNS = ("building iran",)
ALIASES = {"L1": "L1 Street", "L3": "L3 Avenue"}

# ---------------------------------------------------------------- SQL pieces shared by the oracles


def key_sql(c: str) -> str:
    prefixes = "|".join(fixed.BANK_PREFIXES)
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
        f"trim(regexp_replace(trim(lower({c})), '^({prefixes})', '')),"
        f" '#\\s*\\w+', '', 'g'), '\\*\\s*\\w+', '', 'g'), '\\s+\\d+\\b', '', 'g'), '[.,;:!?]', '', 'g'), '\\s+', ' ', 'g'))"
    )


def case_sql(c: str, mapping: dict) -> str:
    quoted = {k.replace("'", "''"): v for k, v in mapping.items() if v is not None}
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in quoted.items()) + " END"


KEYED = f"SELECT *, {key_sql('description')} AS vendor FROM <<ledger>> AS l"
MAP_SQL = f"""
SELECT vendor, arg_min(category, txn_id) AS category, CAST(0.9 AS DOUBLE) AS confidence,
  CAST(count(*) AS BIGINT) AS occurrences,
  array_to_string(list_sort(list_distinct(list(year(date)))), ',') AS learned_from,
  min(category) <> max(category) AS ambiguous,
  coalesce(arg_max(property, txn_id) FILTER (WHERE property <> ''), '') AS property,
  coalesce(arg_max(expense_type, txn_id) FILTER (WHERE expense_type <> ''), '') AS expense_type,
  'review' AS source
FROM (SELECT *, {key_sql('description')} AS vendor FROM <<decision>> AS d
      WHERE year(date) < {SPLIT_YEAR} AND category NOT IN ('Skip', 'Split', 'STR - Split', 'LTR - Split')) AS k
GROUP BY vendor
"""
TAGGED_SQL = f"""
SELECT k.txn_id, k.date, k.description, k.amount, k.account, k.vendor, coalesce(m.category, '') AS category,
  coalesce(m.confidence, 0.0) AS confidence, coalesce(m.property, '') AS property,
  coalesce(m.expense_type, '') AS expense_type,
  CASE WHEN m.vendor IS NULL THEN 'unknown' WHEN m.ambiguous OR m.confidence < 0.8 OR m.category = '' THEN 'ambiguous'
       ELSE 'auto' END AS source
FROM ({KEYED}) AS k LEFT JOIN ({MAP_SQL}) AS m ON k.vendor = m.vendor
WHERE year(k.date) >= {SPLIT_YEAR} AND NOT (
  CASE WHEN k.account = '1-URGENT' THEN contains(lower(k.description), 'building iran')
       ELSE k.amount > 0 AND (contains(lower(k.description), 'furniture kenya') OR contains(lower(k.description), 'household peru')) END)
"""
QUEUE_SQL = f"""
SELECT t.*, CASE WHEN source = 'unknown' THEN 1000000000000 ELSE 0 END + txn_id AS ord
FROM ({TAGGED_SQL}) AS t WHERE source <> 'auto'
"""
VENDORS_SQL = f"""
SELECT vendor, count(*) AS count, sum(abs(amount)) AS total_amount, arg_min(description, ord) AS sample_description,
  arg_min(amount, ord) AS sample_amount, array_to_string(list_sort(list_distinct(list(account))), ', ') AS accounts,
  min(ord) AS first_ord
FROM (SELECT * REPLACE (CASE WHEN vendor = '' THEN '(unknown)' ELSE vendor END AS vendor) FROM ({QUEUE_SQL}) AS q0) AS q
GROUP BY vendor
"""
TXN_TABLE_SQL = f"""
SELECT q.*, row_number() OVER (ORDER BY v.count DESC, v.first_ord, q.date, q.ord) AS row_no
FROM ({QUEUE_SQL}) AS q JOIN ({VENDORS_SQL}) AS v ON q.vendor = v.vendor
"""
# Prefill labels depend on the vendor's region; rare rows differ, so some vendors agree and some do not.
PREFILL_SQL = """
SELECT txn_id, CASE substr(property, 1, 1) WHEN 'S' THEN 'STR' WHEN 'L' THEN 'LTR' ELSE 'Personal' END AS category,
  CASE substr(property, 1, 1) WHEN 'S' THEN 'S1' ELSE '' END AS property,
  CASE WHEN txn_id % 500 = 0 AND account = '2-HIGH' THEN 'HOA' ELSE '' END AS expense_type
FROM <<decision>> AS d WHERE category <> 'Skip'
"""


def learned_map(s: Source) -> DataFrame:
    """Map learned from the years before the split; a stage table, as in production."""
    reviewed = s.adapter("decision").filter(F.year("date") < SPLIT_YEAR).withColumns(
        {"year": F.year("date"), "seq": F.col("txn_id")}
    )
    return durable(learning.learn_from_reviews(learning.empty_map(reviewed), reviewed))


def tagged_ledger(s: Source) -> DataFrame:
    later = s.adapter("ledger").filter(F.year("date") >= SPLIT_YEAR)
    skip = categorize.skip_rule(
        F.col("amount"), F.col("description"), F.col("account") == "1-URGENT", PAYOUT_PATTERNS, CARD_PATTERNS
    )
    return categorize.categorize(later.filter(~skip), learned_map(s))


def queue(s: Source) -> DataFrame:
    return categorize.review_queue(tagged_ledger(s)).withColumn(
        "ord", F.col("queue_part").cast("bigint") * 1_000_000_000_000 + F.col("txn_id")
    )


def prefills(s: Source, queued: DataFrame) -> DataFrame:
    labels = s.sql(PREFILL_SQL)
    return queued.select("ord", "txn_id").join(labels, "txn_id").drop("txn_id")


# ---------------------------------------------------------------- scalar rules


@query("vendor_key", f"SELECT txn_id, {key_sql('description')} AS vendor FROM <<ledger>> AS l")
def _(s: Source) -> DataFrame:
    return s.adapter("ledger").select("txn_id", vendor_key(F.col("description")).alias("vendor"))


@query("auto_skip", """
SELECT account = '1-URGENT' AS is_card,
  CASE WHEN account = '1-URGENT' THEN contains(lower(description), 'building iran')
       ELSE amount > 0 AND (contains(lower(description), 'furniture kenya') OR contains(lower(description), 'household peru')) END AS skipped,
  count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount
FROM <<ledger>> AS l GROUP BY 1, 2""")
def _(s: Source) -> DataFrame:
    is_card = F.col("account") == "1-URGENT"
    skip = categorize.skip_rule(F.col("amount"), F.col("description"), is_card, PAYOUT_PATTERNS, CARD_PATTERNS)
    return s.adapter("ledger").groupBy(is_card.alias("is_card"), skip.alias("skipped")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


@query("category_map", f"""
SELECT category, {case_sql('category', maps.PM_LABELS)} AS label,
  CASE WHEN {case_sql('category', maps.PM_LABELS)} IS NOT NULL THEN 'mapped'
       WHEN category IN ('Security Deposits', 'Security Deposits Clearing', 'Owner Distributions / S corp Distributions') THEN 'excluded'
       ELSE 'unknown' END AS map_status,
  count(*) AS n, CAST(sum(coalesce(nullif(cash_in, 0), nullif(cash_out, 0), 0)) AS DOUBLE) AS amount
FROM <<pm_txn>> AS p GROUP BY category""")
def _(s: Source) -> DataFrame:
    c = F.col("category")
    return s.adapter("pm_txn").groupBy(
        "category", lookup(c, maps.PM_LABELS).alias("label"), map_status(c, maps.PM_LABELS).alias("map_status")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cash_amount(F.col("cash_in"), F.col("cash_out"))).alias("amount"))


# ---------------------------------------------------------------- learning and categorization


def with_middle(rows: DataFrame) -> DataFrame:
    """Rows with about the middle transaction number. It is stored: found anew, it depends on the order in which parts of the table arrive."""
    middle = durable(rows.agg(F.expr("percentile_approx(txn_id, 0.5)").alias("m")))
    return rows.join(F.broadcast(middle), F.lit(True))


@query("learn_vendor_map", MAP_SQL)
def _(s: Source) -> DataFrame:
    reviewed = s.adapter("decision").filter(F.year("date") < SPLIT_YEAR).withColumns(
        {"year": F.year("date"), "seq": F.col("txn_id")}
    )
    return learning.learn_from_reviews(learning.empty_map(reviewed), reviewed)


@query("learn_in_two_steps", MAP_SQL.replace(f"year(date) < {SPLIT_YEAR}", "TRUE"))
def _(s: Source) -> DataFrame:
    """A map learned from the first half of the rows and extended by the rest equals one pass over all."""
    rows = s.adapter("decision").withColumns({"year": F.year("date"), "seq": F.col("txn_id")})
    # Order of first sight is by transaction number: fold the lower numbers first, whatever their year.
    rows = with_middle(rows)
    early = learning.learn_from_reviews(learning.empty_map(rows), rows.filter("txn_id <= m"))
    return learning.learn_from_reviews(early, rows.filter("txn_id > m"))


@query("categorize_buckets", f"""
SELECT txn_id, vendor, category, confidence, property, expense_type, source FROM ({TAGGED_SQL}) AS t""")
def _(s: Source) -> DataFrame:
    return tagged_ledger(s).select("txn_id", "vendor", "category", "confidence", "property", "expense_type", "source")


@query("bucket_counts", f"""
SELECT b.source, count(t.txn_id) AS rows FROM (VALUES ('auto'), ('ambiguous'), ('unknown')) AS b(source)
LEFT JOIN ({TAGGED_SQL}) AS t ON t.source = b.source GROUP BY b.source""")
def _(s: Source) -> DataFrame:
    return categorize.bucket_counts(tagged_ledger(s))


PM_KEYED_SQL = f"SELECT *, {key_sql('payee')} AS vendor FROM <<pm_txn>> AS p WHERE category <> ''"


@query("learn_from_pm", f"""
SELECT vendor, arg_min(category, ord) AS category, CAST(0.95 AS DOUBLE) AS confidence, CAST(count(*) AS BIGINT) AS occurrences,
  array_to_string(list_sort(list_distinct(list(year(date)))), ',') AS learned_from, min(category) <> max(category) AS ambiguous,
  '' AS property, '' AS expense_type, 'pm_bootstrap' AS source
FROM ({PM_KEYED_SQL}) AS k GROUP BY vendor""")
def _(s: Source) -> DataFrame:
    rows = s.adapter("pm_txn").withColumns({"year": F.year("date"), "seq": F.col("ord")})
    return learning.learn_from_pm(learning.empty_map(rows), rows)


@query("pm_learning_report", f"""
SELECT (SELECT count(*) FROM <<pm_txn>> AS p) AS total_transactions,
  (SELECT count(DISTINCT nullif(category, '')) FROM <<pm_txn>> AS p) AS categories_seen,
  (SELECT count(DISTINCT vendor) FROM ({PM_KEYED_SQL}) AS k) AS vendors_learned""")
def _(s: Source) -> DataFrame:
    rows = s.adapter("pm_txn").withColumns({"year": F.year("date"), "seq": F.col("ord")})
    return learning.pm_learning_report(learning.empty_map(rows), rows)


# ---------------------------------------------------------------- review tables


@query("review_vendors", f"""
SELECT v.vendor, v.count, CAST(v.total_amount AS DOUBLE) AS total_amount, v.sample_description,
  CAST(v.sample_amount AS DOUBLE) AS sample_amount, v.accounts,
  row_number() OVER (ORDER BY v.count DESC, v.first_ord) - 1 AS vendor_ord,
  coalesce(p.category, '') AS category, coalesce(p.property, '') AS property, coalesce(p.expense_type, '') AS expense_type
FROM ({VENDORS_SQL}) AS v LEFT JOIN (
  SELECT vendor, min(f.category) AS category, min(f.property) AS property, min(f.expense_type) AS expense_type
  FROM ({QUEUE_SQL}) AS q JOIN ({PREFILL_SQL}) AS f ON q.txn_id = f.txn_id GROUP BY vendor
  HAVING min(f.category) = max(f.category) AND min(f.property) = max(f.property) AND min(f.expense_type) = max(f.expense_type)
) AS p ON v.vendor = p.vendor""")
def _(s: Source) -> DataFrame:
    queued = durable(queue(s))
    table = review.vendor_table(queued, prefills(s, queued))
    return table.select("vendor", "count", "total_amount", "sample_description", "sample_amount", "accounts",
                        "vendor_ord", "category", "property", "expense_type")


@query("review_transactions", f"""
SELECT '1998-' || lpad(CAST(row_no AS STRING), CAST(greatest(4, length(CAST(row_no AS STRING))) AS INT), '0') AS row_id, CAST(date AS STRING) AS date,
  vendor, description, CAST(amount AS DOUBLE) AS amount, account,
  coalesce(f.category, '') AS category, coalesce(f.property, '') AS property, coalesce(f.expense_type, '') AS expense_type
FROM ({TXN_TABLE_SQL}) AS q LEFT JOIN ({PREFILL_SQL}) AS f ON q.txn_id = f.txn_id""")
def _(s: Source) -> DataFrame:
    queued = durable(queue(s))
    table = review.transaction_table(queued, year=SPLIT_YEAR, prefills=prefills(s, queued))
    return table.select("row_id", "date", "vendor", "description", "amount", "account", "category", "property", "expense_type")


@query("prefill_consensus", f"""
SELECT vendor, min(f.category) AS category, min(f.property) AS property, min(f.expense_type) AS expense_type
FROM ({QUEUE_SQL}) AS q JOIN ({PREFILL_SQL}) AS f ON q.txn_id = f.txn_id GROUP BY vendor
HAVING min(f.category) = max(f.category) AND min(f.property) = max(f.property) AND min(f.expense_type) = max(f.expense_type)""")
def _(s: Source) -> DataFrame:
    queued = durable(queue(s))
    return review.prefill_consensus(queued, prefills(s, queued))


@query("prefill_count", f"""
SELECT count(*) AS txn_count, count(*) FILTER (WHERE coalesce(f.category, '') <> '' OR coalesce(f.property, '') <> ''
  OR coalesce(f.expense_type, '') <> '') AS prefilled
FROM ({QUEUE_SQL}) AS q LEFT JOIN ({PREFILL_SQL}) AS f ON q.txn_id = f.txn_id""")
def _(s: Source) -> DataFrame:
    queued = durable(queue(s))
    return review.prefill_count(review.transaction_table(queued, year=SPLIT_YEAR, prefills=prefills(s, queued)))


# What people typed: some vendors undecided, one vendor twice, some rows overridden.
TYPED_VENDORS = """
SELECT vendor, count, row_no, CASE length(vendor) % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'STR ' WHEN 2 THEN 'LTR' ELSE 'Skip' END AS category,
  CASE length(vendor) % 4 WHEN 1 THEN ' S2' ELSE '' END AS property, 'Supplies' AS expense_type
"""
DECIDED_VENDORS_SQL = f"""
SELECT vendor, 'Personal' AS category, '' AS property, '' AS expense_type, count FROM ({VENDORS_SQL}) AS v WHERE vendor LIKE 'building%'
UNION ALL
SELECT vendor, CASE length(vendor) % 4 WHEN 1 THEN 'STR' WHEN 2 THEN 'LTR' ELSE 'Skip' END,
  CASE length(vendor) % 4 WHEN 1 THEN 'S2' ELSE '' END, 'Supplies', count
FROM ({VENDORS_SQL}) AS v WHERE vendor NOT LIKE 'building%' AND length(vendor) % 4 <> 0
"""
RESOLVED_SQL = f"""
SELECT q.txn_id,
  CASE WHEN q.row_no % 11 = 0 THEN 'STR - Split' ELSE d.category END AS category,
  CASE WHEN q.row_no % 11 = 0 THEN '' ELSE d.property END AS property,
  CASE WHEN q.row_no % 11 = 0 THEN 'HOA' ELSE d.expense_type END AS expense_type,
  CASE WHEN q.row_no % 11 = 0 THEN 'review_override' ELSE 'review_vendor' END AS source
FROM ({TXN_TABLE_SQL}) AS q LEFT JOIN ({DECIDED_VENDORS_SQL}) AS d ON q.vendor = d.vendor
WHERE q.row_no % 11 = 0 OR d.vendor IS NOT NULL
"""


def typed_vendors(groups: DataFrame) -> DataFrame:
    n = F.length("vendor") % 4
    first = groups.select(
        F.lit(1).alias("row_no"), F.concat(F.lit(" "), "vendor").alias("vendor"), "count",
        F.when(n == 0, " ").when(n == 1, "STR ").when(n == 2, "LTR").otherwise("Skip").alias("category"),
        F.when(n == 1, " S2").otherwise("").alias("property"), F.lit("Supplies").alias("expense_type"),
    )
    again = groups.filter(F.col("vendor").startswith("building")).select(
        F.lit(2).alias("row_no"), "vendor", "count", F.lit("Personal").alias("category"), F.lit("").alias("property"),
        F.lit("").alias("expense_type"),
    )
    return first.unionByName(again)


def typed_rows(table: DataFrame) -> DataFrame:
    overridden = (F.col("row_index") + 1) % 11 == 0
    return table.select(
        F.col("row_index").alias("row_no"), "row_id",
        F.when(overridden, "STR - Split").otherwise("").alias("category"), F.lit("").alias("property"),
        F.when(overridden, " HOA").otherwise("").alias("expense_type"),
    )


def resolved(s: Source) -> DataFrame:
    queued = durable(queue(s))
    table = review.transaction_table(queued, year=SPLIT_YEAR)
    by_vendor = durable(review.vendor_decisions(typed_vendors(review.group_by_vendor(queued))))
    by_row = review.row_overrides(typed_rows(table))
    return review.resolve(table, by_vendor, by_row)


@query("resolve_decisions", RESOLVED_SQL)
def _(s: Source) -> DataFrame:
    return resolved(s).select("txn_id", "category", "property", "expense_type", "source")


@query("learn_from_vendor_decisions", f"""
SELECT coalesce(m.vendor, d.vendor) AS vendor, coalesce(m.category, d.category) AS category, CAST(0.9 AS DOUBLE) AS confidence,
  CAST(coalesce(m.occurrences, 0) + coalesce(d.count, 0) AS BIGINT) AS occurrences,
  coalesce(m.ambiguous, false) OR coalesce(m.category <> d.category, false) AS ambiguous,
  CASE WHEN coalesce(d.property, '') <> '' THEN d.property ELSE coalesce(m.property, '') END AS property,
  CASE WHEN coalesce(d.expense_type, '') <> '' THEN d.expense_type ELSE coalesce(m.expense_type, '') END AS expense_type
FROM ({MAP_SQL}) AS m FULL JOIN (SELECT * FROM ({DECIDED_VENDORS_SQL}) AS x WHERE category <> 'Skip') AS d ON m.vendor = d.vendor""")
def _(s: Source) -> DataFrame:
    queued = durable(queue(s))
    by_vendor = durable(review.vendor_decisions(typed_vendors(review.group_by_vendor(queued))))
    after = learning.learn_from_vendor_decisions(learned_map(s), by_vendor, year=SPLIT_YEAR)
    return after.select("vendor", "category", "confidence", "occurrences", "ambiguous", "property", "expense_type")


# ---------------------------------------------------------------- P&L


def pnl_items_sql(sign: str = "abs") -> str:
    amount = "abs(amount)" if sign == "abs" else "amount"
    return f"""
SELECT property, template_category, CAST(sum({amount}) AS DECIMAL(28,10)) AS amount FROM (
  SELECT property, CASE WHEN expense_type = '' THEN 'other' ELSE expense_type END AS template_category, CAST(amount AS DECIMAL(28,10)) AS amount
  FROM <<tagged>> AS t WHERE category IN ('STR', 'LTR')
  UNION ALL
  SELECT p.property, CASE WHEN expense_type = '' THEN 'other' ELSE expense_type END, CAST(amount / 4.0 AS DECIMAL(28,10))
  FROM <<tagged>> AS t, (VALUES ('S1'), ('S2'), ('S3'), ('S4')) AS p(property) WHERE category = 'STR - Split'
  UNION ALL
  SELECT p.property, CASE WHEN expense_type = '' THEN 'other' ELSE expense_type END, CAST(amount / 3.0 AS DECIMAL(28,10))
  FROM <<tagged>> AS t, (VALUES ('L1'), ('L2'), ('L3')) AS p(property) WHERE category = 'LTR - Split'
  UNION ALL
  SELECT property, 'Sales revenue', CAST(payout AS DECIMAL(28,10)) FROM <<earning_base>> AS e WHERE event_type = 'purchase'
  UNION ALL
  SELECT property, 'Interest expense', CAST(-amount AS DECIMAL(28,10)) FROM ({INTEREST_SQL}) AS i
) AS items WHERE property <> '' GROUP BY property, template_category"""


INTEREST_SQL = """
SELECT n_regionkey + 1996 AS year, CASE WHEN n_nationkey % 7 < 4 THEN 'S' || CAST(n_nationkey % 7 + 1 AS STRING)
  ELSE 'L' || CAST(n_nationkey % 7 - 3 AS STRING) END AS property, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS amount
FROM <<customer>> JOIN <<nation>> ON c_nationkey = n_nationkey WHERE n_regionkey = 2 GROUP BY 1, 2
"""


def interest_nested(s: Source) -> DataFrame:
    """``{year: {property: amount}}``: regions stand for years, nations for properties."""
    prop = F.when(
        F.col("n_nationkey") % 7 < 4, F.concat(F.lit("S"), (F.col("n_nationkey") % 7 + 1).cast("string"))
    ).otherwise(F.concat(F.lit("L"), (F.col("n_nationkey") % 7 - 3).cast("string")))
    flat = s.table("customer").join(s.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        (F.col("n_regionkey") + 1996).cast("int").alias("year"), prop.alias("property")
    ).agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"))
    # At most seven properties per year.
    by_property = flat.groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("property", "amount"))).alias("m"))
    return by_property.select(F.create_map("year", "m").alias("by_year"))


@query("interest_items", f"""
SELECT property, 'Interest expense' AS template_category, CAST(-amount AS DOUBLE) AS amount
FROM ({INTEREST_SQL}) AS i WHERE property LIKE 'L%'""")
def _(s: Source) -> DataFrame:
    interest = tables.interest_by_year(interest_nested(s), year=1998)
    return rollup.interest_items(interest, year=1998, members=LTR_PROPERTIES)


def earnings_raw(s: Source) -> DataFrame:
    """Events as positional text rows: payouts as money text, cancelled stays, short rows, dates in three forms."""
    d, n = F.col("stay"), F.col("event_id") % 3
    date = F.when(n == 0, F.date_format(d, "M/d/yyyy")).when(n == 1, F.date_format(d, "M/d/yy")).otherwise(F.date_format(d, "M/d"))
    paid = F.when(F.col("event_type") == "purchase", F.concat(F.lit(" $"), F.format_number("payout", 2))).when(
        F.col("event_type") == "view", "cancelled").otherwise(" ")
    row = F.array(date, F.lit("13/45/2024"), paid, F.concat(F.lit(" "), "event_type"))
    cells = F.when(F.col("event_type") == "error", F.slice(row, F.lit(1), F.lit(2))).when(
        F.col("event_type") == "click", F.array(F.lit(" "), F.lit(""), F.lit(" "), F.lit("x"))).otherwise(row)
    return s.adapter("earning_base").select("event_id", "property", cells.alias("cells"))


@query("earnings_rows", """
SELECT property, CAST(stay AS STRING) AS stay_start, 'purchase' AS platform, count(*) AS n, CAST(sum(payout) AS DOUBLE) AS net_payout
FROM <<earning_base>> AS e WHERE event_type = 'purchase' GROUP BY property, stay""")
def _(s: Source) -> DataFrame:
    rows = tables.earnings_by_position(earnings_raw(s), year=2024)
    return rows.filter("stay_end IS NULL").groupBy("property", "stay_start", "platform").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_payout").alias("net_payout"))


@query("net_payout", """
SELECT property, CAST(sum(payout) AS DOUBLE) AS net_payout FROM <<earning_base>> AS e WHERE event_type = 'purchase' GROUP BY property""")
def _(s: Source) -> DataFrame:
    return rollup.net_payout_by_property(tables.earnings_by_position(earnings_raw(s), year=2024))


@query("earnings_by_header", """
SELECT property, CAST(stay AS STRING) AS stay_start, platform, count(*) AS n, CAST(sum(payout) AS DOUBLE) AS net_payout,
  CAST(sum(gross) AS DOUBLE) AS gross
FROM (SELECT property, stay, payout, CASE property WHEN 'S1' THEN event_type ELSE '' END AS platform,
        CASE property WHEN 'S1' THEN payout + 1 END AS gross
      FROM <<earning_base>> AS e WHERE event_type <> 'error' AND property IN ('S1', 'S2', 'S4')) AS x
GROUP BY property, stay, platform""")
def _(s: Source) -> DataFrame:
    """Sheets whose headers differ; a sheet without a payout column is skipped, unreadable payouts are dropped."""
    e = s.adapter("earning_base")
    paid = F.when(F.col("event_type") == "error", "cancelled").otherwise(F.col("payout").cast("string"))
    stay = F.col("stay").cast("string")
    sheets = {
        "S1": e.filter("property = 'S1'").select(stay.alias("Check In"), paid.alias("NET"), F.col("event_type").alias("Channel"),
                                                 (F.col("payout") + 1).cast("string").alias("Gross Amount")),
        "S2": e.filter("property = 'S2'").select(stay.alias("arrival"), paid.alias("Net Payout"), F.lit("9").alias("payee")),
        "S3": e.filter("property = 'S3'").select(stay.alias("arrival"), paid.alias("amount")),
        "S4": e.filter("property = 'S4'").select(stay.alias("Arrival"), paid.alias("payout")),
    }
    rows = tables.earnings_by_header(sheets)
    return rows.groupBy("property", "stay_start", "platform").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_payout").alias("net_payout"), F.sum("gross").alias("gross"))


def pnl_items(s: Source) -> DataFrame:
    tagged = s.adapter("tagged")
    interest = tables.interest_by_year(interest_nested(s), year=1998)
    payouts = rollup.net_payout_by_property(tables.earnings_by_position(earnings_raw(s), year=2024))
    parts = [
        rollup.tagged_items(tagged, "STR", STR_PROPERTIES),
        rollup.tagged_items(tagged, "LTR", LTR_PROPERTIES),
        rollup.earning_items(payouts),
        rollup.interest_items(interest, year=1998, members=[*STR_PROPERTIES, *LTR_PROPERTIES]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("pnl_long", f"SELECT property, template_category, CAST(round(amount, 2) AS DOUBLE) AS amount FROM ({pnl_items_sql()}) AS p")
def _(s: Source) -> DataFrame:
    return rollup.rollup(pnl_items(s))


@query("pnl_net", f"SELECT property, template_category, CAST(round(amount, 2) AS DOUBLE) AS amount FROM ({pnl_items_sql('net')}) AS p")
def _(s: Source) -> DataFrame:
    return rollup.rollup(pnl_items(s), sign="net")


@query("pnl_dropped", """
SELECT CASE WHEN expense_type = '' THEN 'other' ELSE expense_type END AS template_category, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount
FROM <<tagged>> AS t WHERE category IN ('STR', 'LTR') AND property = '' GROUP BY 1""")
def _(s: Source) -> DataFrame:
    dropped = rollup.dropped_items(pnl_items(s))
    return dropped.groupBy("template_category").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


def layout_case() -> str:
    return "CASE template_category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.STR_LAYOUT.items()) + " END"


@query("pnl_fixed_layout", f"""
SELECT property, row_no, label, amount FROM (
  SELECT property, CAST({layout_case()} AS BIGINT) AS row_no, template_category AS label, CAST(round(amount, 2) AS DOUBLE) AS amount
  FROM ({pnl_items_sql()}) AS p WHERE property LIKE 'S%') AS x WHERE row_no IS NOT NULL AND amount <> 0""")
def _(s: Source) -> DataFrame:
    totals = rollup.rollup(pnl_items(s)).filter(F.col("property").isin(*STR_PROPERTIES))
    return rollup.on_fixed_layout(totals, fixed.STR_LAYOUT)


@query("pnl_wide", f"""
SELECT row_no, label, CAST(round(sum(amount) FILTER (WHERE property = 'S1'), 2) AS DOUBLE) AS "S1", CAST(round(sum(amount) FILTER (WHERE property = 'S2'), 2) AS DOUBLE) AS "S2",
  CAST(round(sum(amount) FILTER (WHERE property = 'S3'), 2) AS DOUBLE) AS "S3", CAST(round(sum(amount) FILTER (WHERE property = 'S4'), 2) AS DOUBLE) AS "S4"
FROM (SELECT property, CAST({layout_case()} AS BIGINT) AS row_no, template_category AS label, amount
      FROM ({pnl_items_sql()}) AS p WHERE property LIKE 'S%') AS x WHERE row_no IS NOT NULL AND amount <> 0 GROUP BY row_no, label""")
def _(s: Source) -> DataFrame:
    totals = rollup.rollup(pnl_items(s)).filter(F.col("property").isin(*STR_PROPERTIES))
    return rollup.wide(rollup.on_fixed_layout(totals, fixed.STR_LAYOUT), STR_PROPERTIES)


# Scanned layout: rows and letter case drift per property, one label is missing on one sheet.
SCANNED_SQL = """
SELECT property AS sheet, CAST(10 + rank() OVER (PARTITION BY property ORDER BY template_category) * 2 AS INT) AS row_no,
  CASE property WHEN 'L1' THEN upper(template_category) ELSE ' ' || template_category END AS label
FROM (SELECT DISTINCT property, CASE WHEN expense_type = '' THEN 'other' ELSE expense_type END AS template_category
      FROM <<tagged>> AS t WHERE category = 'LTR' AND property IN ('L1', 'L2')) AS d
WHERE NOT (property = 'L2' AND template_category = 'Supplies')
"""


@query("pnl_scanned_layout", f"""
SELECT t.property, CAST(l.row_no AS BIGINT) AS row_no, l.label, t.template_category, CAST(round(t.amount, 2) AS DOUBLE) AS amount
FROM ({pnl_items_sql()}) AS t LEFT JOIN ({SCANNED_SQL}) AS l
  ON t.property = l.sheet AND lower(t.template_category) = lower(trim(l.label))
WHERE t.property IN ('L1', 'L2') AND t.amount <> 0""")
def _(s: Source) -> DataFrame:
    totals = rollup.rollup(pnl_items(s))
    cells, unmatched = rollup.on_scanned_layout(totals, s.sql(SCANNED_SQL))
    named = cells.withColumn("template_category", F.lower(F.trim("label")))
    original = totals.withColumn("k", F.lower("template_category")).select("property", "k", F.col("template_category").alias("c"))
    named = named.join(original, (named.property == original.property) & (named.template_category == original.k)).select(
        named.property, "row_no", "label", F.col("c").alias("template_category"), "amount")
    return named.unionByName(unmatched, allowMissingColumns=True)


@query("cleared_template", """
SELECT property AS sheet, CAST(row_no AS BIGINT) AS row_no, col, CASE WHEN col = 'D' AND value NOT LIKE '=%' THEN NULL ELSE value END AS value
FROM (
  SELECT property, expense_type, category, 'C' AS col, expense_type AS value, ascii(expense_type || 'z') AS row_no FROM <<tagged>> AS t
  UNION ALL
  SELECT property, expense_type, category, 'D', CASE WHEN category = 'STR' THEN '=SUM(D5:D9)' ELSE CAST(amount AS STRING) END, ascii(expense_type || 'z') FROM <<tagged>> AS t
) AS cells""")
def _(s: Source) -> DataFrame:
    cells = s.sql("""
SELECT property AS sheet, 'C' AS col, expense_type AS value, ascii(expense_type || 'z') AS row_no FROM <<tagged>> AS t
UNION ALL
SELECT property, 'D', CASE WHEN category = 'STR' THEN '=SUM(D5:D9)' ELSE CAST(amount AS STRING) END, ascii(expense_type || 'z') FROM <<tagged>> AS t""")
    return rollup.cleared_template(cells)


@query("pm_detail", f"""
SELECT {case_sql('property', ALIASES)} AS alias, property, CAST(date AS STRING) AS date, 'pm' AS source, 'order ' || reference AS description,
  CAST(coalesce(nullif(cash_in, 0), nullif(cash_out, 0), 0) AS DOUBLE) AS amount,
  {case_sql('category', maps.PM_LABELS)} AS template_category, 'payee=' || payee AS notes
FROM <<pm_txn>> AS p WHERE year(date) = 1998 AND {case_sql('category', maps.PM_LABELS)} IS NOT NULL""".replace(
    f"{case_sql('property', ALIASES)} AS alias, property", f"coalesce({case_sql('property', ALIASES)}, property) AS property"))
def _(s: Source) -> DataFrame:
    rows = s.adapter("pm_txn").withColumn("description", F.concat(F.lit("order "), "reference"))
    return rollup.pm_detail(rows, year=1998, labels=maps.PM_LABELS, aliases=ALIASES)


@query("flatten_reports", f"""
SELECT ord AS doc_id, coalesce({case_sql('property', ALIASES)}, property) AS property, CAST(date AS STRING) AS date, payee, reference, category,
  CAST(cash_in AS DOUBLE) AS cash_in, CAST(cash_out AS DOUBLE) AS cash_out
FROM <<pm_txn>> AS p WHERE year(date) = 1998 AND reference <> '77'""")
def _(s: Source) -> DataFrame:
    """Nested report -> property -> transaction records, written as a stage table, read back and flattened."""
    txn = F.struct("date", "payee", "reference", "category", "cash_in", "cash_out")
    empty = F.slice(F.array(txn), F.lit(1), F.lit(0))
    props = F.array(
        F.struct(F.col("property").alias("name"), F.array(txn).alias("transactions")),
        F.struct(F.lit("L9").alias("name"), empty.alias("transactions")),
    )
    # A report that starts in another year is left out, an undated one is kept.
    start = F.when(F.col("reference") == "77", F.lit("1990-01-01").cast("date")).when(F.year("date") == 1998, F.trunc("date", "year"))
    reports = durable(s.adapter("pm_txn").select(F.col("ord").alias("doc_id"), start.alias("period_start"), props.alias("properties")))
    return rollup.flatten_reports(reports, year=1998, aliases=ALIASES).select(
        "doc_id", "property", "date", "payee", "reference", "category", "cash_in", "cash_out")


# ---------------------------------------------------------------- worksheet

WORKSHEET_CLASS_SQL = """
SELECT *, CASE lower(trim(type)) WHEN 'booth' THEN 'STR - Split' WHEN 'garage' THEN 'STR - Split'
    WHEN 'all cottages' THEN 'STR - Split' WHEN 'elm' THEN 'STR' WHEN 'oak' THEN 'STR' WHEN 'pine' THEN 'STR' WHEN 'ash' THEN 'STR' END AS cat,
  CASE lower(trim(type)) WHEN 'elm' THEN 'S1' WHEN 'oak' THEN 'S2' WHEN 'pine' THEN 'S3' WHEN 'ash' THEN 'S4' END AS prop,
  CASE lower(trim(type)) WHEN 'booth' THEN 'Promotion' WHEN 'garage' THEN 'other' ELSE
    CASE lower(trim(label)) WHEN 'cleaning fees' THEN 'Housekeeping' WHEN 'lawn mowing' THEN 'Garden' WHEN 'hoa dues' THEN 'Dues'
      WHEN 'wifi service' THEN 'Services' WHEN 'supplies' THEN 'Goods' WHEN 'pest control and repairs' THEN 'Services'
      ELSE 'other' END END AS exp
FROM <<worksheet_base>> AS w WHERE txn_id % 29 <> 0 AND (txn_id % 31 = 0 OR year(date) = 1999)
"""


def worksheet_rows(s: Source) -> DataFrame:
    """All-text worksheet: ``M/D/YY`` or ``M/D/YYYY`` dates, ``$1,234.50`` costs, some undated, some without cost."""
    n = F.col("txn_id")
    late = F.col("date")
    date = F.when(n % 31 == 0, F.lit(" ")).otherwise(F.date_format(late, "M/d/yyyy"))
    cost = F.when(n % 29 == 0, F.lit("")).otherwise(F.concat(F.lit("$"), F.format_number("cost", 2)))
    return s.adapter("worksheet_base").select(
        F.col("txn_id").alias("w_id"), F.col("txn_id").alias("w_ord"), date.alias("date"), cost.alias("cost"), "source", "type",
        F.col("label").alias("description"),
    )


@query("worksheet_items", f"""
SELECT property, template_category, count(*) AS n, CAST(round(sum(amount), 2) AS DOUBLE) AS amount FROM (
  SELECT prop AS property, exp AS template_category, CAST(cost AS DECIMAL(28,10)) AS amount FROM ({WORKSHEET_CLASS_SQL}) AS c WHERE cat = 'STR'
  UNION ALL
  SELECT p.property, exp, CAST(cost / 4.0 AS DECIMAL(28,10)) FROM ({WORKSHEET_CLASS_SQL}) AS c, (VALUES ('S1'), ('S2'), ('S3'), ('S4')) AS p(property) WHERE cat = 'STR - Split'
) AS i GROUP BY property, template_category""")
def _(s: Source) -> DataFrame:
    classified = worksheet.classify(worksheet_rows(s), year=1999, rules=maps.WORKSHEET)
    items = worksheet.to_items(classified, STR_PROPERTIES)
    return items.groupBy("property", "template_category").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("worksheet_unmapped", f"""
SELECT label AS description, count(*) AS occurrences FROM ({WORKSHEET_CLASS_SQL}) AS c
WHERE cat IS NOT NULL AND exp = 'other' AND lower(trim(type)) <> 'garage' GROUP BY label""")
def _(s: Source) -> DataFrame:
    return worksheet.unmapped_descriptions(worksheet.classify(worksheet_rows(s), year=1999, rules=maps.WORKSHEET))


@query("worksheet_counters", f"""
SELECT count(*) AS rows_read,
  count(*) FILTER (WHERE (txn_id % 31 <> 0 AND year(date) <> 1999) OR (txn_id % 29 <> 0 AND txn_id % 8 = 6)) AS skipped,
  count(*) FILTER (WHERE (txn_id % 31 = 0 OR year(date) = 1999) AND txn_id % 29 <> 0 AND txn_id % 8 IN (3, 4, 5)) AS split_rows
FROM <<worksheet_base>> AS w""")
def _(s: Source) -> DataFrame:
    return worksheet.counters(worksheet.classify(worksheet_rows(s), year=1999, rules=maps.WORKSHEET))


# ---------------------------------------------------------------- linkage


@query("match_date_amount", rules.BLOCKS_PAIRS_SQL)
def _(s: Source) -> DataFrame:
    ledger = s.adapter("ledger").select(F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), "date", "amount", "description")
    sheet = worksheet.parse(worksheet_rows(s)).select("w_id", "w_ord", F.col("txn_date").alias("date"), F.col("amount").alias("cost"), "source")
    return matching.match_date_amount(ledger, sheet)


@query("match_prefills", f"""
SELECT m.q_id AS ord, CASE lower(trim(type)) WHEN 'garage' THEN 'Skip' WHEN 'all cottages' THEN 'STR - Split' WHEN 'elm' THEN 'STR'
    WHEN 'oak' THEN 'STR' WHEN 'pine' THEN 'STR' WHEN 'ash' THEN 'STR' ELSE '' END AS category,
  CASE lower(trim(type)) WHEN 'elm' THEN 'S1' WHEN 'oak' THEN 'S2' WHEN 'pine' THEN 'S3' WHEN 'ash' THEN 'S4' ELSE '' END AS property,
  CASE lower(trim(label)) WHEN 'cleaning fees' THEN 'Housekeeping' WHEN 'lawn mowing' THEN 'Garden' WHEN 'hoa dues' THEN 'Dues'
      WHEN 'wifi service' THEN 'Services' WHEN 'supplies' THEN 'Goods' WHEN 'pest control and repairs' THEN 'Services'
      ELSE '' END AS expense_type
FROM <<worksheet_base>> AS w JOIN ({rules.EDIT_PAIRS_SQL}) AS m ON w.txn_id = m.w_id""")
def _(s: Source) -> DataFrame:
    ledger = s.adapter("ledger").select(F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), "date", "amount", "description")
    rows = worksheet.parse(worksheet_rows(s))
    pairs = matching.match_date_amount(
        ledger, rows.select("w_id", "w_ord", F.col("txn_date").alias("date"), F.col("amount").alias("cost"), "source"), similarity="edit")
    return review.prefills_from_pairs(pairs, rows, maps.WORKSHEET)


FUZZY_SQL = rules.fuzzy_pairs_sql(key_sql)
MATCHED_SQL = f"""
SELECT x.txn_id, {key_sql('x.description')} AS vendor, y.category
FROM ({FUZZY_SQL}) AS m JOIN <<ledger>> AS x ON x.txn_id = m.q_id JOIN <<prior_filing>> AS y ON y.w_id = m.w_id"""


def _fuzzy_inputs(s: Source) -> tuple[DataFrame, DataFrame]:
    ledger = s.adapter("ledger").select(F.col("txn_id").alias("q_id"), F.col("txn_id").alias("q_ord"), "date", "amount", "description")
    return ledger, s.adapter("prior_filing")


@query("match_fuzzy", FUZZY_SQL)
def _(s: Source) -> DataFrame:
    return matching.match_fuzzy(*_fuzzy_inputs(s))


def matched_rows(s: Source) -> tuple[DataFrame, DataFrame, DataFrame]:
    ledger, filings = _fuzzy_inputs(s)
    pairs = durable(matching.match_fuzzy(ledger, filings))
    rows = pairs.join(ledger, "q_id").join(filings.select("w_id", "category"), "w_id").select(
        "description", "category", F.col("q_ord").alias("seq"))
    return ledger, filings, durable(rows)


@query("learn_from_prior", f"""
SELECT vendor, arg_min(category, txn_id) AS category, CAST(count(*) AS BIGINT) AS occurrences, min(category) <> max(category) AS ambiguous,
  '1999' AS learned_from
FROM ({MATCHED_SQL}) AS k GROUP BY vendor""")
def _(s: Source) -> DataFrame:
    _, _, rows = matched_rows(s)
    learned = learning.learn_from_matches(learning.empty_map(rows), rows, year=1999)
    return learned.select("vendor", "category", "occurrences", "ambiguous", "learned_from")


@query("prior_learning_report", f"""
WITH x AS MATERIALIZED ({MATCHED_SQL})
SELECT count(*) AS matched, (SELECT count(*) FROM <<ledger>> AS l) - count(*) AS unmatched_bank,
  (SELECT count(*) FROM <<prior_filing>> AS p) - count(*) AS unmatched_prior,
  count(DISTINCT vendor) AS new_vendors_learned,
  (SELECT count(*) FROM (SELECT vendor FROM x GROUP BY vendor HAVING min(category) <> max(category)) AS a) AS ambiguous
FROM x""")
def _(s: Source) -> DataFrame:
    ledger, filings, rows = matched_rows(s)
    empty = learning.empty_map(rows)
    after = learning.learn_from_matches(empty, rows, year=1999)
    return learning.match_report(empty, after, ledger, filings, rows)


DOUBLE_SQL = """
SELECT d.q_id, CAST(d.q_id AS STRING) AS reference, CAST(g.total AS DOUBLE) AS group_sum, g.n AS members
FROM <<deposits>> AS d JOIN (
  SELECT CAST(reference AS BIGINT) AS key, sum(cash_out) AS total, count(*) AS n, max(date) AS last_paid
  FROM <<pm_txn>> AS p WHERE category = 'Owner Distributions / S corp Distributions' GROUP BY reference) AS g ON d.q_id = g.key
WHERE contains(lower(d.description), 'acme pm') AND abs(d.amount - g.total) <= 0.5
  AND date_diff('day', g.last_paid, d.date) <= 5
"""


def double_counted(s: Source) -> tuple[DataFrame, DataFrame]:
    deposits = durable(s.adapter("deposits"))
    pairs = matching.double_counts(deposits, s.adapter("pm_txn"), payer=PAYER)
    return deposits, pairs


@query("double_count", DOUBLE_SQL)
def _(s: Source) -> DataFrame:
    return double_counted(s)[1]


@query("exclude_double_counted", f"""
SELECT q_id, CAST(date AS STRING) AS date, description, CAST(amount AS DOUBLE) AS amount
FROM <<deposits>> AS d WHERE q_id NOT IN (SELECT q_id FROM ({DOUBLE_SQL}) AS x)""")
def _(s: Source) -> DataFrame:
    deposits, pairs = double_counted(s)
    excluded = deposits.join(pairs.select("q_id"), "q_id", "left_semi")
    return matching.exclude_deposits(deposits, excluded).select("q_id", "date", "description", "amount")


@query("payout_groups", """
SELECT reference, CAST(sum(cash_out) AS DOUBLE) AS group_sum, count(*) AS members
FROM <<pm_txn>> AS p WHERE category = 'Owner Distributions / S corp Distributions' GROUP BY reference""")
def _(s: Source) -> DataFrame:
    return matching.payout_groups(s.adapter("pm_txn")).select("reference", "group_sum", "members")


# ---------------------------------------------------------------- duplicates and guards


@query("duplicates", """
SELECT CAST(date AS STRING) AS date, CAST(amount AS DOUBLE) AS amount, lower(trim(description)) AS dup_description, count(*) AS copies,
  min(ord) AS first_ord, max(ord) AS last_ord
FROM <<ledger_lines>> AS l GROUP BY date, amount, lower(trim(description)) HAVING count(*) > 1""")
def _(s: Source) -> DataFrame:
    return guards.duplicate_groups(s.adapter("ledger_lines"))


@query("duplicate_members", """
SELECT CAST(date AS STRING) AS date, CAST(amount AS DOUBLE) AS amount, dup_description, description, ord, copies FROM (
  SELECT *, lower(trim(description)) AS dup_description, count(*) OVER (PARTITION BY date, amount, lower(trim(description))) AS copies
  FROM <<ledger_lines>> AS l) AS x WHERE copies > 1""")
def _(s: Source) -> DataFrame:
    return guards.duplicate_members(s.adapter("ledger_lines")).select(
        "date", "amount", "dup_description", "description", "ord", "copies")


def check_sql(entity: str, name: str, expected: str, actual: str, tol: str, source: str) -> str:
    return f"""SELECT CAST({entity} AS STRING) AS entity, '{name}' AS "check", CAST({expected} AS DOUBLE) AS expected,
  CAST({actual} AS DOUBLE) AS actual, CAST(({actual}) - ({expected}) AS DOUBLE) AS delta, abs(({actual}) - ({expected})) <= {tol} AS ok FROM {source}"""


STMT_SQL = """
SELECT c_custkey AS doc_id, CAST(1000 AS DECIMAL(18,2)) AS beginning,
  CAST(1000 + coalesce(sum(a), 0) + CASE WHEN c_custkey % 50 = 0 THEN 0.05 ELSE 0 END AS DECIMAL(18,2)) AS ending,
  CAST(coalesce(sum(a) FILTER (WHERE a > 0), 0) AS DECIMAL(18,2)) AS total_deposits,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(coalesce(-sum(a) FILTER (WHERE a < 0), 0) + CASE WHEN c_custkey % 60 = 0 THEN 0.03 ELSE 0 END AS DECIMAL(18,2)) END AS total_withdrawals
FROM <<customer>> LEFT JOIN (
  SELECT o_custkey, CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(18,2)) AS a FROM <<orders>>
) AS o ON o_custkey = c_custkey GROUP BY c_custkey
"""
SUMS_SQL = """
SELECT o_custkey AS doc_id, sum(a) AS total, coalesce(sum(a) FILTER (WHERE a > 0), 0) AS plus, coalesce(sum(a) FILTER (WHERE a < 0), 0) AS minus
FROM (SELECT o_custkey, CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(18,2)) AS a FROM <<orders>>) AS o GROUP BY o_custkey
"""
_BOTH = f"(SELECT h.*, coalesce(s.total, 0) AS total, coalesce(s.plus, 0) AS plus, coalesce(s.minus, 0) AS minus FROM ({STMT_SQL}) AS h LEFT JOIN ({SUMS_SQL}) AS s ON h.doc_id = s.doc_id) AS b"


@query("guard_statement", "\nUNION ALL\n".join([
    check_sql("doc_id", "balance_delta", "ending - beginning", "total", "0.02", _BOTH),
    check_sql("doc_id", "deposits", "total_deposits", "plus", "0.02", _BOTH + " WHERE total_withdrawals IS NOT NULL"),
    check_sql("doc_id", "withdrawals", "-total_withdrawals", "minus", "0.02", _BOTH + " WHERE total_withdrawals IS NOT NULL"),
]))
def _(s: Source) -> DataFrame:
    headers = s.sql(STMT_SQL)
    txns = s.table("orders").select(
        F.col("o_custkey").alias("doc_id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).cast("decimal(18,2)").alias("amount"))
    return guards.statement_checks(headers, txns)


PM_PROPS_SQL = """
SELECT year(date) AS doc_id, property AS property_id, CAST(500 AS DECIMAL(18,2)) AS beginning_balance,
  coalesce(sum(cash_in), 0) AS s_in, coalesce(sum(cash_out) FILTER (WHERE category <> 'Owner Distributions / S corp Distributions'), 0) AS s_out,
  coalesce(sum(cash_out) FILTER (WHERE category = 'Owner Distributions / S corp Distributions'), 0) AS s_own
FROM <<pm_txn>> AS p GROUP BY 1, 2
"""
PM_HEADS_SQL = f"""
SELECT doc_id, property_id, beginning_balance, CAST(s_in AS DECIMAL(18,2)) AS cash_in, CAST(-s_out AS DECIMAL(18,2)) AS cash_out,
  CASE WHEN property_id = 'L3' AND doc_id % 2 = 0 THEN NULL ELSE CAST(-s_own AS DECIMAL(18,2)) END AS owner_disbursements,
  CAST(500 + s_in - s_out - s_own + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS ending_balance,
  CAST(s_in + CASE WHEN doc_id % 4 = 0 THEN 0.03 ELSE 0 END AS DECIMAL(18,2)) AS total_cash_in_printed,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(s_out + s_own AS DECIMAL(18,2)) END AS total_cash_out_printed
FROM ({PM_PROPS_SQL}) AS x
"""
_PM_BOTH = f"(SELECT h.*, x.s_in AS txn_in, x.s_out + x.s_own AS txn_out, coalesce(owner_disbursements, 0) AS own FROM ({PM_HEADS_SQL}) AS h JOIN ({PM_PROPS_SQL}) AS x ON h.doc_id = x.doc_id AND h.property_id = x.property_id) AS b"
_ENT = "CAST(doc_id AS STRING) || '/' || property_id"
PM_CONS_SQL = f"""
SELECT doc_id, sum(beginning_balance) AS consolidated_beginning_balance, sum(cash_in) + CASE WHEN doc_id % 6 = 0 THEN 5 ELSE 0 END AS consolidated_cash_in,
  sum(cash_out) AS consolidated_cash_out, sum(owner_disbursements) AS consolidated_owner_disbursements,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE sum(ending_balance) END AS consolidated_ending_balance
FROM ({PM_HEADS_SQL}) AS h GROUP BY doc_id
"""
_PM_SUMS = f"(SELECT c.*, t.* EXCLUDE (doc_id) FROM ({PM_CONS_SQL}) AS c JOIN (SELECT doc_id, sum(beginning_balance) AS b0, sum(cash_in) AS b1, sum(cash_out) AS b2, sum(owner_disbursements) AS b3, sum(ending_balance) AS b4 FROM ({PM_HEADS_SQL}) AS h GROUP BY doc_id) AS t ON c.doc_id = t.doc_id) AS b"


@query("guard_pm_report", "\nUNION ALL\n".join([
    check_sql(_ENT, "balance_formula", "ending_balance", "beginning_balance + cash_in + cash_out + own", "0.02", _PM_BOTH),
    check_sql(_ENT, "printed_cash_in", "cash_in", "total_cash_in_printed", "0.02", _PM_BOTH),
    check_sql(_ENT, "printed_cash_out", "-(cash_out + own)", "total_cash_out_printed", "0.02", _PM_BOTH + " WHERE total_cash_out_printed IS NOT NULL"),
    check_sql(_ENT, "sum_cash_in", "total_cash_in_printed", "txn_in", "0.02", _PM_BOTH),
    check_sql(_ENT, "sum_cash_out", "total_cash_out_printed", "txn_out", "0.02", _PM_BOTH + " WHERE total_cash_out_printed IS NOT NULL"),
    *[check_sql("doc_id", f"consolidated_{n}", f"consolidated_{c}", f"b{i}", "0.02", _PM_SUMS + f" WHERE consolidated_{c} IS NOT NULL")
      for i, (n, c) in enumerate([("beginning", "beginning_balance"), ("cash_in", "cash_in"), ("cash_out", "cash_out"),
                                  ("owner_disbursements", "owner_disbursements"), ("ending", "ending_balance")])],
]))
def _(s: Source) -> DataFrame:
    txns = s.adapter("pm_txn").select(F.year("date").alias("doc_id"), F.col("property").alias("property_id"), "cash_in", "cash_out")
    # A property's year is a sum: it needs more digits than one amount.
    cons, heads = (s.sql(sql.replace(MONEY.upper(), TOTAL.upper())) for sql in (PM_CONS_SQL, PM_HEADS_SQL))
    return guards.pm_report_checks(cons, heads, txns)


@query("guard_platform", check_sql("'platform'", "platform_vs_bank",
       "(SELECT coalesce(sum(payout), 0) FROM <<earning_base>> AS e WHERE event_type = 'purchase')",
       "(SELECT coalesce(sum(amount), 0) FROM <<ledger>> AS l WHERE amount > 0 AND contains(lower(description), 'household peru'))", "500", "(SELECT 1 AS one) AS o"))
def _(s: Source) -> DataFrame:
    platform = tables.earnings_by_position(earnings_raw(s), year=2024).agg(F.sum("net_payout").alias("total"))
    bank = s.adapter("ledger").filter((F.col("amount") > 0) & F.lower("description").contains("household peru")).agg(F.sum("amount").alias("total"))
    return guards.platform_check(platform, bank)


@query("guard_split", """
SELECT CAST(txn_id AS STRING) AS entity, 'split' AS "check", CAST(amount AS DOUBLE) AS expected, round(CAST(amount AS DOUBLE), 2) AS actual, true AS ok
FROM <<tagged>> AS t WHERE category IN ('STR - Split', 'LTR - Split')""")
def _(s: Source) -> DataFrame:
    rows = s.adapter("tagged").filter(F.col("category").isin("STR - Split", "LTR - Split"))
    targets, each = rollup.split_targets(F.col("category"), F.col("property"), F.col("amount"),
                                         {"STR - Split": STR_PROPERTIES, "LTR - Split": LTR_PROPERTIES})
    shares = rows.select(F.col("txn_id").alias("source_id"), F.explode(targets).alias("property"), each.alias("amount"))
    checks = guards.split_checks(rows.select(F.col("txn_id").alias("source_id"), "amount"), shares)
    return checks.select("entity", "check", "expected", F.round("actual", 2).alias("actual"), "ok")


# ---------------------------------------------------------------- verification

FILED_SQL = f"""
SELECT property AS sheet, CAST({layout_case()} AS INT) AS row_no,
  CASE WHEN template_category = 'other' THEN ' ' ELSE template_category END AS label,
  CASE WHEN template_category = 'Utilities' AND property = 'S2' THEN '=SUM(D1:D2)' WHEN template_category = 'Insurance' AND property = 'S3' THEN 'n/a'
       ELSE CAST(CAST(round(CAST(amount AS DOUBLE) * CASE WHEN template_category = 'Supplies' THEN 1.05 ELSE 1.0 END, 0) AS BIGINT) AS STRING) || '.50' END AS raw
FROM ({pnl_items_sql()}) AS p WHERE property LIKE 'S%' AND {layout_case()} IS NOT NULL
"""
COMPARE_SQL = f"""
SELECT f.sheet, f.row_no, f.label, f.filed, coalesce(g.amount, 0.0) AS generated, coalesce(g.amount, 0.0) - f.filed AS delta,
  abs(coalesce(g.amount, 0.0) - f.filed) <= CASE WHEN f.row_no <= 10 THEN 1.0 ELSE greatest(5.0, abs(f.filed) * 0.02) END AS within_tolerance
FROM (SELECT sheet, row_no, CASE WHEN trim(label) = '' THEN 'Row ' || CAST(row_no AS STRING) ELSE trim(label) END AS label, CAST(raw AS DOUBLE) AS filed
      FROM ({FILED_SQL}) AS c WHERE raw NOT LIKE '=%' AND raw <> 'n/a') AS f
LEFT JOIN (SELECT property, CAST({layout_case()} AS INT) AS row_no, CAST(round(amount, 2) AS DOUBLE) AS amount FROM ({pnl_items_sql()}) AS p WHERE property IN ('S1', 'S2', 'S3')) AS g
  ON f.sheet = g.property AND f.row_no = g.row_no
"""


def compared(s: Source) -> DataFrame:
    """Filed cells of four sheets against a generated P&L that misses one of them."""
    items = durable(rollup.rollup(pnl_items(s)))
    case = layout_case()
    cells = items.filter(F.col("property").isin(*STR_PROPERTIES)).withColumn("row_no", F.expr(case)).filter("row_no IS NOT NULL")
    up = F.when(F.col("template_category") == "Supplies", 1.05).otherwise(1.0)
    raw = (
        F.when((F.col("template_category") == "Utilities") & (F.col("property") == "S2"), "=SUM(D1:D2)")
        .when((F.col("template_category") == "Insurance") & (F.col("property") == "S3"), "n/a")
        .otherwise(F.concat(F.round(F.col("amount").cast("double") * up, 0).cast("bigint").cast("string"), F.lit(".50")))
    )
    filed = cells.select(
        F.col("property").alias("sheet"), "row_no",
        F.when(F.col("template_category") == "other", " ").otherwise(F.col("template_category")).alias("label"), raw.alias("raw"))
    generated = rollup.on_fixed_layout(items.filter(F.col("property").isin("S1", "S2", "S3")), fixed.STR_LAYOUT).select(
        F.col("property").alias("sheet"), "row_no", F.round("amount", 2).cast("double").alias("generated"))
    return verify.compare(verify.filed_cells(filed), generated)


@query("compare_filed", f"""
SELECT sheet, CAST(row_no AS BIGINT) AS row_no, label, filed, generated, round(delta, 2) AS delta, within_tolerance FROM ({COMPARE_SQL}) AS c""")
def _(s: Source) -> DataFrame:
    return compared(s).select("sheet", "row_no", "label", "filed", "generated", F.round("delta", 2).alias("delta"), "within_tolerance")


@query("compare_summary", f"""
SELECT count(*) FILTER (WHERE within_tolerance) AS matched, count(*) AS total,
  round(count(*) FILTER (WHERE within_tolerance) * 100.0 / count(*), 4) AS percent FROM ({COMPARE_SQL}) AS c""")
def _(s: Source) -> DataFrame:
    return verify.summary(compared(s)).withColumn("percent", F.round("percent", 4))


@query("compare_report", f"""
SELECT CAST(1 AS BIGINT) AS section, sheet, CAST(row_no AS BIGINT) AS row_no,
  '| ' || sheet || ' | ' || CAST(row_no AS STRING) || ' | ' || label || ' | ' || format('{{:,.2f}}', filed) || ' | ' || format('{{:,.2f}}', generated)
  || ' | ' || CASE WHEN round(delta, 2) >= 0 THEN '+' ELSE '' END || format('{{:,.2f}}', round(delta, 2)) || ' | ' || CASE WHEN within_tolerance THEN 'YES' ELSE '**NO**' END || ' |' AS line
FROM ({COMPARE_SQL}) AS c
UNION ALL SELECT 0, NULL, 1, '| Sheet | Row | Label | Filed | Generated | Delta | OK? |'
UNION ALL SELECT 0, NULL, 2, '|---|---|---|---|---|---|---|'
UNION ALL SELECT 2, NULL, 0, ''
UNION ALL SELECT 2, NULL, 1, '**' || CAST(count(*) FILTER (WHERE within_tolerance) AS STRING) || '/' || CAST(count(*) AS STRING) || ' cells within tolerance ('
  || format('{{:.1f}}', count(*) FILTER (WHERE within_tolerance) * 100.0 / count(*)) || '%)**' FROM ({COMPARE_SQL}) AS c""")
def _(s: Source) -> DataFrame:
    return verify.report_lines(compared(s))


_PM_LABEL = case_sql("category", maps.PM_LABELS)
PARSED_SQL = f"""
SELECT property, {_PM_LABEL} AS template_category, sum(coalesce(nullif(cash_in, 0), nullif(cash_out, 0), 0)) AS parsed
FROM <<pm_txn>> AS p WHERE year(date) = 1999 AND {_PM_LABEL} IS NOT NULL GROUP BY 1, 2
"""


@query("pm_totals", f"SELECT property, template_category, CAST(parsed AS DOUBLE) AS parsed FROM ({PARSED_SQL}) AS p")
def _(s: Source) -> DataFrame:
    return rollup.pm_totals(s.adapter("pm_txn"), year=1999, labels=maps.PM_LABELS)


@query("parsed_vs_filed", f"""
SELECT property, template_category, CAST(parsed AS DOUBLE) AS parsed,
  CAST(CASE WHEN property = 'L2' OR template_category = 'Plumbing' THEN 0 ELSE parsed + 1 END AS DOUBLE) AS filed,
  CAST(CASE WHEN property = 'L2' OR template_category = 'Plumbing' THEN parsed ELSE -1 END AS DOUBLE) AS delta
FROM ({PARSED_SQL}) AS p""")
def _(s: Source) -> DataFrame:
    parsed = durable(rollup.pm_totals(s.adapter("pm_txn"), year=1999, labels=maps.PM_LABELS))
    filed = parsed.filter("property <> 'L2' AND template_category <> 'Plumbing'").select(
        "property", F.upper("template_category").alias("label"), F.length("template_category").alias("row_no"),
        (F.col("parsed") + 1).alias("filed"))
    return verify.parsed_vs_filed(parsed, filed)


# ---------------------------------------------------------------- extraction round trips

BLOCK_SQL = f"CAST(floor(txn_id / {render.BLOCK}.0) AS BIGINT)"
MONTH_DOC = f"((year(date) * 100 + month(date)) * 10000000000 + {BLOCK_SQL})"
TWO_MONTH_DOC = f"(CAST(floor((year(date) * 12 + month(date)) / 2.0) AS BIGINT) * 10000000000 + {BLOCK_SQL})"


@query("stmt_generic", f"""
SELECT {TWO_MONTH_DOC} AS doc_id, row_number() OVER (PARTITION BY {TWO_MONTH_DOC} ORDER BY date, txn_id) - 1 AS ord, CAST(date AS STRING) AS date,
  description, CAST(amount AS DOUBLE) AS amount, CASE WHEN txn_id % 2 = 0 THEN CAST(abs(amount) + 100 AS DOUBLE) END AS balance
FROM <<ledger>> AS l""")
def _(s: Source) -> DataFrame:
    docs = render.generic_statements(s.adapter("ledger"))
    return generic.transactions(docs).select("doc_id", "ord", "date", "description", "amount", "balance")


@query("stmt_generic_totals", f"""
SELECT {TWO_MONTH_DOC} AS doc_id, CAST(1000 AS DOUBLE) AS beginning, CAST(1000 + sum(amount) AS DOUBLE) AS ending,
  CAST(coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS DOUBLE) AS total_deposits,
  CAST(coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS DOUBLE) AS total_withdrawals
FROM <<ledger>> AS l GROUP BY 1""")
def _(s: Source) -> DataFrame:
    return generic.header_totals(render.generic_statements(s.adapter("ledger"))).drop("account")


CHECK_SECTION_SQL = """CASE WHEN amount > 0 THEN 'deposits' WHEN txn_id % 3 = 0 THEN 'checks_paid' WHEN txn_id % 3 = 1 THEN 'electronic_withdrawals' ELSE 'fees' END"""


@query("stmt_checking", f"""
SELECT {MONTH_DOC} AS doc_id, section, CAST(date AS STRING) AS date,
  CASE WHEN section = 'checks_paid' THEN 'Check #' || CASE WHEN txn_id % 13 = 0 THEN '(unknown)' ELSE CAST(1000 + txn_id % 9000 AS STRING) END
       ELSE trim(description) || CASE WHEN txn_id % 4 = 0 THEN ' Descr:Payment Sec:Web Ind Name:Sample Trn: ' || CAST(txn_id AS STRING) || 'Tc' ELSE '' END END AS description,
  CAST(amount AS DOUBLE) AS amount,
  CASE WHEN section = 'checks_paid' AND txn_id % 13 <> 0 THEN CAST(1000 + txn_id % 9000 AS STRING) END AS check_number
FROM (SELECT *, {CHECK_SECTION_SQL} AS section FROM <<ledger>> AS l) AS x""")
def _(s: Source) -> DataFrame:
    parsed = CheckingStatements(render.checking_statements(s.adapter("ledger")))
    return parsed.transactions().select("doc_id", "section", "date", "description", "amount", "check_number")


CHECKING_DOCS_SQL = f"""
SELECT {MONTH_DOC} AS doc_id, min(date) AS d, sum(amount) AS net, count(*) AS n,
  count(*) FILTER (WHERE section = 'deposits') AS n_deposits, count(*) FILTER (WHERE section = 'checks_paid') AS n_checks_paid,
  count(*) FILTER (WHERE section = 'electronic_withdrawals') AS n_electronic_withdrawals, count(*) FILTER (WHERE section = 'fees') AS n_fees,
  coalesce(sum(abs(amount)) FILTER (WHERE section = 'deposits'), 0) AS s_deposits, coalesce(sum(abs(amount)) FILTER (WHERE section = 'checks_paid'), 0) AS s_checks_paid
FROM (SELECT *, {CHECK_SECTION_SQL} AS section FROM <<ledger>> AS l) AS x GROUP BY 1
"""


@query("stmt_checking_totals", f"""
SELECT doc_id, CAST(date_trunc('month', d) AS DATE)::STRING AS period_start, CAST(last_day(d) AS STRING) AS period_end, CAST(1000 AS DOUBLE) AS beginning,
  CAST(1000 + net + CASE WHEN doc_id % 10000000000 % 7 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS ending, CAST(s_deposits AS DOUBLE) AS total_deposits,
  CAST(-s_checks_paid AS DOUBLE) AS total_checks_paid, n_deposits + CASE WHEN doc_id % 10000000000 % 5 = 0 THEN 1 ELSE 0 END AS count_deposits, n AS count_total
FROM ({CHECKING_DOCS_SQL}) AS c""")
def _(s: Source) -> DataFrame:
    parsed = CheckingStatements(render.checking_statements(s.adapter("ledger")))
    return parsed.statements().select(
        "doc_id", "period_start", "period_end", "beginning", "ending", "total_deposits", "total_checks_paid",
        F.col("instance_counts")["deposits"].alias("count_deposits"), F.col("instance_counts")["total"].alias("count_total"))


@query("stmt_checking_warnings", f"""
SELECT doc_id, 'electronic_withdrawals' AS section, 'unreadable first line' AS warning, CAST(1 AS BIGINT) AS n FROM ({CHECKING_DOCS_SQL}) AS c
UNION ALL
SELECT {MONTH_DOC}, 'checks_paid', 'check number missing', count(*) FROM <<ledger>> AS l
WHERE amount <= 0 AND txn_id % 3 = 0 AND txn_id % 13 = 0 GROUP BY 1""")
def _(s: Source) -> DataFrame:
    parsed = CheckingStatements(render.checking_statements(s.adapter("ledger")))
    return parsed.warnings().groupBy("doc_id", "section", "warning").agg(F.count(F.lit(1)).alias("n"))


@query("guard_sections", "\nUNION ALL\n".join([
    *[check_sql("doc_id", f"count_{n}", f"n_{n}" + (" + CASE WHEN doc_id % 10000000000 % 5 = 0 THEN 1 ELSE 0 END" if n == "deposits" else ""),
                f"n_{n}", "0", f"({CHECKING_DOCS_SQL}) AS c") for n in ("deposits", "checks_paid", "electronic_withdrawals", "fees")],
    check_sql("doc_id", "balance", "net + CASE WHEN doc_id % 10000000000 % 7 = 0 THEN 5 ELSE 0 END", "net", "0.02", f"({CHECKING_DOCS_SQL}) AS c"),
]))
def _(s: Source) -> DataFrame:
    parsed = CheckingStatements(render.checking_statements(s.adapter("ledger")), stored=True)
    return guards.section_checks(parsed.statements(), parsed.transactions())


@query("stmt_errors", f"""
SELECT {MONTH_DOC} AS doc_id, CASE WHEN month(min(date)) % 2 = 0 THEN 'no checking summary' ELSE 'no statement period' END AS error FROM <<ledger>> AS l GROUP BY 1""")
def _(s: Source) -> DataFrame:
    """Documents whose period or control block was cut off are reported, not parsed."""
    docs = render.checking_statements(s.adapter("ledger"))
    even = F.floor(F.col("doc_id") / 10_000_000_000) % 2 == 0
    cut = F.when(even, F.regexp_replace("text", "CHECKING SUMMARY", "SUMMARY")).otherwise(F.regexp_replace("text", "through", " to "))
    return CheckingStatements(docs.withColumn("text", cut)).errors().drop("account")


@query("stmt_card", f"""
SELECT {TWO_MONTH_DOC} AS doc_id, CAST(make_date(year(date) + 20, month(date), day(date)) AS STRING) AS date, trim(description) AS description,
  CAST(-amount AS DOUBLE) AS amount, CASE WHEN txn_id % 2 = 0 THEN '4001' ELSE '4002' END AS cardholder
FROM <<ledger>> AS l""".replace("TWO", "TWO"))
def _(s: Source) -> DataFrame:
    rows = s.adapter("ledger")
    docs = render.card_statements(rows)
    # Statement numbers follow the printed dates; bring them back to the source rows' months.
    shift = F.col("doc_id") - F.lit(20 * 6 * 10_000_000_000)
    return CardStatements(docs, CARDS).transactions().select(shift.alias("doc_id"), "date", "description", "amount", "cardholder")


CARD_DOCS_SQL = f"""
SELECT {TWO_MONTH_DOC} AS doc_id, coalesce(sum(-amount) FILTER (WHERE amount > 0), 0) AS credits, coalesce(sum(-amount) FILTER (WHERE amount < 0), 0) AS purchases,
  coalesce(sum(-amount) FILTER (WHERE txn_id % 2 = 0), 0) AS c0, coalesce(sum(-amount) FILTER (WHERE txn_id % 2 = 1), 0) AS c1
FROM <<ledger>> AS l GROUP BY 1
"""


@query("stmt_card_totals", f"""
SELECT doc_id, CAST({render.PREVIOUS_BALANCE} AS DOUBLE) AS previous_balance, CAST(credits AS DOUBLE) AS payments_credits, CAST(purchases AS DOUBLE) AS purchases_total,
  CAST(40 AS DOUBLE) AS fees_charged, CAST(c0 AS DOUBLE) AS cycle_4001, CAST(c1 + CASE WHEN doc_id % 10000000000 % 6 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS cycle_4002
FROM ({CARD_DOCS_SQL}) AS c""")
def _(s: Source) -> DataFrame:
    st = CardStatements(render.card_statements(s.adapter("ledger")), CARDS).statements()
    return st.select((F.col("doc_id") - F.lit(20 * 6 * 10_000_000_000)).alias("doc_id"), "previous_balance", "payments_credits", "purchases_total",
                     "fees_charged", F.col("cycle_totals")["4001"].alias("cycle_4001"), F.col("cycle_totals")["4002"].alias("cycle_4002"))


@query("guard_cycle", "\nUNION ALL\n".join([
    check_sql("CAST(doc_id + 1200000000000 AS STRING) || '/4001'", "cycle_total", "c0", "c0", "0.02", f"({CARD_DOCS_SQL}) AS c"),
    check_sql("CAST(doc_id + 1200000000000 AS STRING) || '/4002'", "cycle_total", "c1 + CASE WHEN doc_id % 10000000000 % 6 = 0 THEN 1 ELSE 0 END", "c1", "0.02", f"({CARD_DOCS_SQL}) AS c"),
]))
def _(s: Source) -> DataFrame:
    parsed = CardStatements(render.card_statements(s.adapter("ledger")), CARDS)
    return guards.cycle_checks(parsed.statements(), parsed.transactions())


PM_TEXT_CATEGORY = "CASE txn_id % 5 WHEN 0 THEN 'Rental Income' WHEN 1 THEN 'Repairs' WHEN 2 THEN 'Management Fee' WHEN 3 THEN 'Property Tax' ELSE 'Legal' END"


@query("pm_text", f"""
SELECT {MONTH_DOC} * 3 + txn_id % 3 AS doc_id, CAST(date AS STRING) AS date, trim(description) AS description, {PM_TEXT_CATEGORY} AS pm_category,
  CAST(amount AS DOUBLE) AS amount, 'L' || CAST(txn_id % 3 + 1 AS STRING) AS property_id
FROM <<ledger>> AS l""")
def _(s: Source) -> DataFrame:
    docs = render.pm_text_reports(s.adapter("ledger"))
    return pm_text.entries(docs).select("doc_id", "date", "description", "pm_category", "amount", "property_id")


@query("pm_text_totals", f"""
SELECT {MONTH_DOC} * 3 + txn_id % 3 AS doc_id, 'L' || CAST(txn_id % 3 + 1 AS STRING) AS property_id,
  CAST(coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS DOUBLE) AS total_income,
  CAST(coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS DOUBLE) AS total_expenses, CAST(sum(amount) AS DOUBLE) AS net_to_owner
FROM <<ledger>> AS l GROUP BY 1, 2""")
def _(s: Source) -> DataFrame:
    return pm_text.totals(render.pm_text_reports(s.adapter("ledger")))


LAYOUT_SQL = f"""
SELECT *, {MONTH_DOC} AS doc_id, CAST(floor(txn_id / 7.0) AS BIGINT) % 3 AS p,
  CASE txn_id % 5 WHEN 0 THEN 'Rent Income' WHEN 1 THEN 'Water' WHEN 2 THEN 'Repair (IA)' WHEN 3 THEN 'HVAC (Heat, Ventilation, Air)' ELSE 'Late Fee' END AS category,
  CASE txn_id % 3 WHEN 0 THEN '102' WHEN 1 THEN '1/2 upper' END AS unit
FROM <<ledger>> AS l
"""


def owner_statements(s: Source) -> OwnerStatements:
    return OwnerStatements(durable(render.layout_words(s.adapter("ledger"))), render.PROPERTY_RULES, "SW ")


@query("pm_layout", f"""
SELECT doc_id, 'L' || CAST(p + 1 AS STRING) AS property, CAST(date AS STRING) AS date,
  'Doe' || CASE txn_id % 4 WHEN 0 THEN ' Jane' WHEN 1 THEN ' LLC' ELSE '' END AS payee, 'Check' AS txn_type, 'R' || CAST(txn_id AS STRING) AS reference,
  coalesce(unit || ' - ', '') || category || CASE WHEN txn_id % 4 = 1 THEN ' rest' ELSE '' END AS description,
  CASE WHEN amount > 0 THEN CAST(amount AS DOUBLE) END AS cash_in, CASE WHEN amount <= 0 THEN CAST(-amount AS DOUBLE) END AS cash_out,
  CAST(abs(amount) + 1 AS DOUBLE) AS balance, unit, category
FROM ({LAYOUT_SQL}) AS x""")
def _(s: Source) -> DataFrame:
    return owner_statements(s).transactions().select(
        "doc_id", "property", "date", "payee", "txn_type", "reference", "description", "cash_in", "cash_out", "balance", "unit", "category")


PROP_SQL = f"""
SELECT doc_id, p, coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS cin, coalesce(-sum(amount) FILTER (WHERE amount <= 0), 0) AS cout FROM ({LAYOUT_SQL}) AS x GROUP BY 1, 2
"""


@query("pm_layout_properties", f"""
SELECT doc_id, 'L' || CAST(p + 1 AS STRING) AS name, CAST(500 AS DOUBLE) AS beginning_balance, CAST(cin AS DOUBLE) AS cash_in, CAST(-cout AS DOUBLE) AS cash_out,
  CAST(500 + cin - cout AS DOUBLE) AS ending_balance, CAST(cin + CASE WHEN doc_id % 10000000000 % 4 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS total_cash_in_printed,
  CAST(cout AS DOUBLE) AS total_cash_out_printed
FROM ({PROP_SQL}) AS q""")
def _(s: Source) -> DataFrame:
    return owner_statements(s).properties().select(
        "doc_id", "name", "beginning_balance", "cash_in", "cash_out", "ending_balance", "total_cash_in_printed", "total_cash_out_printed")


@query("pm_layout_reports", f"""
SELECT doc_id, '2024-01-01' AS period_start, '2024-01-31' AS period_end, CAST(500 * count(*) AS DOUBLE) AS consolidated_beginning_balance,
  CAST(sum(cin) AS DOUBLE) AS consolidated_cash_in, CAST(-sum(cout) AS DOUBLE) AS consolidated_cash_out
FROM ({PROP_SQL}) AS q GROUP BY doc_id""")
def _(s: Source) -> DataFrame:
    return owner_statements(s).reports().select(
        "doc_id", "period_start", "period_end", "consolidated_beginning_balance", "consolidated_cash_in", "consolidated_cash_out")


CASHFLOW_SQL = """
SELECT year(date) AS year, property, CASE WHEN category IN ('Rent Income', 'Late Fee', 'Security Deposits') THEN 'income' ELSE 'expense' END AS side,
  CASE category WHEN 'Postage' THEN 'HVAC (Heat, Ventilation, Air)' ELSE category END AS category,
  sum(coalesce(nullif(cash_in, 0), nullif(cash_out, 0), 0)) AS amount
FROM <<pm_txn>> AS p WHERE category <> '' GROUP BY 1, 2, 3, 4
"""


def cashflow_parsed(s: Source) -> CashFlowPages:
    return CashFlowPages(durable(render.cashflow_pages(s.sql(CASHFLOW_SQL))), (PAYER,), stored=True)


@query("cashflow", f"""
SELECT CAST(year AS BIGINT) AS doc_id, property || ' Elm St, IA' AS property, 'Jan ' || CAST(year AS STRING) || ' to Dec ' || CAST(year AS STRING) AS period,
  side, category, CAST(amount AS DOUBLE) AS amount
FROM ({CASHFLOW_SQL}) AS c""")
def _(s: Source) -> DataFrame:
    return cashflow_parsed(s).summaries().select("doc_id", "property", "period", "side", "category", "amount")


@query("cashflow_totals", f"""
SELECT CAST(year AS BIGINT) AS doc_id, CAST(CAST(substr(property, 2) AS BIGINT) * 3 AS BIGINT) AS group_page,
  CAST(coalesce(sum(amount) FILTER (WHERE side = 'income'), 0) AS DOUBLE) AS total_income,
  CAST(coalesce(sum(amount) FILTER (WHERE side = 'expense'), 0) AS DOUBLE) AS total_expense,
  CAST(coalesce(sum(amount) FILTER (WHERE side = 'income'), 0) - coalesce(sum(amount) FILTER (WHERE side = 'expense'), 0) AS DOUBLE) AS net_income
FROM ({CASHFLOW_SQL}) AS c GROUP BY year, property""")
def _(s: Source) -> DataFrame:
    return cashflow_parsed(s).totals()


_CF_LABEL = case_sql("category", maps.CASHFLOW_LABELS)


@query("cashflow_items", f"""
SELECT CASE property WHEN 'L1' THEN 'L1' ELSE property || ' Elm St, IA' END AS property, {_CF_LABEL} AS template_category,
  CAST(CASE WHEN side = 'expense' THEN -amount ELSE amount END AS DOUBLE) AS amount
FROM ({CASHFLOW_SQL}) AS c WHERE year = 1998 AND {_CF_LABEL} IS NOT NULL""")
def _(s: Source) -> DataFrame:
    return rollup.cashflow_items(
        cashflow_parsed(s).summaries(), year=1998, labels=maps.CASHFLOW_LABELS, aliases={"L1 Elm St, IA": "L1"})


# ---------------------------------------------------------------- documents

ROUTES = (("statements-1234", "checking"), ("statements-5678", "card"), ("^pm-", "owner_report"), (r"owner\s*packet", "owner_report"))
PATHS_SQL = """
SELECT page_id, '/in/' || CAST(page_id % 7 AS STRING) || '/' || CASE page_id % 6 WHEN 0 THEN '20240131-STATEMENTS-1234-' WHEN 1 THEN 'statements-5678-'
  WHEN 2 THEN 'PM-' WHEN 3 THEN 'Owner  Packet ' WHEN 4 THEN 'x-pm-' ELSE 'misc-' END || replace(url, '/', '_') || '.pdf' AS path FROM <<pages>>
"""
ROUTED_SQL = f"""
SELECT page_id, replace(path, '/in/' || CAST(page_id % 7 AS STRING) || '/', '') AS name,
  CASE page_id % 6 WHEN 0 THEN 'checking' WHEN 1 THEN 'card' WHEN 2 THEN 'owner_report' WHEN 3 THEN 'owner_report' ELSE 'unknown' END AS doc_type
FROM ({PATHS_SQL}) AS p
"""


@query("route_documents", ROUTED_SQL)
def _(s: Source) -> DataFrame:
    return documents.route_files(s.sql(PATHS_SQL), ROUTES).select("page_id", "name", "doc_type")


@query("route_counts", f"""
SELECT t.doc_type, count(r.page_id) AS files, min(r.name) AS first_name, max(r.name) AS last_name
FROM (VALUES ('checking'), ('card'), ('owner_report'), ('unknown')) AS t(doc_type) LEFT JOIN ({ROUTED_SQL}) AS r ON r.doc_type = t.doc_type GROUP BY t.doc_type""")
def _(s: Source) -> DataFrame:
    return documents.count_by_type(s.sql(PATHS_SQL), ROUTES)


def document_pages(s: Source) -> DataFrame:
    """Every line of a document as a page."""
    return s.table("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "text"))


@query("full_text", "SELECT doc_id, length(text) AS chars, md5(text) AS digest FROM <<documents>>")
def _(s: Source) -> DataFrame:
    return documents.full_text(document_pages(s)).select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query("ocr_queue", """
SELECT c.conv_id AS doc_id, CASE WHEN sum(CASE WHEN c.conv_id % 4 = 0 THEN 4 ELSE length(trim(text, chr(32) || chr(10) || chr(13) || chr(9))) END) < 10 THEN 'ocr' ELSE 'text' END AS method
FROM <<conversations>> AS c GROUP BY c.conv_id""")
def _(s: Source) -> DataFrame:
    """Conversations as documents, turns as pages; every fourth document only carries a stray mark per page."""
    pages = s.table("conversations").select(
        F.col("conv_id").alias("doc_id"), F.when(F.col("conv_id") % 4 == 0, F.lit("  mark\n")).otherwise(F.col("text")).alias("text"))
    return documents.text_or_scanned(pages.select("doc_id").distinct(), pages).select("doc_id", "method")


TABS_SQL = """
SELECT 'P' || CAST(c_custkey AS STRING) AS property, CAST(o_orderkey AS BIGINT) AS position,
  CASE o_orderkey % 9 WHEN 0 THEN '''98 earnings' WHEN 1 THEN '1998 Earnings' WHEN 2 THEN ' 1998 EARNINGS ' ELSE 'notes ' || CAST(o_orderkey AS STRING) END AS title
FROM <<orders>> JOIN <<customer>> ON o_custkey = c_custkey
"""


@query("pick_tab", f"""
SELECT property, arg_min(title, rk) FILTER (WHERE rk IS NOT NULL) AS title
FROM (SELECT *, CASE title WHEN '''98 earnings' THEN 1 WHEN '1998 Earnings' THEN 4 WHEN ' 1998 EARNINGS ' THEN 5 + position END AS rk FROM ({TABS_SQL}) AS t) AS r
GROUP BY property""")
def _(s: Source) -> DataFrame:
    return documents.pick_tab(s.sql(TABS_SQL), 1998)


@query("prior_entries", """
SELECT CAST(date AS STRING) AS date, trim(description) AS description, CAST(amount AS DOUBLE) AS amount, category, count(*) AS n
FROM <<prior_filing>> AS p WHERE w_id % 7 <> 0 AND w_id % 11 <> 0 GROUP BY 1, 2, 3, 4""")
def _(s: Source) -> DataFrame:
    """Two sheets with different header case and column order, one sheet without the columns."""
    p = s.adapter("prior_filing")
    date = F.when(F.col("w_id") % 7 == 0, "12/31 maybe").otherwise(F.col("date").cast("string"))
    amount = F.when(F.col("w_id") % 11 == 0, F.lit(None)).otherwise(F.col("amount").cast("string"))
    one = p.filter("amount > 0").select(date.alias("DATE"), F.concat(F.lit(" "), "description").alias("Description "), amount.alias("Amount"), F.col("category").alias("Category"))
    two = p.filter("amount <= 0").select(F.col("category").alias("category"), amount.alias("amount"), date.alias("date"), F.col("description").alias("DESCRIPTION"))
    rows = tables.prior_entries([one, p.select("w_id", "date"), two])
    return rows.groupBy("date", "description", "amount", "category").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- stages and pipelines


@query("vendor_map_roundtrip", MAP_SQL)
def _(s: Source) -> DataFrame:
    """Save half of the learning, load it, learn the rest from the loaded map, save over it and load again."""
    path = f"{shared_folder(s.spark)}/vendor_map_{uuid.uuid4().hex}"
    reviewed = s.adapter("decision").filter(F.year("date") < SPLIT_YEAR).withColumns({"year": F.year("date"), "seq": F.col("txn_id")})
    reviewed = with_middle(reviewed)
    sinks.save_vendor_map(learning.learn_from_reviews(tables.load_vendor_map(s.spark, path), reviewed.filter("txn_id <= m")), path)
    sinks.save_vendor_map(learning.learn_from_reviews(tables.load_vendor_map(s.spark, path), reviewed.filter("txn_id > m")), path)
    return tables.load_vendor_map(s.spark, path)


BUSINESS = pipeline.Business(
    STR_PROPERTIES, LTR_PROPERTIES, cards=CARDS, pm_payer=PAYER, payout_patterns=PAYOUT_PATTERNS, card_patterns=CARD_PATTERNS,
    worksheet_rules=maps.WORKSHEET, card_sign=-1,
)
STATEMENT_ROWS_SQL = f"""
SELECT 'checking' AS kind, amount,
  CASE WHEN section = 'checks_paid' THEN 'Check #' || CASE WHEN txn_id % 13 = 0 THEN '(unknown)' ELSE CAST(1000 + txn_id % 9000 AS STRING) END
       ELSE trim(description) || CASE WHEN txn_id % 4 = 0 THEN ' Descr:Payment Sec:Web Ind Name:Sample Trn: ' || CAST(txn_id AS STRING) || 'Tc' ELSE '' END END AS description
FROM (SELECT *, {CHECK_SECTION_SQL} AS section FROM <<ledger>> AS l) AS x
UNION ALL SELECT 'card', amount, trim(description) FROM <<ledger>> AS l
"""


@query("statements_to_tags", f"""
SELECT k.kind, CASE WHEN m.vendor IS NULL THEN 'unknown' WHEN m.ambiguous THEN 'ambiguous' ELSE 'auto' END AS source, coalesce(m.category, '') AS category,
  count(*) AS n, CAST(sum(k.amount) AS DOUBLE) AS amount
FROM (SELECT *, {key_sql('description')} AS vendor FROM ({STATEMENT_ROWS_SQL}) AS r) AS k LEFT JOIN ({MAP_SQL}) AS m ON k.vendor = m.vendor
WHERE NOT CASE WHEN kind = 'card' THEN contains(lower(k.description), 'building iran')
  ELSE k.amount > 0 AND (contains(lower(k.description), 'furniture kenya') OR contains(lower(k.description), 'household peru')) END
GROUP BY 1, 2, 3""")
def _(s: Source) -> DataFrame:
    """Statement texts of both kinds, parsed, united with one sign and tagged."""
    ledger = durable(s.adapter("ledger"))
    rows = pipeline.ingest(render.checking_statements(ledger), render.card_statements(ledger), BUSINESS, strict=False)
    tagged, _ = pipeline.tag(durable(rows), learned_map(s), BUSINESS)
    return tagged.groupBy("kind", "source", "category").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("build_from_worksheet", f"""
SELECT property, template_category, CAST(round(sum(abs(amount)), 2) AS DOUBLE) AS amount FROM (
  SELECT prop AS property, exp AS template_category, CAST(cost AS DECIMAL(28,10)) AS amount FROM ({WORKSHEET_CLASS_SQL}) AS c WHERE cat = 'STR'
  UNION ALL
  SELECT p.property, exp, CAST(cost / 4.0 AS DECIMAL(28,10)) FROM ({WORKSHEET_CLASS_SQL}) AS c, (VALUES ('S1'), ('S2'), ('S3'), ('S4')) AS p(property) WHERE cat = 'STR - Split'
  UNION ALL
  SELECT property, 'Sales revenue', CAST(sum(payout) AS DECIMAL(28,10)) FROM <<earning_base>> AS e WHERE event_type = 'purchase' GROUP BY property
  UNION ALL
  SELECT property, 'Interest expense', CAST(amount AS DECIMAL(28,10)) FROM ({INTEREST_SQL}) AS i WHERE property LIKE 'S%'
) AS i GROUP BY property, template_category""")
def _(s: Source) -> DataFrame:
    interest = tables.interest_by_year(interest_nested(s), year=1998).withColumn("year", F.lit(1999))
    return pipeline.build_from_worksheet(
        worksheet_rows(s), BUSINESS, year=1999, earnings=tables.earnings_by_position(earnings_raw(s), year=2024), interest=interest)


_LAYOUT_PRINTED = "cin + CASE WHEN doc_id % 10000000000 % 4 = 0 THEN 1 ELSE 0 END"
_LAYOUT_ENTITY = "CAST(doc_id AS STRING) || '/' || CAST(p * 1000 + 1 AS STRING)"
_LAYOUT_DOCS = f"(SELECT doc_id, sum(cin) AS cin, sum(cout) AS cout, count(*) AS n FROM ({PROP_SQL}) AS q GROUP BY doc_id) AS g"


@query("guard_pm_layout", "\nUNION ALL\n".join([
    check_sql(_LAYOUT_ENTITY, "balance_formula", "500 + cin - cout", "500 + cin - cout", "0.02", f"({PROP_SQL}) AS q"),
    check_sql(_LAYOUT_ENTITY, "printed_cash_in", "cin", _LAYOUT_PRINTED, "0.02", f"({PROP_SQL}) AS q"),
    check_sql(_LAYOUT_ENTITY, "printed_cash_out", "cout", "cout", "0.02", f"({PROP_SQL}) AS q"),
    check_sql(_LAYOUT_ENTITY, "sum_cash_in", _LAYOUT_PRINTED, "cin", "0.02", f"({PROP_SQL}) AS q"),
    check_sql(_LAYOUT_ENTITY, "sum_cash_out", "cout", "cout", "0.02", f"({PROP_SQL}) AS q"),
    check_sql("doc_id", "consolidated_beginning", "500 * n", "500 * n", "0.02", _LAYOUT_DOCS),
    check_sql("doc_id", "consolidated_cash_in", "cin", "cin", "0.02", _LAYOUT_DOCS),
    check_sql("doc_id", "consolidated_cash_out", "-cout", "-cout", "0.02", _LAYOUT_DOCS),
]))
def _(s: Source) -> DataFrame:
    """The six invariants on parsed word-box statements whose printed totals carry seeded errors."""
    words = durable(render.layout_words(s.adapter("ledger")))
    parsed = pipeline.ingest_owner_statements(words, OWNER, strict=False)
    by_page = lambda df: df.withColumn("property_id", F.col("property_page"))
    return guards.pm_report_checks(parsed.reports, by_page(parsed.properties), by_page(parsed.transactions))


OWNER = pipeline.Business(STR_PROPERTIES, LTR_PROPERTIES, pm_payer=PAYER, property_rules=render.PROPERTY_RULES, property_header="SW ")


# ---------------------------------------------------------------- end to end


@query("ledger_to_pnl", f"""
SELECT property, template_category, CAST(round(sum(abs(amount)), 2) AS DOUBLE) AS amount FROM (
  SELECT property, CASE WHEN expense_type = '' THEN 'other' ELSE expense_type END AS template_category, CAST(amount AS DECIMAL(28,10)) AS amount
  FROM ({TAGGED_SQL}) AS a WHERE source = 'auto' AND category IN ('STR', 'LTR')
  UNION ALL
  SELECT r.property, CASE WHEN r.expense_type = '' THEN 'other' ELSE r.expense_type END, CAST(l.amount AS DECIMAL(28,10))
  FROM ({RESOLVED_SQL}) AS r JOIN <<ledger>> AS l ON r.txn_id = l.txn_id WHERE r.category IN ('STR', 'LTR')
  UNION ALL
  SELECT p.property, r.expense_type, CAST(l.amount / 4.0 AS DECIMAL(28,10))
  FROM ({RESOLVED_SQL}) AS r JOIN <<ledger>> AS l ON r.txn_id = l.txn_id, (VALUES ('S1'), ('S2'), ('S3'), ('S4')) AS p(property) WHERE r.category = 'STR - Split'
) AS items WHERE property <> '' GROUP BY property, template_category""")
def ledger_to_pnl(s: Source) -> DataFrame:
    """Flagship: learn, categorize, queue, decide, split and roll up."""
    tagged = durable(tagged_ledger(s))
    queued = categorize.review_queue(tagged).withColumn(
        "ord", F.col("queue_part").cast("bigint") * 1_000_000_000_000 + F.col("txn_id"))
    table = review.transaction_table(queued, year=SPLIT_YEAR)
    by_vendor = durable(review.vendor_decisions(typed_vendors(review.group_by_vendor(queued))))
    decided = review.resolve(table, by_vendor, review.row_overrides(typed_rows(table)))
    columns = ["txn_id", "date", "description", "amount", "category", "property", "expense_type", "source"]
    booked = rollup.tagged_union(tagged.filter("source = 'auto'").select(*columns), decided.select(*columns))
    items = rollup.tagged_items(booked, "STR", STR_PROPERTIES).unionByName(rollup.tagged_items(booked, "LTR", LTR_PROPERTIES))
    return rollup.rollup(items)
