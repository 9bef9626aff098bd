"""SQL that turns the generated tables into ledger-shaped input.

One text serves both engines: ``<<name>>`` stands for a table or for another adapter. Names of properties, cards and
payers are synthetic.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

STR_PROPERTIES = ("S1", "S2", "S3", "S4")
LTR_PROPERTIES = ("L1", "L2", "L3")
CARDS = ("4001", "4002")
PAYER = "Acme PM"
PAYOUT = "Owner Distributions / S corp Distributions"

ADAPTERS: dict[str, str] = {}

ADAPTERS["ledger"] = """
SELECT o_orderkey AS txn_id, CAST(o_orderdate AS DATE) AS date,
  CASE o_orderkey % 5 WHEN 0 THEN 'POS PURCHASE ' WHEN 1 THEN 'ACH DEBIT ' WHEN 2 THEN 'WIRE OUT '
       WHEN 3 THEN '' ELSE 'Check Card Purchase ' END
  || c_mktsegment || ' ' || n_name
  || CASE o_orderkey % 3 WHEN 0 THEN ' #' || CAST(o_orderkey AS STRING)
       WHEN 1 THEN ' *AB' || CAST(o_orderkey AS STRING)
       ELSE ' ' || CAST(o_orderkey AS STRING) END AS description,
  CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(18,2)) AS amount,
  o_orderpriority AS account
FROM <<orders>> JOIN <<customer>> ON o_custkey = c_custkey JOIN <<nation>> ON c_nationkey = n_nationkey
"""

# Reviewed ledger: category, property and expense type per row, with genuine conflicts and blanks.
ADAPTERS["decision"] = """
SELECT o_orderkey AS txn_id, CAST(o_orderdate AS DATE) AS date,
  CASE o_orderkey % 5 WHEN 0 THEN 'POS PURCHASE ' WHEN 1 THEN 'ACH DEBIT ' WHEN 2 THEN 'WIRE OUT '
       WHEN 3 THEN '' ELSE 'Check Card Purchase ' END
  || c_mktsegment || ' ' || n_name
  || CASE o_orderkey % 3 WHEN 0 THEN ' #' || CAST(o_orderkey AS STRING)
       WHEN 1 THEN ' *AB' || CAST(o_orderkey AS STRING)
       ELSE ' ' || CAST(o_orderkey AS STRING) END AS description,
  CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS DECIMAL(18,2)) AS amount,
  o_orderpriority AS account,
  CASE WHEN n_nationkey = 24 THEN 'Skip'
       WHEN o_orderstatus = 'P' AND c_mktsegment = 'BUILDING' THEN 'Personal'
       WHEN n_regionkey <= 2 THEN 'STR' WHEN n_regionkey = 3 THEN 'LTR' ELSE 'Personal' END AS category,
  CASE WHEN n_regionkey <= 2 THEN 'S' || CAST(c_custkey % 4 + 1 AS STRING)
       WHEN n_regionkey = 3 THEN 'L' || CAST(c_custkey % 3 + 1 AS STRING) ELSE '' END AS property,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Utilities' WHEN '2' THEN 'Supplies' WHEN '3' THEN 'Insurance'
       WHEN '4' THEN '' ELSE 'Repairs and Maintenance' END AS expense_type
FROM <<orders>> JOIN <<customer>> ON o_custkey = c_custkey JOIN <<nation>> ON c_nationkey = n_nationkey
"""

# Tagged ledger with single-property rows, even splits, never-booked rows and blank properties.
ADAPTERS["tagged"] = """
SELECT txn_id, date, description, amount, account, expense_type,
  CASE WHEN txn_id % 10 = 3 AND category = 'STR' THEN 'STR - Split'
       WHEN txn_id % 10 = 4 AND category = 'LTR' THEN 'LTR - Split' ELSE category END AS category,
  CASE WHEN txn_id % 17 = 0 THEN '' ELSE property END AS property
FROM <<decision>> AS d
"""

# Property-manager transactions; line 7 of an order is a payout to the owner.
ADAPTERS["pm_txn"] = """
SELECT l_orderkey * 10 + l_linenumber AS ord, CAST(l_shipdate AS DATE) AS date,
  CASE WHEN l_linenumber = 7 THEN 'Owner Holdings' ELSE n_name || ' Supply ' || chr(CAST(65 + s_suppkey % 26 AS INT)) END AS payee,
  CAST(l_orderkey AS STRING) AS reference,
  CASE WHEN l_linenumber = 7 THEN 'Owner Distributions / S corp Distributions'
       WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN 'Mystery'
       ELSE CASE s_suppkey % 8 WHEN 0 THEN 'Rent Income' WHEN 1 THEN 'Water' WHEN 2 THEN 'Plumbing' WHEN 3 THEN 'Postage'
            WHEN 4 THEN 'Security Deposits' WHEN 5 THEN 'Repair (IA)' WHEN 6 THEN 'Late Fee' ELSE '' END END AS category,
  CASE WHEN l_linenumber <> 7 AND s_suppkey % 8 IN (0, 4, 6) THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS cash_in,
  CASE WHEN l_linenumber = 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + 1000000 * l_orderkey AS DECIMAL(18,2))
       WHEN s_suppkey % 8 IN (0, 4, 6) THEN NULL
       ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS cash_out,
  'L' || CAST(s_suppkey % 3 + 1 AS STRING) AS property
FROM <<lineitem>> JOIN <<supplier>> ON l_suppkey = s_suppkey JOIN <<nation>> ON s_nationkey = n_nationkey
"""

# Deposits that repeat the payouts: some late, some off by one, some without the payer's name.
ADAPTERS["deposits"] = """
SELECT key AS q_id, key AS q_ord,
  CAST(date_add(last_paid, CAST(key % 9 AS INT)) AS DATE) AS date,
  CAST(total + CASE WHEN key % 4 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS amount,
  CASE WHEN key % 5 = 0 THEN 'ACH CREDIT other payer ' ELSE 'ACH CREDIT Acme PM, LLC ' END || CAST(key AS STRING) AS description
FROM (SELECT CAST(reference AS BIGINT) AS key, max(date) AS last_paid, sum(cash_out) AS total
      FROM <<pm_txn>> AS p WHERE category = 'Owner Distributions / S corp Distributions' GROUP BY reference) AS g
"""

# Worksheet rows before they are rendered as text.
ADAPTERS["worksheet_base"] = """
SELECT txn_id, date, amount, account,
  CAST(abs(amount) + CASE txn_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.25 ELSE 0.75 END AS DECIMAL(18,2)) AS cost,
  CASE txn_id % 8 WHEN 0 THEN 'Elm' WHEN 1 THEN ' OAK ' WHEN 2 THEN 'pine' WHEN 3 THEN 'All Cottages'
       WHEN 4 THEN 'Garage' WHEN 5 THEN 'Booth' WHEN 6 THEN 'Boat' ELSE 'Ash' END AS type,
  CASE txn_id % 7 WHEN 0 THEN 'Cleaning Fees' WHEN 1 THEN 'Lawn mowing' WHEN 2 THEN 'HOA dues' WHEN 3 THEN 'wifi service'
       WHEN 4 THEN 'Mystery' WHEN 5 THEN ' Supplies ' ELSE 'Pest control and repairs' END AS label,
  description AS source
FROM <<ledger>> AS l
"""

# Prior filing: the same rows some days later, in other case and with one more word.
ADAPTERS["prior_filing"] = """
SELECT txn_id AS w_id, txn_id AS w_ord, CAST(date_add(date, CAST(txn_id % 6 AS INT)) AS DATE) AS date, amount,
  upper(description) || ' Filed' AS description, category
FROM <<decision>> AS d
"""

# Natural duplicates: order lines whose key occurs more than once.
ADAPTERS["ledger_lines"] = """
SELECT CAST(o_orderdate AS DATE) AS date,
  CASE WHEN l_returnflag = 'A' THEN ' ORDER ' ELSE 'Order ' END || CAST(l_orderkey AS STRING) || ' line ' || CAST(l_linenumber AS STRING) AS description,
  CAST(l_linenumber * 10.5 AS DECIMAL(18,2)) AS amount,
  l_partkey * 100000 + l_suppkey AS ord
FROM <<lineitem>> JOIN <<orders>> ON l_orderkey = o_orderkey
"""

# Earnings rows before they are rendered as text.
ADAPTERS["earning_base"] = """
SELECT event_id, 'S' || CAST(user_id % 4 + 1 AS STRING) AS property, CAST(ts AS DATE) AS stay,
  CAST(value AS DECIMAL(18,2)) AS payout, event_type
FROM <<events>>
"""


_NAME = re.compile(r"<<(\w+)>>")


def expand(sql: str, spark: bool) -> str:
    """Replace ``<<name>>`` by a subquery or a table name, as often as needed."""

    def one(match: re.Match) -> str:
        name = match.group(1)
        if name in ADAPTERS:
            return "(" + ADAPTERS[name].strip() + ")"
        if name not in TABLES:
            raise KeyError(name)
        return "{" + name + "}" if spark else name

    # Shifts of bits (``1 << n``) stay as they are.
    while _NAME.search(sql):
        sql = _NAME.sub(one, sql)
    if not spark:
        sql = re.sub(r"date_add\((\w+), CAST\(([^()]*) AS INT\)\)", r"(\1 + CAST(\2 AS INT))", sql)
    return sql


def oracle(sql: str) -> str:
    return expand(sql, spark=False).strip()


class Source:
    """The tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, sql: str) -> DataFrame:
        text = expand(sql, spark=True)
        used = [t for t in TABLES if "{" + t + "}" in text]
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    def adapter(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM <<{name}>> AS a")
