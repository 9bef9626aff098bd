"""Control checks. Each returns ``(entity, check, expected, actual, delta, ok)``; ``enforce`` turns failures into an error."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip
from ledgerloom.scale import durable, join_unique, shared_folder

CENTS = 0.02


class GuardError(Exception):
    """Some checks failed: ``failed`` is the stored table of all failed rows, ``count`` their number, ``path`` its place."""

    def __init__(self, failed: DataFrame, count: int, path: str):
        self.failed, self.count, self.path = failed, count, path
        super().__init__(f"{count} failed rows, stored in {path}")


def enforce_empty(findings: DataFrame, path: str | None = None) -> None:
    """Strict mode of detectors (duplicates, double counts): any finding is an error; all are stored."""
    path = path or f"{shared_folder(findings.sparkSession)}/failed-{uuid.uuid4().hex}"
    findings.write.mode("overwrite").parquet(path)
    stored = findings.sparkSession.read.schema(findings.schema).parquet(path)
    count = stored.count()
    if count:
        raise GuardError(stored, count, path)


def enforce(checks: DataFrame, path: str | None = None) -> None:
    """Raise ``GuardError`` when a check failed; all failed rows are stored."""
    enforce_empty(checks.filter("NOT ok"), path)


def _checks(df: DataFrame, entity: Column, specs: list[tuple[str, Column, Column, float]]) -> DataFrame:
    """Unpivot ``(name, expected, actual, tolerance)`` into rows; a side that is missing skips the check."""
    def one(name: str, expected: Column, actual: Column, tol: float) -> Column:
        delta = actual - expected
        return F.struct(
            F.lit(name).alias("check"),
            expected.cast("double").alias("expected"),
            actual.cast("double").alias("actual"),
            delta.cast("double").alias("delta"),
            (F.abs(delta) <= F.lit(str(tol)).cast("decimal(18,2)")).alias("ok"),
        )

    rows = df.select(entity.cast("string").alias("entity"), F.inline(F.array(*[one(*s) for s in specs])))
    return rows.filter("delta IS NOT NULL")


def statement_checks(headers: DataFrame, txns: DataFrame, *, tolerance: float = CENTS) -> DataFrame:
    """Balance change, deposits and withdrawals of generic statements against their transactions."""
    zero = F.lit(0).cast("decimal(18,2)")
    sums = txns.groupBy("doc_id").agg(
        F.sum("amount").alias("total"),
        F.sum(F.when(F.col("amount") > 0, F.col("amount"))).alias("plus"),
        F.sum(F.when(F.col("amount") < 0, F.col("amount"))).alias("minus"),
    )
    both = headers.join(sums, "doc_id", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("total", "plus", "minus")}
    )
    stated = F.col("total_deposits").isNotNull() & F.col("total_withdrawals").isNotNull()
    return _checks(both, F.col("doc_id"), [
        ("balance_delta", F.col("ending") - F.col("beginning"), F.col("total"), tolerance),
        ("deposits", F.when(stated, F.col("total_deposits")), F.col("plus"), tolerance),
        ("withdrawals", F.when(stated, -F.col("total_withdrawals")), F.col("minus"), tolerance),
    ])


def section_checks(statements: DataFrame, txns: DataFrame, *, tolerance: float = CENTS) -> DataFrame:
    """Printed instance counts per section and the balance formula of checking statements."""
    sections = ("deposits", "checks_paid", "electronic_withdrawals", "fees")
    sums = txns.groupBy("doc_id").agg(
        F.sum("amount").alias("total"),
        *[F.count_if(F.col("section") == s).alias(f"n_{s}") for s in sections],
    )
    both = statements.join(sums, "doc_id", "left")
    counts = [
        (f"count_{s}", F.col("instance_counts")[s].cast("decimal(18,2)"),
         F.coalesce(f"n_{s}", F.lit(0)).cast("decimal(18,2)"), 0.0)
        for s in sections
    ]
    formula = ("balance", F.col("ending") - F.col("beginning"),
               F.coalesce("total", F.lit(0).cast("decimal(18,2)")), tolerance)
    return _checks(both, F.col("doc_id"), [*counts, formula])


def cycle_checks(statements: DataFrame, txns: DataFrame, *, tolerance: float = CENTS) -> DataFrame:
    """Card rows per cardholder against the printed cycle subtotal."""
    printed = statements.select("doc_id", F.explode("cycle_totals").alias("cardholder", "printed"))
    sums = txns.groupBy("doc_id", "cardholder").agg(F.sum("amount").alias("total"))
    both = printed.join(sums, ["doc_id", "cardholder"], "left")
    return _checks(both, F.concat_ws("/", "doc_id", "cardholder"), [
        ("cycle_total", F.col("printed"), F.coalesce("total", F.lit(0).cast("decimal(18,2)")), tolerance)
    ])


def pm_report_checks(reports: DataFrame, properties: DataFrame, txns: DataFrame, *, tolerance: float = CENTS) -> DataFrame:
    """Six invariants of owner statements: rows, properties and consolidated totals agree.

    ``properties`` and ``txns`` share ``doc_id, property_id``.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    sums = txns.groupBy("doc_id", "property_id").agg(F.sum("cash_in").alias("txn_in"), F.sum("cash_out").alias("txn_out"))
    props = properties.join(sums, ["doc_id", "property_id"], "left")

    def z(c: str) -> Column:
        return F.coalesce(c, zero)

    per_property = _checks(props, F.concat_ws("/", "doc_id", "property_id"), [
        ("balance_formula", F.col("ending_balance"),
         F.col("beginning_balance") + z("cash_in") + z("cash_out") + z("owner_disbursements"), tolerance),
        ("printed_cash_in", F.col("cash_in"), F.col("total_cash_in_printed"), tolerance),
        ("printed_cash_out", -(F.col("cash_out") + z("owner_disbursements")), F.col("total_cash_out_printed"), tolerance),
        ("sum_cash_in", F.col("total_cash_in_printed"), z("txn_in"), tolerance),
        ("sum_cash_out", F.col("total_cash_out_printed"), z("txn_out"), tolerance),
    ])
    fields = ("beginning", "cash_in", "cash_out", "owner_disbursements", "ending")
    source = {"beginning": "beginning_balance", "ending": "ending_balance"}
    totals = properties.groupBy("doc_id").agg(*[F.sum(source.get(f, f)).alias(f"sum_{f}") for f in fields])
    both = reports.join(totals, "doc_id", "left")
    consolidated = _checks(both, F.col("doc_id"), [
        (f"consolidated_{f}", F.col(f"consolidated_{source.get(f, f)}"), z(f"sum_{f}"), tolerance) for f in fields
    ])
    return per_property.unionByName(consolidated)


def platform_check(platform_total: DataFrame, bank_total: DataFrame, *, tolerance: float = 500.0) -> DataFrame:
    """Platform payouts against bank deposits: two one-row totals named ``total``."""
    zero = F.lit(0).cast("decimal(18,2)")
    both = platform_total.select(F.coalesce("total", zero).alias("platform")).join(
        bank_total.select(F.coalesce("total", zero).alias("bank")), F.lit(True)
    )
    return _checks(both, F.lit("platform"), [("platform_vs_bank", F.col("platform"), F.col("bank"), tolerance)])


def split_checks(originals: DataFrame, shares: DataFrame, *, tolerance: float = 0.01) -> DataFrame:
    """Shares add back to the row they came from: ``originals(source_id, amount)``, ``shares(source_id, amount)``."""
    sums = shares.groupBy("source_id").agg(F.sum("amount").alias("total"))
    both = originals.join(sums, "source_id", "left")
    return _checks(both, F.col("source_id"), [("split", F.col("amount"), F.coalesce("total", F.lit(0)), tolerance)])


def duplicate_groups(txns: DataFrame) -> DataFrame:
    """Groups of equal (date, amount, description ignoring case and outer blanks) with more than one row."""
    return (
        _with_duplicate_key(txns).groupBy("date", "amount", "dup_description")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"))
        .filter("copies > 1")
    )


def _with_duplicate_key(txns: DataFrame) -> DataFrame:
    return txns.withColumn("dup_description", F.lower(strip(F.col("description"))))


def duplicate_members(txns: DataFrame) -> DataFrame:
    """Every row of a duplicate group, with the size of its group. Members stay rows, never one list."""
    key = ["date", "amount", "dup_description"]
    groups = durable(duplicate_groups(txns).select(*key, "copies"))
    return join_unique(_with_duplicate_key(txns), groups, key, "inner")

