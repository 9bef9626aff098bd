"""Sums of many amounts need more digits than one amount: yearly totals beyond 16 digits before the point."""

import datetime as dt

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from workload.adapters import TABLES

KEYS = (9_000_000_001, 9_000_000_002, 9_000_000_003)


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """Three owner payouts of nine digits of millions each, all of one property and year, and a rent."""
    path = str(tmp_path_factory.mktemp("large"))
    for t in ("nation", "supplier"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    when = dt.datetime(1998, 3, 4)
    rows = [(k, 1, 3, 7, 1000.25, "N", when) for k in KEYS] + [(5, 1, 0, 1, 12.5, "N", when)]
    spark.createDataFrame(
        rows, "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_extendedprice DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ"
    ).coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return path


def cells(rows, columns):
    return sorted((tuple(round(r[c], 2) if isinstance(r[c], float) else r[c] for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["cashflow", "cashflow_totals", "cashflow_items", "cashflow_long", "build_year"])
def test_yearly_totals_of_many_digits(spark, folder, name):
    df = queries()[name](spark, folder)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        if t in ("nation", "supplier", "lineitem"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    rel = con.execute(oracle_sql()[name])
    names = [x[0] for x in rel.description]
    want = [dict(zip(names, r)) for r in rel.fetchall()]
    assert cells(df.collect(), columns) == cells(want, columns) and want


def test_owner_report_of_many_digits(spark, folder):
    found = {(r["entity"], r["check"]): r for r in queries()["guard_pm_report"](spark, folder).collect()}
    total = sum(k * 1_000_000 + 1000.25 for k in KEYS)
    assert found["1998", "consolidated_owner_disbursements"]["expected"] == pytest.approx(-total, rel=1e-15)
    assert found["1998/L1", "sum_cash_out"]["ok"]
    assert found["1998/L1", "sum_cash_in"]["actual"] == 12.5
