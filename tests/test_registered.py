"""Registered queries against their SQL on the smallest tables (all of them: ``python tools/check_oracles.py``)."""

import os
import random
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from workload.adapters import TABLES
from workload.registry import QUERIES

TEXT = [n for n in queries() if n == "pipeline" or n.startswith("op")]

CHECKED = ("vendor_key", "learn_vendor_map", "review_transactions", "pnl_scanned_layout", "double_count",
           "duplicate_members", "stmt_generic", "pm_text", "cashflow", "compare_report", "match_date_amount_contested",
           "match_fuzzy_contested", "double_count_contested", "double_count_strict", "pm_detail_sink", "build_year",
           "stmt_card_totals", "match_date_amount_crowded", "match_fuzzy_between", "duplicates_strict", "pm_layout_errors", "pm_layout_long",
           "cashflow_long", "vendor_map_roundtrip", "category_map", "worksheet_items", "match_prefills", "full_text")


def key(row):
    return tuple((x is None, str(x)) for x in row)


def cell(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, con, name):
    df = queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted([tuple(cell(r[c]) for c in columns) for r in df.collect()], key=key)
    rel = con.execute(oracle_sql()[name])
    names = [x[0] for x in rel.description]
    want = sorted([tuple(cell(r[names.index(c)]) for c in columns) for r in rel.fetchall()], key=key)
    assert sorted(names) == columns and got == want and got


def test_every_query_has_sql():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(TEXT) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["property", "template_category", "amount"]


def test_everything_else_works_without_the_text_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()), set(e.queries()) == set(e.oracle_sql()))"],
        cwd=tmp_path / "repo", capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert said.returncode == 0, said.stderr
    n, text, same = said.stdout.split()
    assert int(n) > 70 and text == "False" and same == "True"


@pytest.mark.parametrize("name", ["match_date_amount", "match_prefills", "match_fuzzy", "learn_from_prior", "prior_learning_report"])
def test_rows_with_copies_equal_sql(spark, sf, tmp_path, name):
    """Every order twice under shifted keys: several rows compete for each partner."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t}_1 AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        more = "UNION ALL SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders_1" if t == "orders" else ""
        con.execute(f"COPY (SELECT * FROM {t}_1 {more}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    df = queries()[name](spark, str(tmp_path))
    got = sorted([tuple(cell(r[c]) for c in df.columns) for r in df.collect()], key=key)
    want = sorted([tuple(map(cell, r)) for r in con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracle_sql()[name]})").fetchall()], key=key)
    assert got == want and got


@pytest.mark.parametrize("name", ["vendor_map_roundtrip", "learn_in_two_steps"])
def test_rows_are_halved_once(spark, sf, con, name, monkeypatch):
    """On large tables the sketch of the middle gives another number each time it is computed; here it always does."""
    expr, draw = F.expr, F.udf(lambda low, high: random.SystemRandom().randint(low, high), "long").asNondeterministic()
    monkeypatch.setattr(F, "expr", lambda text: draw(F.min("txn_id"), F.max("txn_id")) if text.startswith("percentile_approx") else expr(text))
    df = queries()[name](spark, sf)
    got = sorted([tuple(cell(r[c]) for c in df.columns) for r in df.collect()], key=key)
    want = sorted([tuple(map(cell, r)) for r in con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracle_sql()[name]})").fetchall()], key=key)
    assert got == want and got
