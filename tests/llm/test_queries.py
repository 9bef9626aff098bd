"""Registered text queries: SQL where there is some, and the promised columns."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerloom.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_pack": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op2_near_dedup": ["doc_id", "class_id", "class_size"],
    "op3_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_lm_score": ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
    "op5_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"],
    "op10_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op13_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_rows_and_columns(spark, sf, name):
    df = queries()[name](spark, sf)
    rows = df.collect()
    assert df.columns == COLUMNS[name]
    if "doc_id" in df.columns:
        assert {r["doc_id"] for r in rows} == set(range(200)) and (name == "op1_pack" or len(rows) == 200)
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        rel = con.execute(ORACLES[name])
        names = [d[0] for d in rel.description]
        want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in rel.fetchall())
        assert sorted(tuple(r) for r in rows) == want
