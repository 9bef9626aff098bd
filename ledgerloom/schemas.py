"""Record schemas shared by sources, operators and stage tables."""

from __future__ import annotations

TRANSACTION = "date DATE, description STRING, amount DECIMAL(18,2), balance DECIMAL(18,2), account STRING"

VENDOR_MAP = (
    "vendor STRING, category STRING, confidence DOUBLE, occurrences BIGINT, learned_from ARRAY<INT>, "
    "ambiguous BOOLEAN, property STRING, expense_type STRING, source STRING"
)

PM_TRANSACTION = (
    "date DATE, payee STRING, txn_type STRING, reference STRING, description STRING, "
    "cash_in DECIMAL(18,2), cash_out DECIMAL(18,2), balance DECIMAL(18,2), unit STRING, category STRING"
)

WORDS = "doc_id BIGINT, page INT, word_no INT, text STRING, x0 DOUBLE, top DOUBLE"

STR_EARNING = (
    "property STRING, stay_start DATE, stay_end DATE, platform STRING, gross DECIMAL(18,2), "
    "fees DECIMAL(18,2), net_payout DECIMAL(18,2)"
)

ITEM = "property STRING, template_category STRING, amount DECIMAL(28,10)"
CELL = "sheet STRING, row_no INT, label STRING, raw STRING"
CHECK = "entity STRING, check STRING, expected DOUBLE, actual DOUBLE, delta DOUBLE, ok BOOLEAN"
