"""Ledger ingestion, categorization, reconciliation and P&L rollup as Spark jobs."""
