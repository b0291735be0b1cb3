"""Ledger repair, reconciliation and data hygiene as Spark DataFrame jobs."""
