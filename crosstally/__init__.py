"""Ledger matching and settlement analytics as PySpark DataFrame operators."""
