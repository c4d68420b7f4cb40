"""Queries over the given tables: derived ledgers, the registered queries, their SQL."""
