"""Delimited file readers, stored tables and the load ledger."""
