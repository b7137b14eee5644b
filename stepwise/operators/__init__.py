"""Operators over interval, series and ledger tables."""
