"""Readers for the daily file drop and for the bank's tables."""
