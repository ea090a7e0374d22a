"""Operators: index, search, results, reports, records, metrics, symbols."""
