"""Operators: table-building transforms, filters, set ops, checks, analyses."""
