"""Operators: cleaning, zones, aggregations, keyed changes."""
