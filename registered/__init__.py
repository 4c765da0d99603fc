"""Queries registered for checking: inputs derived from the given tables, queries, equivalent SQL."""
