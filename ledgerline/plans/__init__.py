"""Compositions of operators: the matching cascade and the daily jobs."""
