"""Reusable operators: dedup, incremental and versioned tables, joins, checks, profiling, governance, logs, neighbours."""
