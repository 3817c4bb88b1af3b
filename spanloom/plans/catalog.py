"""Modules whose import registers queries."""

MODULES = ["plans.q_intervals", "plans.q_aligned", "plans.q_records", "plans.q_variants"]
