"""Composed plans: the feature plan, the registered query catalogue and its
DuckDB oracle statements."""
