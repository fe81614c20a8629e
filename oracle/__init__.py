"""Equivalent ANSI SQL for the registered queries, runnable by DuckDB."""
