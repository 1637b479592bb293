"""Columns, checks, incremental windows and keyed merges."""
