"""Registered queries (one per inventory key) and their DuckDB oracles."""
