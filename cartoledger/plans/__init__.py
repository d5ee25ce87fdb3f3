"""Composition: the pipeline (R1-R4), the registered queries and their DuckDB oracle."""
