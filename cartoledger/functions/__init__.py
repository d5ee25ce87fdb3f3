"""Column helpers: geometry, text, time and rounding expressions (no UDFs)."""

from . import geo, rounding, sql, text, timeops  # noqa: F401
