"""Batch analytics over collaborative map-edit histories, written for Spark.

Edits are rolled up into changesets, changesets are assigned to mapping
projects by contributor, activity period and project area, grouped into edit
sessions with estimated labour hours, and summarised per user, month and
project. Every operator is a plain function from DataFrames to a DataFrame
built from native column expressions, so Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
