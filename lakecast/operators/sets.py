"""Unions and differences, by name only."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def concat_by_name(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new rows; a column only one side has is null on the other."""
    return existing.unionByName(new, allowMissingColumns=True)


def set_difference(all_rows: DataFrame, present: DataFrame) -> DataFrame:
    """Distinct rows of the first input that the second lacks."""
    return all_rows.select(*present.columns).subtract(present)
