"""Grouping, counting and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecast.functions.numeric import rounded_long


def group_series(
    df: DataFrame,
    time: Column,
    keys: Sequence[str | Column],
    sums: Mapping[str, str | Column],
) -> DataFrame:
    """Sum measures per time and key, each value first rounded to a whole number.

    Partial sums are built before the shuffle, so a key that holds a third of the raw
    rows still arrives as one row per task, time and key.
    """
    measures = [
        F.sum(rounded_long(F.col(m) if isinstance(m, str) else m)).alias(name)
        for name, m in sums.items()
    ]
    return df.groupBy(time, *keys).agg(*measures)


def max_time(df: DataFrame, time: str):
    """Largest time as a value; None on empty input."""
    return df.agg(F.max(time)).first()[0]


def count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(columns)) if columns else df.distinct()


def global_sum(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.sum(column).alias(name))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def latest_row(df: DataFrame, time: str, *tie_breakers: str) -> DataFrame:
    """The newest row; ties go to the largest tie breaker. A top-1, not a sort of everything."""
    order = [F.col(c).desc_nulls_last() for c in (time, *tie_breakers)]
    return df.orderBy(*order).limit(1)


def regression_metrics(
    df: DataFrame, label: str, prediction: str = "prediction"
) -> DataFrame:
    """rmse, mse and mae in one pass."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    mse = F.avg(error * error)
    return df.agg(
        F.sqrt(mse).alias("rmse"), mse.alias("mse"), F.avg(F.abs(error)).alias("mae")
    )
