"""Joins that find new, missing or known rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecast.functions.temporal import month_label, month_start
from lakecast.session import broadcast_if_small


def anti_new_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Source rows whose key is not in the target.

    ``null_safe`` lets a null key match a null key, so that a second run adds nothing;
    without it such rows count as new each time. Each side is shuffled once, the target
    by its keys alone; a hot key on the source side is left to the adaptive skew join,
    which may split the left side of an anti join.
    """
    known = target.select(*(F.col(k).alias(f"_known_{k}") for k in keys))
    pairs = [
        F.col(k).eqNullSafe(F.col(f"_known_{k}")) if null_safe else F.col(k) == F.col(f"_known_{k}")
        for k in keys
    ]
    return source.join(known, reduce(lambda a, b: a & b, pairs), "left_anti")


def missing_rows(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    dedupe: bool = False,
) -> DataFrame:
    """Insert-only merge: source rows that equal no target row on all ``columns``.

    Comparison is null-safe and covers nested columns. Copies inside the source are all
    kept unless ``dedupe``.
    """
    rows = source.dropDuplicates(list(columns)) if dedupe else source
    return anti_new_rows(rows, target, columns)


def months_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month from column ``start`` to ``end``: ``month_label`` and ``month_start``."""
    months = F.explode(
        F.sequence(
            F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")
        )
    )
    listed = df.select(months.alias("month_start"))
    return listed.select(month_label(F.col("month_start")).alias("month_label"), "month_start")


def expected_months(spark, start: str, end: str) -> DataFrame:
    """Months from ``start`` to ``end``, both given as MM/yyyy."""
    bounds = spark.range(1).select(
        F.to_date(F.lit(start), "MM/yyyy").alias("a"), F.to_date(F.lit(end), "MM/yyyy").alias("b")
    )
    return months_between(bounds, "a", "b")


def months_present(df: DataFrame, time: str) -> DataFrame:
    found = df.select(month_start(F.col(time)).alias("month_start")).distinct()
    return found.select(month_label(F.col("month_start")).alias("month_label"), "month_start")


def missing_months(expected: DataFrame, existing: DataFrame) -> DataFrame:
    return expected.join(existing.select("month_start"), "month_start", "left_anti").select(
        "month_label", "month_start"
    )


def member_flag(
    df: DataFrame, column: str, allowed: DataFrame, allowed_column: str, name: str
) -> DataFrame:
    """Adds boolean ``name``: is ``column`` among the allowed values? Null stays null.

    The allowed values are made distinct first, so no row is multiplied; they are
    broadcast when a count shows them to be small.
    """
    values = allowed.select(F.col(allowed_column).alias("_allowed")).distinct()
    listed = broadcast_if_small(values.where("_allowed is not null"))
    joined = df.join(listed, F.col(column) == F.col("_allowed"), "left")
    flag = F.when(F.col(column).isNotNull(), F.col("_allowed").isNotNull())
    return joined.withColumn(name, flag).drop("_allowed")


def member_of_dim(
    df: DataFrame, column: str, allowed: DataFrame, allowed_column: str, keep: bool = True
) -> DataFrame:
    """Rows whose value is (``keep``) or is not (``keep=False``) among the allowed ones."""
    listed = broadcast_if_small(allowed.select(F.col(allowed_column).alias("_allowed")).distinct())
    how = "left_semi" if keep else "left_anti"
    return df.join(listed, F.col(column) == F.col("_allowed"), how)


def with_actuals(
    forecast: DataFrame, actual: DataFrame, time: str, keys: Sequence[str], value: str
) -> DataFrame:
    """Forecast rows that have an actual value, with it as ``actual_<value>``."""
    seen = actual.select(time, *keys, F.col(value).alias(f"actual_{value}"))
    return forecast.join(seen, [time, *keys], "inner")
