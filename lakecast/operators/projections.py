"""Column selection, casting and row filters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.functions.temporal import (
    TEXT_FORMAT,
    nanos_to_text,
    nanos_to_timestamp,
    parse_timestamp,
    shift,
)
from lakecast.series import SeriesSpec


def select_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Every column of ``schema`` cast to its type; text that does not fit becomes null."""
    casts = []
    for field in schema.fields:
        c = F.col(field.name)
        tolerant = isinstance(df.schema[field.name].dataType, T.StringType)
        cast = c.try_cast(field.dataType) if tolerant else c.cast(field.dataType)
        casts.append(cast.alias(field.name))
    return df.select(*casts)


def cast_measures(df: DataFrame, columns: Sequence[str], to: str = "float") -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def normalise_time(df: DataFrame, time: str, as_text: bool = False) -> DataFrame:
    """Epoch nanoseconds to timestamp, or to ``yyyy-MM-dd HH:mm:ss`` text for an outer edge."""
    convert = nanos_to_text if as_text else nanos_to_timestamp
    return df.withColumn(time, convert(F.col(time)))


def derive_year(df: DataFrame, time: str, name: str = "year") -> DataFrame:
    return df.withColumn(name, F.year(F.col(time).cast("timestamp")))


def clean_relevant(
    df: DataFrame,
    time: str,
    labels: Sequence[str],
    measures: Sequence[str],
    fmt: str = TEXT_FORMAT,
) -> DataFrame:
    """Parsed time, the label columns, and the measures as doubles; all else is dropped."""
    t = F.col(time)
    if isinstance(df.schema[time].dataType, T.StringType):
        t = parse_timestamp(t, fmt).alias(time)
    return df.select(t, *labels, *(F.col(m).cast("double").alias(m) for m in measures))


def time_range(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Closed range; the bounds are cast to the column's own type, so files can be skipped."""
    kind = df.schema[time].dataType
    return df.where(F.col(time).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def temporal_split(df: DataFrame, time: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cutoff`` and rows from it on."""
    at = F.lit(cutoff).cast(df.schema[time].dataType)
    return df.where(F.col(time) < at), df.where(F.col(time) >= at)


def latest(df: DataFrame, time: str) -> Column:
    """Largest time of ``df`` as an uncorrelated scalar subquery."""
    return df.agg(F.max(time)).scalar()


def filter_at_max(df: DataFrame, time: str) -> DataFrame:
    return df.where(F.col(time) == latest(df, time))


def filter_last_k(df: DataFrame, spec: SeriesSpec, units: int | None = None) -> DataFrame:
    """Rows of the last ``units`` days or hours (``spec.history`` by default) up to the latest."""
    back = (units or spec.history) - 1
    top = latest(df, spec.time)
    return df.where(
        F.col(spec.time) >= df.agg(shift(F.max(spec.time), -back, spec.unit)).scalar()
    ).where(F.col(spec.time) <= top)


def filter_after_max_of(df: DataFrame, time: str, other: DataFrame) -> DataFrame:
    return df.where(F.col(time) > latest(other, time))


def since_high_water(df: DataFrame, time: str, high_water) -> DataFrame:
    """Rows at or after ``high_water``, given as a value so that the scan can skip files."""
    if high_water is None:
        return df
    return df.where(F.col(time) >= F.lit(high_water).cast(df.schema[time].dataType))


def drop_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with no null in ``columns``.

    One condition per column: a single condition over all of them, as ``na.drop`` makes,
    has 2^n rewritings once the columns are computed ones, and the optimizer lists them.
    """
    return df.where(reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True)))


def on_date(df: DataFrame, time: str, date: str) -> Column:
    """The rows of one calendar date, as a range in the column's own type so files can be skipped."""
    kind, day = df.schema[time].dataType, F.lit(date).cast("date")
    return (F.col(time) >= day.cast(kind)) & (F.col(time) < F.date_add(day, 1).cast(kind))


def match_date(df: DataFrame, time: str, date: str) -> DataFrame:
    return df.where(on_date(df, time, date))


def remove_date(df: DataFrame, time: str, date: str) -> DataFrame:
    """The complement of ``match_date``; rows without a time are no match and stay."""
    return df.where(~F.coalesce(on_date(df, time, date), F.lit(False)))


def equality_filter(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    left_out = set(exclude)
    return [c for c in df.columns if c not in left_out]


def next_time(df: DataFrame, spec: SeriesSpec) -> Column:
    """Time of the step after the latest row, as a scalar subquery."""
    return df.agg(shift(F.max(spec.time), 1, spec.unit)).scalar()


def shifted_lags(spec: SeriesSpec, value: str | None = None) -> list[Column]:
    """Lags as the next step sees them: lag 1 is the current value, lag k+1 the old lag k."""
    source = (value or spec.value, *spec.lags[:-1])
    return [F.col(old).alias(new) for old, new in zip(source, spec.lags, strict=True)]


def null_field_count(df: DataFrame, pattern: str) -> Column:
    """How many fields whose name matches ``pattern`` are null in a row.

    Plain null tests on the matching columns; no detour over the row's JSON text.
    """
    hits = [c for c in df.columns if re.fullmatch(pattern, c)]
    if not hits:
        return F.lit(0)
    return sum((F.col(c).isNull().cast("int") for c in hits[1:]), F.col(hits[0]).isNull().cast("int"))
