"""Feature tables from raw rows to model rows; only a code table is computed on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecast.functions.temporal import calendar_columns
from lakecast.operators.aggregates import group_series
from lakecast.operators.encoding import build_code_table, encode
from lakecast.operators.windows import (
    add_lags,
    add_trailing_means,
    drop_null_lags,
    drop_null_means,
)
from lakecast.series import SeriesSpec
from lakecast.session import cut_lineage


def group_hourly(
    df: DataFrame, time: str, keys: Sequence[str], sums: Mapping[str, str | Column]
) -> DataFrame:
    """Sum the measures at the time and key grain, collapsing all finer columns."""
    return group_series(df, F.col(time), keys, sums)


def group_daily(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    sums: Mapping[str, str | Column],
    name: str = "transit_date",
) -> DataFrame:
    return group_series(df, F.to_date(time).alias(name), keys, sums)


def encode_keys(
    df: DataFrame, code_table: DataFrame, columns: Sequence[str], keep_labels: bool = False
) -> DataFrame:
    """Label columns replaced by (or next to) their codes."""
    return encode(df, code_table, columns, keep_labels)


def encode_series(
    series: DataFrame, columns: Sequence[str], code_table: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Grouped series with codes in place of labels, and the code table.

    Without a code table one is built from the series. The series is checkpointed first:
    it is far smaller than the raw rows, and so those are scanned only once.
    """
    if code_table is None:
        series = cut_lineage(series)
        code_table = build_code_table(series, columns)
    return encode(series, code_table, columns, keep_labels=False), code_table


def store_series(series: DataFrame, name: str, spec: SeriesSpec, buckets: int) -> DataFrame:
    """Keep a series as catalog table ``name``, bucketed by its keys and sorted by time, and read it back.

    Lags, averages and whatever else runs over series start from the buckets, each with one file: no feature run shuffles
    again. Take about as many buckets as a run should have tasks.
    """
    order = [*spec.keys, spec.time]
    dealt = series.repartition(buckets, *spec.keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *spec.keys).sortBy(*order).saveAsTable(name)
    return series.sparkSession.table(name)


def add_calendar(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(spec.time), spec.cycles))


def fill_gaps(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Every day or hour between a series' first and last row, measures 0 where absent.

    Off by default: lags count observed rows.
    """
    step = F.expr("interval 1 day" if spec.unit == "day" else "interval 1 hour")
    spans = df.groupBy(*spec.keys).agg(F.min(spec.time).alias("_a"), F.max(spec.time).alias("_b"))
    times = spans.select(*spec.keys, F.explode(F.sequence("_a", "_b", step)).alias(spec.time))
    on = [F.col(f"t.{c}").eqNullSafe(F.col(f"d.{c}")) for c in (*spec.keys, spec.time)]
    measures = [spec.value, *(c for c in spec.carried if c in df.columns)]
    return (
        times.alias("t")
        .join(df.alias("d"), on, "left")
        .select(
            *(F.col(f"t.{c}") for c in (*spec.keys, spec.time)),
            *(F.coalesce(F.col(f"d.{m}"), F.lit(0)).alias(m) for m in measures),
        )
    )


def model_table(
    series: DataFrame,
    spec: SeriesSpec,
    gap_fill: str | None = None,
    split_rows: int | None = None,
) -> DataFrame:
    """Calendar, lags and averages; rows without full lags or without averages are dropped.

    Averages are taken over the rows the lag filter left, so a series loses its first
    ``n_lags`` rows and one more. The calendar is added after the lags: only the bare
    series is shuffled, and the averages reuse its partitioning and order.

    ``split_rows`` cuts long series into segments of that many rows, which run in parallel.
    """
    if gap_fill not in (None, "zero"):
        raise ValueError("gap_fill is None or 'zero'")
    rows = fill_gaps(series, spec) if gap_fill else series
    lagged = drop_null_lags(add_lags(rows, spec, split_rows), spec)
    averaged = add_trailing_means(add_calendar(lagged, spec), spec, split_rows)
    fixed = [c for c in rows.columns if c not in spec.calendar]
    return drop_null_means(averaged, spec).select(*fixed, *spec.calendar, *spec.lags, *spec.means)
