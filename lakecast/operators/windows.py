"""Lags and trailing averages per series.

A series has one row per day or hour once it is grouped, so its length is bounded by the
calendar and a plain window fits. For series that are still too long for one task,
``split_rows`` cuts each into segments of that many rows which run in parallel; every
segment also gets the last few rows before it, so results are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.operators.projections import drop_nulls
from lakecast.series import SeriesSpec

# Resolution of summed sines and cosines: fine to 1e-13, and 2 million rows fit a bigint.
WAVE_SCALE = 2**42

_SEGMENT, _RANK, _HOME = "_segment", "_rank", "_home"


def series_window(spec: SeriesSpec) -> WindowSpec:
    """The one window all features share, so that Spark sorts each series once."""
    return Window.partitionBy(*spec.keys).orderBy(spec.time)


def number_rows(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Row number within each series (from 0) without sorting a whole series in one task.

    Rows are numbered inside a calendar period, then shifted by the rows of all earlier
    periods, which are counted by a partial aggregate first. Keys and period form one
    struct: structs with equal null fields are equal, and the numbering and the join then
    share a partitioning.
    """
    period = F.trunc(F.col(spec.time).cast("date"), "year" if spec.unit == "day" else "month")
    dated = df.withColumn("_part", F.struct(*spec.keys, period.alias("_period")))
    sizes = dated.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = (
        Window.partitionBy(*(F.col("_part")[k] for k in spec.keys))
        .orderBy(F.col("_part")["_period"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_part").orderBy(spec.time)
    numbered = dated.withColumn("_in_part", F.row_number().over(inside) - 1)
    return numbered.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_in_part")).alias(_RANK)
    )


def over_series(
    df: DataFrame,
    spec: SeriesSpec,
    extend: Callable[[DataFrame, WindowSpec], DataFrame],
    reach: int,
    split_rows: int | None = None,
) -> DataFrame:
    """``extend(df, window)``, whose window expressions look back at most ``reach`` rows."""
    if split_rows is None:
        return extend(df, series_window(spec))
    if split_rows < reach:
        raise ValueError(f"split_rows must be at least {reach}")
    home = F.floor(F.col(_RANK) / split_rows)
    lends = F.col(_RANK) % split_rows >= split_rows - reach
    segments = F.when(lends, F.array(home, home + 1)).otherwise(F.array(home))
    pieces = number_rows(df, spec).select(
        *df.columns, home.alias(_HOME), F.explode(segments).alias(_SEGMENT)
    )
    window = Window.partitionBy(*spec.keys, _SEGMENT).orderBy(spec.time)
    extended = extend(pieces, window)
    return extended.where(F.col(_SEGMENT) == F.col(_HOME)).drop(_SEGMENT, _HOME)


def add_lags(df: DataFrame, spec: SeriesSpec, split_rows: int | None = None) -> DataFrame:
    """Lag k is the value k observed rows earlier; gaps in the calendar are not filled."""

    def extend(rows: DataFrame, window: WindowSpec) -> DataFrame:
        lags = [F.lag(spec.value, k).over(window) for k in range(1, spec.n_lags + 1)]
        return rows.select("*", *(c.alias(n) for c, n in zip(lags, spec.lags, strict=True)))

    return over_series(df, spec, extend, spec.n_lags, split_rows)


def drop_null_lags(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return drop_nulls(df, spec.lags)


def _means(
    df: DataFrame, spec: SeriesSpec, split_rows: int | None, including_current: bool
) -> DataFrame:
    """Averages over the last rows, from running sums.

    A sliding frame would be summed up anew for every row; the difference of two running
    sums costs the same for any frame length. The sums are of whole numbers, sines and
    cosines as multiples of ``1 / WAVE_SCALE``, so a row's averages do not depend on where
    its series or segment begins. A measure that is no whole number keeps its sliding frame.
    """
    whole = isinstance(df.schema[spec.value].dataType, T.IntegralType)
    parts = {part for part, _ in spec.cycles}
    summed = {}
    for c in spec.averaged:
        if c in parts or (c == spec.value and whole):
            summed[c] = F.col(c).cast("bigint")
        elif c != spec.value:
            summed[c] = F.rint(F.col(c) * WAVE_SCALE).cast("bigint")
    counted = {c: c if c == spec.value else spec.calendar[0] for c in summed}
    last = 0 if including_current else -1

    def extend(rows: DataFrame, window: WindowSpec) -> DataFrame:
        so_far = window.rowsBetween(Window.unboundedPreceding, last)
        running = rows.select(
            "*",
            *(F.sum(x).over(so_far).alias(f"_sum_{c}") for c, x in summed.items()),
            *(F.count(c).over(so_far).alias(f"_n_{c}") for c in dict.fromkeys(counted.values())),
        )

        def change(name: str, k: int) -> Column:
            return F.col(name) - F.coalesce(F.lag(name, k).over(window), F.lit(0))

        means = []
        for suffix, k in spec.windows:
            sizes = {c: change(f"_n_{c}", k) for c in dict.fromkeys(counted.values())}
            waves = {c: n * F.lit(float(WAVE_SCALE)) for c, n in sizes.items()}
            for c in spec.averaged:
                if c in summed:
                    n = sizes if c in parts or c == spec.value else waves
                    mean = F.try_divide(change(f"_sum_{c}", k), n[counted[c]])
                else:
                    mean = F.avg(c).over(window.rowsBetween(last + 1 - k, last))
                means.append(mean.alias(f"{c}_{suffix}"))
        return running.select(*rows.columns, *means)

    return over_series(df, spec, extend, max(k for _, k in spec.windows), split_rows)


def add_trailing_means(
    df: DataFrame, spec: SeriesSpec, split_rows: int | None = None
) -> DataFrame:
    """Training averages: over the rows before the current one, fewer at a series' start."""
    return _means(df, spec, split_rows, including_current=False)


def drop_null_means(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return drop_nulls(df, spec.means)


def add_serving_means(
    df: DataFrame, spec: SeriesSpec, split_rows: int | None = None
) -> DataFrame:
    """Serving averages: the frame ends at the current row, as seen from the next step."""
    return _means(df, spec, split_rows, including_current=True)


def add_span_means(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Serving averages by the calendar: over the last k days or hours up to the current row's, however many rows they hold.

    On a series with gaps, rows that lie further back do not count, where a frame of k rows would reach them.
    Whole measures are summed as whole numbers, so their averages are exact.
    """
    if spec.unit == "day":
        position, unit = F.unix_date(F.col(spec.time).cast("date")).cast("bigint"), 1
    else:
        position, unit = F.unix_seconds(F.col(spec.time).cast("timestamp")), 3600
    series = Window.partitionBy(*spec.keys).orderBy(position)
    means = []
    for suffix, k in spec.windows:
        frame = series.rangeBetween(1 - k * unit, 0)
        for c in spec.averaged:
            whole = isinstance(df.schema[c].dataType, T.IntegralType)
            mean = F.try_divide(F.sum(F.col(c).cast("bigint")).over(frame), F.count(c).over(frame)) if whole else F.avg(c).over(frame)
            means.append(mean.alias(f"{c}_{suffix}"))
    return df.select("*", *means)
