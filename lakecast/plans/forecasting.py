"""Next-step inputs, recursive forecasts and backtests.

The state of a forecast is one row per series: the recent history and the current lags,
both as arrays of fixed length. A step is a projection over that row, so the loop has
neither joins nor shuffles, however many series there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.functions.numeric import PREDICTION_CASTS
from lakecast.functions.temporal import calendar_columns, shift
from lakecast.operators.projections import filter_after_max_of, time_range
from lakecast.series import SeriesSpec
from lakecast.session import cut_lineage

Predictor = PipelineModel | Callable[[DataFrame], DataFrame]

_HIST, _LAGS, _OUT, _LAST, _NEXT = "_hist", "_lags", "_out", "_last", "_next"


def _entry(t: Column, y: Column, spec: SeriesSpec) -> Column:
    """One history element: time, value, and the calendar features that get averaged."""
    calendar = calendar_columns(t, spec.cycles)
    return F.struct(
        t.alias("t"),
        y.alias(spec.value),
        *(calendar[c].alias(c) for c in spec.averaged[1:]),
    )


def _since(oldest: Column) -> Column:
    return F.filter(_HIST, lambda e: e["t"] >= oldest)


def latest_time(table: DataFrame, spec: SeriesSpec) -> str | None:
    """The table's largest time as text, read from its time column alone; None for an empty table."""
    return table.agg(F.max(spec.time).cast("string")).first()[0]


def series_state(table: DataFrame, spec: SeriesSpec, latest: str) -> DataFrame:
    """Per series: last time, the rows of the last ``history`` units up to ``latest``, and the next step's lags.

    A series has one row per unit, so at most ``history`` rows are collected per series. The
    bound is a value in the column's own type: files before it are skipped.
    """
    oldest = shift(F.lit(latest).cast(table.schema[spec.time].dataType), 1 - spec.history, spec.unit)
    recent = table.select(spec.time, *spec.keys, spec.value, *spec.lags).where(F.col(spec.time) >= oldest)
    t, y = F.col(spec.time), F.col(spec.value)
    return recent.groupBy(*spec.keys).agg(
        F.max(t).alias(_LAST),
        F.sort_array(F.collect_list(_entry(t, y, spec))).alias(_HIST),
        F.max_by(F.array(spec.value, *spec.lags[:-1]), t).alias(_LAGS),
    )


def live_state(table: DataFrame, spec: SeriesSpec) -> DataFrame | None:
    """Checkpointed state of the series that reach the latest time; None for an empty table.

    A series without a row at the latest time is not continued; ``ended_series`` lists those.
    """
    latest = latest_time(table, spec)
    if latest is None:
        return None
    at = F.lit(latest).cast(table.schema[spec.time].dataType)
    live = series_state(table, spec, latest).where(F.col(_LAST) == at)
    return cut_lineage(live.withColumn(_NEXT, shift(F.col(_LAST), 1, spec.unit)).drop(_LAST))


def ended_series(table: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Keys and last time of the series without a row at the table's latest time."""
    last = table.groupBy(*spec.keys).agg(F.max(spec.time).alias(spec.time))
    return last.where(F.col(spec.time) < last.agg(F.max(spec.time)).scalar())


def _mean(entries: str, name: str) -> Column:
    return F.expr(
        f"aggregate({entries}, 0D, (total, e) -> total + e.`{name}`) / size({entries})"
    )


class Step:
    """The expressions of one step, built once and applied to the state again and again."""

    def __init__(self, spec: SeriesSpec, value_type: T.DataType, cast: str) -> None:
        self.spec = spec
        size = F.size(_HIST)
        self.tails = {
            f"_tail_{suffix}": F.slice(
                _HIST, F.greatest(size - rows + 1, F.lit(1)), F.least(size, F.lit(rows))
            )
            for suffix, rows in spec.windows
        }
        calendar = calendar_columns(F.col(_NEXT), spec.cycles)
        self.inputs = [
            F.col(_NEXT).alias(spec.time),
            *spec.keys,
            *(calendar[c].alias(c) for c in spec.calendar),
            *(F.col(_LAGS)[k].alias(name) for k, name in enumerate(spec.lags)),
            *(
                _mean(f"`_tail_{suffix}`", c).alias(f"{c}_{suffix}")
                for suffix, _ in spec.windows
                for c in spec.averaged
            ),
        ]
        self.result = [
            spec.time, *spec.keys, _HIST, _LAGS, _OUT,
            PREDICTION_CASTS[cast](F.col("prediction")).alias("prediction"),
        ]
        t, y = F.col(spec.time), F.col("prediction").cast(value_type)
        self.moved = [
            *spec.keys,
            shift(t, 1, spec.unit).alias(_NEXT),
            F.concat(_since(shift(t, 1 - spec.history, spec.unit)), F.array(_entry(t, y, spec))).alias(_HIST),
            F.slice(F.concat(F.array(y), F.col(_LAGS)), 1, spec.n_lags).alias(_LAGS),
            F.concat(_OUT, F.array(F.struct(t.alias("t"), F.col("prediction")))).alias(_OUT),
        ]

    def features(self, state: DataFrame) -> DataFrame:
        """All features of the next step, next to the state columns."""
        held = [c for c in (_HIST, _LAGS, _OUT) if c in state.columns]
        return state.withColumns(self.tails).select(*self.inputs, *held)

    def advance(self, scored: DataFrame) -> DataFrame:
        """The state after the step: the prediction joins the history and becomes lag 1."""
        return scored.select(*self.result).select(*self.moved)


def next_step_input(table: DataFrame, spec: SeriesSpec, keep_time: bool = False) -> DataFrame:
    """Model input for the step after the latest row of ``table``, one row per live series."""
    live = live_state(table, spec)
    columns = ([spec.time] if keep_time else []) + list(spec.features)
    if live is None:
        return table.select(*columns).limit(0)
    step = Step(spec, table.schema[spec.value].dataType, "truncate")
    return step.features(live).select(*columns)


def _score(predictor: Predictor, features: DataFrame) -> DataFrame:
    if isinstance(predictor, PipelineModel):
        return predictor.transform(features)
    return predictor(features)


def predict_next(
    table: DataFrame, spec: SeriesSpec, predictor: Predictor, cast: str = "round"
) -> DataFrame:
    """One-step prediction per live series, rounded by default."""
    scored = _score(predictor, next_step_input(table, spec, keep_time=True))
    whole = PREDICTION_CASTS[cast](F.col("prediction"))
    return scored.select(spec.time, *spec.keys, whole.alias("prediction"))


def recursive_forecast(
    table: DataFrame,
    spec: SeriesSpec,
    predictor: Predictor,
    steps: int,
    cast: str = "truncate",
    checkpoint_every: int = 5,
) -> DataFrame:
    """``steps`` predictions per live series; each is cast to a whole number and fed back.

    The plan grows with every step, so the state (one row per series) is checkpointed
    every ``checkpoint_every`` steps.
    """
    if cast not in PREDICTION_CASTS:
        raise ValueError(f"cast must be one of {sorted(PREDICTION_CASTS)}")
    live = live_state(table, spec)
    if live is None or steps < 1:
        return table.select(
            spec.time, *spec.keys, F.lit(None).cast("bigint").alias("prediction")
        ).limit(0)
    time_type = "date" if spec.unit == "day" else "timestamp"
    none_yet = F.array().cast(f"array<struct<t:{time_type},prediction:bigint>>")
    state = live.withColumn(_OUT, none_yet)
    step = Step(spec, table.schema[spec.value].dataType, cast)
    for n in range(1, steps + 1):
        state = step.advance(_score(predictor, step.features(state)))
        if n % checkpoint_every == 0 and n < steps:
            state = cut_lineage(state)
    # The outer form keeps the optimizer from pushing a "not empty" filter into every step.
    return state.select(*spec.keys, F.inline_outer(_OUT).alias("t", "prediction")).select(
        F.col("t").alias(spec.time), *spec.keys, "prediction"
    )


def seed_history(table: DataFrame, spec: SeriesSpec, start: str, end: str) -> DataFrame:
    """The model rows a backtest starts from."""
    return time_range(table, spec.time, start, end)


def forecast_only(history: DataFrame, table: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows of ``history`` beyond the latest time of the model table."""
    return filter_after_max_of(history, spec.time, table)


def _while_observed(forecast: DataFrame, actual: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Forecast rows with their actual value, up to each series' first step without one.

    A backtest step enters the history only when its actual row exists, and a series that
    misses one is not continued; dropping everything from the first gap on is the same.
    """
    name = f"actual_{spec.value}"
    seen = actual.select(
        spec.time, *spec.keys, F.col(spec.value).alias(name), F.lit(True).alias("_seen")
    )
    in_order = (
        Window.partitionBy(*spec.keys)
        .orderBy(spec.time)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    steps = forecast.join(seen, [spec.time, *spec.keys], "left")
    gaps = F.count_if(F.col("_seen").isNull()).over(in_order)
    return (
        steps.withColumn("_gaps", gaps)
        .where(F.col("_gaps") == 0)
        .select(spec.time, *spec.keys, name, "prediction")
    )


def backtest(
    table: DataFrame,
    spec: SeriesSpec,
    predictor: Predictor,
    seed: tuple[str, str],
    actual: tuple[str, str],
    steps: int,
    include_seed: bool = False,
    cast: str = "truncate",
) -> DataFrame:
    """Forecast from the ``seed`` range and compare with the rows of the ``actual`` range.

    ``include_seed`` also returns the seed rows, whose prediction is the actual value;
    leave it off when computing errors.
    """
    start = seed_history(table, spec, *seed)
    forecast = recursive_forecast(start, spec, predictor, steps, cast)
    rows = _while_observed(forecast, time_range(table, spec.time, *actual), spec)
    if not include_seed:
        return rows
    known = start.select(
        spec.time,
        *spec.keys,
        F.col(spec.value).alias(f"actual_{spec.value}"),
        F.col(spec.value).cast("bigint").alias("prediction"),
    )
    return known.unionByName(rows)
