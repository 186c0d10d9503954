"""Next-step inputs, recursive forecasts and backtests with a fixed linear predictor.

The SQL side replays the loop as the tables of one statement: lags, averages, prediction
and union per step.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.joins import with_actuals
from lakecast.operators.projections import filter_at_max, next_time, shifted_lags
from lakecast.plans.forecasting import (
    backtest,
    forecast_only,
    next_step_input,
    predict_next,
    recursive_forecast,
    seed_history,
)
from lakecast.queries.common import (
    DAILY,
    HOURLY,
    SQL_DAILY,
    SQL_HOURLY,
    Query,
    comparable,
    daily_table,
    hourly_table,
    sql_calendar,
    sql_edge,
    sql_means,
    sql_model_ctes,
)

DAILY_STEPS, HOURLY_STEPS = 14, 3
DAILY_SEED, DAILY_ACTUAL, DAILY_TEST_STEPS = ("2001-05-01", "2001-06-30"), ("2001-07-01", "2001-07-31"), 9
HOURLY_SEED = ("2024-01-27 00:00:00", "2024-01-29 23:00:00")
HOURLY_ACTUAL = ("2024-01-30 00:00:00", "2024-01-30 23:00:00")
HOURLY_TEST_STEPS = 3


def linear(df):
    """A fixed predictor whose terms are exact in both engines."""
    return df.withColumn(
        "prediction",
        F.col("ridership_lag_1") * 0.5
        + F.col("ridership_lag_7") * 0.25
        + F.col("ridership_7d_mv") * 0.125
        + F.col("ridership_30d_mv") * 0.125
        + F.col("day_of_week"),
    )


SQL_LINEAR = (
    "ridership_lag_1 * 0.5::DOUBLE + ridership_lag_7 * 0.25::DOUBLE + ridership_7d_mv * 0.125::DOUBLE "
    "+ ridership_30d_mv * 0.125::DOUBLE + day_of_week"
)


def _next_input(model, spec):
    def run(spark, sf_dir):
        return comparable(next_step_input(model(spark, sf_dir), spec, keep_time=True))

    return run


def _shifted(spark, sf_dir):
    """Lags as the next day sees them, under the next day's date."""
    model = daily_table(spark, sf_dir)
    rows = filter_at_max(model, DAILY.time)
    return comparable(
        rows.select(next_time(model, DAILY).alias(DAILY.time), *DAILY.keys, *shifted_lags(DAILY))
    )


def _next(model, spec):
    def run(spark, sf_dir):
        return comparable(predict_next(model(spark, sf_dir), spec, linear))

    return run


def _recursive(model, spec, steps):
    def run(spark, sf_dir):
        return comparable(recursive_forecast(model(spark, sf_dir), spec, linear, steps))

    return run


def _forecast_only(spark, sf_dir):
    """Seed rows and forecast in one history; what lies beyond the model table is kept."""
    model = daily_table(spark, sf_dir)
    forecast = recursive_forecast(model, DAILY, linear, 2)
    seed = seed_history(model, DAILY, *DAILY_SEED).select(
        DAILY.time, *DAILY.keys, F.col("ridership").alias("prediction")
    )
    return comparable(forecast_only(seed.unionByName(forecast), model, DAILY))


def _backtest(model, spec, seed, actual, steps, include_seed=False):
    def run(spark, sf_dir):
        return comparable(
            backtest(model(spark, sf_dir), spec, linear, seed, actual, steps, include_seed)
        )

    return run


def _joined_actuals(spark, sf_dir):
    """Lag-1 forecasts of every row joined with the actual value."""
    model = daily_table(spark, sf_dir)
    forecast = model.select(DAILY.time, *DAILY.keys, F.col("ridership_lag_1").alias("prediction"))
    return comparable(with_actuals(forecast, model, DAILY.time, DAILY.keys, "ridership"))


# --- the same in SQL --------------------------------------------------------------------


def _step(spec, n: int) -> str:
    return f"+ {n}" if spec.unit == "day" else f"+ INTERVAL {n} HOUR"


def _sql_features(spec, history: str, tag: str) -> str:
    """Input of the step after ``history``: shifted lags, serving averages, calendar."""
    t, keys = spec.time, ", ".join(spec.keys)
    back = "- 29" if spec.unit == "day" else "- INTERVAL 29 HOUR"
    lags = ", ".join(
        f"{old} AS {new}" for old, new in zip(("prediction", *spec.lags[:-1]), spec.lags, strict=True)
    )
    return f"""
    top_{tag} AS MATERIALIZED (SELECT MAX({t}) AS top FROM {history}),
    recent_{tag} AS (SELECT *, {sql_means(spec, True, 'prediction')} FROM
      (SELECT {t}, {keys}, prediction, {', '.join(spec.calendar)} FROM {history}, top_{tag} WHERE {t} >= top {back})),
    means_{tag} AS (SELECT {keys}, {', '.join(spec.means)} FROM recent_{tag}, top_{tag} WHERE {t} = top),
    shifted_{tag} AS (SELECT top {_step(spec, 1)} AS {t}, {keys}, {lags} FROM {history}, top_{tag} WHERE {t} = top),
    input_{tag} AS MATERIALIZED (SELECT s.{t}, {', '.join('s.' + k for k in spec.keys)}, {sql_calendar(spec, 's.' + t)},
      {', '.join(spec.lags)}, {', '.join(spec.means)} FROM shifted_{tag} s JOIN means_{tag} m
      ON {' AND '.join(f's.{k} = m.{k}' for k in spec.keys)})
    """


def _sql_history(spec, source: str) -> str:
    return (
        f"SELECT {spec.time}, {', '.join(spec.keys)}, {spec.value} AS prediction, "
        f"{', '.join(spec.calendar)}, {', '.join(spec.lags)} FROM {source}"
    )


def _sql_loop(spec, steps: int, start: str, actual: str | None = None, predictor: str = SQL_LINEAR) -> str:
    """CTEs ``history_0`` to ``history_<steps>``; with ``actual`` only observed rows are appended."""
    ctes = [f"history_0 AS MATERIALIZED ({_sql_history(spec, start)})"]
    for i in range(steps):
        ctes.append(_sql_features(spec, f"history_{i}", str(i)))
        known = ""
        if actual:
            known = f"SEMI JOIN {actual} USING ({spec.time}, {', '.join(spec.keys)})"
        ctes.append(
            f"""history_{i + 1} AS MATERIALIZED (SELECT * FROM history_{i} UNION ALL
            SELECT {spec.time}, {', '.join(spec.keys)}, CAST(trunc({predictor}) AS BIGINT) AS prediction,
            {', '.join(spec.calendar)}, {', '.join(spec.lags)} FROM input_{i} {known})"""
        )
    return ",".join(ctes)


def _sql_next_input(series, spec) -> str:
    columns = (spec.time, *spec.features)
    return (
        f"WITH {sql_model_ctes(series, spec)}, history AS MATERIALIZED ({_sql_history(spec, 'model')}), "
        f"{_sql_features(spec, 'history', 'n')} SELECT {sql_edge(spec, columns)} FROM input_n"
    )


def _sql_shifted() -> str:
    spec, columns = DAILY, (DAILY.time, *DAILY.keys, *DAILY.lags)
    return (
        f"WITH {sql_model_ctes(SQL_DAILY, spec)}, history AS MATERIALIZED ({_sql_history(spec, 'model')}), "
        f"{_sql_features(spec, 'history', 'n')} SELECT {sql_edge(spec, columns)} FROM shifted_n"
    )


def sql_next(series, spec, predictor: str = SQL_LINEAR, ctes: str = "") -> str:
    columns = (spec.time, *spec.keys)
    return (
        f"WITH {sql_model_ctes(series, spec)}, {ctes} history AS MATERIALIZED ({_sql_history(spec, 'model')}), "
        f"{_sql_features(spec, 'history', 'n')} SELECT {sql_edge(spec, columns)}, "
        f"CAST(round({predictor}) AS BIGINT) AS prediction FROM input_n"
    )


def sql_recursive(series, spec, steps, predictor: str = SQL_LINEAR, ctes: str = "") -> str:
    columns = (spec.time, *spec.keys, "prediction")
    return (
        f"WITH {sql_model_ctes(series, spec)}, {ctes} {_sql_loop(spec, steps, 'model', None, predictor)} "
        f"SELECT {sql_edge(spec, columns)} FROM history_{steps} WHERE {spec.time} > (SELECT MAX({spec.time}) FROM model)"
    )


def sql_backtest(series, spec, seed, actual, steps, include_seed=False, predictor: str = SQL_LINEAR, ctes: str = "") -> str:
    keys = ", ".join(spec.keys)
    kind = "DATE" if spec.unit == "day" else "TIMESTAMP"

    def between(bounds):
        return f"{spec.time} BETWEEN {kind} '{bounds[0]}' AND {kind} '{bounds[1]}'"

    columns = (spec.time, *spec.keys, "actual_ridership", "prediction")
    after = "" if include_seed else f"WHERE {spec.time} > {kind} '{seed[1]}'"
    return (
        f"WITH {sql_model_ctes(series, spec)}, {ctes} seed AS MATERIALIZED (SELECT * FROM model WHERE {between(seed)}), "
        f"actual AS MATERIALIZED (SELECT {spec.time}, {keys}, ridership FROM model WHERE {between(actual)}), "
        f"{_sql_loop(spec, steps, 'seed', 'actual', predictor)}, "
        f"known AS (SELECT {spec.time}, {keys}, ridership AS actual_ridership FROM model), "
        f"result AS (SELECT * FROM history_{steps} JOIN known USING ({spec.time}, {keys}) {after}) "
        f"SELECT {sql_edge(spec, columns)} FROM result"
    )


DAILY_TEST = (DAILY_SEED, DAILY_ACTUAL, DAILY_TEST_STEPS)
HOURLY_TEST = (HOURLY_SEED, HOURLY_ACTUAL, HOURLY_TEST_STEPS)

QUERIES = [
    Query("next_step_input_daily", _next_input(daily_table, DAILY), _sql_next_input(SQL_DAILY, DAILY)),
    Query("next_step_input_hourly", _next_input(hourly_table, HOURLY), _sql_next_input(SQL_HOURLY, HOURLY)),
    Query("shifted_lags", _shifted, _sql_shifted()),
    Query("predict_next_linear_daily", _next(daily_table, DAILY), sql_next(SQL_DAILY, DAILY)),
    Query("predict_next_linear_hourly", _next(hourly_table, HOURLY), sql_next(SQL_HOURLY, HOURLY)),
    Query("recursive_forecast_linear_daily", _recursive(daily_table, DAILY, DAILY_STEPS),
          sql_recursive(SQL_DAILY, DAILY, DAILY_STEPS)),
    Query("recursive_forecast_linear_hourly", _recursive(hourly_table, HOURLY, HOURLY_STEPS),
          sql_recursive(SQL_HOURLY, HOURLY, HOURLY_STEPS)),
    Query("forecast_only", _forecast_only, sql_recursive(SQL_DAILY, DAILY, 2)),
    Query("backtest_linear_daily", _backtest(daily_table, DAILY, *DAILY_TEST),
          sql_backtest(SQL_DAILY, DAILY, *DAILY_TEST)),
    Query("backtest_linear_daily_with_seed", _backtest(daily_table, DAILY, *DAILY_TEST, True),
          sql_backtest(SQL_DAILY, DAILY, *DAILY_TEST, True)),
    Query("backtest_linear_hourly", _backtest(hourly_table, HOURLY, *HOURLY_TEST),
          sql_backtest(SQL_HOURLY, HOURLY, *HOURLY_TEST)),
    Query("joined_actuals", _joined_actuals,
          f"WITH {sql_model_ctes(SQL_DAILY, DAILY)} SELECT "
          f"{sql_edge(DAILY, (DAILY.time, *DAILY.keys, 'ridership_lag_1'))}, ridership AS actual_ridership FROM model"
          .replace("ridership_lag_1, ridership AS", "ridership_lag_1 AS prediction, ridership AS")),
]
