"""Fitting, scoring, saving, publishing and forecasting with a model that SQL can fit as well.

A line on the last value goes through the same functions as the tree ensembles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.aggregates import regression_metrics
from lakecast.operators.projections import temporal_split
from lakecast.plans.features import encode_series, model_table
from lakecast.plans.forecasting import backtest, predict_next, recursive_forecast
from lakecast.plans.modeling import (
    cast_time,
    evaluate,
    fit,
    linear_model,
    load_model,
    publish,
    save_model,
)
from lakecast.queries.common import (
    DAILY,
    DAILY_LABELS,
    HOURLY,
    SQL_DAILY,
    SQL_DAILY_SERIES,
    SQL_HOURLY,
    Query,
    comparable,
    daily_series,
    daily_table,
    hourly_table,
    sql_double,
    sql_edge,
    sql_model_ctes,
)
from lakecast.queries.forecasts import (
    DAILY_STEPS,
    DAILY_TEST,
    HOURLY_TEST,
    sql_backtest,
    sql_next,
    sql_recursive,
)
from lakecast.queries.models import CUTOFF
from lakecast.session import scratch_path

#: Daily keys in the order of the labels they stand for.
_LABELS = dict(zip(DAILY.keys, DAILY_LABELS, strict=True))


def _line(train, spec):
    return fit(train, spec.lags[:1], linear_model(spec.value))


def _metrics(build, spec):
    def run(spark, sf_dir):
        train, test = temporal_split(build(spark, sf_dir), spec.time, CUTOFF[spec.time])
        fitted = evaluate(_line(train, spec), test, spec.value)
        naive = regression_metrics(test, spec.value, spec.lags[0])
        return comparable(
            fitted.select(F.lit("model").alias("predictor"), "*").unionByName(
                naive.select(F.lit("last value").alias("predictor"), "*")
            )
        )

    return run


def _publish(spark, sf_dir):
    """Test predictions with decoded labels."""
    series, codes = encode_series(daily_series(spark, sf_dir), DAILY_LABELS)
    train, test = temporal_split(model_table(series, DAILY), DAILY.time, CUTOFF[DAILY.time])
    scored = _line(train, DAILY).transform(test).withColumn("prediction", F.round("prediction", 3))
    return comparable(cast_time(publish(scored, DAILY, codes, DAILY_LABELS, extra=("ridership",)), DAILY))


def _next(build, spec):
    """A model is saved, loaded, and asked for the next step."""

    def run(spark, sf_dir):
        model, path = build(spark, sf_dir), scratch_path(spark, "model")
        save_model(_line(model, spec), path)
        return comparable(predict_next(model, spec, load_model(path)))

    return run


def _recursive(spark, sf_dir):
    model = daily_table(spark, sf_dir)
    return comparable(recursive_forecast(model, DAILY, _line(model, DAILY), DAILY_STEPS))


def _backtest(build, spec, seed, actual, steps):
    def run(spark, sf_dir):
        model = build(spark, sf_dir)
        train, _ = temporal_split(model, spec.time, actual[0])
        return comparable(backtest(model, spec, _line(train, spec), seed, actual, steps))

    return run


# --- the same in SQL --------------------------------------------------------------------

_PREDICTOR = "((SELECT slope FROM fitted) * ridership_lag_1 + (SELECT intercept FROM fitted))"


def _sql_fitted(spec, before: str | None = None) -> str:
    kind = "DATE" if spec.unit == "day" else "TIMESTAMP"
    rows = f"WHERE {spec.time} < {kind} '{before}'" if before else ""
    return (
        "fitted AS MATERIALIZED (SELECT regr_slope(ridership, ridership_lag_1) AS slope, "
        f"regr_intercept(ridership, ridership_lag_1) AS intercept FROM model {rows}),"
    )


def _sql_metrics(series, spec) -> str:
    kind = "DATE" if spec.unit == "day" else "TIMESTAMP"

    def errors(name, prediction):
        error = f"(ridership - {prediction})"
        mse = f"avg({error} * {error})"
        columns = (("rmse", f"sqrt({mse})"), ("mse", mse), ("mae", f"avg(abs({error}))"))
        return f"SELECT '{name}' AS predictor, {', '.join(sql_double(e, n) for n, e in columns)} FROM test"

    return (
        f"WITH {sql_model_ctes(series, spec)}, {_sql_fitted(spec, CUTOFF[spec.time])} "
        f"test AS (SELECT ridership::DOUBLE AS ridership, ridership_lag_1, {_PREDICTOR} AS p FROM model "
        f"WHERE {spec.time} >= {kind} '{CUTOFF[spec.time]}') "
        f"{errors('model', 'p')} UNION ALL {errors('last value', 'ridership_lag_1')}"
    )


def _sql_publish() -> str:
    labels = ", ".join(
        f"(SELECT label FROM (SELECT {label} AS label, row_number() OVER (ORDER BY {label} NULLS FIRST) AS code "
        f"FROM (SELECT DISTINCT {label} FROM ({SQL_DAILY_SERIES}))) WHERE code = {key}) AS {label}"
        for key, label in _LABELS.items()
    )
    return (
        f"WITH {sql_model_ctes(SQL_DAILY, DAILY)}, {_sql_fitted(DAILY, CUTOFF[DAILY.time])} "
        f"scored AS (SELECT *, {_PREDICTOR} AS p FROM model WHERE {DAILY.time} >= DATE '{CUTOFF[DAILY.time]}') "
        f"SELECT {sql_edge(DAILY, (DAILY.time,))}, {labels}, ridership, round(p, 3) AS prediction FROM scored"
    )


QUERIES = [
    Query("fit_linear_daily", _metrics(daily_table, DAILY), _sql_metrics(SQL_DAILY, DAILY)),
    Query("fit_linear_hourly", _metrics(hourly_table, HOURLY), _sql_metrics(SQL_HOURLY, HOURLY)),
    Query("publish_linear", _publish, _sql_publish()),
    Query("predict_next_fitted_daily", _next(daily_table, DAILY),
          sql_next(SQL_DAILY, DAILY, _PREDICTOR, _sql_fitted(DAILY))),
    Query("predict_next_fitted_hourly", _next(hourly_table, HOURLY),
          sql_next(SQL_HOURLY, HOURLY, _PREDICTOR, _sql_fitted(HOURLY))),
    Query("recursive_forecast_fitted_daily", _recursive,
          sql_recursive(SQL_DAILY, DAILY, DAILY_STEPS, _PREDICTOR, _sql_fitted(DAILY))),
    Query("backtest_fitted_daily", _backtest(daily_table, DAILY, *DAILY_TEST),
          sql_backtest(SQL_DAILY, DAILY, *DAILY_TEST, False, _PREDICTOR, _sql_fitted(DAILY, DAILY_TEST[1][0]))),
    Query("backtest_fitted_hourly", _backtest(hourly_table, HOURLY, *HOURLY_TEST),
          sql_backtest(SQL_HOURLY, HOURLY, *HOURLY_TEST, False, _PREDICTOR, _sql_fitted(HOURLY, HOURLY_TEST[1][0]))),
]
