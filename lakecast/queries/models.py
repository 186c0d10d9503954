"""Fitted models: metrics, publishing, next step, recursion and backtests.

Tree ensembles have no SQL form, so these run without it. All are fitted with the published
settings, which are the library's defaults: depth 10, 100 trees or rounds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.aggregates import regression_metrics
from lakecast.operators.projections import feature_columns, temporal_split
from lakecast.plans.forecasting import backtest, predict_next, recursive_forecast
from lakecast.plans.modeling import (
    boosted_trees,
    cast_time,
    evaluate,
    fit,
    fit_on_split,
    load_model,
    publish,
    random_forest,
    save_model,
)
from lakecast.queries.common import (
    DAILY,
    DAILY_LABELS,
    HOURLY,
    Query,
    comparable,
    daily_table,
    daily_series,
    hourly_table,
)
from lakecast.plans.features import encode_series, model_table
from lakecast.queries.forecasts import DAILY_STEPS, DAILY_TEST, HOURLY_TEST
from lakecast.session import scratch_path
from lakecast.sources.tables import create_or_replace_as

CUTOFF = {"transit_date": "2001-01-01", "transit_timestamp": "2024-01-24"}


def _forest(train, spec):
    return fit(train, spec.features, random_forest(spec.value))


def _fit(build, spec, regressor):
    """Hold-out metrics of one regressor next to those of repeating the last value."""

    def run(spark, sf_dir):
        model = build(spark, sf_dir)
        train, test = temporal_split(model, spec.time, CUTOFF[spec.time])
        features = feature_columns(model, {spec.time, spec.value, *spec.carried})
        fitted = evaluate(fit(train, features, regressor()), test, spec.value)
        naive = regression_metrics(test, spec.value, spec.lags[0])
        return comparable(
            fitted.select(F.lit("model").alias("predictor"), "*").unionByName(
                naive.select(F.lit("last value").alias("predictor"), "*")
            )
        )

    return run


def _publish_best(spark, sf_dir):
    """Test predictions of the better of two models, labels decoded."""
    series, codes = encode_series(daily_series(spark, sf_dir), DAILY_LABELS)
    model = create_or_replace_as(model_table(series, DAILY), scratch_path(spark, "date-model"))
    regressors = {
        "boosted": boosted_trees("ridership"),
        "forest": random_forest("ridership"),
    }
    _, predictions = fit_on_split(model, DAILY, CUTOFF[DAILY.time], regressors)
    published = publish(predictions, DAILY, codes, DAILY_LABELS, extra=("ridership", "transfer"))
    return comparable(cast_time(published, DAILY))


def _predict_next(build, spec):
    """A model is saved, loaded, and asked for the next step."""

    def run(spark, sf_dir):
        model = build(spark, sf_dir)
        path = scratch_path(spark, "model")
        save_model(_forest(model, spec), path)
        return comparable(predict_next(model, spec, load_model(path)))

    return run


def _recursive(build, spec, steps):
    def run(spark, sf_dir):
        model = build(spark, sf_dir)
        return comparable(recursive_forecast(model, spec, _forest(model, spec), steps))

    return run


def _backtest(build, spec, seed, actual, steps):
    def run(spark, sf_dir):
        model = build(spark, sf_dir)
        train, _ = temporal_split(model, spec.time, actual[0])
        return comparable(backtest(model, spec, _forest(train, spec), seed, actual, steps))

    return run


QUERIES = [
    Query("fit_forest_daily", _fit(daily_table, DAILY, lambda: random_forest("ridership"))),
    Query("fit_boosted_daily", _fit(daily_table, DAILY, lambda: boosted_trees("ridership"))),
    Query("fit_forest_hourly", _fit(hourly_table, HOURLY, lambda: random_forest("ridership"))),
    Query("fit_boosted_hourly", _fit(hourly_table, HOURLY, lambda: boosted_trees("ridership"))),
    Query("publish_best", _publish_best),
    Query("predict_next_daily", _predict_next(daily_table, DAILY)),
    Query("predict_next_hourly", _predict_next(hourly_table, HOURLY)),
    Query("recursive_forecast_daily", _recursive(daily_table, DAILY, DAILY_STEPS)),
    Query("recursive_forecast_hourly", _recursive(hourly_table, HOURLY, 1)),
    Query("backtest_daily", _backtest(daily_table, DAILY, *DAILY_TEST)),
    Query("backtest_hourly", _backtest(hourly_table, HOURLY, *HOURLY_TEST)),
]
