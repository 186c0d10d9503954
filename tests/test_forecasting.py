"""Recursion against a plain replay, backtests, models and the SQL surface."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lakecast.operators.aggregates import regression_metrics
from lakecast.plans.features import model_table
from lakecast.plans.forecasting import (
    backtest,
    ended_series,
    latest_time,
    series_state,
    live_state,
    next_step_input,
    predict_next,
    recursive_forecast,
)
from lakecast.plans.modeling import (
    boosted_trees,
    fit,
    fit_on_split,
    load_model,
    publish,
    random_forest,
    save_model,
)
from lakecast.operators.encoding import codes_from_maps
from lakecast.series import SeriesSpec
from lakecast.surface import describe, extract_select, register, run_sql, sample_rows

DAY0 = dt.date(2024, 1, 1)
SPEC = SeriesSpec(time="d", keys=("k_index",), value="y", carried=(), n_lags=6, windows=(("s", 3), ("l", 12)), history=12)
HOURS = SeriesSpec(time="t", keys=("k_index",), value="y", carried=(), unit="hour", n_lags=4, windows=(("s", 3),), history=6)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def daily(spark, rows):
    return spark.createDataFrame([(k, day(n), y) for k, n, y in rows], "k_index bigint, d date, y bigint")


def linear(df):
    lag = F.col("y_lag_1") * 0.5 + F.col("y_lag_5") * 0.25
    return df.withColumn("prediction", lag + F.col("y_s") * 0.25 + F.col("day_of_week_l"))


def week_day(d):
    return (d.weekday() + 1) % 7 + 1


def replay(rows, spec, steps):
    """The loop as the tables would hold it: every row ever seen, the last one per key shifted."""
    history = {}
    for r in rows:
        history.setdefault(r["k_index"], []).append(
            (r["d"], r["y"], [r[c] for c in spec.lags])
        )
    for h in history.values():
        h.sort()
    out = []
    for _ in range(steps):
        top = max(h[-1][0] for h in history.values())
        for k, h in history.items():
            if h[-1][0] != top:
                continue
            recent = [e for e in h if e[0] >= top - dt.timedelta(days=spec.history - 1)]
            lags = [h[-1][1], *h[-1][2][:-1]]
            short = [e[1] for e in recent[-3:]]
            days = [week_day(e[0]) for e in recent[-12:]]
            p = lags[0] * 0.5 + lags[4] * 0.25 + sum(short) / len(short) * 0.25 + sum(days) / len(days)
            h.append((top + dt.timedelta(days=1), math.trunc(p), lags))
            out.append((k, top + dt.timedelta(days=1), math.trunc(p)))
    return sorted(out)


def test_recursion_equals_the_replayed_tables(spark):
    rng = random.Random(3)
    rows = []
    for k in range(5):
        last = 60 if k != 4 else 55
        days = sorted({*rng.sample(range(last), 45 if k % 2 else 30), last})
        rows += [(k, n, rng.randrange(1000)) for n in days]
    model = model_table(daily(spark, rows), SPEC)
    expected = replay(model.collect(), SPEC, 9)
    for every in (2, 5, 100):
        got = recursive_forecast(model, SPEC, linear, 9, checkpoint_every=every)
        assert sorted((r["k_index"], r["d"], r["prediction"]) for r in got.collect()) == expected
    live = live_state(model, SPEC)
    assert live.count() == 4 and len(expected) == 4 * 9
    assert [r["k_index"] for r in ended_series(model, SPEC).collect()] == [4]


def test_state_reads_only_the_last_units(spark, tmp_path):
    rows = [(k, n, n + k) for k in range(3) for n in range(90)]
    model_table(daily(spark, rows), SPEC).write.parquet(str(tmp_path / "model"))
    stored = spark.read.parquet(str(tmp_path / "model"))
    plan = series_state(stored, SPEC, latest_time(stored, SPEC))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "GreaterThanOrEqual(d," in plan
    assert f"{SPEC.means[0]}" not in plan


def test_no_rows_no_forecast(spark):
    model = model_table(daily(spark, []), SPEC)
    assert recursive_forecast(model, SPEC, linear, 3).collect() == []
    assert next_step_input(model, SPEC).columns == list(SPEC.features)
    assert live_state(model, SPEC) is None
    with pytest.raises(ValueError, match="cast"):
        recursive_forecast(model, SPEC, linear, 3, cast="floor")


def test_hourly_steps_cross_midnight(spark):
    start = dt.datetime(2024, 2, 29, 0)
    rows = [(1, start + dt.timedelta(hours=h), 100 + h) for h in range(23)]
    df = spark.createDataFrame(rows, "k_index bigint, t timestamp, y bigint")
    got = recursive_forecast(
        model_table(df, HOURS), HOURS, lambda x: x.withColumn("prediction", F.col("hour_of_day") + 0.9), 3
    )
    assert [(str(r["t"]), r["prediction"]) for r in got.orderBy("t").collect()] == [
        ("2024-02-29 23:00:00", 23), ("2024-03-01 00:00:00", 0), ("2024-03-01 01:00:00", 1)
    ]


def test_next_step_rounds_and_recursion_truncates(spark):
    model = model_table(daily(spark, [(1, n, 2) for n in range(20)]), SPEC)

    def half(df):
        return df.withColumn("prediction", F.lit(2.5))

    assert predict_next(model, SPEC, half).first()["prediction"] == 3
    assert recursive_forecast(model, SPEC, half, 1).first()["prediction"] == 2


def test_backtest_stops_a_series_at_its_first_gap(spark):
    rows = [(k, n, 10 * n + k) for k in (1, 2) for n in range(40) if not (k == 2 and n == 33)]
    model = model_table(daily(spark, rows), SPEC)
    bounds = (str(day(15)), str(day(30))), (str(day(31)), str(day(38)))
    got = backtest(model, SPEC, linear, *bounds, steps=6)
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r["k_index"], []).append((r["d"], r["actual_y"]))
    assert sorted(by_key[1]) == [(day(n), 10 * n + 1) for n in range(31, 37)]
    assert sorted(by_key[2]) == [(day(n), 10 * n + 2) for n in (31, 32)]
    seeded = backtest(model, SPEC, linear, *bounds, steps=6, include_seed=True)
    assert seeded.count() == got.count() + 32
    assert seeded.where("actual_y = prediction").count() >= 32


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0)], "y double, prediction double")
    row = regression_metrics(df, "y").first()
    assert (row["mse"], row["rmse"], row["mae"]) == pytest.approx((4 / 3, (4 / 3) ** 0.5, 2 / 3))


@pytest.fixture(scope="module")
def seasonal(spark):
    rng = random.Random(1)
    rows = [(k, n, 100 * k + 40 * (n % 7) + rng.randrange(5)) for k in (1, 2, 3) for n in range(200)]
    return model_table(daily(spark, rows), SPEC).cache()


def test_models_beat_the_last_value(spark, seasonal, tmp_path):
    regressors = {
        "boosted": boosted_trees("y", max_depth=4, rounds=8, engine="spark"),
        "forest": random_forest("y", trees=10, max_depth=6),
    }
    result, predictions = fit_on_split(seasonal, SPEC, str(day(150)), regressors)
    naive = regression_metrics(seasonal.where(F.col("d") >= F.lit(day(150))), "y", "y_lag_1").first()
    assert result.metrics[result.best]["rmse"] == min(m["rmse"] for m in result.metrics.values())
    assert result.metrics[result.best]["rmse"] < naive["rmse"]
    codes = codes_from_maps(spark, {"k": {1: "one", 2: "two"}})
    published = publish(predictions, SPEC, codes, ["k"], extra=["y"])
    assert published.columns == ["d", "k", "y", "prediction"]
    assert {r["k"] for r in published.collect()} == {"one", "two", None}

    path = str(tmp_path / "model")
    model = result.models[result.best]
    save_model(model, path)
    again = load_model(path)
    for steps in (1, 3):
        a, b = (recursive_forecast(seasonal, SPEC, m, steps).collect() for m in (model, again))
        assert sorted(a) == sorted(b) and len(a) == 3 * steps


def test_defaults_are_the_published_settings():
    forest, boosted = random_forest("y"), boosted_trees("y", engine="spark")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed(), forest.getSubsamplingRate()) == (100, 10, 42, 1.0)
    assert (boosted.getMaxDepth(), boosted.getStepSize()) == (10, 0.1)
    with pytest.raises(ValueError, match="engine"):
        boosted_trees("y", engine="other")


def test_fit_is_seeded(seasonal):
    a, b = (fit(seasonal, SPEC.features, random_forest("y", trees=3, max_depth=3)) for _ in range(2))
    assert a.transform(seasonal).select("prediction").collect() == b.transform(seasonal).select("prediction").collect()


def test_sql_surface(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    register({"surface_test": df})
    assert [tuple(r) for r in describe(df).collect()] == [("n", "int", "NULLABLE"), ("s", "string", "NULLABLE")]
    assert sample_rows(df, "n", limit=1).first()["n"] == 1
    assert run_sql(spark, "Sure:\n```sql\nSELECT sum(n) AS t FROM surface_test\n```\nDone").first()["t"] == 3
    assert extract_select("Use this\n  select 1\nfrom t;") == "select 1\nfrom t"
    for text in ("DROP TABLE x", "", "```sql\nDELETE FROM t\n```", "selection of things"):
        with pytest.raises(ValueError, match="SELECT"):
            extract_select(text)
