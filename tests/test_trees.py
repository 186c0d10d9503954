"""Tree models against plain Python and against repeating the last value; stored series, span averages, the query guard."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lakecast.operators.aggregates import regression_metrics
from lakecast.operators.projections import feature_columns, temporal_split
from lakecast.operators.windows import add_span_means
from lakecast.plans.features import add_calendar, model_table, store_series
from lakecast.plans.forecasting import recursive_forecast
from lakecast.plans.modeling import TreeExpression, boosted_trees, compare, evaluate, fit, fit_on_split, linear_model, random_forest, tree_arrays
from lakecast.series import SeriesSpec
from lakecast.session import cut_lineage
from lakecast.surface import check_query, run_sql

SPEC = SeriesSpec(time="day", keys=("key",), value="n", carried=(), n_lags=7)
CUTOFF = "2023-11-01"


@pytest.fixture(scope="module")
def series(spark):
    """A weekly wave with noise and a level per key, with gaps."""
    rng, start = random.Random(4), dt.date(2023, 1, 1)
    rows = [
        (start + dt.timedelta(days=d), k, round(100 * k + 40 * math.sin(2 * math.pi * d / 7) + rng.gauss(0, 4)))
        for k in (1, 2, 3) for d in range(365) if rng.random() < 0.97
    ]
    return cut_lineage(spark.createDataFrame(rows, "day date, key long, n long"))


@pytest.fixture(scope="module")
def table(series):
    return cut_lineage(model_table(series, SPEC))


@pytest.fixture(scope="module")
def models(table):
    train, _ = temporal_split(table, "day", CUTOFF)
    regressors = {"forest": random_forest("n", trees=12, max_depth=6), "boosted": boosted_trees("n", max_depth=4, rounds=12)}
    return {name: fit(train, SPEC.features, r) for name, r in regressors.items()}


def walk(tree, x):
    at = 0
    while tree["feature"][at] >= 0:
        at = tree["low"][at] if x[tree["feature"][at]] <= tree["threshold"][at] else tree["high"][at]
    return tree["value"][at]


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_tree_expressions_equal_the_models(models, table, name):
    model = models[name]
    expression = TreeExpression(model)
    assert expression.features == list(SPEC.features) and len(expression.trees) == 12
    both = model.transform(table).select("*", expression.score().alias("own")).collect()
    assert len(both) == table.count() > 900
    for row in both:
        x = [float(row[c]) for c in SPEC.features]
        total = sum(t["weight"] * walk(t, x) for t in expression.trees) / expression.scale
        assert row["own"] == pytest.approx(row["prediction"], rel=1e-12) and total == pytest.approx(row["own"], rel=1e-12)


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_trees_beat_the_last_value(models, table, name):
    _, test = temporal_split(table, "day", CUTOFF)
    own = evaluate(models[name], test, "n").first()
    naive = regression_metrics(test, "n", SPEC.lags[0]).first()
    assert own["rmse"] < naive["rmse"] / 2 and own["mae"] < naive["mae"] / 2 and own["rmse"] < 12
    rows = models[name].transform(test).select("n", "prediction").collect()
    errors = [r["n"] - r["prediction"] for r in rows]
    assert own["mse"] == pytest.approx(sum(e * e for e in errors) / len(errors)) and own["mae"] == pytest.approx(sum(map(abs, errors)) / len(errors))


def test_fits_are_the_same_each_time(models, table):
    train, _ = temporal_split(table, "day", CUTOFF)
    assert tree_arrays(fit(train, SPEC.features, random_forest("n", trees=12, max_depth=6))) == tree_arrays(models["forest"])


def test_the_better_model_is_chosen_and_scored(table):
    train, test = temporal_split(table, "day", CUTOFF)
    regressors = {"stump": random_forest("n", trees=1, max_depth=1), "line": linear_model("n")}
    for order in (regressors, dict(reversed(regressors.items()))):
        found = compare(train, test, SPEC, order)
        assert found.best == "line" and found.metrics["line"]["rmse"] < found.metrics["stump"]["rmse"]
    chosen, predictions = fit_on_split(table, SPEC, CUTOFF, regressors)
    assert regression_metrics(predictions, "n").first()["rmse"] == pytest.approx(chosen.metrics["line"]["rmse"])
    assert predictions.count() == test.count()


def test_feature_columns_are_all_but_time_and_measures(table):
    assert sorted(feature_columns(table, {"day", "n"})) == sorted(SPEC.features)


def test_recursion_with_an_expression_equals_the_model(models, table):
    steps = 14
    by_model, by_expression = (
        sorted(map(tuple, recursive_forecast(table, SPEC, m, steps).select("day", "key", "prediction").collect()))
        for m in (models["forest"], TreeExpression(models["forest"]).transform)
    )
    assert by_model == by_expression and len(by_model) >= steps


# --- stored series and calendar spans -------------------------------------------------------


def test_features_of_a_stored_series_do_not_shuffle(spark, series):
    stored = store_series(series, "stored_series", SPEC, 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = model_table(stored, SPEC)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan and before == spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    whole = model_table(series, SPEC)
    assert rows.exceptAll(whole).count() == whole.exceptAll(rows).count() == 0
    spark.sql("DROP TABLE stored_series")


def test_span_averages_leave_out_what_lies_too_far_back(spark):
    days = [1, 2, 3, 12, 13, 45]
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=d), 1, 10 * d) for d in days], "day date, key int, n long")
    found = add_span_means(add_calendar(df, SPEC), SPEC).orderBy("day").collect()
    for suffix, k in SPEC.windows:
        expected = [[10 * d for d in days if now - k < d <= now] for now in days]
        assert [r[f"n_{suffix}"] for r in found] == [pytest.approx(sum(e) / len(e)) for e in expected]
    hours = SeriesSpec(time="ts", keys=("key",), value="n", carried=(), unit="hour", n_lags=2, windows=(("3h", 3),))
    at = [0, 1, 2, 5, 6]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), 1, h) for h in at], "ts timestamp, key int, n long")
    found = add_span_means(add_calendar(df, hours), hours).orderBy("ts").collect()
    assert [r["n_3h"] for r in found] == [0, 0.5, 1, 5, 5.5]


# --- the guard ------------------------------------------------------------------------------


def test_only_single_queries_on_registered_views_run(spark, tmp_path):
    spark.range(4).createOrReplaceTempView("guard_view")
    spark.range(4).write.mode("overwrite").saveAsTable("guard_table")
    spark.range(2).write.parquet(str(tmp_path / "t"))
    try:
        good = {
            "SELECT count(*) AS c FROM guard_view": 4,
            "Here it is:\nWITH big AS (SELECT id FROM guard_view WHERE id > 1), both AS (SELECT * FROM big) SELECT count(*) AS c FROM both": 2,
            "SELECT count(*) AS c FROM Guard_View g WHERE g.id IN (SELECT id FROM guard_view WHERE id < 3)": 3,
            "```sql\nSELECT sum(c) AS c FROM (SELECT 1 AS c UNION ALL SELECT 2);\n```": 3,
        }
        for text, value in good.items():
            assert run_sql(spark, text).first()["c"] == value
        bad = [
            "DROP TABLE guard_table",
            "INSERT INTO guard_table SELECT * FROM guard_view",
            "CREATE TABLE x AS SELECT 1",
            "SELECT 1; DROP VIEW guard_view",
            "SELECT * FROM guard_table",
            f"SELECT * FROM parquet.`{tmp_path / 't'}`",
            f"SELECT * FROM guard_view WHERE id IN (SELECT id FROM parquet.`{tmp_path / 't'}`)",
            "WITH a AS (SELECT * FROM guard_table) SELECT * FROM a",
            "WITH a AS (SELECT * FROM b), b AS (SELECT 1) SELECT * FROM a",
            "SELECT * FROM range(10)",
            "SHOW TABLES",
            "SELECT (1",
        ]
        for text in bad:
            with pytest.raises(ValueError):
                check_query(spark, text)
        assert spark.table("guard_table").count() == 4
    finally:
        spark.catalog.dropTempView("guard_view")
        spark.sql("DROP TABLE guard_table")
