"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from lakecast.queries import registry
from lakecast.queries.common import daily_series
from tests.oracle import TESTDATA, connect, differences

SF_DIR = str(TESTDATA / "sf0.001")
REGISTRY = registry()
# Fitted with the published settings, which takes minutes each; the driver and the bench run them, and the
# same functions are compared with SQL through the fitted lines.
TREES = {name for name, query in REGISTRY.items() if query.sql is None}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is not None])
def test_matches_sql(spark, duck, name):
    query = REGISTRY[name]
    assert differences(query.run(spark, SF_DIR), duck, query.sql) is None


def test_only_tree_ensembles_have_no_sql():
    assert all(name.startswith(("fit_", "publish_", "predict_", "recursive_", "backtest_")) for name in TREES)


@pytest.mark.parametrize("name", ["fit_forest_daily", "predict_next_daily"])
def test_trees_predict_within_what_they_saw(spark, name):
    rows = [r.asDict() for r in REGISTRY[name].run(spark, SF_DIR).collect()]
    if name.startswith("fit_"):
        errors = {r["predictor"]: r["rmse"] for r in rows}
        assert set(errors) == {"model", "last value"} and all(e > 0 for e in errors.values())
    else:
        seen = daily_series(spark, SF_DIR).agg({"ridership": "max"}).first()[0]
        assert rows and all(0 <= r["prediction"] <= seen for r in rows)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
