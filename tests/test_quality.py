"""Rules, isolation and the transit preset."""

import pytest

from lakecast import transit
from lakecast.operators.quality import (
    Rule,
    all_success,
    good_bad_ratio,
    isolate,
    judge,
    rule_counts,
    run_suite,
    schema_gate,
)

RULES = [Rule.in_set("mode", ["subway", "tram"]), Rule.in_set("payment", ["omny"]), Rule.between("ridership", 1, 10)]
ROWS = [
    ("subway", "omny", 5.0),
    ("subway", "omny", 0.0),
    ("bus", "omny", 5.0),
    ("subway", None, 5.0),
    ("bus", "omny", None),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "mode string, payment string, ridership double")


def test_null_policy(rows):
    good, bad = isolate(rows, RULES)
    assert (good.count(), bad.count()) == (1, 4)
    good, bad = isolate(rows, RULES, null_policy="drop")
    assert (good.count(), bad.count()) == (1, 3)
    assert good.columns == rows.columns
    with pytest.raises(ValueError, match="null_policy"):
        isolate(rows, RULES, null_policy="keep")


def test_good_and_bad_are_the_whole_input(rows):
    good, bad = isolate(rows, RULES)
    assert sorted(map(str, good.union(bad).collect())) == sorted(map(str, rows.collect()))
    ratio = good_bad_ratio(rows, RULES).first()
    assert (ratio["row_count"], ratio["good_ratio"], ratio["bad_ratio"]) == (5, 0.2, 0.8)


def test_suite_lets_nulls_pass_unless_told(rows):
    by_column = {r["column"]: r for r in run_suite(rows, RULES).collect()}
    assert by_column["payment"]["success"] and by_column["payment"]["unexpected_count"] == 0
    assert by_column["ridership"]["unexpected_count"] == 1
    assert by_column["ridership"]["unexpected_percent"] == 25.0
    assert by_column["mode"]["partial_unexpected_list"] == ["bus", "bus"]
    strict = {r["column"]: r for r in run_suite(rows, RULES, nulls_pass=False).collect()}
    assert strict["payment"]["unexpected_count"] == 1
    counts = {r["column"]: (r["success_count"], r["failure_count"]) for r in rule_counts(rows, RULES).collect()}
    assert counts == {"mode": (3, 2), "payment": (4, 1), "ridership": (3, 2)}


def test_closed_ranges(spark):
    low, high = transit.RANGES["ridership"]
    df = spark.createDataFrame([(0.0,), (1.0,), (16217.0,), (16218.0,)], "ridership float")
    good, _ = isolate(df, [Rule.between("ridership", low, high)])
    assert [r[0] for r in good.collect()] == [1.0, 16217.0]
    low, high = transit.RANGES["latitude"]
    for kind, expected in (("float", 2), ("double", 1)):
        lat = spark.createDataFrame([(40.576126,), (40.576125,), (40.57612,)], f"latitude {kind}")
        assert isolate(lat, [Rule.between("latitude", low, high)])[0].count() == expected


def test_existence_is_checked_on_the_files(rows):
    rules = [Rule.exists("mode"), Rule.exists("fare"), *RULES]
    with pytest.raises(ValueError, match="fare"):
        schema_gate(rows.columns, rules)
    result = {r["rule"]: r["success"] for r in run_suite(rows, rules).collect()}
    assert result == {0: True, 1: False, 2: False, 3: True, 4: False}
    assert all_success(run_suite(rows, rules[:1]))
    assert not all_success(run_suite(rows, rules), "expect_column_to_exist")


def test_membership_by_table(spark, rows):
    modes = spark.createDataFrame([("subway",), ("subway",), ("ferry",)], "m string")
    rules = [Rule.in_table("mode", modes, "m")]
    good, bad = isolate(rows, rules)
    assert (good.count(), bad.count()) == (3, 2)
    assert good.columns == rows.columns
    summary, passed = judge(rows, rules)
    assert not passed
    assert summary.first()["partial_unexpected_list"] == ["bus", "bus"]


def test_no_value_is_in_an_empty_set(rows):
    rule = [Rule.in_set("mode", [])]
    assert run_suite(rows, rule).first()["unexpected_count"] == 5
    assert [side.count() for side in isolate(rows, rule)] == [0, 5]


def test_a_value_rule_on_an_absent_column_fails_every_row(rows):
    rules = [Rule.between("mode_", 0, 1), RULES[0]]
    assert not run_suite(rows, rules).where("rule = 0").first()["success"]
    assert [side.count() for side in isolate(rows, rules)] == [0, 5]
    assert good_bad_ratio(rows, rules).first()["good_ratio"] == 0


def test_samples_are_bounded(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as mode")
    first = run_suite(df, RULES[:1], sample=20).first()
    assert first["unexpected_count"] == 1000
    assert len(first["partial_unexpected_list"]) == 20


def test_judge_samples_nothing_for_a_clean_batch(rows):
    summary, passed = judge(rows.limit(1), RULES)
    assert passed and all(r["partial_unexpected_list"] == [] for r in summary.collect())


def test_transit_rules(spark):
    stations = spark.createDataFrame([("1", "A St")], "station_complex_id string, station_complex string")
    rules = transit.rules(stations)
    assert len(rules) == 12 + 11
    assert transit.SILVER_SCHEMA.fieldNames() == list(transit.REQUIRED_COLUMNS)
    assert len(transit.FARE_CLASSES) == 12
