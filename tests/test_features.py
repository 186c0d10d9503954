"""Literal rows for the meaning of time, grouping, codes, lags and averages."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lakecast.functions.numeric import rounded_long, truncated_long
from lakecast.functions.temporal import month_of_label, nanos_to_text, parse_timestamp
from lakecast.operators.encoding import (
    build_code_table,
    decode_labels,
    decode_with_maps,
    encode,
    extend_code_table,
    rank_labels_by_range,
)
from lakecast.operators.projections import cast_measures, cast_to_schema, filter_last_k
from lakecast.operators.windows import (
    add_lags,
    add_trailing_means,
    drop_null_lags,
    number_rows,
)
from lakecast.plans.features import add_calendar, fill_gaps, group_daily, group_hourly, model_table
from lakecast.series import DAILY, HOURLY, SeriesSpec

DAY0 = dt.date(2024, 1, 1)
SPEC = SeriesSpec(time="d", keys=("k",), value="y", carried=())


def day(n):
    return DAY0 + dt.timedelta(days=n - 1)


def series(spark, rows):
    return spark.createDataFrame([(k, day(n), y) for k, n, y in rows], "k string, d date, y bigint")


def test_feature_counts_of_the_two_grains():
    assert len(DAILY.features) == 54
    assert len(HOURLY.features) == 57


def test_nanoseconds_become_text(spark):
    df = spark.createDataFrame([(1735603200000000000,), (1735606800000000000,), (None,)], "n bigint")
    got = [r[0] for r in df.select(nanos_to_text(F.col("n"))).collect()]
    assert got == ["2024-12-31 00:00:00", "2024-12-31 01:00:00", None]


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "ridership string")
    assert [r[0] for r in cast_measures(df, ["ridership"]).collect()] == [12.0, None, None]
    schema = spark.createDataFrame([], "ridership float").schema
    assert [r[0] for r in cast_to_schema(df, schema).collect()] == [12.0, None, None]


def test_strict_and_tolerant_time_parsing(spark):
    df = spark.createDataFrame([("2024-02-30 00:00:00",)], "s string")
    assert df.select(parse_timestamp(F.col("s"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|INVALID"):
        df.select(parse_timestamp(F.col("s"))).collect()


def test_halves_round_away_from_zero_before_summing(spark):
    rows = [("2024-01-01 05:00:00", "k", "A", 2.5), ("2024-01-01 05:00:00", "k", "B", -1.5)]
    df = spark.createDataFrame(rows, "ts string, k string, fare string, y double")
    assert group_hourly(df, "ts", ["k"], {"y": "y"}).first()["y"] == 1
    assert group_daily(df, "ts", ["k"], {"y": "y"}, "d").first()["y"] == 1


def test_round_and_truncate(spark):
    df = spark.createDataFrame([(2.5,), (2.9,), (-1.5,)], "p double")
    assert [r[0] for r in df.select(rounded_long(F.col("p"))).collect()] == [3, 3, -2]
    assert [r[0] for r in df.select(truncated_long(F.col("p"))).collect()] == [2, 2, -1]


def test_calendar(spark):
    days = ["2024-12-01 00:00:00", "2024-12-07 23:00:00", "2024-12-08 00:00:00", "2024-12-29 23:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(F.to_timestamp("t").alias("t"))
    spec = SeriesSpec(time="t", keys=(), unit="hour")
    rows = add_calendar(df, spec).collect()
    assert [r["day_of_week"] for r in rows] == [1, 7, 1, 1]
    assert [r["week_of_month"] for r in rows] == [1.0, 1.0, 2.0, 5.0]
    assert [r["hour_of_day"] for r in rows] == [0, 23, 0, 23]
    assert rows[1]["hour_of_day_sin"] == pytest.approx(math.sin(2 * math.pi * 23 / 24))
    assert rows[3]["week_of_month_cos"] == pytest.approx(1.0)


def test_lags_count_rows_not_days(spark):
    rows = [("a", n, n) for n in range(1, 33) if n != 10] + [("b", n, n) for n in range(1, 31)]
    lagged = add_lags(series(spark, rows), SPEC)
    day11 = lagged.where((F.col("k") == "a") & (F.col("d") == F.lit(day(11)))).first()
    assert day11["y_lag_1"] == 9
    kept = drop_null_lags(lagged, SPEC)
    assert kept.groupBy("k").count().collect() == [("a", 1)]
    assert model_table(series(spark, rows), SPEC).count() == 0


def test_a_series_loses_its_lags_and_one_more_row(spark):
    rows = [("a", n, n) for n in range(1, 34)]
    lagged = drop_null_lags(add_lags(add_calendar(series(spark, rows), SPEC), SPEC), SPEC)
    assert lagged.count() == 3
    kept = model_table(series(spark, rows), SPEC).orderBy("d").collect()
    assert [r["y"] for r in kept] == [32, 33]
    assert kept[0]["y_7d_mv"] == 31.0
    assert kept[1]["y_30d_mv"] == 31.5


def test_null_value_drops_the_rows_that_look_back_on_it(spark):
    rows = [("a", n, None if n == 35 else n) for n in range(1, 70)]
    kept = drop_null_lags(add_lags(series(spark, rows), SPEC), SPEC)
    assert {r["y"] for r in kept.collect()} == {*range(31, 35), None, 66, 67, 68, 69}


def test_split_series_give_the_same_features(spark):
    rng = random.Random(7)
    rows = []
    for key in ("hot", "cold", None):
        days = sorted(rng.sample(range(1, 900), 500 if key == "hot" else 80))
        rows += [(key, n, rng.randrange(100) if rng.random() > 0.02 else None) for n in days]
    df = series(spark, rows)
    spec = SeriesSpec(time="d", keys=("k",), value="y", carried=(), n_lags=5, windows=(("w", 7),))
    whole = sorted(map(str, model_table(df, spec).collect()))
    for size in (7, 10, 64, 5000):
        assert sorted(map(str, model_table(df, spec, split_rows=size).collect())) == whole
    with pytest.raises(ValueError, match="at least 7"):
        add_trailing_means(df, spec, split_rows=6)
    ranks = number_rows(df, spec).groupBy("k").agg(F.max("_rank"), F.count_distinct("_rank"))
    assert {(r[0], r[1] + 1, r[2]) for r in ranks.collect()} == {("hot", 500, 500), ("cold", 80, 80), (None, 80, 80)}


def test_gap_fill_is_an_option(spark):
    df = series(spark, [("a", 1, 5), ("a", 4, 6), ("b", 2, 1)])
    got = {(r["k"], r["d"], r["y"]) for r in fill_gaps(df, SPEC).collect()}
    assert got == {("a", day(1), 5), ("a", day(2), 0), ("a", day(3), 0), ("a", day(4), 6), ("b", day(2), 1)}
    with pytest.raises(ValueError, match="gap_fill"):
        model_table(df, SPEC, gap_fill="mean")


def test_last_k_counts_calendar_days(spark):
    df = series(spark, [("a", n, n) for n in (1, 2, 31, 40)])
    assert {r["y"] for r in filter_last_k(df, SPEC).collect()} == {31, 40}


def test_codes_are_dense_and_decode_back(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "label string")
    codes = build_code_table(df, ["label"])
    assert {(r["label"], r["code"]) for r in codes.collect()} == {(None, 1), ("a", 2), ("b", 3), ("c", 4)}
    coded = encode(df, codes, ["label"])
    assert sorted((r["label"] or "", r["label_index"]) for r in coded.collect()) == [
        ("", 1), ("a", 2), ("b", 3), ("b", 3), ("c", 4)
    ]
    back = decode_labels(coded.drop("label"), codes, ["label"])
    assert sorted(r["label"] or "" for r in back.collect()) == ["", "a", "b", "b", "c"]
    unknown = spark.createDataFrame([(9,)], "label_index bigint")
    assert decode_labels(unknown, codes, ["label"]).first()["label"] is None
    assert decode_with_maps(unknown, {"label": {1: "x"}}).first()["label"] is None


def test_codes_by_range_are_dense_ranks(spark):
    labels = spark.range(5000).select(
        F.concat(F.lit("c"), F.col("id") % 2).alias("column"),
        F.when(F.col("id") > 3, F.sha2(F.col("id").cast("string"), 256)).alias("label"),
    ).distinct()
    expected = []
    for column in ("c0", "c1"):
        own = [r["label"] for r in labels.collect() if r["column"] == column]
        in_order = sorted(own, key=lambda label: (label is not None, label or ""))
        expected += [(column, label, code) for code, label in enumerate(in_order, 1)]
    found = [tuple(r) for r in rank_labels_by_range(labels, 7).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_extended_codes_keep_the_old_ones(spark):
    def rows(*labels):
        return spark.createDataFrame([(v, "x") for v in labels], "label string, other string")

    first = build_code_table(rows("b", "d", None), ["label", "other"])
    second = extend_code_table(first, rows("a", "b", "c", None), ["label", "other"])
    found = {(r["column"], r["label"]): r["code"] for r in second.collect()}
    assert found == {("label", None): 1, ("label", "b"): 2, ("label", "d"): 3, ("label", "a"): 4, ("label", "c"): 5, ("other", "x"): 1}
    assert extend_code_table(second, rows("c"), ["label", "other"]).count() == second.count()


def test_month_of_a_file_name(spark):
    df = spark.createDataFrame([("12-2020.parquet",), ("01-2025",)], "s string")
    assert [r[0] for r in df.select(month_of_label(F.col("s"))).collect()] == [
        dt.date(2020, 12, 1), dt.date(2025, 1, 1)
    ]


def test_model_table_stays_cheap_to_plan(spark):
    """The optimizer's constraints on the finished plan grow with the columns, not as 2^columns."""
    rows = model_table(series(spark, [("a", n, n) for n in range(1, 40)]), SPEC)
    plan = rows.join(rows.select("d", "k", F.col("y_7d_mv").alias("again")), ["d", "k"])
    constraints = plan._jdf.queryExecution().optimizedPlan().constraints().size()
    assert constraints < 1000
