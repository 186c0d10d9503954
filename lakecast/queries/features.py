"""Cleaning, grouping, calendar, lags and averages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakecast.operators.encoding import build_code_table
from lakecast.operators.projections import clean_relevant, null_field_count
from lakecast.operators.windows import (
    add_lags,
    add_serving_means,
    add_span_means,
    add_trailing_means,
    drop_null_lags,
)
from lakecast.plans.features import add_calendar, encode_keys, fill_gaps, group_daily, model_table, store_series
from lakecast.queries.common import (
    DAILY,
    DAILY_LABELS,
    HOURLY,
    HOURLY_LABELS,
    SQL_DAILY,
    SQL_DAILY_SERIES,
    SQL_HOURLY,
    SQL_HOURLY_SERIES,
    Query,
    comparable,
    daily_model,
    daily_series,
    encoded_daily,
    encoded_hourly,
    hourly_model,
    hourly_series,
    model_columns,
    sql_calendar,
    sql_date,
    sql_edge,
    sql_lags,
    sql_means,
    sql_model_ctes,
    sql_window,

    sql_time,
    table,
)

# Segment length for the split variants: short enough that every series is really cut.
SPLIT_ROWS = 200


def _clean_relevant(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    landed = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return comparable(clean_relevant(landed, "ts", ["event_type", "user_id"], ["value"]))


def _orders_daily(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return group_daily(
        orders, "o_orderdate", ["o_orderpriority"], {"total": "o_totalprice"}, "order_date"
    )


def _regrain(spark, sf_dir):
    """Hourly series, encoded, summed up to days on the codes."""
    return comparable(
        group_daily(encoded_hourly(spark, sf_dir), "transit_timestamp", HOURLY.keys, {"ridership": "ridership"})
    )


def _ordinal_encode(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    codes = build_code_table(part, ("p_brand", "p_type"))
    return comparable(encode_keys(part, codes, ("p_brand", "p_type")))


def _calendar(series, spec):
    def run(spark, sf_dir):
        return comparable(add_calendar(series(spark, sf_dir), spec))

    return run


def _lags(series, spec, split_rows=None):
    def run(spark, sf_dir):
        return comparable(add_lags(series(spark, sf_dir), spec, split_rows))

    return run


def _means(series, spec, split_rows=None):
    def run(spark, sf_dir):
        lagged = drop_null_lags(add_lags(add_calendar(series(spark, sf_dir), spec), spec), spec)
        averaged = add_trailing_means(lagged, spec, split_rows)
        return comparable(averaged.select(spec.time, *spec.keys, *spec.means))

    return run


def _serving(series, spec):
    def run(spark, sf_dir):
        averaged = add_serving_means(add_calendar(series(spark, sf_dir), spec), spec)
        return comparable(averaged.select(spec.time, *spec.keys, *spec.means))

    return run


def _span(series, spec):
    def run(spark, sf_dir):
        averaged = add_span_means(add_calendar(series(spark, sf_dir), spec), spec)
        return comparable(averaged.select(spec.time, *spec.keys, *spec.means))

    return run


def _bucketed(series, spec):
    """The model table from a stored series, without a shuffle."""

    def run(spark, sf_dir):
        name = f"series_{uuid.uuid4().hex}"
        stored = store_series(series(spark, sf_dir), name, spec, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return comparable(model_table(stored, spec).select(*model_columns(spec)))

    return run


def _model(build, spec):
    def run(spark, sf_dir):
        return comparable(build(spark, sf_dir).select(*model_columns(spec)))

    return run


def _null_lag_count(spark, sf_dir):
    lagged = add_lags(encoded_daily(spark, sf_dir), DAILY)
    counted = lagged.withColumn("null_lags", null_field_count(lagged, r"ridership_lag_\d+"))
    return comparable(counted.select(DAILY.time, *DAILY.keys, "null_lags"))


def _gap_fill(spark, sf_dir):
    return comparable(fill_gaps(encoded_daily(spark, sf_dir), DAILY))


def _sql_calendar(series, spec):
    columns = (spec.time, *spec.keys, spec.value, *spec.carried, *spec.calendar)
    return f"WITH series AS ({series}), c AS (SELECT *, {sql_calendar(spec)} FROM series) SELECT {sql_edge(spec, columns)} FROM c"


def _sql_lags(series, spec):
    columns = (spec.time, *spec.keys, spec.value, *spec.carried, *spec.lags)
    return f"WITH series AS ({series}), l AS (SELECT *, {sql_lags(spec)} FROM series) SELECT {sql_edge(spec, columns)} FROM l"


def _sql_means(series, spec):
    columns = (spec.time, *spec.keys, *spec.means)
    return f"WITH {sql_model_ctes(series, spec)} SELECT {sql_edge(spec, columns)} FROM averaged"


def _sql_serving(series, spec):
    columns = (spec.time, *spec.keys, *spec.means)
    return (
        f"WITH series AS ({series}), c AS (SELECT *, {sql_calendar(spec)} FROM series), "
        f"m AS (SELECT *, {sql_means(spec, True)} FROM c) SELECT {sql_edge(spec, columns)} FROM m"
    )


def _sql_span(series, spec):
    columns = (spec.time, *spec.keys, *spec.means)
    unit = "DAYS" if spec.unit == "day" else "HOURS"
    means = ", ".join(
        f"AVG({c}) OVER ({sql_window(spec)} RANGE BETWEEN INTERVAL {k - 1} {unit} PRECEDING AND CURRENT ROW) AS {c}_{suffix}"
        for suffix, k in spec.windows
        for c in spec.averaged
    )
    return (
        f"WITH series AS ({series}), c AS (SELECT *, {sql_calendar(spec)} FROM series), "
        f"m AS (SELECT *, {means} FROM c) SELECT {sql_edge(spec, columns)} FROM m"
    )


def _sql_model(series, spec):
    return f"WITH {sql_model_ctes(series, spec)} SELECT {sql_edge(spec, model_columns(spec))} FROM model"


_KEYS = ", ".join(DAILY.keys)

QUERIES = [
    Query(
        "clean_relevant",
        _clean_relevant,
        f"SELECT {sql_time('ts', 'ts')}, event_type, user_id, round(value, 6) AS value FROM events",
    ),
    Query(
        "group_hourly",
        lambda spark, sf_dir: comparable(hourly_series(spark, sf_dir)),
        f"SELECT {sql_time('transit_timestamp', 'transit_timestamp')}, {', '.join(HOURLY_LABELS)}, ridership "
        f"FROM ({SQL_HOURLY_SERIES})",
    ),
    Query(
        "group_daily",
        lambda spark, sf_dir: comparable(daily_series(spark, sf_dir)),
        f"SELECT {sql_date('transit_date', 'transit_date')}, {', '.join(DAILY_LABELS)}, ridership, transfer "
        f"FROM ({SQL_DAILY_SERIES})",
    ),
    Query(
        "group_daily_orders",
        lambda spark, sf_dir: comparable(_orders_daily(spark, sf_dir)),
        f"SELECT {sql_date('o_orderdate', 'order_date')}, o_orderpriority, "
        "CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total "
        "FROM orders GROUP BY 1, 2",
    ),
    Query(
        "regrain_daily",
        _regrain,
        f"SELECT {sql_date('transit_timestamp', 'transit_date')}, {', '.join(HOURLY.keys)}, "
        f"CAST(SUM(ridership) AS BIGINT) AS ridership FROM ({SQL_HOURLY}) GROUP BY ALL",
    ),
    Query(
        "ordinal_encode",
        _ordinal_encode,
        "SELECT p_partkey, DENSE_RANK() OVER (ORDER BY p_brand) AS p_brand_index, "
        "DENSE_RANK() OVER (ORDER BY p_type) AS p_type_index FROM part",
    ),
    Query(
        "encoded_daily",
        lambda spark, sf_dir: comparable(encoded_daily(spark, sf_dir)),
        f"SELECT {sql_edge(DAILY, (DAILY.time, *DAILY.keys, 'ridership', 'transfer'))} FROM ({SQL_DAILY})",
    ),
    Query("calendar_daily", _calendar(encoded_daily, DAILY), _sql_calendar(SQL_DAILY, DAILY)),
    Query("calendar_hourly", _calendar(encoded_hourly, HOURLY), _sql_calendar(SQL_HOURLY, HOURLY)),
    Query("lags_daily", _lags(encoded_daily, DAILY), _sql_lags(SQL_DAILY, DAILY)),
    Query("lags_hourly", _lags(encoded_hourly, HOURLY), _sql_lags(SQL_HOURLY, HOURLY)),
    Query("lags_daily_split", _lags(encoded_daily, DAILY, SPLIT_ROWS), _sql_lags(SQL_DAILY, DAILY)),
    Query("lags_hourly_split", _lags(encoded_hourly, HOURLY, SPLIT_ROWS), _sql_lags(SQL_HOURLY, HOURLY)),
    Query("ma_daily", _means(encoded_daily, DAILY), _sql_means(SQL_DAILY, DAILY)),
    Query("ma_hourly", _means(encoded_hourly, HOURLY), _sql_means(SQL_HOURLY, HOURLY)),
    Query("ma_daily_split", _means(encoded_daily, DAILY, SPLIT_ROWS), _sql_means(SQL_DAILY, DAILY)),
    Query("serving_ma_daily", _serving(encoded_daily, DAILY), _sql_serving(SQL_DAILY, DAILY)),
    Query("serving_ma_hourly", _serving(encoded_hourly, HOURLY), _sql_serving(SQL_HOURLY, HOURLY)),
    Query("serving_ma_daily_span", _span(encoded_daily, DAILY), _sql_span(SQL_DAILY, DAILY)),
    Query("serving_ma_hourly_span", _span(encoded_hourly, HOURLY), _sql_span(SQL_HOURLY, HOURLY)),
    Query("model_daily_bucketed", _bucketed(encoded_daily, DAILY), _sql_model(SQL_DAILY, DAILY)),
    Query("model_hourly_bucketed", _bucketed(encoded_hourly, HOURLY), _sql_model(SQL_HOURLY, HOURLY)),
    Query("model_daily", _model(daily_model, DAILY), _sql_model(SQL_DAILY, DAILY)),
    Query("model_hourly", _model(hourly_model, HOURLY), _sql_model(SQL_HOURLY, HOURLY)),
    Query(
        "null_lag_count",
        _null_lag_count,
        f"WITH l AS (SELECT *, {sql_lags(DAILY)} FROM ({SQL_DAILY})) "
        f"SELECT {sql_date(DAILY.time, DAILY.time)}, {_KEYS}, CAST("
        + " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in DAILY.lags)
        + " AS BIGINT) AS null_lags FROM l",
    ),
    Query(
        "gap_fill",
        _gap_fill,
        f"WITH series AS ({SQL_DAILY}), spans AS (SELECT {_KEYS}, MIN(transit_date) AS a, MAX(transit_date) AS b "
        f"FROM series GROUP BY ALL), days AS (SELECT {_KEYS}, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) "
        f"AS transit_date FROM spans) SELECT {sql_date('transit_date', 'transit_date')}, {_KEYS}, "
        f"coalesce(ridership, 0) AS ridership, coalesce(transfer, 0) AS transfer "
        f"FROM days LEFT JOIN series USING (transit_date, {_KEYS})",
    ),
]
