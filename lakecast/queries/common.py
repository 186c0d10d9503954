"""Data mapping and SQL building blocks shared by the registered queries.

Daily facts: ``lineitem`` by ship date, return flag and line status. Hourly facts:
``events`` by hour, event type and channel (parity of the user). Results leave with dates
and times as text and doubles rounded to six places, so that both engines agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.functions.temporal import TEXT_FORMAT
from lakecast.plans.features import encode_series, group_daily, group_hourly, model_table
from lakecast.series import SeriesSpec
from lakecast.session import scratch_path
from lakecast.sources.tables import create_or_replace_as


@dataclass(frozen=True)
class Query:
    """A Spark query and, where SQL can say the same, its SQL."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, whole numbers as bigint, doubles rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            c = F.date_format(c, TEXT_FORMAT)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.FloatType | T.DoubleType):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def sql_date(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"


def sql_time(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


def sql_double(expr: str, name: str) -> str:
    # The case keeps a rounded negative speck from coming out as minus zero.
    return f"CASE WHEN abs({expr}) < 5e-7 THEN 0.0 ELSE round({expr}, 6) END AS {name}"


# --- daily and hourly series ------------------------------------------------------------

DAILY_LABELS = ("l_returnflag", "l_linestatus")
HOURLY_LABELS = ("event_type", "channel")

DAILY = SeriesSpec(
    time="transit_date", keys=tuple(f"{c}_index" for c in DAILY_LABELS)
)
HOURLY = SeriesSpec(
    time="transit_timestamp",
    keys=tuple(f"{c}_index" for c in HOURLY_LABELS),
    carried=(),
    unit="hour",
    n_lags=24,
)


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_daily(
        table(spark, sf_dir, "lineitem"),
        "l_shipdate",
        DAILY_LABELS,
        {"ridership": "l_quantity", "transfer": "l_extendedprice"},
    )


def hourly_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.date_trunc("hour", "ts").alias("transit_timestamp"),
        "event_type",
        F.concat(F.lit("c"), F.col("user_id") % 2).alias("channel"),
        "value",
    )


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = hourly_facts(spark, sf_dir)
    return group_hourly(facts, "transit_timestamp", HOURLY_LABELS, {"ridership": "value"})


def encoded_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_series(daily_series(spark, sf_dir), DAILY_LABELS)[0]


def encoded_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_series(hourly_series(spark, sf_dir), HOURLY_LABELS)[0]


def daily_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table(encoded_daily(spark, sf_dir), DAILY)


def hourly_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table(encoded_hourly(spark, sf_dir), HOURLY)


def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model table as files, as the jobs keep it: computed once, pruned by what is read."""
    return create_or_replace_as(daily_model(spark, sf_dir), scratch_path(spark, "date-model"))


def hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return create_or_replace_as(hourly_model(spark, sf_dir), scratch_path(spark, "hour-model"))


# --- the same in SQL --------------------------------------------------------------------

SQL_DAILY_SERIES = """
SELECT CAST(l_shipdate AS DATE) AS transit_date, l_returnflag, l_linestatus,
       CAST(SUM(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS ridership,
       CAST(SUM(CAST(round(l_extendedprice) AS BIGINT)) AS BIGINT) AS transfer
FROM lineitem GROUP BY 1, 2, 3
"""

SQL_HOURLY_SERIES = """
SELECT date_trunc('hour', ts) AS transit_timestamp, event_type,
       'c' || CAST(user_id % 2 AS VARCHAR) AS channel,
       CAST(SUM(CAST(round(value) AS BIGINT)) AS BIGINT) AS ridership
FROM events GROUP BY 1, 2, 3
"""


def sql_encoded(series: str, spec: SeriesSpec, labels: tuple[str, ...]) -> str:
    codes = ", ".join(
        f"DENSE_RANK() OVER (ORDER BY {c} NULLS FIRST) AS {c}_index" for c in labels
    )
    measures = ", ".join((spec.value, *spec.carried))
    return f"SELECT {spec.time}, {codes}, {measures} FROM ({series})"


SQL_DAILY = sql_encoded(SQL_DAILY_SERIES, DAILY, DAILY_LABELS)
SQL_HOURLY = sql_encoded(SQL_HOURLY_SERIES, HOURLY, HOURLY_LABELS)

_SQL_PARTS = {
    "hour_of_day": "CAST(hour({t}) AS BIGINT)",
    "day_of_week": "CAST(dayofweek({t}) + 1 AS BIGINT)",
    "week_of_month": "CAST(ceil(day({t}) / 7.0) AS DOUBLE)",
}


def sql_calendar(spec: SeriesSpec, t: str | None = None) -> str:
    """Calendar features of ``t`` as a select list."""
    out = []
    for part, period in spec.cycles:
        position = _SQL_PARTS[part].format(t=t or spec.time)
        angle = f"2 * acos(-1.0) * {position} / {period}"
        out += [f"{position} AS {part}", f"sin({angle}) AS {part}_sin", f"cos({angle}) AS {part}_cos"]
    return ", ".join(out)


def sql_window(spec: SeriesSpec) -> str:
    return f"PARTITION BY {', '.join(spec.keys)} ORDER BY {spec.time}"


def sql_lags(spec: SeriesSpec) -> str:
    return ", ".join(
        f"LAG({spec.value}, {k}) OVER ({sql_window(spec)}) AS {name}"
        for k, name in enumerate(spec.lags, 1)
    )


def sql_means(spec: SeriesSpec, including_current: bool = False, value: str | None = None) -> str:
    out = []
    for suffix, rows in spec.windows:
        first, last = (rows - 1, 0) if including_current else (rows, 1)
        frame = f"ROWS BETWEEN {first} PRECEDING AND {'CURRENT ROW' if last == 0 else '1 PRECEDING'}"
        for c in spec.averaged:
            source = value if value and c == spec.value else c
            out.append(f"AVG({source}) OVER ({sql_window(spec)} {frame}) AS {c}_{suffix}")
    return ", ".join(out)


def sql_not_null(columns) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def sql_model_ctes(series: str, spec: SeriesSpec) -> str:
    """``series``, ``calendar``, ``lagged`` and ``model`` as CTE definitions."""
    return f"""
    series AS ({series}),
    calendar AS (SELECT *, {sql_calendar(spec)} FROM series),
    lagged_all AS (SELECT *, {sql_lags(spec)} FROM calendar),
    lagged AS (SELECT * FROM lagged_all WHERE {sql_not_null(spec.lags)}),
    averaged AS (SELECT *, {sql_means(spec)} FROM lagged),
    model AS MATERIALIZED (SELECT * FROM averaged WHERE {sql_not_null(spec.means)})
    """


def _is_double(column: str, spec: SeriesSpec) -> bool:
    return column in spec.means or (column in spec.calendar and column not in ("hour_of_day", "day_of_week"))


def sql_edge(spec: SeriesSpec, columns, prefix: str = "") -> str:
    """Select list in comparable form."""
    out = []
    for c in columns:
        if c == spec.time:
            out.append((sql_date if spec.unit == "day" else sql_time)(f"{prefix}{c}", c))
        elif _is_double(c, spec):
            out.append(sql_double(f"{prefix}{c}", c))
        else:
            out.append(f"{prefix}{c}")
    return ", ".join(out)


def model_columns(spec: SeriesSpec) -> tuple[str, ...]:
    return (spec.time, *spec.keys, spec.value, *spec.carried, *spec.calendar, *spec.lags, *spec.means)
