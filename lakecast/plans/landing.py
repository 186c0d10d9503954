"""From landed records to the month-partitioned lake: backfill of missing months, resume of the last one."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecast.functions.temporal import month_end, month_start, shift
from lakecast.operators.joins import expected_months, missing_months
from lakecast.session import broadcast_if_small
from lakecast.sources.files import append_months, list_months, newest_month, scan_months, write_months

log = logging.getLogger(__name__)


def rows_of_months(source: DataFrame, time: str, months: DataFrame) -> DataFrame:
    """Rows whose month is listed; the scan is also bounded by the first and last month."""
    first, last = months.agg(
        F.min("month_start").cast("string"),
        F.date_add(F.last_day(F.max("month_start")), 1).cast("string"),
    ).first()
    if first is None:
        return source.limit(0)
    kind = source.schema[time].dataType
    bounded = source.where(
        (F.col(time) >= F.lit(first).cast(kind)) & (F.col(time) < F.lit(last).cast(kind))
    )
    wanted = broadcast_if_small(months.select(F.col("month_start").alias("_wanted")))
    return bounded.join(wanted, month_start(F.col(time)) == F.col("_wanted"), "left_semi")


@dataclass
class BackfillReport:
    """Labels of the months that were missing, and the errors by label."""

    missing: list[str]
    errors: dict[str, str] = field(default_factory=dict)


def backfill_missing(
    source: DataFrame, time: str, root: str, start: str, end: str
) -> BackfillReport:
    """Load every month from ``start`` to ``end`` (MM/yyyy) that ``root`` lacks.

    All missing months go in one pass over the source. Should that job fail, the months
    are tried one by one, so one bad month does not keep the others out.
    """
    spark = source.sparkSession
    missing = missing_months(expected_months(spark, start, end), list_months(spark, root))
    listed = missing.orderBy("month_start").collect()
    report = BackfillReport([m["month_label"] for m in listed])
    if not listed:
        return report
    try:
        write_months(rows_of_months(source, time, missing), time, root)
    except Exception:
        log.exception("one-pass backfill failed; loading month by month")
        for month in listed:
            one = missing.where(F.col("month_start") == F.lit(month["month_start"]))
            try:
                write_months(rows_of_months(source, time, one), time, root)
            except Exception as error:
                report.errors[month["month_label"]] = str(error)
                log.exception("month %s failed", month["month_label"])
    return report


def resume_window(df: DataFrame, time: str, unit: str = "hour") -> DataFrame:
    """What is left of the month of the latest row: ``resume_from`` and ``resume_to``.

    Starts at the next hour (or day), not the next day, so the rest of a partly loaded
    day is included. No row when the month is complete.
    """
    top = df.agg(F.max(time).alias("_top"))
    if unit == "day":
        start, end = F.date_add("_top", 1), month_end(F.col("_top"))
    else:
        hour = F.date_trunc("hour", F.col("_top").cast("timestamp"))
        start = shift(hour, 1, "hour")
        end = shift(F.date_add(month_end(F.col("_top")), 1).cast("timestamp"), -1, "hour")
    return top.select(start.alias("resume_from"), end.alias("resume_to")).where(
        F.col("resume_from") <= F.col("resume_to")
    )


def resume_month(source: DataFrame, time: str, root: str) -> DataFrame | None:
    """Append the source rows after the lake's latest row, up to the end of that month.

    Returns the appended rows, or None when the lake is empty, already as new as the
    source, or its month has ended.
    """
    spark = source.sparkSession
    newest = newest_month(list_months(spark, root)).first()
    if newest is None:
        return None
    start: dt.date = newest["month_start"]
    lake = scan_months(spark, root).where(
        (F.col("year") == start.year) & (F.col("month") == start.month)
    )
    loaded = lake.agg(F.max(time).cast("timestamp").cast("string")).first()[0]
    ahead = source.agg(F.max(time).cast("timestamp").cast("string")).first()[0]
    if loaded is None or ahead is None or loaded >= ahead:
        return None
    kind = source.schema[time].dataType
    month_over = F.date_add(F.last_day(F.lit(start)), 1).cast(kind)
    rest = source.where((F.col(time) > F.lit(loaded).cast(kind)) & (F.col(time) < month_over))
    return rest if append_months(rest, time, root) else None
