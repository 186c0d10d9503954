"""Time parsing, calendar parts, steps on the clock and month labels, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
US_DATE_FORMAT = "MM/dd/yyyy"
MONTH_FORMAT = "MM-yyyy"


def parse_timestamp(text: Column, fmt: str = TEXT_FORMAT, strict: bool = True) -> Column:
    """Text to timestamp; ``strict`` fails on bad text, otherwise it becomes null."""
    if strict:
        return F.to_timestamp(text, fmt)
    return F.try_to_timestamp(text, F.lit(fmt))


def nanos_to_timestamp(nanos: Column) -> Column:
    """Epoch nanoseconds to timestamp on the integer path, without a detour over doubles."""
    return F.timestamp_micros(F.call_function("div", nanos, F.lit(1000)))


def nanos_to_text(nanos: Column, fmt: str = TEXT_FORMAT) -> Column:
    return F.date_format(nanos_to_timestamp(nanos), fmt)


def hour_of_day(t: Column) -> Column:
    return F.hour(t).cast("bigint")


def day_of_week(t: Column) -> Column:
    """1 is Sunday."""
    return F.dayofweek(t).cast("bigint")


def week_of_month(t: Column) -> Column:
    """Days 1-7 are week 1.0, 8-14 week 2.0 and so on."""
    return F.ceil(F.dayofmonth(t) / 7).cast("double")


CALENDAR_PARTS = {
    "hour_of_day": hour_of_day,
    "day_of_week": day_of_week,
    "week_of_month": week_of_month,
}


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of ``period`` steps."""
    angle = F.lit(2) * F.acos(F.lit(-1.0)) * position / F.lit(period)
    return F.sin(angle), F.cos(angle)


def calendar_columns(t: Column, cycles) -> dict[str, Column]:
    """Every calendar feature of ``t`` by name, for ``SeriesSpec.cycles``."""
    out: dict[str, Column] = {}
    for part, period in cycles:
        position = CALENDAR_PARTS[part](t)
        out[part] = position
        out[f"{part}_sin"], out[f"{part}_cos"] = cycle(position, period)
    return out


def shift(t: Column, n: int, unit: str) -> Column:
    """``t`` plus ``n`` days (dates) or hours (timestamps)."""
    if unit == "day":
        return F.date_add(t, n)
    return t + F.make_dt_interval(hours=F.lit(n))


def day_bounds(start: Column, end: Column) -> tuple[Column, Column]:
    """Half-open bounds ``[start 00:00, end + 1 day)`` of two days given as MM/dd/yyyy text."""
    return (
        F.to_date(start, US_DATE_FORMAT),
        F.date_add(F.to_date(end, US_DATE_FORMAT), 1),
    )


def month_start(t: Column) -> Column:
    return F.trunc(t.cast("date"), "month")


def month_end(t: Column) -> Column:
    return F.last_day(t.cast("date"))


def month_label(t: Column) -> Column:
    return F.date_format(t, MONTH_FORMAT)


def month_of_label(label: Column) -> Column:
    """First day of the month named ``MM-yyyy``, also when a file extension follows."""
    return F.to_date(F.regexp_replace(label, r"\.[^.]*$", ""), MONTH_FORMAT)
