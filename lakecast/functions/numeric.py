"""Number conversions whose rounding matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_long(x: Column) -> Column:
    """Nearest whole number, halves away from zero."""
    return F.round(x, 0).cast("bigint")


def truncated_long(x: Column) -> Column:
    return x.cast("bigint")


PREDICTION_CASTS = {"round": rounded_long, "truncate": truncated_long}
