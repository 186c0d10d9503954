"""Time-stamped event counts, from raw files to published forecasts, on Spark DataFrames."""

from lakecast.series import DAILY, HOURLY, SeriesSpec
from lakecast.session import build_session

__all__ = ["DAILY", "HOURLY", "SeriesSpec", "build_session"]
