"""What a set of time series looks like: time, keys, measure, and the features built from them."""

from __future__ import annotations

from dataclasses import dataclass

TRANSIT_KEYS = (
    "transit_mode_index",
    "station_complex_index",
    "borough_index",
    "payment_method_index",
)


@dataclass(frozen=True)
class SeriesSpec:
    """One row per ``keys`` and ``time``; ``value`` is what gets forecast.

    ``carried`` measures ride along but are no features. ``unit`` is ``"day"`` (date
    column) or ``"hour"`` (timestamp column). ``history`` is how many units back serving
    averages may look, counted on the calendar.
    """

    time: str
    keys: tuple[str, ...]
    value: str = "ridership"
    carried: tuple[str, ...] = ("transfer",)
    unit: str = "day"
    n_lags: int = 30
    windows: tuple[tuple[str, int], ...] = (("7d_mv", 7), ("30d_mv", 30))
    history: int = 30

    def __post_init__(self) -> None:
        if self.unit not in ("day", "hour"):
            raise ValueError(f"unit must be 'day' or 'hour', not {self.unit!r}")

    @property
    def cycles(self) -> tuple[tuple[str, int], ...]:
        """Calendar parts with the period of their sine and cosine."""
        daily = (("day_of_week", 7), ("week_of_month", 5))
        return (("hour_of_day", 24), *daily) if self.unit == "hour" else daily

    @property
    def calendar(self) -> tuple[str, ...]:
        return tuple(
            name
            for part, _ in self.cycles
            for name in (part, f"{part}_sin", f"{part}_cos")
        )

    @property
    def lags(self) -> tuple[str, ...]:
        return tuple(f"{self.value}_lag_{k}" for k in range(1, self.n_lags + 1))

    @property
    def averaged(self) -> tuple[str, ...]:
        """Columns that get trailing averages: the measure, the calendar parts, their cycles."""
        parts = tuple(part for part, _ in self.cycles)
        waves = tuple(c for c in self.calendar if c not in parts)
        return (self.value, *parts, *waves)

    @property
    def means(self) -> tuple[str, ...]:
        return tuple(f"{c}_{suffix}" for suffix, _ in self.windows for c in self.averaged)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.keys, *self.calendar, *self.lags, *self.means)


DAILY = SeriesSpec(time="transit_date", keys=TRANSIT_KEYS)
HOURLY = SeriesSpec(
    time="transit_timestamp", keys=TRANSIT_KEYS, unit="hour", n_lags=24
)
