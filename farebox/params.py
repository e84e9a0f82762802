"""Run parameters of the pipeline (the reference passes these as model
variables; here they are plain function arguments)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values of the reference: default loaded window, duration bounds in
# minutes, distance bound in miles, and the airport zone names.
DEFAULT_START = dt.date(2024, 1, 1)
DEFAULT_END = dt.date(2025, 1, 1)
DEFAULT_MIN_DURATION_MINUTES = 1
DEFAULT_MAX_DURATION_MINUTES = 1440
DEFAULT_MAX_DISTANCE_MILES = 200
DEFAULT_AIRPORT_ZONES = ("JFK Airport", "LaGuardia Airport", "Newark Airport")


@dataclass(frozen=True)
class PipelineParams:
    """Window ``[start, end)`` plus the numeric bounds of the cleaning rules."""

    start: dt.date = DEFAULT_START
    end: dt.date = DEFAULT_END
    min_duration_minutes: int = DEFAULT_MIN_DURATION_MINUTES
    max_duration_minutes: int = DEFAULT_MAX_DURATION_MINUTES
    max_distance_miles: float = DEFAULT_MAX_DISTANCE_MILES
    airport_zones: tuple[str, ...] = field(default=DEFAULT_AIRPORT_ZONES)

    @property
    def min_duration_us(self) -> int:
        return int(self.min_duration_minutes) * 60_000_000

    @property
    def max_duration_us(self) -> int:
        return int(self.max_duration_minutes) * 60_000_000

    def start_ts(self) -> dt.datetime:
        return dt.datetime.combine(self.start, dt.time())

    def end_ts(self) -> dt.datetime:
        return dt.datetime.combine(self.end, dt.time())
