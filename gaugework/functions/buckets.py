"""Time and depth buckets.

Time buckets work on wall-clock (``timestamp_ntz``) values by date parts, so the session time zone
and daylight-saving gaps play no role. Depth buckets are integer indices: 0.1524 and 0.3048 have no
exact binary form, so grouping never uses the bucket's depth itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugework.functions.vocabulary import DEPTH_INCREMENTS, DEPTH_STEP_METRES, TIME_INCREMENTS, canonical

# Interval text per time increment, for ``sequence``.
TIME_STEP_INTERVALS = {
    "EverySecond": "INTERVAL 1 SECOND",
    "EveryMinute": "INTERVAL 1 MINUTE",
    "EveryFiveMinutes": "INTERVAL 5 MINUTE",
    "EveryFifteenMinutes": "INTERVAL 15 MINUTE",
    "Hourly": "INTERVAL 1 HOUR",
    "Daily": "INTERVAL 1 DAY",
    "Monthly": "INTERVAL 1 MONTH",
    "Quarterly": "INTERVAL 3 MONTH",
    "Yearly": "INTERVAL 1 YEAR",
}
_CALENDAR = {"Monthly": "month", "Quarterly": "quarter", "Yearly": "year"}
_MINUTES = {"EveryMinute": 1, "EveryFiveMinutes": 5, "EveryFifteenMinutes": 15}


def time_bucket(c: Column, increment: str) -> Column:
    """Start of the increment that holds the time, as ``timestamp_ntz``."""
    step = canonical("time increment", increment)
    day = c.cast("date")
    if step in _CALENDAR:
        return F.trunc(day, _CALENDAR[step]).cast("timestamp_ntz")
    midnight = day.cast("timestamp_ntz")
    if step == "Daily":
        return midnight
    if step == "Hourly":
        return midnight + F.make_dt_interval(hours=F.hour(c))
    if step == "EverySecond":
        return midnight + F.make_dt_interval(
            hours=F.hour(c), mins=F.minute(c), secs=F.second(c).cast("decimal(18,6)")
        )
    width = _MINUTES[step]
    minute = F.minute(c) - F.minute(c) % width if width > 1 else F.minute(c)
    return midnight + F.make_dt_interval(hours=F.hour(c), mins=minute)


def depth_bucket(c: Column, increment: str, metres_per_unit: float = 1.0) -> Column:
    """Integer index of the depth increment that holds the depth."""
    step = DEPTH_STEP_METRES[canonical("depth increment", increment)]
    return F.floor(F.round(c * F.lit(metres_per_unit) / F.lit(step), 9)).cast("bigint")


def depth_of_bucket(index: Column, increment: str, metres_per_unit: float = 1.0) -> Column:
    step = DEPTH_STEP_METRES[canonical("depth increment", increment)]
    return F.round(index * F.lit(step) / F.lit(metres_per_unit), 9)


def step_order(kind: str) -> dict[str, int]:
    """Ordinal of each increment, finest first."""
    return {name: i for i, name in enumerate(TIME_INCREMENTS if kind == "time" else DEPTH_INCREMENTS)}


def finest(kind: str, steps: list[str | None]) -> str | None:
    order = step_order(kind)
    names = [canonical(f"{kind} increment", s) for s in steps if s]
    return min(names, key=order.__getitem__) if names else None


def coarsest(kind: str, steps: list[str | None]) -> str | None:
    order = step_order(kind)
    names = [canonical(f"{kind} increment", s) for s in steps if s]
    return max(names, key=order.__getitem__) if names else None
