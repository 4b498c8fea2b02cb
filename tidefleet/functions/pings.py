"""Expressions on pings: local time, speed classes, kinematics."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidefleet.session import LOCAL_TZ

PEAK_HOURS = (7, 8, 17, 18)


def local_time(ts: Column, zone: str = LOCAL_TZ) -> Column:
    """A UTC wall-clock time (TIMESTAMP_NTZ) in a zone, whatever the session's zone is."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a UTC wall-clock time, whatever the session's zone is."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts).cast("long")


def speed_level(speed: Column) -> Column:
    """stopped, slow, normal or fast; an unknown speed counts as fast."""
    return F.when(speed == 0, "stopped").when(speed < 20, "slow").when(speed < 60, "normal").otherwise("fast")


def day_type(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), "weekend").otherwise("weekday")


def is_peak(hour: Column) -> Column:
    return F.when(hour.isin(*PEAK_HOURS), 1).otherwise(0)


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or null."""
    return F.when(condition, 1).otherwise(0)


def cyclic(seconds: Column) -> tuple[Column, Column]:
    """Sine and cosine of the time of day."""
    angle = F.lit(2 * math.pi) * (seconds % 86400) / F.lit(86400.0)
    return F.sin(angle), F.cos(angle)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; zero where whole is zero or null."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
