"""Durations and whole-second times."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Duration = timedelta | float | int

HALF_SECOND_US = 500_000
SECOND_US = 1_000_000


def duration_us(duration: Duration, field: str = "duration") -> int:
    """Microseconds of a timedelta or a number of seconds; never negative."""
    if isinstance(duration, bool) or not isinstance(duration, (timedelta, int, float)):
        raise TypeError(f"{field}: expected a timedelta or seconds")
    if isinstance(duration, timedelta):
        micros = duration // timedelta(microseconds=1)
    else:
        if not math.isfinite(duration):
            raise ValueError(f"{field}: must be finite")
        micros = round(duration * SECOND_US)
    if micros < 0:
        raise ValueError(f"{field}: must not be negative")
    return micros


def duration_seconds(duration: Duration, field: str = "duration") -> int:
    """Whole seconds of a duration that the second-grained operators accept."""
    micros = duration_us(duration, field)
    if micros < SECOND_US or micros % SECOND_US:
        raise ValueError(f"{field}: must be a whole number of seconds, at least 1")
    return micros // SECOND_US


def second_of(timestamp: Column) -> Column:
    """The whole second an instant falls in, as epoch seconds."""
    return F.unix_seconds(timestamp)


def timer_second(timestamp: Column, delay: Duration = 0) -> Column:
    """Timers have whole-second precision: nearest second, half rounds up."""
    shifted = F.unix_micros(timestamp) + F.lit(duration_us(delay) + HALF_SECOND_US)
    return F.floor(shifted / F.lit(SECOND_US)).cast("long")


def utc_text(timestamp: Column) -> Column:
    """UTC text with milliseconds and ``Z``, as lifecycle rows carry times."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
