"""Retry arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ATTEMPTS, CEILING, SIZE_BASE = 5, 3600, 60


def seconds(delay: Column, attempts: Column, base: Column | None = None) -> Column:
    """Wait after so many attempts: doubling from the base (the delay itself if there is none), capped, never under the delay."""
    base = delay if base is None else base
    doubled = base * F.pow(F.lit(2), F.least(attempts - 1, F.lit(10)))
    return F.greatest(delay, F.least(F.lit(CEILING), doubled)).cast("long")


def next_attempt(now: Column, delay: Column, attempts: Column, base: Column | None = None) -> Column:
    """When to try again; null once suspended."""
    return F.when(attempts < ATTEMPTS, now + seconds(delay, attempts, base))


def ready(row_there: Column, deadline: Column, now: Column) -> Column:
    """No schedule, or one whose deadline has come. A schedule without deadline is a suspension."""
    return row_there.isNull() | F.coalesce(deadline <= now, F.lit(False))


def later_of(deadline: Column, pause: Column) -> Column:
    """The deadline, or the pause's end if later; null without a deadline (greatest alone would skip the null)."""
    return F.when(deadline.isNotNull(), F.greatest(deadline, F.coalesce(pause, deadline)))
