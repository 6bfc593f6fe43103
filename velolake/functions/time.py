"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest |seconds| whose microsecond count still fits a signed 64-bit timestamp.
_MAX_EPOCH_SECONDS = 9_223_372_036_854


def epoch_ms_to_ts(column: str) -> Column:
    """Epoch milliseconds in ``column`` -> TIMESTAMP at whole-second precision.

    Milliseconds are dropped toward zero (``-1500`` -> ``-1`` s), as a seconds
    conversion of ``ms / 1000`` does.  Values outside the timestamp range become
    NULL instead of raising, so the NOT NULL filter of the fact tables drops them.
    """
    secs = F.expr(f"`{column}` div 1000")  # integral division, toward zero
    return F.when(secs.between(-_MAX_EPOCH_SECONDS, _MAX_EPOCH_SECONDS), F.timestamp_seconds(secs))


def hour_start(c: Column | str) -> Column:
    return F.date_trunc("hour", F.col(c) if isinstance(c, str) else c)


def calendar_parts(c: str) -> list[Column]:
    """year, month, day of month, day of week (1 = Sunday), hour of ``c``."""
    x = F.col(c)
    return [
        F.year(x).alias("year"),
        F.month(x).alias("month"),
        F.dayofmonth(x).alias("day"),
        F.dayofweek(x).alias("day_of_week"),
        F.hour(x).alias("hour"),
    ]


def tumbling(c: str, duration: str) -> Column:
    """Epoch-aligned half-open tumbling window ``[start, end)``."""
    return F.window(F.col(c), duration)
