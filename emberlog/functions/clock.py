"""Time columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BUCKET_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_start(ts: Column | str, unit: str) -> Column:
    """Start of the millisecond, minute, hour or day that holds ``ts``.

    ``date_trunc`` turns a zoneless timestamp into a zoned one, so its answer depends on the session
    zone. Subtracting the part below the unit keeps the type and needs no zone.
    """
    ts = col(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    zero = F.lit(0)
    if unit == "millisecond":
        # A remainder of decimals is ten times slower than taking the floor off.
        below = F.make_dt_interval(zero, zero, zero, seconds - F.floor(seconds, F.lit(3)))
    elif unit == "minute":
        below = F.make_dt_interval(zero, zero, zero, seconds)
    elif unit == "hour":
        below = F.make_dt_interval(zero, zero, F.minute(ts), seconds)
    elif unit == "day":
        below = F.make_dt_interval(zero, F.hour(ts), F.minute(ts), seconds)
    else:
        raise ValueError(f"unknown bucket unit: {unit}")
    return ts - below


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 read from the clock face of ``ts``, the same in every session zone."""
    ts = col(ts)
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def day_of_week(ts: Column | str) -> Column:
    """0 on Monday to 6 on Sunday."""
    return F.weekday(col(ts))


def weekend_flag(ts: Column | str) -> Column:
    """1 on Saturday and Sunday (Monday counts as 0)."""
    return F.when(day_of_week(ts) >= 5, 1).otherwise(0)


def seconds(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def in_range(ts: Column | str, start, end) -> Column:
    """Half-open range ``[start, end)``."""
    ts = col(ts)
    return (ts >= start) & (ts < end)
