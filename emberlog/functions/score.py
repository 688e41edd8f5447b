"""Score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .clock import col


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as a double, null when ``b`` is 0 or null."""
    b = col(b).cast("double")
    return col(a).cast("double") / F.nullif(b, F.lit(0.0))


def sigmoid(raw: Column | str) -> Column:
    """Log odds to a probability."""
    return 1.0 / (1.0 + F.exp(-col(raw)))


def is_error(status: Column | str = "status_code") -> Column:
    return col(status) >= 500


def spread(n: Column | str, total: Column | str, squares: Column | str) -> Column:
    """``n`` times the population standard deviation of whole numbers, from their sum and sum of squares.

    ``n*squares - total^2`` is a whole number, taken as a wide decimal, so the result does not depend
    on the order rows arrive in and nothing overflows. Null when all numbers are equal.
    """
    wide = col(total).cast("decimal(38,0)")
    return F.nullif(F.sqrt((col(n) * col(squares) - wide * wide).cast("double")), F.lit(0.0))


def z_score(x: Column | str, n: Column | str, total: Column | str, spread: Column | str) -> Column:
    """(x - mean) / stddev with ``n`` cancelled; null without spread."""
    return (col(n).cast("double") * col(x) - col(total).cast("double")) / col(spread)
