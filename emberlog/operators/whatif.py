"""Logs as they would have been: a harmless burst, a silent change of signature."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clock import in_range

# The rare signature of a silent failure, and the latency range of normal traffic.
SILENT_SIGNATURE = "[ORDER]:[CHECKOUT]:[EMPTY_RESULT]"
NORMAL_STATUS, NORMAL_MS = 200, (1, 1000)
BURST_FACTOR = 10


def calm(df: DataFrame, start, end) -> DataFrame:
    """Rows of ``[start, end)`` turned into normal traffic: status 200, latency in 1..1000, label 0."""
    here = in_range("timestamp", start, end)
    clamped = F.least(F.lit(NORMAL_MS[1]), F.greatest(F.lit(NORMAL_MS[0]), F.col("response_time_ms")))
    return df.withColumns({
        "status_code": F.when(here, NORMAL_STATUS).otherwise(F.col("status_code")),
        "response_time_ms": F.when(here, clamped).otherwise(F.col("response_time_ms")).cast("bigint"),
        "is_anomaly": F.when(here, 0).otherwise(F.col("is_anomaly")),
    })


def amplify(df: DataFrame, start, end, factor: int = BURST_FACTOR) -> DataFrame:
    """All rows, those of ``[start, end)`` made normal and repeated to ``factor`` times their number.

    ``copy`` is 0 for a row itself and 1 and up for its repeats. Each row makes its own copies, so
    nothing is shuffled or read twice.
    """
    copies = F.when(in_range("timestamp", start, end), F.sequence(F.lit(0), F.lit(factor - 1))).otherwise(
        F.array(F.lit(0)))
    return calm(df, start, end).withColumn("copy", F.explode(copies))


def overlay_signature(df: DataFrame, start, end, signature: str = SILENT_SIGNATURE) -> DataFrame:
    """All rows, those of ``[start, end)`` under one rare signature; nothing else changes."""
    return df.withColumn("log_signature", F.when(in_range("timestamp", start, end), F.lit(signature))
                         .otherwise(F.col("log_signature")))
