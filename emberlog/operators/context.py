"""What was going on around each bucket of a service: velocity, error acceleration, surge, baselines.

The shapes are fixed by the row frames of the contract: 10 buckets for velocity, 10 back for acceleration,
61 (60 before, and the current one) for the surge score. Buckets without traffic have no row and are
not counted by row frames; ``frame="range"`` measures in minutes instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..functions.clock import BUCKET_SECONDS, bucket_start, epoch_seconds
from ..functions.score import ratio, spread, z_score
from .joins import attach, attach_lazy
from .windows import over_series, running_sums

VELOCITY_BUCKETS, LAG_BUCKETS, SURGE_BUCKETS, SURGE_Z = 10, 10, 60, 3.0
PIECE_BUCKETS = 20_000


def _features(df: DataFrame, w: WindowSpec, before: Callable[[str, int], Column], then_rate: Column) -> DataFrame:
    """The context columns. ``before(c, n)`` is the running column ``c`` just ahead of the last n buckets.

    Counts are whole numbers, so differences of running sums are exact.
    """
    x = F.col("total_reqs")
    wide = x.cast("decimal(20,0)")
    run = running_sums(df, w, _x=x, _q=wide * wide)

    def last(c: str, n: int) -> Column:
        return F.col(c) - F.coalesce(before(c, n), F.lit(0))

    short, long = VELOCITY_BUCKETS, SURGE_BUCKETS + 1
    totals = run.withColumns({"_n10": last("_i", short), "_x10": last("_x", short), "_n61": last("_i", long),
                              "_x61": last("_x", long), "_q61": last("_q", long), "_then": then_rate})
    z = z_score(x, "_n61", "_x61", spread("_n61", "_x61", "_q61"))
    return totals.withColumns({
        "throughput_velocity": ratio(x, ratio("_x10", "_n10")),
        "error_acceleration": ratio("error_rate", "_then"),
        "is_surge": F.when(z > SURGE_Z, 1).otherwise(0),
        "has_baseline": F.coalesce(F.col("_then") > 0, F.lit(False)),
    }).drop("_i", "_x", "_q", "_n10", "_x10", "_n61", "_x61", "_q61", "_then")


def with_rates(merged: DataFrame) -> DataFrame:
    return merged.withColumn("error_rate", ratio("error_reqs", "total_reqs"))


def context(merged: DataFrame, frame: str = "rows", bucket: str = "minute",
            chunk_rows: int | None = None) -> DataFrame:
    """Merged buckets with throughput_velocity, error_acceleration, is_surge and has_baseline.

    ``chunk_rows`` is that of :func:`emberlog.operators.windows.over_series`.
    """
    rates = with_rates(merged)
    if frame == "range":
        return _range_context(rates, bucket)
    return over_series(rates, ["service_id"], "window_start", SURGE_BUCKETS, _row_features, chunk_rows)


def _row_features(df: DataFrame, w: WindowSpec) -> DataFrame:
    return _features(df, w, lambda c, n: F.lag(c, n).over(w), F.lag("error_rate", LAG_BUCKETS).over(w))


def _range_context(rates: DataFrame, bucket: str) -> DataFrame:
    """Time-true frames: the last 10 and 61 bucket lengths, and the bucket exactly 10 lengths back.

    Frames reach back a known time, so the series is cut by time, with the buckets just before each
    cut copied into the next piece.
    """
    step = BUCKET_SECONDS[bucket]
    piece = step * PIECE_BUCKETS
    t = rates.withColumn("_t", epoch_seconds("window_start"))
    own = F.floor(F.col("_t") / piece)
    later = F.floor((F.col("_t") + step * SURGE_BUCKETS) / piece)
    copies = t.withColumn("_own", own).withColumn("_piece", F.explode(F.sequence(own, later)))
    w = Window.partitionBy("service_id", "_piece").orderBy("_t")

    def before(c: str, n: int) -> Column:
        # Running columns only grow, so the largest value up to a time is the latest.
        return F.max(c).over(w.rangeBetween(Window.unboundedPreceding, -n * step))

    then_rate = F.max("error_rate").over(w.rangeBetween(-LAG_BUCKETS * step, -LAG_BUCKETS * step))
    out = _features(copies, w, before, then_rate)
    return out.where(F.col("_piece") == F.col("_own")).drop("_t", "_own", "_piece")


def filled(ctx: DataFrame) -> DataFrame:
    """Context with the defaults for what has no value: velocity 1, acceleration 0, surge 0."""
    return ctx.withColumns({
        "throughput_velocity": F.coalesce("throughput_velocity", F.lit(1.0)),
        "error_acceleration": F.coalesce("error_acceleration", F.lit(0.0)),
        "is_surge": F.coalesce("is_surge", F.lit(0)),
    })


def attach_context(logs: DataFrame, ctx: DataFrame, bucket: str = "minute", lazy: bool = False) -> DataFrame:
    """Log rows with the context of their bucket in place of the stored placeholders."""
    features = ["throughput_velocity", "error_acceleration", "is_surge"]
    rows = logs.drop(*features).withColumn("window_start", bucket_start("timestamp", bucket))
    right = ctx.select("service_id", "window_start", *features, "total_reqs")
    join = attach_lazy if lazy else attach
    return filled(join(rows, right, ["service_id", "window_start"], weight="total_reqs")).drop("window_start")


def rolling_latency(logs: DataFrame, buckets: int = VELOCITY_BUCKETS, bucket: str = "minute",
                    chunk_rows: int | None = None) -> DataFrame:
    """Mean latency of a service over its last ``buckets`` buckets, weighted by requests."""
    sums = logs.groupBy("service_id", bucket_start("timestamp", bucket).alias("window_start")).agg(
        F.count(F.lit(1)).alias("total_reqs"), F.sum("response_time_ms").alias("latency_sum"))

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        last = w.rowsBetween(1 - buckets, 0)
        return df.withColumns({
            "avg_latency": ratio("latency_sum", "total_reqs"),
            "rolling_latency": ratio(F.sum("latency_sum").over(last), F.sum("total_reqs").over(last))})

    return over_series(sums, ["service_id"], "window_start", buckets, compute, chunk_rows)


def seasonal_baseline(merged: DataFrame) -> DataFrame:
    """Every bucket next to what its service usually sees at that hour of the day."""
    hours = merged.withColumn("hour_of_day", F.hour("window_start"))
    usual = hours.groupBy("service_id", "hour_of_day").agg(
        F.avg("total_reqs").alias("usual_reqs"),
        ratio(F.sum("error_reqs"), F.sum("total_reqs")).alias("usual_error_rate"),
        F.count(F.lit(1)).alias("_buckets"))
    out = attach(hours, usual, ["service_id", "hour_of_day"], weight="_buckets")
    return out.withColumn("vs_usual", ratio("total_reqs", "usual_reqs"))
