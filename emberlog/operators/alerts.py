"""Thresholds and alerts over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..functions.clock import bucket_start
from ..functions.score import spread, z_score
from ..session import pinned
from .joins import attach
from .rank import above
from .windows import over_series

SCORE = "anomaly_score"


def apply_thresholds(scored: DataFrame, thresholds: DataFrame, default: float) -> DataFrame:
    """Rows with the threshold of their service, or the default, and an ``is_alert`` flag."""
    rows = attach(scored, thresholds.select("service_id", "threshold"), ["service_id"])
    limit = F.coalesce("threshold", F.lit(default))
    return rows.withColumn("threshold", limit).withColumn(
        "is_alert", F.when(F.col(SCORE) > F.col("threshold"), 1).otherwise(0))


def anomaly_series(scored: DataFrame, threshold: Column | float, bucket: str = "hour",
                   by: Sequence[str] = ()) -> DataFrame:
    """Rows above a threshold per time bucket; a bucket with traffic but no such row counts zero."""
    return (scored.groupBy(*by, bucket_start("timestamp", bucket).alias("bucket_start"))
            .agg(F.count_if(F.col(SCORE) > threshold).alias("n_anomalies")))


def sliding_counts(scored: DataFrame, threshold: Column | float, length: str = "10 minutes",
                   slide: str = "5 minutes", by: Sequence[str] = ("service_id",)) -> DataFrame:
    """Rows above a threshold per sliding window; the same plan serves batches and streams."""
    w = F.window("timestamp", length, slide)
    counts = above(scored, threshold).groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("n_anomalies"))
    edges = [F.col(f"w.{e}").cast("timestamp_ntz").alias(f"window_{e}") for e in ("start", "end")]
    return counts.select(*by, *edges, "n_anomalies")


def sliding_alerts(scored: DataFrame, threshold: Column | float, limit: int, **window) -> DataFrame:
    return sliding_counts(scored, threshold, **window).where(F.col("n_anomalies") >= limit)


def count_alert(scored: DataFrame, threshold: Column | float, limit: int) -> DataFrame:
    """One row with the count when more rows than ``limit`` are above the threshold, otherwise none."""
    return above(scored, threshold).agg(F.count(F.lit(1)).alias("n_anomalies")).where(F.col("n_anomalies") > limit)


def zscore_alerts(series: DataFrame, buckets: int = 60, z: float = 3.0, by: Sequence[str] = ("service_id",),
                  chunk_rows: int | None = None) -> DataFrame:
    """Buckets of an anomaly series whose count stands out from the ``buckets`` before it and itself."""
    x = F.col("n_anomalies")
    wide = x.cast("decimal(20,0)")

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        last = w.rowsBetween(-buckets, 0)
        sums = df.withColumns({"_n": F.count(F.lit(1)).over(last), "_sum": F.sum(x).over(last),
                               "_squares": F.sum(wide * wide).over(last)})
        z = z_score(x, "_n", "_sum", spread("_n", "_sum", "_squares"))
        return sums.withColumn("z", z).drop("_n", "_sum", "_squares")

    return over_series(series, by, "bucket_start", buckets, compute, chunk_rows).where(F.col("z") > z)


def alert_examples(scored: DataFrame, threshold: Column | float, limit: int, k: int, bucket: str = "hour",
                   key: str = "event_id") -> DataFrame:
    """For each (service, bucket) with at least ``limit`` rows above the threshold: its k highest rows."""
    high = above(scored, threshold).withColumn("bucket_start", bucket_start("timestamp", bucket))
    keys = ["service_id", "bucket_start"]
    counts = high.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_anomalies"))
    alerts = counts.where(F.col("n_anomalies") >= limit).withColumn("_w", F.col("n_anomalies"))
    w = Window.partitionBy(*keys).orderBy(F.desc(SCORE), key)
    best = high.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return attach(best, alerts, keys, weight="_w").where(F.col("n_anomalies").isNotNull())


def thresholds_asof(scored: DataFrame, changes: DataFrame, default: float, bucket: str = "minute") -> DataFrame:
    """Rows with the ``threshold`` that was in force for their service at their time, and ``default`` before its first.

    ``changes`` (service_id, valid_from, threshold) says from when on a threshold holds; of two with one time the larger counts, a null
    one does not. A row's bucket brings the threshold in force when it begins, carried along the buckets of the service, and the changes
    within it, which are few. So log rows are neither sorted nor put into one task by service: they are joined by (service, bucket).
    """
    place = ["service_id", "_bucket"]
    rows = scored.drop("threshold").withColumn("_bucket", bucket_start("timestamp", bucket))
    marks = changes.where(F.col("threshold").isNotNull() & F.col("valid_from").isNotNull()).select(
        "service_id", bucket_start("valid_from", bucket).alias("_bucket"), F.struct("valid_from", F.col("threshold").cast("double").alias("threshold")).alias("_mark"))
    series = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).withColumn("_mark", F.lit(None).cast(marks.schema["_mark"].dataType))
    both = series.unionByName(marks.withColumn("_n", F.lit(0).cast("bigint")))
    buckets = both.groupBy(*place).agg(F.sum("_n").alias("_n"), F.max("_mark").alias("_last"), F.sort_array(F.collect_list("_mark")).alias("_marks"))
    before = Window.partitionBy("service_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.withColumn("_carried", F.last(F.col("_last")["threshold"], ignorenulls=True).over(before))
    carried = pinned(carried.where("_n > 0").select(*place, "_carried", "_marks", "_n"))
    width = F.lit(128) + F.lit(48) * F.size("_marks") + F.coalesce(F.octet_length("service_id"), F.lit(0))
    size = carried.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()["b"]
    met = attach(rows, carried, place, weight="_n", size=size)
    within = F.try_element_at(F.filter("_marks", lambda m: m["valid_from"] <= F.col("timestamp")), F.lit(-1))["threshold"]
    return met.withColumn("threshold", F.coalesce(within, F.col("_carried"), F.lit(float(default)))).drop("_bucket", "_carried", "_marks")
