"""Top rows. Ties are broken by a key, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clock import bucket_start

SCORE = "anomaly_score"


def top_scores(df: DataFrame, k: int, key: str = "event_id") -> DataFrame:
    return df.orderBy(F.desc(SCORE), key).limit(k)


def latest(df: DataFrame, k: int, key: str = "event_id") -> DataFrame:
    return df.orderBy(F.desc("timestamp"), key).limit(k)


def recent(df: DataFrame, as_of: Column, hours: int, ts: str = "timestamp") -> DataFrame:
    """Rows not older than ``hours`` at ``as_of``."""
    return df.where(F.col(ts) >= as_of - F.make_dt_interval(hours=F.lit(hours)))


def above(df: DataFrame, threshold: Column | float) -> DataFrame:
    return df.where(F.col(SCORE) > F.lit(threshold))


def top_endpoints(df: DataFrame, threshold: Column | float) -> DataFrame:
    """Endpoints by number of rows above a threshold."""
    return above(df, threshold).groupBy("endpoint").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "endpoint")


def top_n_per_hour(df: DataFrame, n: int, key: str = "event_id") -> DataFrame:
    """The n highest scores of each hour. Every task keeps n rows per hour before the shuffle."""
    w = Window.partitionBy("hour_start").orderBy(F.desc(SCORE), key)
    return (df.withColumn("hour_start", bucket_start("timestamp", "hour"))
              .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))
