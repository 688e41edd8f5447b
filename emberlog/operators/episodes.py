"""Alerts that belong together: one episode instead of many alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..functions.clock import BUCKET_SECONDS, bucket_start, seconds
from ..session import pinned
from .alerts import SCORE
from .joins import attach
from .rank import above
from .windows import highest_so_far, over_series


def alert_episodes(scored: DataFrame, threshold: Column | float, gap: int = 1800, cooldown: int = 7200, k: int = 3,
                   bucket: str = "minute", key: str = "event_id", chunk_rows: int | None = None) -> DataFrame:
    """Episodes of each service: (service_id, episode_start, episode_end, n_alerts, peak_score, examples, is_notified).

    Rows above the threshold that follow each other by at most ``gap`` seconds are one episode; it ends with its last row.
    ``examples`` are the keys of its ``k`` highest rows, highest first, ties by key. ``is_notified`` is 1 if the service had no episode
    in the ``cooldown`` seconds before: only then does the episode deserve a message. Rows without a score or a time are
    in no episode; a null service is a service.

    Rows are reduced to one per bucket before they meet, as rows of one bucket, which is no longer than the gap, belong together. So
    nothing but a bucket's highest rows and counts is ordered by service, and a series of many buckets is cut by day.
    """
    if gap < BUCKET_SECONDS[bucket]:
        raise ValueError(f"the gap must last a {bucket} at least")
    place = ["service_id", "_bucket"]
    high = above(scored, threshold).where(F.col("timestamp").isNotNull()).withColumn("_bucket", bucket_start("timestamp", bucket))
    counts = high.groupBy(*place).agg(F.min("timestamp").alias("_first"), F.max("timestamp").alias("_end"),
                                      F.count(F.lit(1)).alias("_n"), F.max(SCORE).alias("_peak"))

    def starts(df: DataFrame, w: WindowSpec) -> DataFrame:
        quiet = F.col("_first") > F.lag("_end").over(w) + seconds(gap)
        return df.withColumn("_start", F.when(F.coalesce(quiet, F.lit(True)), F.col("_first")))

    marked = over_series(counts, ["service_id"], "_bucket", 1, starts, chunk_rows)
    placed = pinned(highest_so_far(marked, ["service_id"], "_bucket", "_start", "episode_start"))
    whole = ["service_id", "episode_start"]
    episodes = placed.groupBy(*whole).agg(F.max("_end").alias("episode_end"), F.sum("_n").alias("n_alerts"), F.max("_peak").alias("peak_score"))

    def notified(df: DataFrame, w: WindowSpec) -> DataFrame:
        recent = F.col("episode_start") <= F.lag("episode_end").over(w) + seconds(cooldown)
        return df.withColumn("is_notified", F.when(recent, 0).otherwise(1))

    told = over_series(episodes, ["service_id"], "episode_start", 1, notified, chunk_rows)

    def best(df: DataFrame, by: list[str]) -> DataFrame:
        return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(SCORE), key))).where(F.col("_rank") <= k)

    tops = best(high.select(*place, key, SCORE), place).drop("_rank")
    tops = best(attach(tops, placed.select(*place, "episode_start"), place), whole)
    ordered = F.sort_array(F.collect_list(F.struct("_rank", F.col(key).alias("_key"))))
    examples = tops.groupBy(*whole).agg(F.transform(ordered, lambda x: x["_key"]).alias("examples"))
    return attach(told, examples, whole).select(*whole, "episode_end", "n_alerts", "peak_score", "examples", "is_notified")
