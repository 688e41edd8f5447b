"""State that remembers when a key was last there: new signatures, and episodes that deserve a message."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.clock import BUCKET_SECONDS, bucket_start, seconds
from ..operators.alerts import SCORE
from ..operators.rank import above
from .live import with_event_time

SIGNATURES = "service_id string, log_signature string, window_start timestamp_ntz, n bigint"
EPISODES = ("service_id string, episode_start timestamp_ntz, episode_end timestamp_ntz, n_alerts bigint, peak_score double, "
            "peak_id bigint, is_notified int")


class FirstSeen(StatefulProcessor):
    """Closed buckets of one (service, signature); those go out before which the signature was not there for the retention time."""

    def __init__(self, retention: int, length: int) -> None:
        self.retention, self.length = retention, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "window_start timestamp_ntz")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("window_start")
        keep = pd.Timedelta(seconds=self.retention)
        last = pd.Timestamp(self.last.get()[0]) if self.last.exists() else None
        fresh = []
        for start in batch["window_start"]:
            fresh.append(last is None or start - last > keep)
            last = start
        self.last.update((last.to_pydatetime(),))
        # One timer a key: it forgets a signature that has not come back. A bucket that begins within the retention time is closed a bucket later.
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int((last + keep).timestamp() + self.length) * 1000)
        if any(fresh):
            out = batch.loc[fresh, ["window_start", "n"]].copy()
            out.insert(0, "service_id", key[0])
            out.insert(1, "log_signature", key[1])
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_seen(logs: DataFrame, retention: int, bucket: str = "hour") -> DataFrame:
    """(service_id, log_signature, window_start, n): buckets with a signature that no bucket of the ``retention`` seconds before has.

    Null is a service or signature like others. Rows without a time are in no bucket.
    """
    pair = ["service_id", "log_signature"]
    counts = logs.where(F.col("timestamp").isNotNull()).groupBy(*pair, bucket_start("timestamp", bucket).alias("window_start")).agg(F.count(F.lit(1)).alias("n"))
    last = F.lag("window_start").over(Window.partitionBy(*pair).orderBy("window_start"))
    known = F.coalesce(F.col("window_start") <= last + seconds(retention), F.lit(False))
    return counts.withColumn("_known", known).where(~F.col("_known")).drop("_known")


def stream_first_seen(logs: DataFrame, retention: int, bucket: str = "hour", delay: str = "10 minutes") -> DataFrame:
    """:func:`first_seen` over the buckets that the watermark has closed.

    State is kept by (service, signature), one time each, so a service with most of the rows is no task of its own; what
    reaches it is one row per bucket. A timer drops a pair that was not there for the retention time, so
    state does not grow with time.
    """
    counts = (with_event_time(logs, delay).groupBy("service_id", "log_signature", F.window("timestamp", f"{BUCKET_SECONDS[bucket]} seconds").alias("w"))
              .agg(F.count(F.lit(1)).alias("n")))
    closed = counts.select("service_id", "log_signature", "w", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n")
    return closed.groupBy("service_id", "log_signature").transformWithStateInPandas(
        FirstSeen(retention, BUCKET_SECONDS[bucket]), SIGNATURES, outputMode="Append", timeMode="EventTime")


class Cooldown(StatefulProcessor):
    """Closed episodes of one service in time order, with whether it was quiet before."""

    def __init__(self, cooldown: int) -> None:
        self.cooldown = cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ended = handle.getValueState("ended", "episode_end timestamp_ntz")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("episode_start")
        ended = pd.Timestamp(self.ended.get()[0]) if self.ended.exists() else None
        told = []
        for start, end in zip(batch["episode_start"], batch["episode_end"]):
            told.append(int(ended is None or start - ended > pd.Timedelta(seconds=self.cooldown)))
            ended = end
        self.ended.update((ended.to_pydatetime(),))
        out = batch[["episode_start", "episode_end", "n_alerts", "peak_score", "peak_id"]].copy()
        out.insert(0, "service_id", key[0])
        out["is_notified"] = told
        yield out

    def close(self) -> None:
        pass


def stream_episodes(scored: DataFrame, threshold: Column | float, gap: int = 1800, cooldown: int = 7200, delay: str = "10 minutes",
                    key: str = "event_id") -> DataFrame:
    """The episodes of :func:`emberlog.operators.episodes.alert_episodes` as the watermark closes them, each with its highest row.

    An episode is closed when the watermark has passed its last alert by the gap. Rows above the threshold move the watermark.
    Episodes of a service follow each other in time, so its state is the end of the last one.
    """
    high = with_event_time(above(scored, threshold), delay)
    span = F.session_window("timestamp", f"{gap} seconds").alias("w")
    best = F.min_by(key, F.struct(-F.col(SCORE), F.col(key)))
    episodes = high.groupBy("service_id", span).agg(
        F.max("timestamp").alias("_end"), F.count(F.lit(1)).alias("n_alerts"), F.max(SCORE).alias("peak_score"), best.alias("peak_id"))
    closed = episodes.select("service_id", F.col("w.start").cast("timestamp_ntz").alias("episode_start"),
                             F.col("_end").cast("timestamp_ntz").alias("episode_end"), "n_alerts", "peak_score", "peak_id")
    # Sessions and the state below may not share a task, and would if both were spread by the same key.
    apart = closed.withColumn("_apart", F.xxhash64("service_id"))
    return apart.groupBy("service_id", "_apart").transformWithStateInPandas(Cooldown(cooldown), EPISODES, outputMode="Append", timeMode="None")
