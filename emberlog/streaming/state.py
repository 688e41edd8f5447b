"""Context of a service held as stream state: the last 61 buckets, and nothing else.

Row windows are not allowed on streams. This processor takes closed buckets in time order and gives
each one the same features as the batch operator.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.score import is_error
from ..operators.context import LAG_BUCKETS, SURGE_BUCKETS, SURGE_Z, VELOCITY_BUCKETS
from .live import with_event_time

OUTPUT = ("service_id string, window_start timestamp_ntz, total_reqs bigint, error_reqs bigint, "
          "throughput_velocity double, error_acceleration double, is_surge int")
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bucket_features(past: list[tuple[int, int]], total: int, errors: int) -> tuple[float | None, float | None, int]:
    """Velocity, acceleration and surge of a bucket after its (total, errors) predecessors."""
    totals = [t for t, _ in past[-SURGE_BUCKETS:]] + [total]
    recent = totals[-VELOCITY_BUCKETS:]
    velocity = total / (sum(recent) / len(recent)) if sum(recent) else None
    acceleration = None
    if len(past) >= LAG_BUCKETS and total:
        then_total, then_errors = past[-LAG_BUCKETS]
        if then_total and then_errors:
            acceleration = (errors / total) / (then_errors / then_total)
    n, s, q = len(totals), sum(totals), sum(t * t for t in totals)
    spread = n * q - s * s
    surge = int(spread > 0 and (n * total - s) / sqrt(spread) > SURGE_Z)
    return velocity, acceleration, surge


class ServiceContext(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getListState("past", "total_reqs bigint, error_reqs bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        past = [tuple(r) for r in self.past.get()]
        # One micro-batch brings a few closed buckets of a service; they must be taken in time order.
        batch = pd.concat(list(rows)).sort_values("window_start")
        features = []
        for total, errors in zip(batch["total_reqs"].tolist(), batch["error_reqs"].tolist()):
            features.append(bucket_features(past, total, errors))
            past = (past + [(total, errors)])[-SURGE_BUCKETS:]
        self.past.put(past)
        out = batch[["window_start", "total_reqs", "error_reqs"]].copy()
        out.insert(0, "service_id", key[0])
        out[["throughput_velocity", "error_acceleration"]] = [f[:2] for f in features]
        out["is_surge"] = [f[2] for f in features]
        yield out

    def close(self) -> None:
        pass


def closed_buckets(logs: DataFrame, length: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """One row per service and bucket, given out when the watermark has passed its end."""
    counts = (with_event_time(logs, delay)
              .groupBy("service_id", F.window("timestamp", length).alias("w"))
              .agg(F.count(F.lit(1)).alias("total_reqs"), F.count_if(is_error()).alias("error_reqs")))
    start = F.col("w.start").cast("timestamp_ntz").alias("window_start")
    return counts.select("service_id", start, "total_reqs", "error_reqs")


def stream_context(buckets: DataFrame) -> DataFrame:
    """Context rows of a stream of closed buckets. The session must use STATE_PROVIDER for its state."""
    return buckets.groupBy("service_id").transformWithStateInPandas(
        ServiceContext(), OUTPUT, outputMode="Append", timeMode="None")
