"""The scored views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import BUCKET_SECONDS, in_range, seconds
from ..operators import context as ctx
from ..operators import rollup as ru
from ..sources import contract
from . import model as ml

# Columns of the two views before the score.
VIEW_V1_COLUMNS = contract.V1_SCHEMA.fieldNames()
VIEW_V2_COLUMNS = ["timestamp", "service_id", "endpoint", "status_code", "response_time_ms", "hour_of_day",
                   "throughput_velocity", "error_acceleration", "is_surge", "log_signature", "log_payload",
                   "is_anomaly"]


def score_v1(logs: DataFrame, model: PipelineModel) -> DataFrame:
    return ml.score(logs.select(*VIEW_V1_COLUMNS), model)


def scored_context(logs: DataFrame, rolled: DataFrame | None = None, bucket: str = "minute",
                   frame: str = "rows", chunk_rows: int | None = None, lazy: bool = False) -> DataFrame:
    """Log rows with computed context. ``rolled`` are merged buckets; without them the logs are rolled up here.

    The result keeps one row per log row, also where a bucket is missing. With ``lazy``, nothing runs before the result
    is read, and a view of it computes rows and context anew each time; series are then taken to be short unless
    ``chunk_rows`` is given.
    """
    merged = ru.buckets(logs, bucket) if rolled is None else rolled
    if lazy and chunk_rows is None:
        chunk_rows = 0
    return ctx.attach_context(logs, ctx.context(merged, frame, bucket, chunk_rows), bucket, lazy)


def score_v2(logs: DataFrame, rolled: DataFrame, model: PipelineModel, keep: tuple[str, ...] = (),
             **options) -> DataFrame:
    """The adaptive view: 12 columns and the score; ``keep`` names further columns to carry."""
    rows = scored_context(logs, rolled, **options).select(*keep, *VIEW_V2_COLUMNS)
    return ml.score(rows, model)


def scored_between(logs: DataFrame, partials: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                   start: Column, end: Column, bucket: str = "minute") -> DataFrame:
    """Scored rows of ``[start, end)`` with time-true context.

    A filter on log time cannot move below the windows by itself. Here logs are read for the range
    only, and buckets from one halo (60 buckets) before it, which range frames never look past.
    """
    halo = seconds((ctx.SURGE_BUCKETS + 1) * BUCKET_SECONDS[bucket])
    near = partials.where(in_range("window_start", start - halo, end))
    rows = logs.where(in_range("timestamp", start, end))
    return scorer(scored_context(rows, ru.merge_partials(near), bucket, frame="range"))


def anomaly_view(df: DataFrame, name: str = contract.VIEW_V2) -> None:
    """Register a scored frame under a name; every query on it reads its sources anew, if the frame was built lazily
    (:func:`scored_context` with ``lazy``) over catalog tables."""
    df.createOrReplaceTempView(name)


def training_events(logs: DataFrame, rolled: DataFrame, bucket: str = "minute", version: int | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Training rows whose context is computed as in scoring, not read from the stored placeholders."""
    rows = logs if version is None else contract.for_version(logs, version)
    full = scored_context(rows, rolled, bucket)
    return full.select(*keep, *contract.FEATURES_V2, F.col(contract.TARGET))
