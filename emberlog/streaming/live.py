"""Incremental rollup, continuous scoring and alerts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import bucket_start
from ..operators import alerts
from ..operators import context as ctx
from ..operators import rollup as ru
from ..operators.joins import attach
from ..operators.windows import over_series
from ..plans import view
from ..session import pinned, there

Scorer = Callable[[DataFrame], DataFrame]


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
           trigger: dict | None) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def stream_rollup(stream: DataFrame, root: str, checkpoint: str, bucket: str = "minute",
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep the store of partial counts up to date.

    Each micro-batch goes to a folder named after its number and replaces what a failed try left there.
    Counts are merged on read, so late rows need no watermark and no state is held. The stream
    counts what arrives after it starts; :func:`emberlog.operators.rollup.backfill` adds the rest.
    """
    return _start(stream, lambda batch, n: ru.write_partials(batch, root, n, bucket), checkpoint, trigger)


def stream_scored(stream: DataFrame, root: str, sink: str, checkpoint: str, scorer: Scorer,
                  bucket: str = "minute", since: Column | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Roll up each micro-batch, then score its rows against everything rolled up so far.

    ``since`` bounds how far back buckets are read; without it, that is the retention time before the first row
    of the batch. Scored rows of batch N go to ``batch_id=N``.
    """
    def handle(batch: DataFrame, n: int) -> None:
        rows = batch.persist()
        try:
            first = rows.agg(F.min("timestamp").alias("t")).first()["t"]
            if first is None:
                return
            back = F.lit(first - timedelta(days=ru.RETENTION_DAYS)).cast("timestamp_ntz") if since is None else since
            ru.write_partials(rows, root, n, bucket)
            seen = ru.read_partials(batch.sparkSession, root, back).where(F.col("batch_id") <= n)
            context = view.scored_context(rows, ru.merge_partials(seen), bucket)
            scorer(context).write.mode("overwrite").parquet(f"{sink}/batch_id={n}")
        finally:
            rows.unpersist()

    return _start(stream, handle, checkpoint, trigger)


# --- scores that follow late rows ---------------------------------------------------------------------------------
#
# A late row changes the counts of its bucket, and so the frames of the buckets after it. Scored rows are kept by bucket: when
# a bucket is scored again, all its rows go to the folder of that batch, and a small table beside them says which buckets the batch
# holds. A bucket's rows are those of the last batch that has it. Nothing is rewritten in place, so a replay changes nothing.

_BUCKET = ["service_id", "window_start"]


def _versions(sink: str) -> str:
    return f"{sink}/buckets"


def read_scored(spark, sink: str, before: int | None = None) -> DataFrame:
    """The current row of every log row that :func:`stream_rescored` has scored; ``before`` leaves out batches from that number on."""
    versions, rows = spark.read.parquet(_versions(sink)), spark.read.parquet(f"{sink}/rows")
    if before is not None:
        versions, rows = versions.where(F.col("batch_id") < before), rows.where(F.col("batch_id") < before)
    last = versions.groupBy(*_BUCKET).agg(F.max("batch_id").alias("_last"), F.max_by("n", "batch_id").alias("_n"))
    current = attach(rows, last, _BUCKET, weight="_n")
    return current.where(F.col("batch_id") == F.col("_last")).drop("_last", "batch_id")


def stale_buckets(merged: DataFrame, touched: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Buckets whose context a change in the ``touched`` ones reaches: these, and the 60 bucket rows after each of them.

    No frame of the contract reaches further back than that. ``merged`` holds all buckets after the change.
    """
    marked = attach(merged, touched.select(*_BUCKET, F.lit(1).alias("_touched")), _BUCKET)

    def compute(df: DataFrame, w) -> DataFrame:
        return df.withColumn("_stale", F.max("_touched").over(w.rowsBetween(-ctx.SURGE_BUCKETS, 0)))

    return over_series(marked, ["service_id"], "window_start", ctx.SURGE_BUCKETS, compute, chunk_rows).where("_stale = 1").select(*_BUCKET, "total_reqs")


def stream_rescored(stream: DataFrame, root: str, sink: str, checkpoint: str, scorer: Scorer,
                    bucket: str = "minute", since: Column | None = None,
                    trigger: dict | None = None) -> StreamingQuery:
    """Score each micro-batch, and score again the earlier rows whose context its rows have changed.

    After any batch, :func:`read_scored` gives what scoring all rows so far in one go would give, in whatever order they came.
    Only stale buckets are read back and written again. ``since`` bounds how far back buckets count, as in
    :func:`stream_scored`; the bound should lie before everything that late rows may still reach.
    """
    def handle(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("window_start", bucket_start("timestamp", bucket)).persist()
        try:
            first = rows.agg(F.min("timestamp").alias("t")).first()["t"]
            if first is None:
                return
            back = F.lit(first - timedelta(days=ru.RETENTION_DAYS)).cast("timestamp_ntz") if since is None else since
            ru.write_partials(batch, root, n, bucket)
            merged = pinned(ru.merge_partials(ru.read_partials(spark, root, back).where(F.col("batch_id") <= n)))
            stale = pinned(stale_buckets(merged, rows.select(*_BUCKET).distinct()))
            affected = rows
            if there(spark, _versions(sink)):
                earlier = attach(read_scored(spark, sink, n), stale.select(*_BUCKET, "total_reqs", F.lit(1).alias("_stale")), _BUCKET, weight="total_reqs")
                affected = rows.unionByName(earlier.where("_stale = 1").select(*rows.columns))
            features = ctx.context(merged, bucket=bucket).drop("hour_of_day")
            scored = scorer(ctx.attach_context(affected.drop("window_start"), features, bucket))
            scored = scored.withColumn("window_start", bucket_start("timestamp", bucket))
            scored.write.mode("overwrite").parquet(f"{sink}/rows/batch_id={n}")
            stale.select(*_BUCKET, F.col("total_reqs").alias("n")).write.mode("overwrite").parquet(f"{_versions(sink)}/batch_id={n}")
        finally:
            rows.unpersist()

    return _start(stream, handle, checkpoint, trigger)


def with_event_time(stream: DataFrame, delay: str) -> DataFrame:
    """``stream`` with a watermark, which Spark allows on zoned timestamps only. The session zone must be UTC."""
    if stream.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError("set spark.sql.session.timeZone to UTC: log times carry no zone")
    return stream.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)


def sliding_alerts(scored: DataFrame, threshold: float, limit: int, delay: str = "10 minutes", **window) -> DataFrame:
    """Alerts over sliding windows of a scored stream; rows later than ``delay`` are not counted any more."""
    return alerts.sliding_alerts(with_event_time(scored, delay), threshold, limit, **window)
