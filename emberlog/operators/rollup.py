"""Counts per service and time bucket, as partial counts per batch and merged on read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from ..functions.clock import bucket_start
from ..functions.score import is_error
from ..session import discard, there
from ..sources.contract import ROLLUP_SCHEMA

RETENTION_DAYS = 14
BACKFILL_BATCH = -1


def rollup(logs: DataFrame, bucket: str = "minute") -> DataFrame:
    """Request and error counts per (service, bucket, hour). Of one batch these are its partial counts."""
    return _counts(logs, bucket, F.hour("timestamp").alias("hour_of_day"))


def buckets(logs: DataFrame, bucket: str = "minute") -> DataFrame:
    """Merged counts per (service, bucket) straight from all logs, for when there is no store of partials."""
    return _counts(logs, bucket)


def _counts(logs: DataFrame, bucket: str, *keys: Column) -> DataFrame:
    start = bucket_start("timestamp", bucket).alias("window_start")
    return (logs.groupBy("service_id", start, *keys)
                .agg(F.count(F.lit(1)).alias("total_reqs"), F.count_if(is_error()).alias("error_reqs")))


def merge_partials(partials: DataFrame, keys: Sequence[str] = ("service_id", "window_start")) -> DataFrame:
    """Add up partial counts. Rows that came late simply add to their old bucket."""
    return partials.groupBy(*keys).agg(F.sum("total_reqs").alias("total_reqs"),
                                       F.sum("error_reqs").alias("error_reqs"))


def coarser(rolled: DataFrame, bucket: str) -> DataFrame:
    """Hour or day buckets from minute buckets."""
    wide = rolled.withColumn("window_start", bucket_start("window_start", bucket))
    return merge_partials(wide, ("service_id", "window_start"))


def control_totals(rolled: DataFrame) -> DataFrame:
    """Sums over all buckets, to be held against the log table."""
    return rolled.agg(F.count(F.lit(1)).alias("buckets"), F.sum("total_reqs").alias("total_reqs"),
                      F.sum("error_reqs").alias("error_reqs"))


def retained(rolled: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Buckets not older than ``days`` at ``as_of``."""
    return rolled.where(F.col("window_start") >= as_of - F.make_dt_interval(F.lit(days)))


# --- the store of partial counts: one folder per day, inside it one per batch --------------------------------
#
# Batches are numbered from 0; -1 is the backfill. Compaction writes the merged counts of a day under a number
# below that, then a manifest row that says which batches it replaces, then deletes those. Readers take a compacted
# batch only if the manifest has it, and no batch that is replaced, so a crash at any point changes no count. The manifest
# lies in folders by day, too, and goes with its day when that expires.

KEYS = ("service_id", "window_start", "hour_of_day")
_MANIFEST = StructType([StructField("day", DateType()), StructField("replaced", LongType()), StructField("by", LongType())])


def write_partials(logs: DataFrame, root: str, batch_id: int, bucket: str = "minute") -> None:
    """Roll up one batch into its folders. Writing the same batch again replaces them, so a replay is harmless."""
    _write(rollup(logs, bucket), root, batch_id)


def _write(rolled: DataFrame, root: str, batch_id: int) -> None:
    """Few files per day; of existing folders, only those of this batch are replaced."""
    days = rolled.withColumns({"event_date": F.col("window_start").cast("date"), "batch_id": F.lit(batch_id).cast("bigint")})
    (days.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "batch_id").parquet(root))


def backfill(logs: DataFrame, root: str, bucket: str = "minute") -> None:
    """Roll up the rows that were there before the stream began."""
    write_partials(logs, root, BACKFILL_BATCH, bucket)


def _stored_partials(spark: SparkSession, root: str) -> DataFrame:
    schema = StructType(ROLLUP_SCHEMA.fields + [StructField("event_date", DateType()), StructField("batch_id", LongType())])
    return spark.read.schema(schema).parquet(root)


def _manifest(spark: SparkSession, root: str) -> list[tuple]:
    """(day, replaced, by) of all compactions whose day is not deleted: a few rows per day of retention."""
    folder = f"{root}/_manifest"
    if not there(spark, folder):
        return []
    return [tuple(r) for r in spark.read.schema(_MANIFEST).parquet(folder).select("day", "replaced", "by").collect()]


def read_partials(spark: SparkSession, root: str, since: Column | None = None) -> DataFrame:
    """Partial counts of all batches; ``since`` skips whole days before it, then buckets."""
    df = _stored_partials(spark, root)
    if since is not None:
        df = df.where((F.col("event_date") >= since.cast("date")) & (F.col("window_start") >= since))
    replaced = _manifest(spark, root)
    if replaced:
        gone = spark.createDataFrame([(d, b) for d, b, _ in replaced], "event_date date, batch_id bigint")
        by = spark.createDataFrame(sorted({(d, n) for d, _, n in replaced}), "event_date date, batch_id bigint")
        df = df.join(F.broadcast(gone), ["event_date", "batch_id"], "left_anti")
        df = df.where(F.col("batch_id") >= BACKFILL_BATCH).unionByName(
            df.where(F.col("batch_id") < BACKFILL_BATCH).join(F.broadcast(by), ["event_date", "batch_id"], "left_semi"))
    else:
        df = df.where(F.col("batch_id") >= BACKFILL_BATCH)
    return df.select(*ROLLUP_SCHEMA.fieldNames(), "batch_id")


def compact_partials(spark: SparkSession, root: str, before) -> int:
    """Merge the batches of each day before ``before`` (a date) that has several into one; gives back how many went.

    A running stream goes on meanwhile: it writes under other numbers, and what it adds to a compacted day later
    counts on top until the next compaction.
    """
    days = _stored_partials(spark, root).where(F.col("event_date") < F.lit(before)).select("event_date", "batch_id").distinct()
    known = _manifest(spark, root)
    there_now, compacted = {(r.event_date, r.batch_id) for r in days.collect()}, {(d, n) for d, _, n in known}
    live = there_now - {(d, b) for d, b, _ in known}
    live = {(d, b) for d, b in live if b >= BACKFILL_BATCH or (d, b) in compacted}
    per_day = Counter(d for d, _ in live)
    many = sorted((d, b) for d, b in live if per_day[d] > 1)
    if many:
        number = min([BACKFILL_BATCH, *(n for _, _, n in known)]) - 1
        chosen = spark.createDataFrame(many, "event_date date, batch_id bigint")
        rows = _stored_partials(spark, root).join(F.broadcast(chosen), ["event_date", "batch_id"], "left_semi")
        _write(merge_partials(rows, KEYS), root, number)
        (spark.createDataFrame([(d, b, number) for d, b in many], _MANIFEST).coalesce(1)
              .write.mode("append").partitionBy("day").parquet(f"{root}/_manifest"))
    for day, batch in sorted(there_now & {(d, b) for d, b, _ in known} | set(many)):  # also what a crash has left
        discard(spark, f"{root}/event_date={day}/batch_id={batch}")
    return len(many)


def expire_partials(spark: SparkSession, root: str, before) -> int:
    """Delete the days before ``before`` (a date) from the store; gives back how many."""
    days = _stored_partials(spark, root).where(F.col("event_date") < F.lit(before)).select("event_date").distinct().collect()
    for row in days:
        discard(spark, f"{root}/event_date={row.event_date}")
        discard(spark, f"{root}/_manifest/day={row.event_date}")
    return len(days)
