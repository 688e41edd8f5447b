"""Labels for training: from rules, incidents, analyst tags and lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clock import bucket_start, seconds
from .joins import attach, attach_range
from .quantiles import exact_quantiles

# The levels and error kinds that mark a row as anomalous.
BAD_LEVELS = ("ERROR", "FATAL")
BAD_KINDS = ("TIMEOUT", "DEPENDENCY_FAILURE")
SLOT = "hour"


def any_of(*rules: Column) -> Column:
    """1 when a rule holds; a rule that is null does not."""
    return F.when(reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules]), 1).otherwise(0)


def rule_label(df: DataFrame, exceptions: Sequence[str] = (), levels: Sequence[str] = BAD_LEVELS,
               kinds: Sequence[str] = BAD_KINDS, target: str = "is_anomaly") -> DataFrame:
    """Label by status, level, error kind or listed exception, over the columns the frame has."""
    rules = [F.col("status_code") >= 500]
    if "log_level" in df.columns:
        rules.append(F.col("log_level").isin(*levels))
    if "error_kind" in df.columns:
        rules.append(F.col("error_kind").isin(*kinds))
    if exceptions and "exception_class" in df.columns:
        rules.append(F.col("exception_class").isin(*exceptions))
    return df.withColumn(target, any_of(*rules))


def merged_spans(spans: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    """Spans cut at hour slots, overlaps within a slot joined: (keys, slot, start, end), free of overlap.

    Work is grouped by (keys, slot), so a service with many or long incidents is spread over its hours.
    """
    slots = F.sequence(bucket_start(start, SLOT), bucket_start(end, SLOT), F.make_dt_interval(hours=F.lit(1)))
    valid = spans.where(F.col(start) < F.col(end)).select(*on, start, end, F.explode(slots).alias("slot"))
    next_slot = F.col("slot") + F.make_dt_interval(hours=F.lit(1))
    cut = (valid.select(*on, "slot", F.greatest(start, "slot").alias(start), F.least(F.col(end), next_slot).alias(end))
                .where(F.col(start) < F.col(end)).distinct())
    w = Window.partitionBy(*on, "slot").orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = cut.withColumn("_reach", reach).withColumn("_new", fresh).withColumn("_island", island)
    return marked.groupBy(*on, "slot", "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def incident_label(logs: DataFrame, incidents: DataFrame, before: int, after: int,
                   target: str = "is_anomaly", at: str = "start_at", until: str | None = "end_at",
                   as_of: Column | None = None) -> DataFrame:
    """1 for rows of the same service from ``before`` seconds ahead of an incident to ``after`` past it.

    Both ends count. ``until=None`` is for incidents known by one moment only. An incident without an end is
    still open: it lasts until ``as_of``, which must be given if there may be such. Incidents that end before
    they start label nothing; :func:`unusable_incidents` lists them.
    """
    tick = F.make_dt_interval(secs=F.lit(0.000001))
    end = F.col(until or at)
    if until is not None:
        still = as_of if as_of is not None else F.raise_error(F.lit("an open incident needs as_of")).cast("timestamp_ntz")
        end = F.when(end.isNull() & F.col(at).isNotNull(), still).otherwise(end)
    used = incidents.where(F.col(at).isNotNull() & F.col("service_id").isNotNull() & (end >= F.col(at)))
    spans = used.select("service_id", (F.col(at) - seconds(before)).alias("_from"), (end + seconds(after) + tick).alias("_to"))
    cut = merged_spans(spans, ["service_id"], "_from", "_to")
    rows = logs.withColumn("slot", bucket_start("timestamp", SLOT))
    hit = attach_range(rows, cut, ["service_id", "slot"], "timestamp", "_from", "_to")
    return hit.drop("slot", target).withColumnRenamed("_hit", target)


def unusable_incidents(incidents: DataFrame, at: str = "start_at", until: str = "end_at") -> DataFrame:
    """Incidents without a service or a start, or with an end before it."""
    return incidents.where(F.col("service_id").isNull() | F.col(at).isNull() | (F.col(until) < F.col(at)))


def join_tags(logs: DataFrame, tags: DataFrame, on: Sequence[str], target: str = "tagged") -> DataFrame:
    """1 for rows an analyst tagged by trace or row key; several tags of one key count once."""
    flags = tags.select(*on).distinct().withColumn("_tag", F.lit(1))
    return (attach(logs, flags, on).withColumn(target, F.coalesce("_tag", F.lit(0))).drop("_tag"))


def in_blocklist(logs: DataFrame, blocklist: DataFrame, column: str = "user_agent",
                 target: str = "is_blocked") -> DataFrame:
    """1 for rows whose value is on the list."""
    return join_tags(logs, blocklist, [column], target)


def p99_rule(logs: DataFrame, target: str = "is_slow", prob: float = 0.99) -> DataFrame:
    """1 for rows slower than the exact P99 of all latencies."""
    p99 = exact_quantiles(logs, "response_time_ms", {"p": prob}).scalar()
    return logs.withColumn(target, F.when(F.col("response_time_ms") > p99, 1).otherwise(0))
