"""Labels that come hours after the rows they are for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clock import bucket_start, seconds
from ..operators.labels import SLOT
from .live import with_event_time


def stream_incident_labels(logs: DataFrame, incidents: DataFrame, before: int, after: int, wait: int, key: str = "event_id",
                           delay: str = "10 minutes", target: str = "is_anomaly") -> DataFrame:
    """(key, service_id, timestamp, target): 1 for rows that an incident of their service covers, 0 once none can come any more.

    ``incidents`` (service_id, start_at, end_at, reported_at) come when they are reported. One covers the rows from ``before`` seconds
    ahead of its start to ``after`` past its end, both ends counted, as in :func:`emberlog.operators.labels.incident_label`. A row
    waits ``wait`` seconds of event time for the reports: an incident labels the rows up to that much older than its report. A covered
    row goes out when the two meet, any other when both streams have passed its time by the wait. ``key`` tells rows apart.

    Incidents are cut into hours and joined by (service, hour), so the rows of a busy service are spread over its hours. A row that several
    incidents cover goes out once. Rows without a time have no hour and are left out; rows without a service get 0; incidents that
    end before they start, or lack a service, an end or a report, label nothing.
    """
    tick = F.make_dt_interval(secs=F.lit(0.000001))
    rows = with_event_time(logs.drop(target).where(F.col("timestamp").isNotNull()), delay).select(
        key, "service_id", "timestamp", bucket_start(F.col("timestamp").cast("timestamp_ntz"), SLOT).alias("_slot"))
    usable = incidents.where(F.col("service_id").isNotNull() & (F.col("end_at") >= F.col("start_at")) & F.col("reported_at").isNotNull())
    spans = usable.select(F.col("service_id").alias("_service"), F.col("reported_at").cast("timestamp").alias("_reported"),
                          (F.col("start_at") - seconds(before)).alias("_from"), (F.col("end_at") + seconds(after) + tick).alias("_to"))
    slots = F.explode(F.sequence(bucket_start("_from", SLOT), bucket_start("_to", SLOT), F.make_dt_interval(hours=F.lit(1))))
    cut = spans.withWatermark("_reported", delay).select("*", slots.alias("_hour"))
    time = F.col("timestamp").cast("timestamp_ntz")
    met = rows.join(cut, (F.col("service_id") == F.col("_service")) & (F.col("_slot") == F.col("_hour")) & (time >= F.col("_from")) & (time < F.col("_to"))
                    & F.expr(f"_reported >= timestamp - INTERVAL {after} SECONDS AND _reported <= timestamp + INTERVAL {wait} SECONDS"), "left_outer")
    labelled = met.select(key, "service_id", "timestamp", F.when(F.col("_reported").isNotNull(), 1).otherwise(0).alias(target))
    return labelled.dropDuplicates([key, "timestamp"]).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
