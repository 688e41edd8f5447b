"""The ``events`` table of the test data as a log source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clock, signature as sig
from . import adapters

SLOW_MS = 2000


def read(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def envelope(events: DataFrame) -> DataFrame:
    """v2 log rows, with ``event_id`` in front as row key."""
    third = F.pmod("event_id", F.lit(3))
    failure = F.when(third == 0, 500).when(third == 1, 502).otherwise(503)
    base = adapters.apply_mapping(events, {
        "timestamp": clock.bucket_start("ts", "millisecond"),
        "service_id": F.concat(F.lit("svc-"), F.pmod("user_id", F.lit(3)).cast("string")),
        "endpoint": F.concat(F.lit("/api/"), F.col("event_type")),
        "status_code": F.when(F.col("event_type") == "error", failure).otherwise(200),
        "response_time_ms": F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("value") * 10).cast("bigint")),
        "user_agent": F.concat(F.lit("ua-"), F.pmod("user_id", F.lit(5)).cast("string")),
        "log_payload": "props",
        "action": F.upper("event_type"),
    }, keep=["event_id"])
    return base.select(
        "event_id", "timestamp", "service_id", "endpoint", "status_code", "response_time_ms", "user_agent",
        F.hour("timestamp").alias("hour_of_day"),
        clock.weekend_flag("timestamp").alias("is_weekend"),
        F.lit(1.0).alias("throughput_velocity"),
        F.lit(0.0).alias("error_acceleration"),
        F.lit(0).alias("is_surge"),
        sig.signature(F.upper("service_id"), "action", sig.status_class("status_code")).alias("log_signature"),
        "log_payload",
        F.when((F.col("status_code") >= 500) | (F.col("response_time_ms") > SLOW_MS), 1).otherwise(0)
         .alias("is_anomaly"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(read(spark, sf_dir))


def messages(logs: DataFrame) -> DataFrame:
    """Log rows with a raw message such as a service would write."""
    failed = F.concat(F.lit("Call to "), F.col("endpoint"), F.lit(" failed: "))
    text = (F.when(F.col("status_code") == 500,
                   F.concat(failed, F.lit("TimeoutException after "), F.col("response_time_ms").cast("string"),
                            F.lit("ms")))
             .when(F.col("status_code") == 502, F.concat(failed, F.lit("connection reset by peer")))
             .when(F.col("status_code") == 503, F.concat(failed, F.lit("OrderValidationException: missing field")))
             .otherwise(F.concat(F.lit("rid="), F.col("event_id").cast("string"), F.lit(" msg=ok"))))
    return logs.withColumn("message", text)
