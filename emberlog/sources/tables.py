"""Catalog tables and Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from . import contract


def ensure_table(spark: SparkSession, name: str, schema: StructType, time_column: str | None = None,
                 location: str | None = None) -> None:
    """Create a Parquet table when there is none. With a time column, the table is partitioned by its date."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    tail = ""
    if time_column:
        fields.append("event_date date")
        tail = " PARTITIONED BY (event_date)"
    if location:
        tail += f" LOCATION '{location}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(fields)}) USING parquet{tail}")


def ensure_log_tables(spark: SparkSession) -> None:
    """The two log tables and the rollup, each by date."""
    ensure_table(spark, contract.LOGS_V1, contract.V1_SCHEMA, "timestamp")
    ensure_table(spark, contract.LOGS_V2, contract.V2_SCHEMA, "timestamp")
    ensure_table(spark, contract.ROLLUP_TABLE, contract.ROLLUP_SCHEMA, "window_start")


def exists(spark: SparkSession, *names: str) -> bool:
    """True when every table or view is there."""
    return all(spark.catalog.tableExists(n) for n in names)


def append_table(df: DataFrame, name: str, schema: StructType, time_column: str | None = None) -> None:
    """Append rows that keep the contract to a catalog table."""
    rows = contract.check_contract(df, schema)
    if time_column:
        rows = rows.withColumn("event_date", F.col(time_column).cast("date"))
    rows.write.mode("append").insertInto(name)


def read_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The contract columns of a catalog table."""
    return contract.check_contract(spark.table(name).select(*schema.fieldNames()), schema)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def append(df: DataFrame, path: str, time_column: str = "timestamp", keys: tuple[str, ...] = ("service_id",)) -> int:
    """Append rows to a Parquet folder with one sub-folder per day; gives back how many.

    Rebalancing gives each day its own tasks, splits a day that holds most rows over many and merges
    small ones. Sorting inside a task keeps the min/max of row groups narrow.
    """
    written = Observation()
    (df.observe(written, F.count(F.lit(1)).alias("n"))
       .withColumn("event_date", F.col(time_column).cast("date"))
       .hint("rebalance", "event_date")
       .sortWithinPartitions("event_date", *keys, time_column)
       .write.mode("append").partitionBy("event_date").parquet(path))
    return written.get["n"]


def read_logs(spark: SparkSession, path: str, schema: StructType = contract.V2_SCHEMA,
              start=None, end=None) -> DataFrame:
    """Rows of a folder written by :func:`append`, between two times when given: first whole days, then exactly."""
    df = spark.read.schema(schema).parquet(path)
    if start is not None:
        df = df.where((F.col("event_date") >= F.to_date(F.lit(start))) & (F.col("timestamp") >= F.lit(start)))
    if end is not None:
        df = df.where((F.col("event_date") <= F.to_date(F.lit(end))) & (F.col("timestamp") < F.lit(end)))
    return df.select(*schema.fieldNames())


def export_anomalies(scored: DataFrame, path: str, threshold: float) -> int:
    """Append rows that score above a threshold to a Parquet folder by day; gives back how many."""
    return append(scored.where(F.col("anomaly_score") > threshold), path)


def drop_days_before(spark: SparkSession, name: str, day: str) -> None:
    """Drop the date partitions of a catalog table that lie wholly before a day."""
    parts = spark.sql(f"SHOW PARTITIONS {name}").where(
        F.regexp_extract("partition", r"event_date=([0-9-]+)", 1) < F.lit(day))
    for row in parts.toLocalIterator():
        value = row["partition"].split("=", 1)[1]
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (event_date='{value}')")
