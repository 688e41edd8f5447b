"""Table contracts: names, types and order of columns. Everything else reads them from here."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

TS, STR, INT, LONG, DBL = TimestampNTZType(), StringType(), IntegerType(), LongType(), DoubleType()


def _schema(*columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


# The columns of the tables, in contract order.
V1_SCHEMA = _schema(
    ("timestamp", TS), ("service_id", STR), ("endpoint", STR), ("status_code", INT),
    ("response_time_ms", LONG), ("user_agent", STR), ("is_anomaly", INT),
)
V2_SCHEMA = _schema(
    ("timestamp", TS), ("service_id", STR), ("endpoint", STR), ("status_code", INT),
    ("response_time_ms", LONG), ("user_agent", STR), ("hour_of_day", INT), ("is_weekend", INT),
    ("throughput_velocity", DBL), ("error_acceleration", DBL), ("is_surge", INT),
    ("log_signature", STR), ("log_payload", STR), ("is_anomaly", INT),
)
ENVELOPE_SCHEMA = StructType(V2_SCHEMA.fields + [
    StructField("log_level", STR), StructField("error_kind", STR), StructField("schema_version", INT),
])
ROLLUP_SCHEMA = _schema(
    ("service_id", STR), ("window_start", TS), ("hour_of_day", INT),
    ("total_reqs", LONG), ("error_reqs", LONG),
)
THRESHOLD_SCHEMA = _schema(("service_id", STR), ("threshold", DBL), ("last_updated_by", STR), ("notes", STR))
INCIDENT_SCHEMA = _schema(("incident_id", STR), ("service_id", STR), ("start_at", TS), ("end_at", TS))

# Model features, numeric ones first, and the label.
NUMERIC_V1 = ["status_code", "response_time_ms"]
CATEGORICAL_V1 = ["service_id", "endpoint", "user_agent"]
NUMERIC_V2 = ["status_code", "response_time_ms", "throughput_velocity", "error_acceleration", "hour_of_day"]
CATEGORICAL_V2 = ["service_id", "endpoint", "log_signature"]
TEXT_V2: list[str] = []
FEATURES_V1 = NUMERIC_V1 + CATEGORICAL_V1
FEATURES_V2 = NUMERIC_V2 + CATEGORICAL_V2
TARGET = "is_anomaly"

# Names of the tables and views.
LOGS_V1, LOGS_V2 = "service_logs", "service_logs_v2"
ROLLUP_TABLE = "log_features_1m"
VIEW_V1, VIEW_V2 = "anomalous_events", "anomalous_events_v2"

# What a row takes when the source says nothing (a label has no default), and the ranges of the small unsigned columns.
DEFAULTS = {"throughput_velocity": 1.0, "error_acceleration": 0.0, "is_surge": 0, "schema_version": 2}
RANGES = {"status_code": (0, 65535), "response_time_ms": (0, 4294967295), "hour_of_day": (0, 23),
          "is_weekend": (0, 1), "is_surge": (0, 1), "is_anomaly": (0, 1)}


class ContractError(ValueError):
    """The columns of a frame are not the ones the contract asks for."""


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every column in order."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def check_contract(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` itself when names, types and order are right; otherwise an error that lists the differences."""
    have = columns_of(df)
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if have == want:
        return df
    lines = [f"missing: {c}" for c in want if c not in have] + [f"unexpected: {c}" for c in have if c not in want]
    raise ContractError("; ".join(lines or [f"order is {[n for n, _ in have]}"]))


def conform(df: DataFrame, schema: StructType, errors: str | None = None) -> DataFrame:
    """Columns of ``schema`` in order and type; absent ones take their default, or null.

    A value that cannot be cast is null. ``errors`` names a further column that lists the columns where that happened, after
    what a column of that name in ``df`` says already; null where nothing is wrong.
    """
    present = set(df.columns)
    out = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in present
           else F.lit(DEFAULTS.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    if errors:
        lost = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                for f in schema.fields if f.name in present]
        lost = F.array_join(F.array_compact(F.array(*lost)), ", ") if lost else F.lit("")
        said = F.when(lost != "", F.concat(F.lit("bad value: "), lost))
        own = F.col(errors) if errors in present else F.lit(None)
        out.append(F.nullif(F.concat_ws("; ", own, said), F.lit("")).alias(errors))
    return df.select(*out)


def range_violations(df: DataFrame) -> DataFrame:
    """One row: for each ranged column present, how many values lie outside its range."""
    return df.agg(*[
        F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c)
        for c, (low, high) in RANGES.items() if c in df.columns
    ])


def training_frame(df: DataFrame, version: int = 2, limit: int | None = None) -> DataFrame:
    """Feature columns in model order, then the label, of labelled rows. Row choice under ``limit`` is up to Spark."""
    out = df.where(F.col(TARGET).isNotNull()).select(*(FEATURES_V2 if version == 2 else FEATURES_V1), TARGET)
    return out if limit is None else out.limit(limit)


def for_version(df: DataFrame, version: int) -> DataFrame:
    return df.where(F.col("schema_version") == version)
