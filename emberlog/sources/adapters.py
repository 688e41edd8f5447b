"""Native log formats to the common envelope."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import clock, signature as sig
from . import contract

SEPARATOR = "\u0001"

#: What :func:`derived` adds, or replaces.
DERIVED = ("hour_of_day", "is_weekend", "log_signature", "error_kind", "log_level")


def apply_mapping(df: DataFrame, mapping: Mapping[str, Column | str], keep: Sequence[str] = ()) -> DataFrame:
    """Envelope columns by name, each from a native column or an expression; ``keep`` is carried along."""
    return df.select(*keep, *[clock.col(source).alias(name) for name, source in mapping.items()])


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with these columns. Whatever is built on them reads their values; their expressions are not copied into it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _checked(df: DataFrame, mapping: Mapping[str, Column | str], types: Mapping[str, str], line: str,
             broken: Column) -> DataFrame:
    """Mapped columns in their types, then the line itself and what is wrong with it, or null."""
    raw = df.select(F.col(line).alias("raw_line"), broken.alias("_broken"),
                    *[clock.col(source).alias(f"_raw_{name}") for name, source in mapping.items()])
    typed = _once(raw, **{name: F.col(f"_raw_{name}").try_cast(types[name]) if name in types else F.col(f"_raw_{name}") for name in mapping})
    failed = [F.when(F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull(), F.lit(n)) for n in types if n in mapping]
    wrong = F.array_join(F.array_compact(F.array(*failed)), ", ") if failed else F.lit("")
    error = F.when(F.col("_broken"), F.lit("malformed")).when(wrong != "", F.concat(F.lit("bad value: "), wrong))
    return _once(typed, parse_error=error).select(*mapping, "raw_line", "parse_error")


def from_json_logs(df: DataFrame, schema: StructType, mapping: Mapping[str, Column | str],
                   types: Mapping[str, str] | None = None, line: str = "value") -> DataFrame:
    """Parse one JSON object per row; ``mapping`` names fields of the object, ``types`` what they are cast to.

    Every line gives a row and is parsed once. ``parse_error`` says why a line is no object or which of its values have the wrong
    type; such values are null, the others are there. :func:`accepted` and :func:`rejected` part the two.
    """
    whole = StructType(schema.fields + [StructField("_corrupt", StringType())])
    parsed = _once(df.select(line), _r=F.from_json(line, whole, {"columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("_r").isNull() | F.col("_corrupt").isNotNull()
    return _checked(parsed.select(line, "_r", "_r.*"), mapping, types or {}, line, broken)


def from_text_logs(df: DataFrame, pattern: str, fields: Sequence[str], mapping: Mapping[str, Column | str],
                   types: Mapping[str, str] | None = None, line: str = "value") -> DataFrame:
    """Parse text lines with a pattern that spans a line; its groups, two at least, become ``fields``.

    All groups are taken in one match: put side by side with a separator, then split. A line without a match, or one
    that holds the separator itself, is marked as malformed; every line gives a row, as in :func:`from_json_logs`.
    """
    groups = SEPARATOR.join(f"${i + 1}" for i in range(len(fields)))
    replaced = _once(df.select(line), _all=F.regexp_replace(line, pattern, groups))
    broken = F.coalesce((F.col("_all") == F.col(line)) | F.contains(line, F.lit(SEPARATOR)), F.lit(True))
    marked = _once(replaced, _no=broken, _p=F.split(F.when(~broken, F.col("_all")), SEPARATOR, len(fields)))
    named = marked.select(line, "_no", *[F.get("_p", i).alias(f) for i, f in enumerate(fields)])
    return _checked(named, mapping, types or {}, line, F.col("_no"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull()).drop("raw_line", "parse_error")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNotNull()).select("raw_line", "parse_error")


def derived(df: DataFrame) -> DataFrame:
    """Fill the columns that follow from the others: hour, weekend flag, signature, error kind, level.

    Signatures must stay few. An operation (a column of that name, or one that the message says was called) stands with its error
    kind; a named exception with its top frame, else its error kind; anything else with its endpoint's template and the
    class of its status, which also stands in where there is no error kind. What is not known is UNKNOWN.
    """
    known = _once(df.drop(*DERIVED), _exception=sig.exception_class("log_payload"))
    known = _once(known, error_kind=sig.error_kind("log_payload", "_exception", "status_code"))

    def or_unknown(c: Column) -> Column:
        return F.coalesce(c, F.lit("UNKNOWN"))

    service, result = or_unknown(sig.service_name("service_id")), or_unknown(sig.status_class("status_code"))
    operation = sig.called_operation("log_payload")
    if "operation" in df.columns:
        operation = F.coalesce("operation", operation)
    kind = F.coalesce("error_kind", result)
    signature = F.when(operation.isNotNull(), sig.signature(service, operation, kind)).when(
        F.col("_exception").isNotNull(), sig.signature(service, "_exception", F.coalesce(sig.top_frame("log_payload"), kind))).otherwise(
        sig.signature(service, or_unknown(sig.endpoint_template("endpoint")), result))
    return known.withColumns({
        "hour_of_day": F.hour("timestamp"),
        "is_weekend": clock.weekend_flag("timestamp"),
        "log_signature": signature,
        "log_level": F.when(F.col("status_code") >= 500, "ERROR").when(F.col("status_code") >= 400, "WARN")
                      .otherwise("INFO"),
    }).select(*[c for c in df.columns if c not in DERIVED], *DERIVED)


def union_sources(*frames: DataFrame, schema: StructType = contract.ENVELOPE_SCHEMA, errors: str | None = None) -> DataFrame:
    """All rows of all sources; a column a source lacks takes its default. A label that is not known stays null.

    A value that does not fit its column is null; ``errors`` names a column to say which were (:func:`contract.conform`).
    """
    return reduce(DataFrame.unionByName, [contract.conform(f, schema, errors) for f in frames])


def mixed_versions(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Old and new rows in one frame, marked by ``schema_version``.

    What an old row lacks but its own columns imply is filled in; the rest takes the defaults.
    """
    old = v1.withColumns({"hour_of_day": F.hour("timestamp"), "is_weekend": clock.weekend_flag("timestamp"),
                          "schema_version": F.lit(1)})
    both = old.unionByName(v2.withColumn("schema_version", F.lit(2)), allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(c, F.lit(contract.DEFAULTS[c]))
                             for c in ("throughput_velocity", "error_acceleration", "is_surge")})
