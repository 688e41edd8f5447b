"""One query per operator over the test tables. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import score as sc, signature as sig, text
from ..functions.clock import day_of_week, in_range
from ..operators import alerts, context, episodes, evaluate, isolation, labels, novelty, ordered, rank, rollup, sketches, templates, whatif
from ..session import fresh_dir, pinned
from ..sources import adapters, contract, events, tables
from ..streaming import firsts, live, state
from ..streaming.labels import stream_incident_labels as late_labels
from . import model, report, trees, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HIGH = 1.5  # fixed score threshold of the reports
BURST = ("2024-01-02 12:00:00", "2024-01-02 16:00:00")
SILENT = ("2024-01-03 08:00:00", "2024-01-03 12:00:00")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def span(pair: tuple[str, str]) -> tuple[Column, Column]:
    return at(pair[0]), at(pair[1])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on the order of rows in their last bits; reports show six digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def scored_logs(spark: SparkSession, d: str) -> DataFrame:
    return novelty.outlier_score(events.logs(spark, d))


def hour_buckets(spark: SparkSession, d: str) -> DataFrame:
    return rollup.buckets(events.logs(spark, d), "hour")


def now(spark: SparkSession, d: str) -> Column:
    return events.read(spark, d).agg(F.max("ts")).scalar()


# --- contract and adapters ------------------------------------------------------------------------------------

@query
def envelope_v2(spark, d):
    df = events.logs(spark, d)
    contract.check_contract(df.drop("event_id"), contract.V2_SCHEMA)
    return df


@query
def envelope_v1(spark, d):
    return events.logs(spark, d).select("event_id", *contract.V1_SCHEMA.fieldNames())


@query
def training_frame(spark, d):
    return contract.training_frame(events.logs(spark, d))


@query
def training_frame_v1(spark, d):
    return contract.training_frame(events.logs(spark, d), version=1)


@query
def calendar_features(spark, d):
    df = events.logs(spark, d)
    clamped = F.least(F.lit(whatif.NORMAL_MS[1]), F.greatest(F.lit(whatif.NORMAL_MS[0]), F.col("response_time_ms")))
    return df.select("event_id", "hour_of_day", day_of_week("timestamp").alias("day_of_week"), "is_weekend",
                     clamped.cast("bigint").alias("clamped_ms"))


@query
def range_violations(spark, d):
    return contract.range_violations(events.logs(spark, d))


# Native field names of the raw lines built below, by envelope column.
JSON_FIELDS = {"event_id": "id", "timestamp": "@time", "service_id": "svc", "endpoint": "route",
               "status_code": "code", "response_time_ms": "took", "user_agent": "agent", "log_payload": "msg"}
RAW_TYPES = {"event_id": "bigint", "timestamp": "timestamp_ntz", "status_code": "int", "response_time_ms": "bigint"}
TEXT_LINE = r"^([0-9]+) \[([^\]]+)\] ([^ ]+) \"GET ([^ ]+)\" ([0-9]{3}) ([0-9]+)ms ([^ ]+) - (.*)$"
TEXT_FIELDS = ["event_id", "timestamp", "service_id", "endpoint", "status_code", "response_time_ms",
               "user_agent", "log_payload"]


def _native(df: DataFrame) -> DataFrame:
    time = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS")
    return df.select(*[(time if c == "timestamp" else F.col(c).cast("string")).alias(c) for c in TEXT_FIELDS])


def json_lines(df: DataFrame) -> DataFrame:
    fields = F.struct(*[F.col(c).alias(n) for c, n in JSON_FIELDS.items()])
    return _native(df).select(F.to_json(fields).alias("value"))


def text_lines(df: DataFrame) -> DataFrame:
    c = [F.col(f) for f in TEXT_FIELDS]
    return _native(df).select(F.concat(c[0], F.lit(" ["), c[1], F.lit("] "), c[2], F.lit(' "GET '), c[3], F.lit('" '),
                                       c[4], F.lit(" "), c[5], F.lit("ms "), c[6], F.lit(" - "), c[7]).alias("value"))


def parse_json_lines(lines: DataFrame) -> DataFrame:
    schema = StructType([StructField(n, StringType()) for n in JSON_FIELDS.values()])
    return adapters.from_json_logs(lines, schema, {c: F.col(f"`{n}`") for c, n in JSON_FIELDS.items()}, RAW_TYPES)


def parse_text_lines(lines: DataFrame) -> DataFrame:
    return adapters.from_text_logs(lines, TEXT_LINE, TEXT_FIELDS, {f: f for f in TEXT_FIELDS}, RAW_TYPES)


def read_json_lines(lines: DataFrame) -> DataFrame:
    return adapters.derived(adapters.accepted(parse_json_lines(lines)))


def read_text_lines(lines: DataFrame) -> DataFrame:
    return adapters.derived(adapters.accepted(parse_text_lines(lines)))


@query
def json_adapter(spark, d):
    return read_json_lines(json_lines(events.logs(spark, d)))


@query
def text_adapter(spark, d):
    return read_text_lines(text_lines(events.logs(spark, d)))


@query
def adapter_rejects(spark, d):
    """Lines in, rows out: what became of clean, cut and wrongly typed lines in both formats."""
    logs = events.logs(spark, d)
    number = F.regexp_extract("value", r"^(?:\{\"id\":\")?([0-9]+)", 1).cast("bigint") % 10
    cut = F.when(number == 3, F.substring("value", 1, 12)).otherwise(F.col("value"))
    text_ = text_lines(logs).withColumn("value", F.when(number == 4, F.regexp_replace("value", "^[0-9]+ ", "99999999999999999999 ")).otherwise(cut))
    json_ = json_lines(logs).withColumn("value", F.when(number == 4, F.regexp_replace("value", '"code":"[0-9]+"', '"code":"abc"')).otherwise(cut))
    parsed = [(kind, frame.select("parse_error", "raw_line")) for kind, frame in (("json", parse_json_lines(json_)), ("text", parse_text_lines(text_)))]
    both = parsed[0][1].withColumn("format", F.lit("json")).unionByName(parsed[1][1].withColumn("format", F.lit("text")))
    return both.groupBy("format", F.coalesce("parse_error", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.count("raw_line").alias("lines_kept"))


@query
def unlabelled_rows(spark, d):
    """How many rows of the united sources lack a label, and how many the training frame takes."""
    united = union_sources(spark, d)
    counts = united.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("n"))
    trained = contract.training_frame(united).agg(F.count(F.lit(1)).alias("n")).select(F.lit("training").alias("what"), "n")
    return counts.select(F.coalesce(F.col("is_anomaly").cast("string"), F.lit("none")).alias("what"), "n").unionByName(trained)


@query
def derived_signatures(spark, d):
    """Signatures from raw rows whose endpoints carry ids and whose messages carry traces."""
    logs = events.logs(spark, d)
    turn = F.pmod("event_id", F.lit(6))
    raw = logs.select(
        "event_id", "timestamp", "status_code",
        F.when(turn == 3, "orders-api").when(turn == 4, "payments").when(turn == 5, "checkout").when(turn != 1, F.col("service_id")).alias("service_id"),
        F.when(turn == 3, F.concat(F.lit("/orders/"), F.col("event_id").cast("string")))
         .when(turn != 1, F.concat(F.lit("/orders/"), F.col("event_id").cast("string"), F.lit("/items"))).alias("endpoint"),
        F.when(turn == 3, F.concat(F.lit("GET /orders/"), F.col("event_id").cast("string"), F.lit(" failed with status 502 upstream timeout")))
         .when(turn == 4, F.concat(F.lit("Call to PaymentGateway.charge failed: TimeoutException after "), F.col("event_id").cast("string"), F.lit("ms")))
         .when(turn == 5, F.lit("OrderValidationException: missing field 'shippingAddress'"))
         .when((F.col("status_code") >= 500) & (turn == 0), F.concat(F.lit("PaymentException: "), F.col("event_id").cast("string"),
                                                                    F.lit("\n\tat shop.Pay.charge(Pay.java:7)\n\tat shop.Main.run(Main.java:1)")))
         .when(F.col("status_code") >= 500, F.lit("upstream failed")).otherwise(F.lit("ok")).alias("log_payload"),
        F.when(turn == 2, F.lit("checkout")).alias("operation"))
    return adapters.derived(raw).groupBy("log_signature").agg(F.count(F.lit(1)).alias("n"))


@query
def union_sources(spark, d):
    """Three services, three formats: JSON lines, text lines and rows that fit already."""
    logs = events.logs(spark, d)
    a, b, c = (logs.where(F.col("service_id") == f"svc-{i}") for i in range(3))
    schema = StructType([StructField("event_id", contract.LONG)] + contract.V2_SCHEMA.fields)
    return adapters.union_sources(read_json_lines(json_lines(a)), read_text_lines(text_lines(b)), c, schema=schema)


def _mixed(spark, d):
    logs = events.logs(spark, d)
    old = logs.where(F.col("service_id") == "svc-0").select("event_id", *contract.V1_SCHEMA.fieldNames())
    return adapters.mixed_versions(old, logs.where(F.col("service_id") != "svc-0"))


@query
def mixed_versions(spark, d):
    return _mixed(spark, d)


@query
def version_filter(spark, d):
    return contract.for_version(_mixed(spark, d), 2).select("event_id", "service_id", "schema_version")


@query
def append_readback(spark, d):
    """Rows written by day and read back for a range of time."""
    path = fresh_dir(spark, "logs")
    tables.append(events.logs(spark, d), path)
    schema = StructType([StructField("event_id", contract.LONG)] + contract.V2_SCHEMA.fields)
    return tables.read_logs(spark, path, schema, *BURST)


@query
def append_whole(spark, d):
    """Everything that was written is read back; the writer's own count stands beside it."""
    path = fresh_dir(spark, "logs")
    written = tables.append(events.logs(spark, d), path)
    schema = StructType([StructField("event_id", contract.LONG)] + contract.V2_SCHEMA.fields)
    return tables.read_logs(spark, path, schema).withColumn("written", F.lit(written).cast("bigint"))


@query
def catalog_roundtrip(spark, d):
    """A table is created, listed, filled and emptied."""
    name = f"logs_{uuid4().hex}"
    for _ in range(2):  # the second time it is there already
        tables.ensure_table(spark, name, contract.V2_SCHEMA, "timestamp")
    columns = len(spark.table(name).columns)
    tables.append_table(events.logs(spark, d).drop("event_id"), name, contract.V2_SCHEMA, "timestamp")
    filled = tables.read_table(spark, name, contract.V2_SCHEMA).agg(
        F.count(F.lit(1)).alias("n"), F.sum("response_time_ms").alias("total_ms"), F.count_if(F.col("is_anomaly") == 1).alias("n_bad")).first()
    there = tables.exists(spark, name)
    tables.truncate(spark, name)
    left = tables.read_table(spark, name, contract.V2_SCHEMA).count()
    spark.sql(f"DROP TABLE {name}")
    gone = not tables.exists(spark, name)
    row = [(columns, filled["n"], filled["total_ms"], filled["n_bad"], left, there, gone)]
    return spark.createDataFrame(row, "columns int, n bigint, total_ms bigint, n_bad bigint, left bigint, there boolean, gone boolean")


@query
def export_anomalies(spark, d):
    path = fresh_dir(spark, "export")
    scored = scored_logs(spark, d)
    tables.export_anomalies(scored, path, HIGH)
    return spark.read.schema(scored.schema).parquet(path).select("event_id", "timestamp", "service_id", "anomaly_score")


# --- rollup -----------------------------------------------------------------------------------------------------

@query
def rollup_minute(spark, d):
    return rollup.rollup(events.logs(spark, d))


@query
def rollup_hour(spark, d):
    return rollup.coarser(rollup.rollup(events.logs(spark, d)), "hour")


@query
def rollup_partial_merge(spark, d):
    """Failed requests come as a late batch of their own; merging must not notice."""
    logs = events.logs(spark, d)
    late = sc.is_error()
    parts = rollup.rollup(logs.where(~late)).unionByName(rollup.rollup(logs.where(late)))
    return rollup.merge_partials(parts, ("service_id", "window_start", "hour_of_day"))


@query
def control_totals(spark, d):
    return rollup.control_totals(rollup.rollup(events.logs(spark, d)))


@query
def retention_14d(spark, d):
    return rollup.retained(rollup.rollup(events.logs(spark, d)), now(spark, d))


# --- context ----------------------------------------------------------------------------------------------------

CONTEXT_COLUMNS = ["service_id", "window_start", "total_reqs", "error_reqs", "error_rate", "throughput_velocity",
                   "error_acceleration", "is_surge", "has_baseline"]


def _context_report(ctx: DataFrame) -> DataFrame:
    return rounded(context.filled(ctx).select(*CONTEXT_COLUMNS), "error_rate", "throughput_velocity",
                   "error_acceleration")


@query
def context_rows(spark, d):
    return _context_report(context.context(hour_buckets(spark, d)))


@query
def context_rows_minute(spark, d):
    return _context_report(context.context(rollup.buckets(events.logs(spark, d))))


@query
def context_chunked(spark, d):
    return _context_report(context.context(hour_buckets(spark, d), chunk_rows=200))


@query
def context_range(spark, d):
    return _context_report(context.context(hour_buckets(spark, d), frame="range", bucket="hour"))


def _context_view(df: DataFrame) -> DataFrame:
    return rounded(df.select("event_id", *view.VIEW_V2_COLUMNS), "throughput_velocity", "error_acceleration")


@query
def scored_context(spark, d):
    return _context_view(view.scored_context(events.logs(spark, d), bucket="hour"))


@query
def scored_context_minute(spark, d):
    return _context_view(view.scored_context(events.logs(spark, d)))


@query
def live_view(spark, d):
    """A view is made over the first rows of a table; the rest comes later, and the view knows their context."""
    name = f"logs_{uuid4().hex}"
    schema = StructType([StructField("event_id", contract.LONG)] + contract.V2_SCHEMA.fields)
    tables.ensure_table(spark, name, schema, "timestamp", fresh_dir(spark, "live"))
    logs, cut = events.logs(spark, d), at(BURST[0])
    tables.append_table(logs.where(F.col("timestamp") < cut), name, schema, "timestamp")
    view.anomaly_view(view.scored_context(spark.table(name).drop("event_date"), lazy=True), f"view_{name}")
    seen = spark.table(f"view_{name}")
    tables.append_table(logs.where(F.col("timestamp") >= cut), name, schema, "timestamp")
    return _context_view(seen)


@query
def scored_between(spark, d):
    """Four hours of rows with time-true context; buckets are read from one halo before."""
    logs = events.logs(spark, d)
    return _context_view(view.scored_between(logs, rollup.rollup(logs, "hour"), lambda df: df, *span(BURST),
                                             bucket="hour"))


@query
def rolling_latency(spark, d):
    return rounded(context.rolling_latency(events.logs(spark, d), bucket="hour"), "avg_latency", "rolling_latency")


@query
def seasonal_baseline(spark, d):
    return rounded(context.seasonal_baseline(hour_buckets(spark, d)), "usual_reqs", "usual_error_rate", "vs_usual")


# --- evaluation -------------------------------------------------------------------------------------------------

@query
def score_stats(spark, d):
    return rounded(evaluate.score_stats(scored_logs(spark, d)), "avg_score")


@query
def score_by_label(spark, d):
    stats = evaluate.score_stats(scored_logs(spark, d), by=["is_anomaly"])
    return rounded(stats, "avg_score").orderBy("is_anomaly")


@query
def score_center(spark, d):
    return rounded(evaluate.score_center(scored_logs(spark, d)), "avg_score", "median_score")


@query
def score_histogram(spark, d):
    return evaluate.score_histogram(scored_logs(spark, d), 0.25)


@query
def threshold_p90(spark, d):
    return rounded(evaluate.suggest_threshold(scored_logs(spark, d)), "threshold")


@query
def confusion(spark, d):
    return evaluate.confusion(scored_logs(spark, d), HIGH)


@query
def precision_recall_f1(spark, d):
    return rounded(evaluate.precision_recall_f1(evaluate.confusion(scored_logs(spark, d), HIGH)), "precision",
                   "recall", "f1")


@query
def validation_report(spark, d):
    return rounded(report.validation_report(scored_logs(spark, d)), "avg_score", "avg_score_0", "avg_score_1",
                   "threshold", "precision", "recall", "f1")


@query
def anomaly_ratio(spark, d):
    return rounded(evaluate.anomaly_ratio(events.logs(spark, d), by=["service_id"]), "anomaly_ratio")


@query
def count_parity(spark, d):
    return evaluate.count_parity(events.logs(spark, d), scored_logs(spark, d))


@query
def max_score_in_range(spark, d):
    return evaluate.max_score(scored_logs(spark, d), *span(BURST))


@query
def distinct_signatures(spark, d):
    return evaluate.signatures(events.logs(spark, d))


# --- ranking ----------------------------------------------------------------------------------------------------

@query
def top_scores(spark, d):
    df = rank.top_scores(scored_logs(spark, d), 20)
    return df.select("event_id", "timestamp", "service_id", "endpoint", "status_code", "response_time_ms",
                     "anomaly_score")


@query
def latest_events(spark, d):
    return rank.latest(events.logs(spark, d), 20).select("event_id", "timestamp", "service_id", "endpoint")


@query
def recent_hour(spark, d):
    df = rank.recent(scored_logs(spark, d), now(spark, d), hours=1)
    return df.select("event_id", "timestamp", "endpoint", "status_code", "anomaly_score")


@query
def above_threshold(spark, d):
    return rank.above(scored_logs(spark, d), HIGH).select("event_id", "timestamp", "service_id", "endpoint",
                                                          "anomaly_score")


@query
def top_endpoints(spark, d):
    return rank.top_endpoints(scored_logs(spark, d), HIGH)


@query
def top_n_per_hour(spark, d):
    df = rank.top_n_per_hour(scored_logs(spark, d), 3)
    return df.select("hour_start", "rank", "event_id", "service_id", "endpoint", "anomaly_score")


# --- thresholds and labels -----------------------------------------------------------------------------------------

@query
def service_percentiles(spark, d):
    return rounded(evaluate.service_percentiles(scored_logs(spark, d)), "p90", "p95")


def threshold_table(spark: SparkSession) -> DataFrame:
    """Settings for two of the three services."""
    return spark.createDataFrame([("svc-0", 1.0, "ops", ""), ("svc-1", 2.0, "ops", "")], contract.THRESHOLD_SCHEMA)


@query
def service_thresholds(spark, d):
    df = alerts.apply_thresholds(scored_logs(spark, d), threshold_table(spark), default=HIGH)
    return df.select("event_id", "service_id", "anomaly_score", "threshold", "is_alert")


@query
def p99_latency_rule(spark, d):
    return labels.p99_rule(events.logs(spark, d)).select("event_id", "response_time_ms", "is_slow")


def message_logs(spark: SparkSession, d: str) -> DataFrame:
    df = events.messages(events.logs(spark, d))
    df = df.withColumn("exception_class", sig.exception_class("message"))
    return df.withColumns({
        "error_kind": sig.error_kind("message", "exception_class", "status_code",
                                     {"OrderValidationException": "VALIDATION"}),
        "log_level": F.when(F.col("status_code") >= 500, "ERROR").otherwise("INFO"),
    })


@query
def rule_labels(spark, d):
    df = labels.rule_label(message_logs(spark, d), exceptions=["OrderValidationException"])
    return df.select("event_id", "status_code", "log_level", "error_kind", "exception_class", "is_anomaly")


@query
def incident_labels(spark, d):
    """Incidents are the surge hours; rows within half an hour of one are labelled."""
    surges = context.context(hour_buckets(spark, d)).where(F.col("is_surge") == 1)
    incidents = surges.select("service_id", F.col("window_start").alias("start_at"))
    df = labels.incident_label(events.logs(spark, d), incidents, 1800, 1800, until=None)
    return df.select("event_id", "timestamp", "service_id", "is_anomaly")


@query
def open_incidents(spark, d):
    """Incidents are the surge hours; those of odd hours have no end yet and last until now."""
    surges = context.context(hour_buckets(spark, d)).where(F.col("is_surge") == 1)
    end = F.when(F.hour("window_start") % 2 == 0, F.col("window_start") + F.make_dt_interval(hours=F.lit(1)))
    backwards = F.col("window_start") - F.make_dt_interval(hours=F.lit(9))
    incidents = surges.select("service_id", F.col("window_start").alias("start_at"), end.alias("end_at"))
    wrong = surges.select("service_id", F.col("window_start").alias("start_at"), backwards.alias("end_at"))
    df = labels.incident_label(events.logs(spark, d), incidents.unionByName(wrong), 0, 0, as_of=now(spark, d))
    return df.select("event_id", "timestamp", "service_id", "is_anomaly")


@query
def tag_labels(spark, d):
    """Analyst tags by row key: the label table, where toxic marks a bad row."""
    tags = events.read(spark, d, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("event_id"))
    return labels.join_tags(events.logs(spark, d), tags, ["event_id"]).select("event_id", "tagged")


@query
def tag_ranges(spark, d):
    """Analyst tags by service and time: from the slowest row of each day of a service to half an hour past it."""
    logs = events.logs(spark, d)
    worst = logs.groupBy("service_id", F.col("timestamp").cast("date").alias("day")).agg(
        F.max_by("timestamp", F.struct("response_time_ms", "event_id")).alias("start_at"))
    df = labels.incident_label(logs, worst, 0, 1800, target="tagged", until=None)
    return df.select("event_id", "service_id", "timestamp", "tagged")


@query
def blocklist_agents(spark, d):
    blocklist = spark.createDataFrame([("ua-4",)], "user_agent string")
    return labels.in_blocklist(events.logs(spark, d), blocklist).select("event_id", "user_agent", "is_blocked")


# --- signatures and text --------------------------------------------------------------------------------------------

@query
def new_signatures(spark, d):
    """A silent failure shows as a signature that was never there before."""
    shifted = whatif.overlay_signature(events.logs(spark, d), *span(SILENT))
    start, _ = span(SILENT)
    return novelty.new_signatures(shifted.where(F.col("timestamp") >= start), shifted.where(F.col("timestamp") < start))


SIX_HOURS = 6 * 3600


@query
def first_seen_signatures(spark, d):
    """Hours with a signature that its service has not shown for six hours."""
    return firsts.first_seen(events.logs(spark, d), SIX_HOURS)


@query
def signature_rarity(spark, d):
    shifted = whatif.overlay_signature(events.logs(spark, d), *span(SILENT))
    return rounded(novelty.rarity(shifted).select("event_id", "service_id", "log_signature", "rarity"), "rarity")


@query
def signature_check(spark, d):
    df = events.logs(spark, d)
    return df.groupBy(sig.valid_signature("log_signature").alias("valid"), sig.status_class("status_code")
                      .alias("status_class")).agg(F.count(F.lit(1)).alias("n"))


@query
def endpoint_template(spark, d):
    df = events.read(spark, d, "pages")
    return df.select("page_id", sig.endpoint_template("url").alias("template"))


@query
def mask_tokens(spark, d):
    return events.read(spark, d, "documents").select("doc_id", sig.mask_tokens("text").alias("masked"))


@query
def error_kind(spark, d):
    return message_logs(spark, d).groupBy("error_kind", "status_code").agg(F.count(F.lit(1)).alias("n"))


@query
def exception_class(spark, d):
    return message_logs(spark, d).select("event_id", "exception_class")


@query
def payload_split(spark, d):
    df = events.messages(events.logs(spark, d))
    line = F.concat("log_signature", F.lit(" "), "message")
    return df.select("event_id", sig.signature_prefix(line).alias("prefix"), sig.payload_rest(line).alias("payload"))


@query
def payload_kv(spark, d):
    df = events.messages(events.logs(spark, d))
    return df.select("event_id", text.payload_value("message", "rid").alias("rid"),
                     text.payload_value("message", "msg").alias("msg"))


@query
def json_fields(spark, d):
    df = events.read(spark, d)
    return df.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query
def outcome_enum(spark, d):
    df = events.logs(spark, d)
    return df.groupBy("service_id", sig.outcome("status_code").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query
def text_features(spark, d):
    features = text.text_features("text")
    return events.read(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in features.items()])


EMBEDDING_SIZE = 64


@query
def embedding_columns(spark, d):
    return events.read(spark, d, "embeddings").select("vec_id", *text.vector_columns("embedding", EMBEDDING_SIZE))


@query
def payload_score(spark, d):
    docs = events.read(spark, d, "documents")
    return rounded(novelty.payload_score(docs, "doc_id", "text"), "payload_anomaly_score")


@query
def learned_templates(spark, d):
    """Rows with the template of their message, learnt from all messages: words that vary are values."""
    letter = F.char(97 + F.pmod("event_id", F.lit(20)))
    served = F.concat(F.lit("Served "), F.col("endpoint"), F.lit(" to "), letter, F.lit(" in "), F.col("response_time_ms").cast("string"), F.lit("ms with "), F.col("log_payload"))
    failed = F.concat(F.lit("Call of "), letter, F.lit(" failed:\t"), F.when(F.col("status_code") == 500, "timeout").otherwise("connection reset"))
    turn = F.pmod("event_id", F.lit(50))
    message = F.when(turn == 7, F.lit(" \n")).when(turn == 8, F.lit("ok")).when(turn != 9, F.when(F.col("status_code") >= 500, failed).otherwise(served))
    logs = events.logs(spark, d).select("event_id", "service_id", message.alias("message"))
    return templates.templated(logs, "message", templates.learn(logs, "message", depth=3, fanout=3)).select("event_id", "service_id", "template")


@query
def payload_score_blanks(spark, d):
    """Null, empty and blank messages keep their row."""
    third = F.pmod("doc_id", F.lit(50))
    blank = F.when(third == 7, F.lit(None)).when(third == 8, F.lit("")).when(third == 9, F.lit(" \t\n ")).otherwise(F.col("text"))
    docs = events.read(spark, d, "documents").withColumn("text", blank)
    return rounded(novelty.payload_score(docs, "doc_id", "text"), "payload_anomaly_score")


@query
def outlier_zscore(spark, d):
    return scored_logs(spark, d).select("event_id", "service_id", "response_time_ms", "anomaly_score")


@query
def outlier_mad(spark, d):
    df = novelty.robust_outlier_score(events.logs(spark, d))
    return df.select("event_id", "service_id", "response_time_ms", "anomaly_score")


ISOLATED = ("status_code", "response_time_ms", "hour_of_day")


@query
def isolation_score(spark, d):
    """How easily a row is parted from the others by status, latency and hour."""
    logs = events.logs(spark, d)
    df = isolation.score(logs, isolation.fit(logs, ISOLATED, "event_id"))
    return rounded(df.select("event_id", *ISOLATED, "anomaly_score"), "anomaly_score")


@query
def sigmoid_score(spark, d):
    df = scored_logs(spark, d).select("event_id", "anomaly_score", sc.sigmoid("anomaly_score").alias("probability"))
    return rounded(df, "probability")


# --- mergeable states -------------------------------------------------------------------------------------------

PERCENTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@query
def sketch_percentiles(spark, d):
    """Latency percentiles and distinct signatures by service, from three batches of minute states merged to hours, then to services."""
    logs = events.logs(spark, d)
    parts = [sketches.sketch_rollup(logs.where(F.pmod("event_id", F.lit(3)) == i)) for i in range(3)]
    minutes = sketches.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    services = sketches.merge_sketches(sketches.coarser_sketches(minutes, "hour"), ["service_id"])
    found = pinned(sketches.sketch_quantiles(services, PERCENTILES).select("service_id", "total_reqs", "error_reqs", *PERCENTILES, "n_categories"))
    off = sketches.rank_errors(logs, found, "response_time_ms", PERCENTILES, "service_id")
    exact = logs.groupBy("service_id").agg(F.count_distinct("log_signature").alias("n_signatures"))
    close = [(F.col(name) <= sketches.RANK_ERROR).alias(f"{name}_close") for name in PERCENTILES]
    judged = off.select("service_id", *close).join(exact, "service_id").join(found.drop(*PERCENTILES), "service_id")
    count_close = F.abs(F.col("n_categories") - F.col("n_signatures")) <= F.col("n_signatures") * sketches.DISTINCT_ERROR
    return judged.select("service_id", "total_reqs", "error_reqs", *[f"{name}_close" for name in PERCENTILES], count_close.alias("distinct_close"))


@query
def sketch_hours(spark, d):
    """Hour states merged from minute states count like hours rolled up from the rows; their extremes are exact."""
    hours = sketches.coarser_sketches(sketches.sketch_rollup(events.logs(spark, d)), "hour")
    out = sketches.sketch_quantiles(hours, {"least": 0.0, "most": 1.0})
    return out.select("service_id", "window_start", "total_reqs", "error_reqs", "least", "most", F.col("n_categories").alias("n_signatures"))


# --- alerts ---------------------------------------------------------------------------------------------------------

@query
def anomaly_series(spark, d):
    return alerts.anomaly_series(scored_logs(spark, d), HIGH)


@query
def sliding_alerts(spark, d):
    return alerts.sliding_alerts(scored_logs(spark, d), HIGH, limit=2, length="2 hours", slide="1 hour")


@query
def zscore_alerts(spark, d):
    series = alerts.anomaly_series(scored_logs(spark, d), HIGH, by=["service_id"])
    return rounded(alerts.zscore_alerts(series), "z")


@query
def count_alert(spark, d):
    return alerts.count_alert(scored_logs(spark, d), HIGH, limit=10)


@query
def thresholds_asof(spark, d):
    """Rows with the threshold in force at their time, where every 97th row marks a change of its service's threshold."""
    scored = scored_logs(spark, d)
    changes = scored.where(F.pmod("event_id", F.lit(97)) == 0).select(
        "service_id", F.col("timestamp").alias("valid_from"), (1 + F.pmod("event_id", F.lit(5)) / 2).alias("threshold"))
    df = alerts.thresholds_asof(scored, changes, 1.25)
    return df.select("event_id", "service_id", "anomaly_score", "threshold", F.when(F.col("anomaly_score") > F.col("threshold"), 1).otherwise(0).alias("is_alert"))


@query
def alert_examples(spark, d):
    scored = scored_logs(spark, d).withColumn("error_kind", sig.error_kind("log_payload", status="status_code"))
    df = alerts.alert_examples(scored, HIGH, limit=3, k=2)
    return df.select("service_id", "bucket_start", "n_anomalies", "rank", "event_id", "log_signature", "log_payload",
                     "error_kind", "anomaly_score")


@query
def alert_episodes(spark, d):
    """Alerts at most five hours apart are one episode; after less than eight hours of quiet, a new one is not notified."""
    df = episodes.alert_episodes(scored_logs(spark, d), HIGH, gap=18000, cooldown=28800, k=3)
    return df.withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


# --- what-if --------------------------------------------------------------------------------------------------------

@query
def burst_whatif(spark, d):
    df = whatif.amplify(events.logs(spark, d), *span(BURST))
    return df.select("event_id", "copy", "timestamp", "service_id", "status_code", "response_time_ms", "is_anomaly")


@query
def burst_context(spark, d):
    """What the context of the burst hours looks like after the burst."""
    burst = whatif.amplify(events.logs(spark, d), *span(BURST))
    ctx = context.context(rollup.buckets(burst, "hour"))
    return _context_report(ctx.where(in_range("window_start", *span(BURST))))


@query
def signature_shift_whatif(spark, d):
    df = whatif.overlay_signature(events.logs(spark, d), *span(SILENT))
    return df.select("event_id", "timestamp", "log_signature", "is_anomaly")


# --- model ----------------------------------------------------------------------------------------------------------

_MODELS: dict[tuple, str] = {}


def trained(spark: SparkSession, d: str, version: int = 2) -> model.Fitted:
    """The model of the contract, all rounds, trained once per session and table, then read from where it was saved."""
    key = (spark.sparkContext.applicationId, d, version)
    features = contract.FEATURES_V2 if version == 2 else contract.FEATURES_V1
    if key not in _MODELS:
        numeric, categorical = (contract.NUMERIC_V2, contract.CATEGORICAL_V2) if version == 2 else (contract.NUMERIC_V1, contract.CATEGORICAL_V1)
        path = fresh_dir(spark, "model")
        model.save(model.train(model.split(model_rows(spark, d), ["event_id"])[0], numeric, categorical), path)
        _MODELS[key] = path
    return model.load(spark, _MODELS[key], features)


def model_rows(spark: SparkSession, d: str) -> DataFrame:
    """Log rows with computed context, as training and scoring take them."""
    return view.scored_context(events.logs(spark, d))


@query
def gbt_scores_v1(spark, d):
    logs = events.logs(spark, d)
    return model.score(logs.select("event_id", *contract.V1_SCHEMA.fieldNames()), trained(spark, d, 1))


@query
def gbt_scores_v2(spark, d):
    logs = events.logs(spark, d)
    return view.score_v2(logs, rollup.buckets(logs), trained(spark, d), keep=("event_id",))


@query
def gbt_probability(spark, d):
    return model.probability(model_rows(spark, d).select("event_id", *contract.FEATURES_V2, "is_anomaly"), trained(spark, d))


@query
def training_events(spark, d):
    logs = events.logs(spark, d)
    rows = view.training_events(logs, rollup.buckets(logs), keep=("event_id",))
    return rounded(rows, "throughput_velocity", "error_acceleration")


@query
def ordered_codes(spark, d):
    """Each row's categories by the labels of the rows before it."""
    coded = ("service_id", "log_signature", "user_agent")
    df = ordered.ordered_codes(events.logs(spark, d), coded, "is_anomaly", prior=0.1)
    return rounded(df.select("event_id", *[f"code_{c}" for c in coded]), *[f"code_{c}" for c in coded])


@query
def split_rows(spark, d):
    train, test = model.split(events.logs(spark, d), ["event_id"])
    return train.select("event_id", F.lit("train").alias("side")).unionByName(test.select("event_id", F.lit("test").alias("side")))


@query
def model_quality(spark, d):
    """The model on the rows held out."""
    _, test = model.split(model_rows(spark, d), ["event_id"])
    scored = pinned(model.score(test, trained(spark, d)))
    f1 = evaluate.precision_recall_f1(evaluate.confusion(scored, 0.0)).select((F.col("f1") >= 0.90).alias("good_f1")).first()["good_f1"]
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_score").isNull()).alias("null_scores")).withColumn("good_f1", F.lit(f1))


@query
def model_roundtrip(spark, d):
    """Scores before and after a model is saved and loaded, row by row."""
    fitted, path = trained(spark, d), fresh_dir(spark, "again")
    model.save(fitted, path)
    rows = pinned(model_rows(spark, d).select("event_id", *contract.FEATURES_V2))
    a = model.score(rows, fitted).select("event_id", F.col("anomaly_score").alias("a"))
    b = model.score(rows, model.load(spark, path)).select("event_id", F.col("anomaly_score").alias("b"))
    return a.join(b, "event_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("n_equal"))


@query
def batch_scores(spark, d):
    """The scorer for small batches against the model's own scores, row by row."""
    fitted = trained(spark, d)
    rows = pinned(model_rows(spark, d).select("event_id", *contract.FEATURES_V2))
    both = model.score(trees.BatchScorer(fitted).score(rows, "batch_score"), fitted)
    close = F.abs(F.col("batch_score") - F.col("anomaly_score")) < 1e-9
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(close).alias("n_close"))


@query
def model_record(spark, d):
    path = fresh_dir(spark, "record")
    model.record_model(spark, path, "v2", trained(spark, d), {"rows": float(events.read(spark, d).count())})
    return spark.read.parquet(path).select("version", "features", "rounds", F.col("metrics")["rows"].alias("n_rows"))


@query
def burst_quiet(spark, d):
    """A harmless burst of ten times the traffic is seen as such: high velocity, no alarm."""
    burst = whatif.amplify(events.logs(spark, d), *span(BURST))
    inside = in_range("window_start", *span(BURST))
    hours = context.context(rollup.buckets(burst, "hour")).where(inside).agg((F.max("throughput_velocity") > 5.0).alias("fast"))
    rows = view.scored_context(burst).where(in_range("timestamp", *span(BURST)))
    quiet = model.score(rows, trained(spark, d)).agg(F.count(F.lit(1)).alias("n"), (F.max("anomaly_score") <= 0.5).alias("quiet"))
    return quiet.withColumn("fast", F.lit(hours.first()["fast"]))


@query
def cluster_distance(spark, d):
    rows = pinned(view.scored_context(events.logs(spark, d), bucket="hour").select("event_id", *contract.NUMERIC_V2, "is_anomaly"))
    return model.cluster_distance(rows, contract.NUMERIC_V2, normal=rows.where(F.col("is_anomaly") == 0)).drop("is_anomaly")


CENTRES = ((2.0, 0.5), (2.0, 2.5), (5.0, 1.0))


@query
def cluster_assign(spark, d):
    """Rows by the nearest of given centres."""
    rows = events.logs(spark, d).select("event_id", "status_code", "response_time_ms")
    return rounded(model.nearest(rows, ["status_code", "response_time_ms"], CENTRES, (100.0, 1000.0), target="distance"), "distance")


# --- streams --------------------------------------------------------------------------------------------------------

def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = events.read(spark, d).schema
    # A stream takes a folder or a pattern; this pattern fits the table be it one file or a folder of files.
    return events.envelope(spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]"))


@query
def stream_rollup(spark, d):
    """Rows before the burst are backfilled in one batch, the rest comes as a stream."""
    root, check = fresh_dir(spark, "partials"), fresh_dir(spark, "stream")
    cut = at(BURST[0])
    rollup.backfill(events.logs(spark, d).where(F.col("timestamp") < cut), root)
    live.stream_rollup(_event_stream(spark, d).where(F.col("timestamp") >= cut), root, check).awaitTermination()
    return rollup.merge_partials(rollup.read_partials(spark, root))


@query
def partials_compacted(spark, d):
    """A store with a backfill, three batches, a replay, a late batch, two compactions and an expiry counts like one rollup."""
    logs, root = events.logs(spark, d), fresh_dir(spark, "partials")
    day, late = F.dayofmonth("timestamp"), F.col("event_id") % 10 == 0
    rollup.backfill(logs.where((day <= 5) & ~late), root)
    for n, days in enumerate(((6, 12), (13, 20), (21, 31))):
        rollup.write_partials(logs.where(day.between(*days) & ~late), root, n)
    rollup.write_partials(logs.where(day.between(6, 12) & ~late), root, 0)
    rollup.write_partials(logs.where(late & (day <= 20)), root, 3)
    rollup.compact_partials(spark, root, date(2024, 1, 16))
    rollup.write_partials(logs.where(late & (day > 20)), root, 4)
    rollup.compact_partials(spark, root, date(2024, 1, 25))
    rollup.expire_partials(spark, root, date(2024, 1, 4))
    return rollup.merge_partials(rollup.read_partials(spark, root), rollup.KEYS)


DELAY = "10 minutes"


def _finished(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """What a stream gives out until its input is used up."""
    sink, check = fresh_dir(spark, name), fresh_dir(spark, "stream")
    query = (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", check)
                   .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


@query
def stream_sliding_alerts(spark, d):
    """Windows that the watermark has closed, of rows slower than two seconds."""
    slow = _event_stream(spark, d).withColumn("anomaly_score", F.col("response_time_ms").cast("double"))
    return _finished(live.sliding_alerts(slow, 2000.0, 2, delay=DELAY, length="2 hours", slide="1 hour"), spark, "alerts")


@query
def stream_context(spark, d):
    """Context of the hours that the watermark has closed, from stream state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", state.STATE_PROVIDER)
    out = state.stream_context(state.closed_buckets(_event_stream(spark, d), "1 hour", DELAY))
    return rounded(_finished(out, spark, "context"), "throughput_velocity", "error_acceleration")


@query
def stream_new_signatures(spark, d):
    """:func:`first_seen_signatures` over the hours that the watermark has closed, from stream state that forgets."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", state.STATE_PROVIDER)
    return _finished(firsts.stream_first_seen(_event_stream(spark, d), SIX_HOURS, delay=DELAY), spark, "signatures")


@query
def stream_alert_episodes(spark, d):
    """Episodes of rows slower than two seconds, as the watermark closes them."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", state.STATE_PROVIDER)
    slow = _event_stream(spark, d).withColumn("anomaly_score", F.col("response_time_ms").cast("double"))
    return _finished(firsts.stream_episodes(slow, 2000.0, gap=18000, cooldown=28800, delay=DELAY), spark, "episodes")


@query
def stream_incident_labels(spark, d):
    """Labels of surge hours that are reported three hours after they begin; rows wait six hours for them."""
    source = fresh_dir(spark, "incidents")
    surges = context.context(hour_buckets(spark, d)).where(F.col("is_surge") == 1)
    start = F.col("window_start")
    surges.select("service_id", start.alias("start_at"), start.alias("end_at"), (start + F.make_dt_interval(hours=F.lit(3))).alias("reported_at")).write.parquet(source)
    reports = spark.readStream.schema("service_id string, start_at timestamp_ntz, end_at timestamp_ntz, reported_at timestamp_ntz").parquet(source)
    return _finished(late_labels(_event_stream(spark, d), reports, 1800, 1800, SIX_HOURS, delay=DELAY), spark, "labelled")


@query
def stream_scored_model(spark, d):
    """Rows scored by the model of the contract as they arrive, in four micro-batches of about a week."""
    source, root, sink, check = (fresh_dir(spark, n) for n in ("events", "partials", "scored", "stream"))
    rows, fitted = events.read(spark, d), trained(spark, d)
    for week in range(4):  # each run of the stream takes the files that are new, as one batch
        part = rows.where(F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)) == week)
        part.write.mode("append").parquet(source)
        stream = events.envelope(spark.readStream.schema(rows.schema).parquet(source))
        live.stream_scored(stream, root, sink, check, lambda df: model.score(df, fitted)).awaitTermination()
    df = spark.read.parquet(sink).select("event_id", "throughput_velocity", "is_surge", F.col("anomaly_score").isNotNull().alias("scored"), "batch_id")
    return rounded(df, "throughput_velocity")


@query
def stream_rescored(spark, d):
    """Rows that arrive out of order, a month's thirds as 1, 3, 2 and then late rows of all of it: every score follows what came later."""
    source, root, sink, check = (fresh_dir(spark, n) for n in ("events", "partials", "scored", "stream"))
    rows = events.read(spark, d)
    late, third = F.pmod("event_id", F.lit(50)) == 7, F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    schema = rows.schema
    for part in (rows.where(~late & (third == 0)), rows.where(~late & (third == 2)), rows.where(~late & (third == 1)), rows.where(late)):
        part.write.mode("append").parquet(source)
        stream = events.envelope(spark.readStream.schema(schema).parquet(source))
        live.stream_rescored(stream, root, sink, check, lambda df: df.withColumn("anomaly_score", sc.sigmoid(F.col("throughput_velocity") - 1.0)),
                             since=at("2000-01-01 00:00:00")).awaitTermination()
    df = live.read_scored(spark, sink)
    return rounded(df.select("event_id", "service_id", "throughput_velocity", "error_acceleration", "is_surge", "anomaly_score"),
                   "throughput_velocity", "error_acceleration", "anomaly_score")


@query
def stream_scored(spark, d):
    """Rows scored as they arrive, by how busy their minute is."""
    root, sink, check = (fresh_dir(spark, n) for n in ("partials", "scored", "stream"))

    def scorer(df: DataFrame) -> DataFrame:
        return df.withColumn("anomaly_score", sc.sigmoid(F.col("throughput_velocity") - 1.0))

    live.stream_scored(_event_stream(spark, d), root, sink, check, scorer).awaitTermination()
    df = spark.read.parquet(sink).select("event_id", "timestamp", "service_id", "throughput_velocity", "is_surge",
                                         "anomaly_score")
    return rounded(df, "throughput_velocity", "anomaly_score")
