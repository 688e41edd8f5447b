"""Streams give what the same rows give in one batch."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators import alerts, context as ctx, rollup as ru
from emberlog.plans import view
from emberlog.sources import contract, events, tables
from emberlog.streaming import live, state
from tests.helpers import BASE, log, logs, series

SF = "/root/testdata/sf0.001"
KEY = ["service_id", "window_start"]


@pytest.fixture
def files(spark, tmp_path):
    """The log rows in four files, the first of them holding the latest rows."""
    path = str(tmp_path / "in")
    df = events.logs(spark, SF).drop("event_id")
    bounds = ["2024-01-24", "2024-01-16", "2024-01-08", "2024-01-01"]
    upper = "2025-01-01"
    for low in bounds:
        part = df.where((F.col("timestamp") >= F.lit(low)) & (F.col("timestamp") < F.lit(upper)))
        part.coalesce(1).write.mode("append").parquet(path)
        upper = low
    return path


def source(spark, path):
    return (spark.readStream.schema(contract.V2_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path))


def test_stream_rollup_equals_batch(spark, files, tmp_path):
    root, check = str(tmp_path / "p"), str(tmp_path / "c")
    query = live.stream_rollup(source(spark, files), root, check)
    query.awaitTermination()
    parts = ru.read_partials(spark, root)
    assert parts.select("batch_id").distinct().count() == 4
    want = ru.buckets(spark.read.parquet(files)).orderBy(*KEY).collect()
    assert ru.merge_partials(parts).orderBy(*KEY).collect() == want

    # New rows arrive late, for an old minute; only they are read.
    old = spark.read.parquet(files).orderBy("timestamp").limit(3)
    old.coalesce(1).write.mode("append").parquet(files)
    live.stream_rollup(source(spark, files), root, check).awaitTermination()
    want = ru.buckets(spark.read.parquet(files)).orderBy(*KEY).collect()
    assert ru.merge_partials(ru.read_partials(spark, root)).orderBy(*KEY).collect() == want


def test_stream_scored_counts_what_was_seen_so_far(spark, tmp_path):
    path, root, sink, check = (str(tmp_path / n) for n in ("in", "p", "s", "c"))
    first = [log(ts=BASE + timedelta(minutes=i)) for i in range(12)]
    second = [log(ts=BASE + timedelta(minutes=12), endpoint="/new")] * 10
    logs(spark, first).coalesce(1).write.parquet(path)

    def start():
        live.stream_scored(source(spark, path), root, sink, check,
                           lambda df: df.withColumn("anomaly_score", F.col("throughput_velocity"))).awaitTermination()

    start()
    assert spark.read.parquet(sink).count() == 12
    logs(spark, second).coalesce(1).write.mode("append").parquet(path)
    start()
    out = spark.read.parquet(sink)
    assert out.count() == 22
    assert {round(r.anomaly_score, 6) for r in out.where("endpoint = '/new'").collect()} == {round(10 / 1.9, 6)}


@pytest.mark.parametrize("chunk_rows", [None, 70])
def test_stale_buckets_are_the_touched_ones_and_sixty_rows_after(spark, chunk_rows):
    merged = series(spark, [1] * 300, skip=range(100, 110))
    touched = spark.createDataFrame([("svc-a", BASE + timedelta(minutes=m)) for m in (20, 95, 250)], "service_id string, window_start timestamp_ntz")
    got = {(r.window_start - BASE).seconds // 60 for r in live.stale_buckets(merged, touched, chunk_rows).collect()}
    assert got == {*range(20, 81), *range(95, 100), *range(110, 166), *range(250, 300)}


def test_scores_follow_late_rows_and_replays(spark, tmp_path):
    """Minutes arrive in a shuffled order; after each batch every row has the score of the batch operator over all rows so far."""
    path, root, sink, check = (str(tmp_path / n) for n in ("in", "p", "s", "c"))
    rows = [log(ts=BASE + timedelta(minutes=i), service=s, endpoint=f"/{i}") for s in ("a", "b") for i in range(100) for _ in range(1 + (i * 7 + len(s)) % 4)]
    parts = [rows[60:140], rows[:60], rows[140:], [log(ts=BASE + timedelta(minutes=3), service="a", endpoint="/late")] * 30]

    def scorer(df):
        return df.withColumn("anomaly_score", F.col("throughput_velocity") + F.col("is_surge"))

    def start():
        stream = spark.readStream.schema(contract.V2_SCHEMA).parquet(path)
        live.stream_rescored(stream, root, sink, check, scorer).awaitTermination()

    def values(df):
        return sorted((r.service_id, r.timestamp, r.endpoint, round(r.throughput_velocity, 9), round(r.anomaly_score, 9)) for r in df.collect())

    for part in parts:
        logs(spark, part).coalesce(1).write.mode("append").parquet(path)
        start()
        so_far = spark.read.schema(contract.V2_SCHEMA).parquet(path)
        assert values(live.read_scored(spark, sink)) == values(scorer(view.scored_context(so_far)))
    versions = spark.read.parquet(f"{sink}/buckets")
    assert versions.where("batch_id = 3 AND service_id = 'a'").count() == 61 and versions.where("batch_id = 3 AND service_id = 'b'").count() == 0
    # A batch that runs again, as after a crash before its commit, replaces what it wrote.
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].unlink()
    (tmp_path / "c" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    before = values(live.read_scored(spark, sink))
    start()
    assert values(live.read_scored(spark, sink)) == before


def test_live_view_knows_the_context_of_rows_that_came_later(spark, tmp_path):
    name = "live_view_logs"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.ensure_table(spark, name, contract.V2_SCHEMA, "timestamp", str(tmp_path / "live"))
    early = [log(ts=BASE + timedelta(minutes=i)) for i in range(12)]
    tables.append_table(logs(spark, early), name, contract.V2_SCHEMA, "timestamp")
    view.anomaly_view(view.scored_context(spark.table(name), lazy=True), "live_view")
    assert spark.table("live_view").count() == 12
    tables.append_table(logs(spark, [log(ts=BASE + timedelta(minutes=12))] * 50), name, contract.V2_SCHEMA, "timestamp")
    late = spark.table("live_view").where(F.col("timestamp") == F.lit(BASE + timedelta(minutes=12))).collect()
    assert len(late) == 50 and {(round(r.throughput_velocity, 6), r.is_surge) for r in late} == {(round(500 / 59, 6), 1)}
    spark.sql(f"DROP TABLE {name}")


def test_sliding_alerts_on_a_stream(spark, files):
    def score(df):
        return df.withColumn("anomaly_score", F.col("response_time_ms").cast("double"))

    df = score(spark.read.parquet(files))
    stream = score(spark.readStream.schema(contract.V2_SCHEMA).parquet(files))
    out = live.sliding_alerts(stream, 500.0, 2, delay="1 hour", length="6 hours", slide="3 hours")
    query = out.writeStream.format("memory").queryName("sliding").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("sliding")
    want = alerts.sliding_alerts(df, 500.0, 2, length="6 hours", slide="3 hours")
    assert got.count() > 0 and got.exceptAll(want).isEmpty()
    # Windows still open at the end are not given out; all closed ones are. The rows above the threshold
    # move the watermark, as the filter is done first.
    last = df.where("anomaly_score > 500").agg(F.max("timestamp")).first()[0] - timedelta(hours=1)
    assert want.where(F.col("window_end") <= F.lit(last)).exceptAll(got).isEmpty()


def test_context_as_stream_state(spark, tmp_path):
    """Buckets closed by the watermark get the features of the batch operator."""
    path = str(tmp_path / "in")
    rows = [log(ts=BASE + timedelta(minutes=i), service=s, status=500 if i % 4 == 0 else 200)
            for s in ("a", "b") for i in range(90) for _ in range(1 + (i * 7 + len(s)) % 5 + (40 if i == 70 else 0))]
    # Two files in time order: state has to carry over from the first micro-batch to the second.
    half = BASE + timedelta(minutes=45)
    for part in ([r for r in rows if r[0] < half], [r for r in rows if r[0] >= half]):
        logs(spark, part).coalesce(1).write.mode("append").parquet(path)
    stream = state.stream_context(state.closed_buckets(source(spark, path), delay="0 seconds"))
    query = stream.writeStream.format("memory").queryName("ctx").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.service_id, r.window_start): r for r in spark.table("ctx").collect()}
    want = {(r.service_id, r.window_start): r for r in ctx.context(ru.buckets(logs(spark, rows))).collect()}
    assert len(got) >= 2 * 88
    for k, r in got.items():
        assert r.throughput_velocity == pytest.approx(want[k].throughput_velocity)
        assert r.error_acceleration == pytest.approx(want[k].error_acceleration)
        assert (r.is_surge, r.total_reqs, r.error_reqs) == (want[k].is_surge, want[k].total_reqs, want[k].error_reqs)
    assert any(r.is_surge for r in got.values())
