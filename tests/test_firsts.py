"""Stream state that remembers when something was last there, against batch answers; several micro-batches, ties and nulls."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators import episodes, labels
from emberlog.streaming import firsts
from emberlog.streaming.labels import stream_incident_labels
from tests.helpers import BASE

DAY = BASE.replace(hour=0, minute=0)
LOGS = "event_id bigint, service_id string, timestamp timestamp_ntz, log_signature string, anomaly_score double, is_anomaly int"


@pytest.fixture
def rows():
    """Four days of rows by time; some services and signatures are null, and some signatures pause for long."""
    rng, out = random.Random(2), []
    for i in range(1200):
        at = DAY + timedelta(seconds=288 * i + rng.choice([0, 0, rng.randrange(200)]))
        name = rng.choice(["a", "b", None]) if (i // 150) % 2 else rng.choice(["a", "c"])
        out.append((i, rng.choice(["hot", "hot", "x", None]), at, name, rng.choice([0.5, 2.0, 3.0, None]), None))
    return out


def parts(spark, path, rows, n):
    """``rows`` in ``n`` files in the order of time, each a micro-batch."""
    step = -(-len(rows) // n)
    for i in range(0, len(rows), step):
        spark.createDataFrame(rows[i:i + step], LOGS).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(LOGS).option("maxFilesPerTrigger", 1).parquet(path)


def given_out(stream, spark, tmp_path, name):
    sink = f"{tmp_path}/{name}"
    (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{sink}-check")
           .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(sink)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_first_seen_walked_by_hand(spark, rows):
    hours = sorted({(r[1], r[3], r[2].replace(minute=0, second=0)) for r in rows}, key=lambda r: r[2])
    last, want = {}, []
    for service, name, hour in hours:
        if (service, name) not in last or hour - last[service, name] > timedelta(hours=3):
            want.append((service, name, hour))
        last[service, name] = hour
    got = firsts.first_seen(spark.createDataFrame(rows + [(-1, "hot", None, "new", 1.0, None)], LOGS), 3 * 3600)
    assert values(got.drop("n")) == sorted(want, key=repr) and len(want) > 20
    assert firsts.first_seen(spark.createDataFrame([], LOGS), 3600).collect() == []


def test_stream_of_first_seen_equals_batch(spark, rows, tmp_path):
    stream = firsts.stream_first_seen(parts(spark, str(tmp_path / "in"), rows, 4), 3 * 3600, delay="0 seconds")
    got = values(given_out(stream, spark, tmp_path, "out"))
    last = max(r[2] for r in rows)
    closed = firsts.first_seen(spark.createDataFrame(rows, LOGS), 3 * 3600).where(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(last))
    assert got == values(closed.select(*stream.columns)) and len(got) > 20


def test_stream_of_episodes_equals_batch(spark, rows, tmp_path):
    stream = firsts.stream_episodes(parts(spark, str(tmp_path / "in"), rows, 3), 1.0, 900, 2000, "0 seconds")
    got = values(given_out(stream, spark, tmp_path, "out"))
    last = max(r[2] for r in rows if (r[4] or 0) > 1)
    batch = episodes.alert_episodes(spark.createDataFrame(rows, LOGS), 1.0, 900, 2000, 1).withColumn("peak_id", F.element_at("examples", 1))
    closed = batch.where(F.col("episode_end") + F.expr("INTERVAL 900 SECONDS") <= F.lit(last))
    assert got == values(closed.select(*stream.columns)) and len(got) > 20 and {r[-1] for r in got} == {0, 1}


def test_late_labels_equal_batch(spark, rows, tmp_path):
    """Incidents overlap, one is of no service, one ends before it starts, one has no report; each comes two hours after its end."""
    spans = [("hot", 10, 13), ("hot", 12, 15), ("x", 30, 30), ("hot", 50, 49), (None, 20, 22), ("x", 70, 72), ("hot", 90, 91)]
    hour = lambda h: DAY + timedelta(hours=h)
    reports = [(s, hour(a), hour(b), hour(b + 2)) for s, a, b in spans] + [("x", hour(40), hour(41), None)]
    schema = "service_id string, start_at timestamp_ntz, end_at timestamp_ntz, reported_at timestamp_ntz"
    source = str(tmp_path / "incidents")
    for i in (0, 4):
        spark.createDataFrame(reports[i:i + 4], schema).coalesce(1).write.mode("append").parquet(source)
    incidents = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    wait = 8 * 3600
    stream = stream_incident_labels(parts(spark, str(tmp_path / "in"), rows, 2), incidents, 600, 1200, wait, delay="0 seconds")
    got = values(given_out(stream, spark, tmp_path, "out"))
    usable = spark.createDataFrame([r for r in reports if r[3] is not None], schema)
    want = labels.incident_label(spark.createDataFrame(rows, LOGS), usable, 600, 1200).select(*stream.columns)
    # Rows wait until both streams have passed them by the wait; what is covered goes out at once.
    mark = min(max(r[2] for r in rows), hour(93)) - timedelta(seconds=wait)
    assert got == values(want.where((F.col("is_anomaly") == 1) | (F.col("timestamp") < F.lit(mark))))
    assert sum(r[-1] for r in got) > 50 and len(got) == len({r[0] for r in got}) > 800
