import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators import alerts, evaluate, joins, labels, novelty, rank, whatif
from emberlog.plans import report
from emberlog.sources import adapters, contract
from tests.helpers import BASE, log, logs


def at(minutes):
    return F.lit(str(BASE + timedelta(minutes=minutes))).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def scored(spark):
    """200 rows a minute apart with scores 0..199, keyed by event_id; 20 bad ones."""
    rows = [(i, *log(ts=BASE + timedelta(minutes=i), service=f"s{i % 2}", endpoint=f"/e{i % 4}", label=int(i >= 180)), float(i))
            for i in range(200)]
    names = ["event_id", *contract.V2_SCHEMA.fieldNames(), "anomaly_score"]
    types = ["bigint", *[f.dataType.simpleString() for f in contract.V2_SCHEMA.fields], "double"]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, types)))


# --- labels ---------------------------------------------------------------------------------------------------

def test_rule_label_uses_the_columns_there_are(spark):
    df = logs(spark, [log(), log(status=500), log(label=1)])
    assert [r.is_anomaly for r in labels.rule_label(df).collect()] == [0, 1, 0]
    more = df.withColumns({"log_level": F.when(F.col("is_anomaly") == 1, "FATAL"),
                           "error_kind": F.lit(None).cast("string"), "exception_class": F.lit("E")})
    assert [r.is_anomaly for r in labels.rule_label(more).collect()] == [0, 1, 1]
    assert [r.is_anomaly for r in labels.rule_label(more, exceptions=["E"]).collect()] == [1, 1, 1]


@pytest.mark.parametrize("limit", [None, 0])
def test_incidents_against_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr("emberlog.operators.joins.BROADCAST_BYTES", 64 << 20 if limit is None else limit)
    rng = random.Random(8)
    rows = [log(ts=BASE + timedelta(seconds=rng.randrange(6 * 3600)), service=rng.choice("ab")) for _ in range(500)]
    # The first row lies exactly on the edge of a span.
    rows.append(log(ts=BASE + timedelta(minutes=50), service="a"))
    incidents = [(str(i), rng.choice("ab"), BASE + timedelta(minutes=m), BASE + timedelta(minutes=m + n))
                 for i, (m, n) in enumerate([(20, 20), (30, 20), (35, 1), (200, 0), (260, 90)])]
    incidents.append(("x", "a", BASE + timedelta(minutes=40), BASE + timedelta(minutes=45)))
    out = labels.incident_label(logs(spark, rows), spark.createDataFrame(incidents, contract.INCIDENT_SCHEMA), 120, 300)

    def want(ts, service):
        return int(any(s == service and a - timedelta(seconds=120) <= ts <= b + timedelta(seconds=300)
                       for _, s, a, b in incidents))

    got = out.collect()
    assert len(got) == len(rows) and out.columns == contract.V2_SCHEMA.fieldNames()
    assert all(r.is_anomaly == want(r.timestamp, r.service_id) for r in got)
    assert 0 < sum(r.is_anomaly for r in got) < len(rows)


def test_merged_spans_do_not_overlap(spark):
    rows = [("a", BASE, BASE + timedelta(hours=3)), ("a", BASE + timedelta(minutes=5), BASE + timedelta(minutes=6)),
            ("a", BASE + timedelta(hours=5), BASE + timedelta(hours=5))]
    out = labels.merged_spans(spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz"), ["k"], "s", "e")
    got = out.orderBy("s").collect()
    assert [(r.s, r.e) for r in got][0] == (BASE, BASE.replace(hour=13, minute=0))
    assert all(a.e <= b.s for a, b in zip(got, got[1:])) and got[-1].e == BASE + timedelta(hours=3) and len(got) == 4


def test_open_and_backward_incidents(spark):
    df = logs(spark, [log(ts=BASE + timedelta(hours=i)) for i in range(5)])
    rows = [("svc-a", BASE + timedelta(hours=2), None), ("svc-a", BASE, BASE - timedelta(hours=1)), ("svc-a", None, BASE), (None, BASE, BASE)]
    incidents = spark.createDataFrame(rows, "service_id string, start_at timestamp_ntz, end_at timestamp_ntz")
    out = labels.incident_label(df, incidents, 0, 0, as_of=F.lit(BASE + timedelta(hours=3)).cast("timestamp_ntz"))
    assert [r.is_anomaly for r in out.orderBy("timestamp").collect()] == [0, 0, 1, 1, 0]
    assert labels.unusable_incidents(incidents).count() == 3
    with pytest.raises(Exception, match="as_of"):
        labels.incident_label(df, incidents, 0, 0).collect()


def test_tags_and_blocklist(spark):
    df = logs(spark, [log(agent="bad"), log(agent="good"), log(agent=None)])
    tags = spark.createDataFrame([("bad",), ("bad",)], "user_agent string")
    assert [r.is_blocked for r in labels.in_blocklist(df, tags).collect()] == [1, 0, 0]


def test_p99(spark):
    df = logs(spark, [log(ms=i) for i in range(1, 101)])
    assert [r.response_time_ms for r in labels.p99_rule(df).where("is_slow = 1").collect()] == [100]


# --- novelty --------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_rows_without_a_service_are_a_group(spark, limit, monkeypatch):
    monkeypatch.setattr("emberlog.operators.joins.BROADCAST_BYTES", limit)
    df = logs(spark, [log(service=None, ms=1), log(service=None, ms=3), log(service=None, ms=8), log(ms=5)])
    assert sorted(r.anomaly_score for r in novelty.robust_outlier_score(df).collect()) == [-1.0, 0.0, 0.0, 2.5]
    assert sorted(r.anomaly_score for r in novelty.outlier_score(df).collect()) == [-1.019049, -0.339683, 0.0, 1.358732]


def test_outlier_score_of_equal_values_is_zero(spark):
    df = logs(spark, [log(ms=5), log(ms=5), log(service="b", ms=1), log(service="b", ms=3), log(service="b", ms=None)])
    assert [r.anomaly_score for r in novelty.outlier_score(df).collect()] == [0.0, 0.0, -1.0, 1.0, None]


def test_robust_score(spark):
    df = logs(spark, [log(ms=m) for m in (1, 2, 3, 4, 100)] + [log(service="b", ms=7)])
    assert [r.anomaly_score for r in novelty.robust_outlier_score(df).orderBy("service_id", "response_time_ms").collect()] == [
        0.0, -2.0, -1.0, 0.0, 1.0, 97.0]


def test_new_signatures(spark):
    old = logs(spark, [log(signature="x"), log(service="b", signature="y")])
    now = logs(spark, [log(signature="x"), log(signature="y"), log(signature="y", ts=BASE + timedelta(minutes=1))])
    assert [r[:] for r in novelty.new_signatures(now, old).collect()] == [("svc-a", "y", 2, BASE)]


def test_rarity(spark):
    df = logs(spark, [log(signature="x")] * 3 + [log(signature="y"), log(service="b", signature="y")])
    got = {(r.service_id, r.log_signature): round(r.rarity, 6) for r in novelty.rarity(df).collect()}
    assert got == {("svc-a", "x"): 0.287682, ("svc-a", "y"): 1.386294, ("b", "y"): 0.0}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_payload_score(spark, limit, monkeypatch):
    monkeypatch.setattr("emberlog.operators.joins.BROADCAST_BYTES", limit)
    from math import log as ln
    texts = {1: "a a b", 2: "A c\n", 3: "  ", 4: None}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    got = {r.id: (r.n_tokens, r.payload_anomaly_score) for r in novelty.payload_score(df, "id", "t").collect()}
    assert got.keys() == {1, 2, 3, 4} and got[3] == got[4] == (0, None)
    assert got[1] == (3, pytest.approx((2 * ln(5 / 3) + ln(5)) / 3)) and got[2] == (2, pytest.approx((ln(5 / 3) + ln(5)) / 2))


@pytest.mark.parametrize("limit, rows", [(0, 12 * 4 + 5), (150, 16 + 12 * 2 + 1), (400, 16 + 12)])
def test_payload_score_shuffles_rare_words_only(spark, limit, rows, monkeypatch):
    """Words that fit a broadcast leave one row per message; the scores are those of a broadcast of all words."""
    texts = {i: " ".join(["the", "of"] * 20 + [f"w{i}", f"x{i % 3}"]) for i in range(12)} | {12: None, 13: " ", 14: "the"}
    df = spark.createDataFrame([*texts.items(), (3, "the w3"), (None, "of it")], "id int, t string")
    want = {r.id: (r.n_tokens, r.payload_anomaly_score) for r in novelty.payload_score(df, "id", "t").collect()}
    seen, attach = [], novelty.attach
    monkeypatch.setattr(novelty, "attach", lambda left, *a, **k: seen.append(left.count()) or attach(left, *a, **k))
    monkeypatch.setattr(novelty, "BROADCAST_BYTES", limit)
    monkeypatch.setattr("emberlog.operators.joins.BROADCAST_BYTES", 0)
    got = {r.id: (r.n_tokens, r.payload_anomaly_score) for r in novelty.payload_score(df, "id", "t").collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == (pytest.approx(want[k][1]) if want[k][1] is not None else None) for k in want)
    assert seen == [rows]  # messages with each of their words; with 150 bytes, messages and words seen up to seven times; with 400, up to three times


# --- evaluation -----------------------------------------------------------------------------------------------

def test_report(scored):
    r = report.validation_report(scored).first()
    assert (r.total_rows, r.n_unlabelled, r.null_scores, r.n_0, r.n_1) == (200, 0, 0, 180, 20)
    assert r.threshold == pytest.approx(179.1) and (r.tp, r.fp, r.fn, r.tn) == (20, 0, 0, 180)
    assert (r.precision, r.recall, r.f1, r.avg_score_1) == (1.0, 1.0, 1.0, 189.5)
    assert report.lines(report.validation_report(scored))[-1].endswith("F1 100.00%")


def test_report_with_threshold_counts_rows_without_label(scored):
    some = scored.withColumn("is_anomaly", F.when(F.col("event_id") < 100, F.col("is_anomaly")))
    r = report.validation_report(some, threshold=50.0).first()
    assert (r.total_rows, r.n_unlabelled, r.max_score, r.n_1) == (200, 100, 199.0, 0)
    assert (r.tp, r.fp, r.fn, r.tn) == (0, 50, 0, 50) and (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_report_of_nothing(scored):
    assert report.lines(report.validation_report(scored.where("false"))) == ["No data to validate."]


def test_equal_to_threshold_is_positive(scored):
    assert evaluate.confusion(scored, 180.0).first()[:] == (20, 0, 0, 180)
    assert evaluate.confusion(scored, 181.0).first()[:] == (19, 0, 1, 180)


def test_stats_and_parity(spark, scored):
    assert evaluate.score_stats(scored).first()[:] == (200, 0.0, 199.0, 99.5, 0)
    assert {r.is_anomaly: (r.n, r.median_score) for r in evaluate.score_center(scored).collect()} == {0: (180, 89.5), 1: (20, 189.5)}
    assert evaluate.count_parity(scored, scored).first()[:] == (200, 200, True)
    assert evaluate.count_parity(scored, scored.where("event_id > 0")).first()[:] == (200, 199, False)
    assert evaluate.max_score(scored, at(10), at(20)).first()[:] == (10, 19.0)
    assert evaluate.anomaly_ratio(scored).first()[:] == (200, 20, 0.1)
    assert evaluate.score_histogram(scored, 100.0).count() == 2


# --- ranks and alerts -----------------------------------------------------------------------------------------

def test_ranks(scored):
    assert [r.event_id for r in rank.top_scores(scored, 3).collect()] == [199, 198, 197]
    assert [r.event_id for r in rank.latest(scored, 2).collect()] == [199, 198]
    assert rank.recent(scored, at(199), hours=1).count() == 61
    assert [r[:] for r in rank.top_endpoints(scored, 197.0).collect()] == [("/e2", 1), ("/e3", 1)]
    best = rank.top_n_per_hour(scored, 2)
    assert {r.rank for r in best.collect()} == {1, 2} and best.count() == 8


def test_thresholds_fall_back_to_the_default(spark, scored):
    table = spark.createDataFrame([("s0", 190.0, "ops", "")], contract.THRESHOLD_SCHEMA)
    out = alerts.apply_thresholds(scored, table, 195.0)
    assert {r.event_id for r in out.where("is_alert = 1").collect()} == {192, 194, 196, 197, 198, 199}


def test_alerts(scored):
    assert alerts.count_alert(scored, 189.0, limit=10).count() == 0
    assert alerts.count_alert(scored, 188.0, limit=10).first()[0] == 11
    windows = alerts.sliding_counts(scored, 189.0, by=[]).collect()
    assert sum(r.n_anomalies for r in windows) == 20
    hours = scored.select(F.date_trunc("hour", "timestamp")).distinct().count()
    assert alerts.anomaly_series(scored, 1e9).agg(F.count("*"), F.sum("n_anomalies")).first()[:] == (hours, 0)
    series = alerts.anomaly_series(scored, -1.0, by=["service_id"])
    assert alerts.zscore_alerts(series).count() == 0
    examples = alerts.alert_examples(scored, 150.0, limit=5, k=2)
    assert all(r.rank <= 2 and r.n_anomalies >= 5 for r in examples.collect()) and examples.count() > 0


@pytest.mark.parametrize("chunk_rows", [None, 60])
def test_zscore_alert_finds_the_spike(spark, chunk_rows):
    rows = [("s", BASE + timedelta(hours=i), 100 if i == 150 else 1 + i % 3) for i in range(200)]
    series = spark.createDataFrame(rows, "service_id string, bucket_start timestamp_ntz, n_anomalies bigint")
    assert [r.n_anomalies for r in alerts.zscore_alerts(series, chunk_rows=chunk_rows).collect()] == [100]


# --- what-if and adapters -------------------------------------------------------------------------------------

def test_burst_is_tenfold_and_normal(spark):
    df = logs(spark, [log(status=500, ms=5000, label=1), log(ts=BASE + timedelta(minutes=5), status=500, label=1)])
    out = whatif.amplify(df, at(0), at(5))
    inside = out.where(F.col("timestamp") < at(5)).collect()
    assert len(inside) == 10 and sorted(r.copy for r in inside) == list(range(10))
    assert {(r.status_code, r.response_time_ms, r.is_anomaly) for r in inside} == {(200, 1000, 0)}
    rest = out.where(F.col("timestamp") >= at(5)).collect()
    assert [(r.status_code, r.is_anomaly, r.copy) for r in rest] == [(500, 1, 0)]


def test_silent_failure_changes_the_signature_only(spark):
    df = logs(spark, [log(status=500, label=1), log(ts=BASE + timedelta(minutes=5))])
    out = whatif.overlay_signature(df, at(0), at(5)).orderBy("timestamp").collect()
    assert [r.log_signature for r in out] == [whatif.SILENT_SIGNATURE, "[A]:[B]:[OK]"]
    assert (out[0].status_code, out[0].is_anomaly) == (500, 1)


def test_mixed_versions(spark):
    v2 = logs(spark, [log()])
    v1 = logs(spark, [log(ts=BASE.replace(day=3))]).select(*contract.V1_SCHEMA.fieldNames())
    rows = {r.schema_version: r for r in adapters.mixed_versions(v1, v2).collect()}
    assert rows[1].throughput_velocity == 1.0 and rows[1].hour_of_day == 12 and rows[1].is_weekend == 0
    assert rows[1].log_signature is None and rows[2].log_signature == "[A]:[B]:[OK]" and rows[2].is_weekend == 1


@pytest.mark.parametrize("limit", [None, 0])
def test_thresholds_as_of_the_row(spark, limit, monkeypatch):
    """Several changes in a minute, of one time, before all rows, without a value; a service without changes, and null services."""
    if limit is not None:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    rng = random.Random(4)
    rows = [(i, rng.choice(("a", "b", "c", None)), BASE + timedelta(seconds=rng.randrange(1200)), float(i % 7), "old") for i in range(600)]
    changes = [(rng.choice(("a", "b", None)), BASE + timedelta(seconds=rng.randrange(-300, 1200)), float(i)) for i in range(40)]
    changes += [("a", BASE + timedelta(seconds=600), v) for v in (50.0, 60.0, None)] + [("b", None, 70.0)]
    scored = spark.createDataFrame(rows, "event_id long, service_id string, timestamp timestamp_ntz, anomaly_score double, threshold string")
    marks = spark.createDataFrame(changes, "service_id string, valid_from timestamp_ntz, threshold double")
    want = {}
    for i, service, ts, _, _ in rows:
        held = [(t, v) for s, t, v in changes if s == service and t is not None and v is not None and t <= ts]
        want[i] = max(held)[1] if held else 9.0
    got = alerts.thresholds_asof(scored, marks, 9.0)
    assert got.columns == ["event_id", "service_id", "timestamp", "anomaly_score", "threshold"]
    assert {r.event_id: r.threshold for r in got.collect()} == want and len(set(want.values())) > 20
    assert {r.threshold for r in alerts.thresholds_asof(scored, marks.limit(0), 9.0).collect()} == {9.0}
    assert alerts.thresholds_asof(scored.limit(0), marks, 9.0).collect() == []
