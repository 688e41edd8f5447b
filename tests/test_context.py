import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.functions.clock import bucket_start, epoch_seconds
from emberlog.operators import context as ctx
from emberlog.operators import rollup as ru
from emberlog.operators import windows
from emberlog.plans import view
from emberlog.sources.contract import ROLLUP_SCHEMA
from tests.helpers import BASE, brute_context, log, logs, series


def features(df):
    return {(r.service_id, r.window_start): (r.throughput_velocity, r.error_acceleration, r.is_surge)
            for r in ctx.filled(df).collect()}


@pytest.fixture(scope="module")
def gappy():
    """Two services over three days with gaps, spikes and errors."""
    rng = random.Random(11)
    rows = []
    for s in ("a", "b"):
        for i in range(4000):
            if rng.random() < 0.15:
                t = BASE + timedelta(minutes=i)
                n = rng.randrange(1, 6) if rng.random() < 0.97 else 60
                rows.append((s, t, t.hour, n, rng.randrange(0, n + 1) if rng.random() < 0.5 else 0))
    return rows


@pytest.mark.parametrize("chunk_rows", [None, 0, 60, 61, 100])
def test_row_frames_against_brute_force(spark, gappy, chunk_rows):
    got = features(ctx.context(spark.createDataFrame(gappy, ROLLUP_SCHEMA), chunk_rows=chunk_rows))
    want = brute_context(gappy)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12), k
    assert any(v[2] for v in want.values())


@pytest.mark.parametrize("piece", [20_000, 100])
def test_range_frames_against_brute_force(spark, gappy, piece, monkeypatch):
    monkeypatch.setattr(ctx, "PIECE_BUCKETS", piece)
    got = features(ctx.context(spark.createDataFrame(gappy, ROLLUP_SCHEMA), frame="range"))
    want = brute_context(gappy, minutes=True)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12), k


def test_long_series_are_cut_by_themselves(spark, gappy, monkeypatch):
    df = spark.createDataFrame(gappy, ROLLUP_SCHEMA)
    plain = features(ctx.context(df, chunk_rows=0))
    monkeypatch.setattr(windows, "CHUNK_ROWS", 70)
    assert features(ctx.context(df)) == plain


def test_chunks_must_hold_the_halo(spark):
    with pytest.raises(ValueError):
        ctx.context(series(spark, [1]), chunk_rows=59)


def test_tenfold_burst_after_nine_equal_buckets(spark):
    got = features(ctx.context(series(spark, [7] * 9 + [70])))
    assert got["svc-a", BASE + timedelta(minutes=9)][0] == pytest.approx(10 / 1.9)


def test_velocity_stays_below_ten(spark):
    got = features(ctx.context(series(spark, [1] * 20 + [10 ** 9])))
    assert max(v[0] for v in got.values()) < 10


def test_no_surge_before_the_eleventh_bucket(spark):
    # With n equal buckets and one spike z is sqrt(n - 1): exactly 3 for n = 10, which is not above 3.
    for n in (5, 10):
        assert not any(v[2] for v in features(ctx.context(series(spark, [1] * (n - 1) + [1000]))).values())
    got = features(ctx.context(series(spark, [1] * 10 + [1000])))
    assert got["svc-a", BASE + timedelta(minutes=10)][2] == 1


def test_surge_frame_holds_61_rows(spark):
    # The spike at position 0 is still seen 60 rows later, not 61 rows later.
    counts = [1000] + [1] * 59 + [1000]
    assert features(ctx.context(series(spark, counts)))["svc-a", BASE + timedelta(minutes=60)][2] == 1
    near = ctx.context(series(spark, [100] + [1] * 59 + [100, 100]), chunk_rows=0)
    assert features(near)["svc-a", BASE + timedelta(minutes=61)][0] == pytest.approx(100 / (208 / 10))


def test_acceleration_needs_errors_ten_buckets_back(spark):
    df = ctx.context(series(spark, [10] * 12, errors={0: 2, 10: 4, 11: 4}))
    rows = {r.window_start: r for r in df.collect()}
    hit, miss = rows[BASE + timedelta(minutes=10)], rows[BASE + timedelta(minutes=11)]
    assert hit.error_acceleration == pytest.approx(2.0) and hit.has_baseline
    assert miss.error_acceleration is None and not miss.has_baseline
    assert features(df)["svc-a", BASE + timedelta(minutes=11)][1] == 0.0


def test_huge_counts_do_not_overflow(spark):
    got = features(ctx.context(series(spark, [3 * 10 ** 11] * 20 + [3 * 10 ** 12])))
    assert got["svc-a", BASE + timedelta(minutes=20)][2] == 1


def test_attached_context_keeps_rows_and_defaults(spark):
    rows = [log(), log(), log(service="svc-z"), log(ts=BASE + timedelta(minutes=1))]
    merged = ru.buckets(logs(spark, rows[:2]))
    out = view.scored_context(logs(spark, rows), merged).collect()
    assert len(out) == 4
    assert {(r.throughput_velocity, r.error_acceleration, r.is_surge) for r in out} == {(1.0, 0.0, 0)}


def test_scored_between_equals_full_run(spark):
    rng = random.Random(2)
    rows = [log(ts=BASE + timedelta(seconds=rng.randrange(4 * 3600)), status=rng.choice([200, 200, 500])) for _ in range(800)]
    df = logs(spark, rows)
    start, end = (F.lit(str(BASE + timedelta(minutes=m))).cast("timestamp_ntz") for m in (150, 200))
    cut = view.scored_between(df, ru.rollup(df), lambda d: d, start, end)
    full = view.scored_context(df, frame="range").where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    key = sorted(cut.columns)
    assert sorted(cut.select(key).collect()) == sorted(full.select(key).collect())
    assert cut.count() > 50


def test_rolling_latency_is_weighted_by_requests(spark):
    rows = [log(ms=100), log(ms=100), log(ms=400, ts=BASE + timedelta(minutes=1))]
    out = ctx.rolling_latency(logs(spark, rows), buckets=2).orderBy("window_start").collect()
    assert [r.rolling_latency for r in out] == [100.0, 200.0]


def test_seasonal_baseline(spark):
    df = series(spark, [10, 30], step=timedelta(days=1), errors={1: 4})
    rows = ctx.seasonal_baseline(df).orderBy("window_start").collect()
    assert [r.usual_reqs for r in rows] == [20.0, 20.0] and [r.vs_usual for r in rows] == [0.5, 1.5]
    assert rows[0].usual_error_rate == 0.1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_buckets_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on this day does not exist in New York.
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:37:41.123456' AS t")
        row = df.select(*[bucket_start("t", u).cast("string").alias(u) for u in ("millisecond", "minute", "hour", "day")],
                        epoch_seconds("t").alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[:] == ("2024-03-10 02:37:41.123", "2024-03-10 02:37:00", "2024-03-10 02:00:00", "2024-03-10 00:00:00",
                      1710038261)
