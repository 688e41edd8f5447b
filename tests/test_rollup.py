from datetime import date, timedelta

from pyspark.sql import functions as F

from emberlog.operators import rollup as ru
from tests.helpers import BASE, log, logs, series

# The hand-written case of the contract.
FIVE = [log(), log(), log(status=503), log(service="svc-b"), log(service="svc-b", status=500)]


def totals(df):
    return {r.service_id: (r.total_reqs, r.error_reqs) for r in df.collect()}


def test_five_rows(spark):
    want = {"svc-a": (3, 1), "svc-b": (2, 1)}
    df = logs(spark, FIVE)
    assert totals(ru.rollup(df)) == totals(ru.buckets(df)) == want
    keyed = ru.merge_partials(ru.rollup(df), ("service_id", "window_start", "hour_of_day"))
    assert totals(keyed) == want and {r.window_start for r in keyed.collect()} == {BASE}
    assert ru.control_totals(ru.rollup(df)).first()[:] == (2, 5, 2)


def test_499_is_no_error_and_500_is(spark):
    assert totals(ru.buckets(logs(spark, [log(status=499), log(status=500)]))) == {"svc-a": (2, 1)}


def test_batches_in_any_order_equal_one_batch(spark, tmp_path):
    root = str(tmp_path / "p")
    rows = [log(ts=BASE + timedelta(minutes=i % 4, days=i % 2), status=500 if i % 5 == 0 else 200, service=f"s{i % 3}")
            for i in range(60)]
    ru.backfill(logs(spark, rows[:10]), root)
    for n, part in enumerate([rows[40:], rows[10:20], rows[20:40]]):
        ru.write_partials(logs(spark, part), root, n)
    ru.write_partials(logs(spark, rows[10:20]), root, 1)  # a replay
    key = ["service_id", "window_start"]
    want = ru.buckets(logs(spark, rows)).orderBy(*key).collect()
    assert ru.merge_partials(ru.read_partials(spark, root)).orderBy(*key).collect() == want
    # Compaction of the first day, twice; a late batch counts on top; the day is then deleted.
    first, second = BASE.date(), BASE.date() + timedelta(days=1)
    assert ru.compact_partials(spark, root, second) == 4 and ru.compact_partials(spark, root, second) == 0
    assert ru.merge_partials(ru.read_partials(spark, root)).orderBy(*key).collect() == want
    assert ru.read_partials(spark, root).where(F.to_date("window_start") == F.lit(first)).select("batch_id").distinct().count() == 1
    ru.write_partials(logs(spark, rows[:3]), root, 9)
    assert ru.compact_partials(spark, root, second) == 2
    more = ru.buckets(logs(spark, rows + rows[:3])).orderBy(*key).collect()
    assert ru.merge_partials(ru.read_partials(spark, root)).orderBy(*key).collect() == more
    # A compaction that broke off before its manifest row counts for nothing.
    ru._write(ru.rollup(logs(spark, rows)), root, -77)
    assert ru.merge_partials(ru.read_partials(spark, root)).orderBy(*key).collect() == more
    assert ru.expire_partials(spark, root, second) == 1
    assert {r.window_start.date() for r in ru.read_partials(spark, root).collect()} == {second}
    late = ru.read_partials(spark, root, F.lit("2025-03-02 00:00:00").cast("timestamp_ntz"))
    assert {r.window_start.day for r in late.collect()} == {2}


def test_coarser_keeps_totals(spark):
    df = logs(spark, [log(ts=BASE + timedelta(minutes=7 * i)) for i in range(50)])
    hours = ru.coarser(ru.rollup(df), "hour")
    assert hours.orderBy("window_start").collect() == ru.buckets(df, "hour").orderBy("window_start").collect()


def test_retention_keeps_the_edge(spark):
    df = series(spark, [1] * 30, step=timedelta(days=1))
    as_of = F.lit(str(BASE + timedelta(days=29))).cast("timestamp_ntz")
    kept = [r.window_start for r in ru.retained(df, as_of).collect()]
    assert min(kept) == BASE + timedelta(days=15) and len(kept) == 15


def test_the_manifest_goes_with_its_days(spark, tmp_path):
    """Compactions of many batches, twice, then an expiry: only what is left of the store is left of the manifest."""
    root = str(tmp_path / "p")
    rows = [log(ts=BASE.replace(day=d)) for d in (1, 2, 3)]
    for n in range(6):
        ru.write_partials(logs(spark, rows), root, n)
    assert ru.compact_partials(spark, root, date(2025, 3, 3)) == 12 and ru.compact_partials(spark, root, date(2025, 3, 3)) == 0
    ru.write_partials(logs(spark, rows), root, 6)
    assert ru.compact_partials(spark, root, date(2025, 3, 4)) == 2 + 2 + 7
    assert {r.window_start.day: r.total_reqs for r in ru.merge_partials(ru.read_partials(spark, root)).collect()} == {1: 7, 2: 7, 3: 7}
    assert len(ru._manifest(spark, root)) == 12 + 4 + 7
    assert ru.expire_partials(spark, root, date(2025, 3, 3)) == 2
    assert {d.day for d, _, _ in ru._manifest(spark, root)} == {3} and len(ru._manifest(spark, root)) == 7
    assert ru.expire_partials(spark, root, date(2025, 3, 4)) == 1 and ru._manifest(spark, root) == []
    ru.write_partials(logs(spark, rows), root, 7)
    assert ru.merge_partials(ru.read_partials(spark, root)).count() == 3
