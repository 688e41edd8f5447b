"""Codes from earlier rows against plain Python."""

import random
from datetime import timedelta

import pytest

from emberlog.operators import joins, ordered
from tests.helpers import BASE


@pytest.mark.parametrize("broadcast", [None, 0])
@pytest.mark.parametrize("bucket", ["minute", "hour"])
def test_codes_come_from_earlier_rows_only(spark, bucket, broadcast, monkeypatch):
    if broadcast is not None:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
        monkeypatch.setattr(joins, "HOT_KEYS", 20)
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot", "hot", "b", None]), rng.choice("xyz"), rng.choice([0, 1, 1, None]),
             rng.choice([BASE + timedelta(seconds=rng.randrange(7200))] * 40 + [None])) for i in range(600)]
    rows += [(600 + i, "hot", "x", 1, BASE) for i in range(5)]  # ties
    df = spark.createDataFrame(rows, "event_id bigint, a string, b string, label int, timestamp timestamp_ntz")
    got = {r.event_id: r for r in ordered.ordered_codes(df, ["a", "b"], "label", 0.25, 4.0, bucket=bucket).collect()}
    assert len(got) == len(rows)
    for i, a, b, _, at in rows:
        for column, place, value in (("code_a", 1, a), ("code_b", 2, b)):
            seen = [r[3] for r in rows if at is not None and r[4] is not None and r[4] < at and r[place] == value and r[3] is not None]
            assert got[i][column] == pytest.approx((sum(seen) + 1.0) / (len(seen) + 4.0), abs=1e-12)


def test_empty_and_first(spark):
    df = spark.createDataFrame([(1, "a", 1, BASE)], "event_id bigint, a string, label int, timestamp timestamp_ntz")
    assert [r.code_a for r in ordered.ordered_codes(df, ["a"], "label", 0.3).collect()] == pytest.approx([0.3])
    assert ordered.ordered_codes(df.limit(0), ["a"], "label", 0.3).collect() == []
