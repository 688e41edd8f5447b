"""Episodes against a walk over the sorted alerts."""

import random
from datetime import timedelta

import pytest

from emberlog.operators import episodes, joins, windows
from emberlog.session import pinned
from tests.helpers import BASE

SCHEMA = "event_id bigint, service_id string, timestamp timestamp_ntz, anomaly_score double"


def walked(rows, threshold, gap, cooldown, k):
    out = []
    for service in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == service and r[2] is not None and r[3] is not None and r[3] > threshold), key=lambda r: r[2])
        groups = []
        for r in own:
            if groups and r[2] - groups[-1][-1][2] <= timedelta(seconds=gap):
                groups[-1].append(r)
            else:
                groups.append([r])
        ended = None
        for g in groups:
            best = [r[0] for r in sorted(g, key=lambda r: (-r[3], r[0]))[:k]]
            told = int(ended is None or g[0][2] - ended > timedelta(seconds=cooldown))
            out.append((service or "", g[0][2], g[-1][2], len(g), max(r[3] for r in g), best, told))
            ended = g[-1][2]
    return sorted(out)


def found(df):
    return sorted((r.service_id or "", r.episode_start, r.episode_end, r.n_alerts, r.peak_score, r.examples, r.is_notified) for r in df.collect())


def scattered(n, seed):
    """Alerts in clumps over some days, with ties, gaps of exactly the limit, a hot service, and rows without time, score or service."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        service = rng.choice(["hot", "hot", "hot", "b", "c", None])
        at = BASE + timedelta(hours=rng.randrange(40), seconds=rng.choice([0, 60, 600, 600, 1200, rng.randrange(3600)]))
        rows.append((i, service, rng.choice([at] * 30 + [None]), rng.choice([0.5, 1.0, 2.0, 2.0, rng.random() * 3, None])))
    return rows


@pytest.mark.parametrize("limits", [{}, {"chunk_rows": 40, "broadcast": 0}])
def test_episodes_equal_a_walk(spark, limits, monkeypatch):
    limits = dict(limits)
    if "broadcast" in limits:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limits.pop("broadcast"))
        monkeypatch.setattr(joins, "HOT_KEYS", 20)
    rows = scattered(900, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    want = walked(rows, 1.0, 600, 3600, 2)
    assert found(episodes.alert_episodes(df, 1.0, 600, 3600, 2, **limits)) == want
    assert len(want) > 50 and {w[-1] for w in want} == {0, 1} and any(w[3] > 5 for w in want)


def test_edges(spark):
    rows = [(1, "a", BASE, 2.0), (2, "a", BASE + timedelta(seconds=60), 2.0), (3, "a", BASE + timedelta(seconds=121), 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [w[3] for w in found(episodes.alert_episodes(df, 1.0, 60, 61))] == [2, 1]
    assert [w[-1] for w in found(episodes.alert_episodes(df, 1.0, 60, 60))] == [1, 1]
    assert found(episodes.alert_episodes(df, 9.0)) == [] and found(episodes.alert_episodes(df.limit(0), 1.0)) == []
    with pytest.raises(ValueError):
        episodes.alert_episodes(df, 1.0, gap=59)


def test_highest_so_far_carries_over_days(spark):
    rng = random.Random(3)
    rows = [(s, BASE + timedelta(hours=5 * i), rng.choice([None, rng.randrange(100 + i)])) for s in ("a", None) for i in range(60)]
    got = windows.highest_so_far(spark.createDataFrame(rows, "s string, t timestamp_ntz, v bigint"), ["s"], "t", "v", "top")
    for r in got.collect():
        seen = [v for s, t, v in rows if s == r.s and t <= r.t and v is not None]
        assert r.top == (max(seen) if seen else None)
    assert pinned(got).count() == len(rows)
