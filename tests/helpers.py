"""Small log frames and plain-Python answers."""

from __future__ import annotations

from datetime import datetime, timedelta
from math import sqrt

from emberlog.sources.contract import ROLLUP_SCHEMA, V2_SCHEMA

BASE = datetime(2025, 3, 1, 12, 34)


def log(ts=BASE, service="svc-a", status=200, ms=100, endpoint="/api/x", agent="ua", signature="[A]:[B]:[OK]",
        payload="rid=1 msg=ok", label=0):
    return (ts, service, endpoint, status, ms, agent, ts.hour, int(ts.weekday() >= 5), 1.0, 0.0, 0, signature, payload,
            label)


def logs(spark, rows):
    return spark.createDataFrame(rows, V2_SCHEMA)


def series(spark, counts, service="svc-a", step=timedelta(minutes=1), errors=None, skip=()):
    """Merged buckets: one per count, without those at the positions in ``skip``."""
    rows = [(service, BASE + i * step, (BASE + i * step).hour, n, (errors or {}).get(i, 0))
            for i, n in enumerate(counts) if i not in skip]
    return spark.createDataFrame(rows, ROLLUP_SCHEMA)


def brute_context(rows, minutes=False):
    """{(service, start): (velocity, acceleration, surge)} from (service, start, hour, total, errors) rows.

    With ``minutes`` frames are measured in time, otherwise in rows.
    """
    out = {}
    for service in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == service)
        for i, (start, _, total, errors) in enumerate(own):
            def frame(n):
                if minutes:
                    return [o for o in own[:i + 1] if o[0] > start - timedelta(minutes=n)]
                return own[max(0, i + 1 - n):i + 1]

            ten = [o[2] for o in frame(10)]
            velocity = total / (sum(ten) / len(ten))
            if minutes:
                then = [o for o in own if o[0] == start - timedelta(minutes=10)]
            else:
                then = own[i - 10:i - 9] if i >= 10 else []
            rate = then[0][3] / then[0][2] if then else 0
            acceleration = (errors / total) / rate if rate else 0.0
            xs = [o[2] for o in frame(61)]
            mean = sum(xs) / len(xs)
            # Spread through whole numbers: rounding must not turn a z of exactly 3 into a surge.
            spread = len(xs) * sum(x * x for x in xs) - sum(xs) ** 2
            surge = int(spread > 0 and len(xs) * (total - mean) / sqrt(spread) > 3 + 1e-12)
            out[service, start] = (velocity, acceleration, surge)
    return out
