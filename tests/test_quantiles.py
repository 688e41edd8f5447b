import random

import numpy as np
import pytest

from emberlog.operators.quantiles import exact_quantiles

PROBS = {"p50": 0.5, "p0": 0.0, "p10": 0.1, "p51": 0.51, "p90": 0.9, "p99": 0.99, "p100": 1.0}


def values(kind, n, rng):
    if kind == "ties":
        return [float(rng.choice([1, 1, 1, 2, 5])) for _ in range(n)]
    if kind == "skewed":
        return [rng.expovariate(1.0) ** 3 for _ in range(n)]
    return [rng.uniform(-5, 5) for _ in range(n)]


CASES = [(kind, 5000, 100, 3) for kind in ("ties", "skewed", "uniform")]
CASES += [("uniform", n, 100, 1) for n in (1, 2, 11)] + [("skewed", 5000, 50, 1), ("skewed", 1000, 10_000, 64)]


@pytest.mark.parametrize("kind,n,accuracy,sketches", CASES)
def test_global(spark, kind, n, accuracy, sketches):
    xs = values(kind, n, random.Random(n))
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "v double")
    # Sorted input makes the heaps as unlike each other as can be.
    df = df.repartitionByRange(8, "v")
    row = exact_quantiles(df, "v", PROBS, accuracy=accuracy, sketches=sketches).first().asDict()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(float(np.percentile(xs, 100 * p)), rel=1e-12, abs=1e-12), name


@pytest.mark.parametrize("accuracy,limit", [(50, 64 << 20), (10_000, 64 << 20), (50, 0)])
def test_by_group_with_one_big_group(spark, accuracy, limit, monkeypatch):
    for module in ("joins", "quantiles"):
        monkeypatch.setattr(f"emberlog.operators.{module}.BROADCAST_BYTES", limit)
    rng = random.Random(1)
    rows = [("big", x) for x in values("skewed", 4000, rng)] + [(f"g{i % 7}", float(i)) for i in range(200)]
    rows += [("one", 3.0)]
    out = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", PROBS, by=["g"], accuracy=accuracy, sketches=4)
    got = {r.g: r.asDict() for r in out.collect()}
    assert set(got) == {g for g, _ in rows}
    for g in got:
        xs = [v for k, v in rows if k == g]
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(float(np.percentile(xs, 100 * p)), rel=1e-12), (g, name)


def test_no_values_gives_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert [r.p for r in exact_quantiles(df, "v", {"p": 0.5}).collect()] == [None]


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert {r.g: r.p for r in exact_quantiles(df, "v", {"p": 0.5}, by=["g"]).collect()} == {None: 2.0, "a": 5.0}
