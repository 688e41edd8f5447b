import random

import pytest
from pyspark.sql import functions as F

from emberlog.operators import joins
from emberlog.operators.joins import attach, attach_range


@pytest.fixture
def frames(spark):
    """One key holds a third of the left rows, some keys are null, some are unknown."""
    rng = random.Random(3)
    left = [(i, "hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{rng.randrange(40)}") for i in range(900)]
    right = [("hot", 1, "x")] + [(f"k{i}", 10 + i, f"v{i}") for i in range(30)]
    return left, right


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("hot_keys", [50_000, 4])
def test_attach_keeps_every_left_row_once(spark, frames, limit, weighted, hot_keys, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", hot_keys)
    left, right = frames
    ldf = spark.createDataFrame(left, "id int, k string")
    rdf = spark.createDataFrame(right, "k string, a int, b string")
    if weighted:
        counts = ldf.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
        rdf = rdf.join(counts, "k", "left")
    out = attach(ldf, rdf, ["k"], weight="w" if weighted else None, limit=limit)
    assert out.columns == ["id", "k", "a", "b"]
    known = {k: (a, b) for k, a, b in right}
    assert sorted(map(tuple, out.collect())) == [(i, k, *known.get(k, (None, None))) for i, k in sorted(left)]


def test_attach_forced_to_shuffle_does_not_broadcast_the_big_side(spark, frames):
    left, right = frames
    ldf = spark.createDataFrame(left, "id int, k string")
    rdf = spark.createDataFrame(right, "k string, a int, b string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = attach(ldf, rdf, ["k"], limit=0)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1


@pytest.mark.parametrize("limit,salt_rows", [(None, 1_000_000), (0, 1_000_000), (0, 250), (0, 7)])
def test_attach_range_against_brute_force(spark, limit, salt_rows, monkeypatch):
    monkeypatch.setattr(joins, "SALT_ROWS", salt_rows)
    rng = random.Random(5)
    left = [(i, "a" if i % 3 else "b", rng.randrange(1000)) for i in range(600)]
    spans = [("a", 10, 50), ("a", 50, 60), ("a", 700, 900), ("b", 0, 1), ("c", 0, 1000)]
    out = attach_range(spark.createDataFrame(left, "id int, k string, t int"),
                       spark.createDataFrame(spans, "k string, s int, e int"), ["k"], "t", "s", "e", limit)
    want = [(i, k, t, int(any(k == kk and s <= t < e for kk, s, e in spans))) for i, k, t in left]
    assert sorted(map(tuple, out.collect())) == want


def test_copies_of_one_row_are_spread_and_kept(spark):
    left = spark.createDataFrame([("hot", 1)] * 400 + [(None, 1)] * 400, "k string, x int").repartition(8)
    left = left.withColumn("extras", F.create_map(F.lit("a"), F.lit(1)))
    out = attach(left, spark.createDataFrame([("hot", 7)], "k string, a int"), ["k"], limit=0)
    assert {(r.k, r.a): r.n for r in out.groupBy("k", "a").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        ("hot", 7): 400, (None, None): 400}
    assert left.select(joins._scatter(left).alias("s")).distinct().count() > 2
