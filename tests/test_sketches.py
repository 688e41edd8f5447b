import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.operators import rollup, sketches
from tests.helpers import BASE, log, logs

PROBS = {"p50": 0.5, "p95": 0.95}


def many(spark, n=20_000):
    rng = random.Random(1)
    rows = [log(ts=BASE + timedelta(seconds=rng.randrange(7200)), service=rng.choice("ab"), ms=int(rng.expovariate(0.01)) + 1,
                signature=f"[A]:[{rng.randrange(400)}]:[OK]", status=rng.choice((200, 200, 500))) for _ in range(n)]
    return logs(spark, rows)


def test_merged_batches_answer_within_the_stated_error(spark):
    df = many(spark)
    parts = [sketches.sketch_rollup(df.where(F.col("response_time_ms") % 7 == i)) for i in range(7)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    merged = sketches.merge_sketches(sketches.coarser_sketches(sketches.merge_sketches(whole), "hour"), ["service_id"])
    got = sketches.sketch_quantiles(merged, PROBS).cache()
    off = sketches.rank_errors(df, got, "response_time_ms", PROBS, "service_id").collect()
    assert len(off) == 2 and all(r[p] <= sketches.RANK_ERROR for r in off for p in PROBS)
    assert all(abs(r.n_categories - 400) <= 400 * sketches.DISTINCT_ERROR for r in got.collect())
    totals = rollup.buckets(df).groupBy("service_id").agg(F.sum("total_reqs"), F.sum("error_reqs"))
    assert sorted(map(tuple, totals.collect())) == sorted((r.service_id, r.total_reqs, r.error_reqs) for r in got.collect())


def test_rank_errors_are_exact(spark):
    df = logs(spark, [log(ms=m) for m in (1, 2, 3, 4, 5, 5, 5, 5, 9, 10)])
    answers = spark.createDataFrame([("svc-a", 5, 3)], "service_id string, p50 long, p95 long")
    row = sketches.rank_errors(df, answers, "response_time_ms", PROBS, "service_id").first()
    assert (row.n, row.p50) == (10, 0.0) and row.p95 == pytest.approx(0.65)


def test_buckets_without_values_have_no_percentile(spark):
    df = logs(spark, [log()]).withColumn("response_time_ms", F.lit(None).cast("bigint"))
    row = sketches.sketch_quantiles(sketches.sketch_rollup(df), PROBS).first()
    assert (row.total_reqs, row.p50, row.n_categories) == (1, None, 1)
    assert sketches.merge_sketches(sketches.sketch_rollup(df.limit(0))).collect() == []
