"""Time the headline queries and print one JSON line.

Every query is written in full to a sink that keeps nothing. Times are single runs in one session after a
warm-up, so they include the jobs a query runs while it is put together.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

from emberlog.functions.clock import in_range
from emberlog.operators import context, evaluate, rollup, whatif
from emberlog.plans import model, trees, view
from emberlog.plans.queries import QUERIES, trained
from emberlog.session import build_session, pinned
from emberlog.sources import events

HEADLINE = (
    "envelope_v2", "json_adapter", "text_adapter", "rollup_minute", "rollup_partial_merge", "retention_14d",
    "context_rows", "context_rows_minute", "context_chunked", "context_range", "scored_context", "scored_context_minute",
    "scored_between", "rolling_latency", "seasonal_baseline", "score_by_label", "threshold_p90", "validation_report", "top_scores",
    "top_n_per_hour", "service_percentiles", "service_thresholds", "p99_latency_rule", "incident_labels", "tag_labels",
    "signature_rarity", "mask_tokens", "text_features", "payload_score", "outlier_zscore", "sliding_alerts",
    "zscore_alerts", "alert_examples", "sketch_percentiles", "isolation_score", "burst_whatif", "stream_rollup", "stream_scored", "live_view", "adapter_rejects",
)


def quality(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Time of the contract's training, F1 on the rows held out, scoring time for 100 rows, velocity and score in a harmless burst."""
    logs = events.logs(spark, sf_dir)
    rolled = pinned(rollup.buckets(logs))
    full = pinned(view.training_events(logs, rolled, keep=("event_id",)))
    _, test = model.split(full, ["event_id"])
    start = time.perf_counter()
    fitted = trained(spark, sf_dir)
    training = time.perf_counter() - start
    f1 = evaluate.precision_recall_f1(evaluate.confusion(model.score(test, fitted), 0.0)).first()["f1"]

    batch = pinned(full.limit(100))
    scored = trees.BatchScorer(fitted).score(batch)
    scored.collect()
    start = time.perf_counter()
    for _ in range(10):
        scored.collect()
    per_batch = (time.perf_counter() - start) * 100

    edges = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-20 12:00:00", "2024-01-20 13:00:00")]
    burst = whatif.amplify(logs, *edges)
    hours = context.context(rollup.buckets(burst, "hour")).where(in_range("window_start", *edges))
    velocity = hours.agg(F.max("throughput_velocity").alias("v")).first()["v"]
    peak = view.score_v2(burst, rollup.buckets(burst), fitted).where(in_range("timestamp", *edges)).agg(F.max("anomaly_score")).first()
    return {"training_sec": round(training, 1), "rounds": fitted.rounds, "f1_holdout": round(f1, 4), "score_100_rows_ms": round(per_batch, 1),
            "burst_max_score": round(peak[0], 4), "burst_velocity": round(velocity, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("emberlog-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="emberlog-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("envelope_v2", "scored_context"):
        run(name)
    times = {name: run(name) for name in HEADLINE}
    model_figures = quality(spark, sf_dir)
    times["gbt_scores_v2"] = run("gbt_scores_v2")  # the model is there already; its training has a figure of its own
    logs = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": logs, "flagship_rows_per_sec": round(logs / times["scored_context"]), **model_figures,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
