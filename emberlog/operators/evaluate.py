"""Reports on scores, with and without labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .quantiles import exact_quantiles

SCORE, LABEL = "anomaly_score", "is_anomaly"


def score_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, min, max and mean of the score, and how many scores are missing."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(SCORE).alias("min_score"), F.max(SCORE).alias("max_score"),
        F.avg(SCORE).alias("avg_score"), F.count_if(F.col(SCORE).isNull()).alias("null_scores"))


def score_center(df: DataFrame) -> DataFrame:
    """Mean and median score by label."""
    means = df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), F.avg(SCORE).alias("avg_score"))
    return means.join(exact_quantiles(df, SCORE, {"median_score": 0.5}, by=[LABEL]), LABEL)


def score_histogram(df: DataFrame, width: float) -> DataFrame:
    """Counts of scores in bins of a given width."""
    low = F.floor(F.col(SCORE) / width) * F.lit(width)
    return df.where(F.col(SCORE).isNotNull()).groupBy(low.alias("bin_start")).agg(F.count(F.lit(1)).alias("n"))


def suggest_threshold(df: DataFrame, q: float = 0.9) -> DataFrame:
    """One row: the score that a share ``q`` of the rows stays below."""
    return exact_quantiles(df, SCORE, {"threshold": q})


def service_percentiles(df: DataFrame) -> DataFrame:
    return exact_quantiles(df, SCORE, {"p90": 0.90, "p95": 0.95}, by=["service_id"])


def confusion(df: DataFrame, threshold: Column | float) -> DataFrame:
    """tp, fp, fn and tn; a score equal to the threshold counts as positive."""
    t = F.lit(threshold)
    flagged, quiet = F.col(SCORE) >= t, F.col(SCORE) < t
    bad, good = F.col(LABEL) == 1, F.col(LABEL) == 0
    return df.agg(F.count_if(bad & flagged).alias("tp"), F.count_if(good & flagged).alias("fp"),
                  F.count_if(bad & quiet).alias("fn"), F.count_if(good & quiet).alias("tn"))


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def precision_recall_f1(cm: DataFrame) -> DataFrame:
    """Adds precision, recall and F1 to a confusion frame; each is 0 when nothing stands below the line."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cm.withColumns({"precision": _share(tp, tp + fp), "recall": _share(tp, tp + fn),
                           "f1": _share(2 * tp, 2 * tp + fp + fn)})


def anomaly_ratio(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(LABEL) == 1).alias("n_anomalies"),
                               (F.count_if(F.col(LABEL) == 1) / F.count(F.lit(1))).alias("anomaly_ratio"))


def count_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: the two row counts and whether they agree."""
    rows = a.select(F.lit(0).alias("side")).unionAll(b.select(F.lit(1).alias("side")))
    counts = rows.agg(F.count_if(F.col("side") == 0).alias("left_rows"),
                      F.count_if(F.col("side") == 1).alias("right_rows"))
    return counts.withColumn("equal", F.col("left_rows") == F.col("right_rows"))


def max_score(df: DataFrame, start, end) -> DataFrame:
    """Highest score in ``[start, end)``."""
    inside = df.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    return inside.agg(F.count(F.lit(1)).alias("n"), F.max(SCORE).alias("max_score"))


def signatures(df: DataFrame) -> DataFrame:
    """Distinct signatures and how often each occurs."""
    return df.groupBy("log_signature").agg(F.count(F.lit(1)).alias("n"))
