"""The validation report of a scored frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.evaluate import LABEL, SCORE, precision_recall_f1, suggest_threshold
from ..session import stored


def validation_report(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row over all rows: counts, score range, the same by label, threshold, confusion matrix, precision, recall, F1.

    The threshold is the 0.9 quantile unless set. Rows without a label are counted and take part in no rate.
    """
    # Scored once; the passes below read two narrow columns.
    rows = stored(scored.select(LABEL, SCORE))
    t = F.lit(threshold).cast("double") if threshold is not None else suggest_threshold(rows).scalar()
    rows = rows.withColumn("_t", t)
    s, flagged, quiet = F.col(SCORE), F.col(SCORE) >= F.col("_t"), F.col(SCORE) < F.col("_t")
    figures = [F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(LABEL).isNull()).alias("n_unlabelled"), F.count_if(s.isNull()).alias("null_scores"),
               F.min(s).alias("min_score"), F.max(s).alias("max_score"), F.avg(s).alias("avg_score")]
    for label in (0, 1):
        mine = F.when(F.col(LABEL) == label, s)
        figures += [F.count_if(F.col(LABEL) == label).alias(f"n_{label}"), F.min(mine).alias(f"min_score_{label}"),
                    F.max(mine).alias(f"max_score_{label}"), F.avg(mine).alias(f"avg_score_{label}")]
    bad, good = F.col(LABEL) == 1, F.col(LABEL) == 0
    figures += [F.max("_t").alias("threshold"), F.count_if(bad & flagged).alias("tp"),
                F.count_if(good & flagged).alias("fp"), F.count_if(bad & quiet).alias("fn"),
                F.count_if(good & quiet).alias("tn")]
    return precision_recall_f1(rows.agg(*figures))


def lines(report: DataFrame) -> list[str]:
    """The report as text."""
    r = report.first()
    if not r["total_rows"]:
        return ["No data to validate."]
    out = [f"rows {r['total_rows']}, without label {r['n_unlabelled']}, without score {r['null_scores']}",
           f"score min {r['min_score']:.4f}, max {r['max_score']:.4f}, mean {r['avg_score']:.4f}"]
    for label in (0, 1):
        if r[f"n_{label}"]:
            out.append(f"label {label}: {r[f'n_{label}']} rows, min {r[f'min_score_{label}']:.4f}, "
                       f"max {r[f'max_score_{label}']:.4f}, mean {r[f'avg_score_{label}']:.4f}")
    out.append(f"at {r['threshold']:.4f}: tp {r['tp']}, fp {r['fp']}, fn {r['fn']}, tn {r['tn']}, "
               f"precision {r['precision']:.2%}, recall {r['recall']:.2%}, F1 {r['f1']:.2%}")
    return out
