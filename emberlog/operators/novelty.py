"""Scores without labels: outliers, rare and new signatures, unlikely messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.score import ratio, spread, z_score
from ..functions.text import tokens
from .joins import BROADCAST_BYTES, _bytes, attach, measured
from .quantiles import exact_quantiles, value_counts


def outlier_score(df: DataFrame, value: str = "response_time_ms", by: Sequence[str] = ("service_id",),
                  digits: int = 6, target: str = "anomaly_score") -> DataFrame:
    """Population z-score of a whole-number column within its group; 0 where a group has no spread."""
    wide = F.col(value).cast("decimal(18,0)")
    sums = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(wide).alias("_sum"), F.sum(wide * wide).alias("_squares"))
    # Wide arithmetic once per group; rows need doubles only.
    stats = sums.select(*by, "_n", "_sum", spread("_n", "_sum", "_squares").alias("_spread"), F.col("_n").alias("_w"))
    rows = attach(df, stats, by, weight="_w")
    z = z_score(value, "_n", "_sum", "_spread")
    score = F.when(F.col(value).isNotNull(), F.round(F.coalesce(z, F.lit(0.0)), digits))
    return rows.withColumn(target, score).drop("_n", "_sum", "_spread")


def robust_outlier_score(df: DataFrame, value: str = "response_time_ms", by: Sequence[str] = ("service_id",),
                         digits: int = 6, target: str = "anomaly_score") -> DataFrame:
    """Distance from the median of the group in units of its median absolute deviation; 0 without deviation.

    Whole numbers are counted by value once, and both medians come from the counts, as long as these are few.
    """
    if (counts := value_counts(df, value, by)) is not None:
        medians = counts.groupBy(*by).agg(F.percentile("_v", F.lit(0.5), F.col("_c")).alias("_median"), F.sum("_c").alias("_w"))
        off = attach(counts, medians, by, weight="_w").withColumn("_d", F.abs(F.col("_v") - F.col("_median")))
        stats = off.groupBy(*by).agg(F.max("_median").alias("_median"), F.percentile("_d", F.lit(0.5), F.col("_c")).alias("_mad"),
                                     F.sum("_c").alias("_w"))
        rows = attach(df, stats, by, weight="_w").withColumn("_off", F.col(value) - F.col("_median"))
    else:
        medians = exact_quantiles(df, value, {"_median": 0.5}, by)
        off = attach(df, medians, by).withColumn("_off", F.col(value) - F.col("_median"))
        spreads = exact_quantiles(off.withColumn("_off", F.abs("_off")), "_off", {"_mad": 0.5}, by)
        rows = attach(off, spreads, by)
    score = F.coalesce(ratio("_off", "_mad"), F.lit(0.0))
    return rows.withColumn(target, F.when(F.col(value).isNotNull(), F.round(score, digits))).drop(
        "_median", "_off", "_mad")


def new_signatures(now: DataFrame, history: DataFrame) -> DataFrame:
    """(service, signature) pairs seen now and never in the history, with their counts."""
    keys = ["service_id", "log_signature"]
    seen = now.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_seen"))
    return seen.join(history.select(*keys).distinct(), keys, "left_anti")


def signature_counts(df: DataFrame, category: str = "log_signature") -> DataFrame:
    """Count of each value within its service, with the count of the service and the rarity ``-ln(share)``."""
    counts = df.groupBy("service_id", category).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("service_id").agg(F.sum("n").alias("service_n"), F.count(F.lit(1)).alias("_pairs"))
    both = attach(counts, totals, ["service_id"], weight="_pairs")
    return both.withColumn("rarity", F.log(F.col("service_n") / F.col("n")))


def rarity(df: DataFrame, category: str = "log_signature", target: str = "rarity") -> DataFrame:
    """Rows with the rarity of their value within their service."""
    counts = signature_counts(df, category).select("service_id", category, F.col("rarity").alias(target), "n")
    return attach(df, counts, ["service_id", category], weight="n")


def payload_score(df: DataFrame, key: str, text: str) -> DataFrame:
    """One number per message: mean ``-ln p`` of its words, p being a word's share of the corpus.

    The words of the corpus are counted with a combine on the map side. If the counts fit a broadcast, each
    message is scored where it is read. Otherwise the most frequent words that fit one are scored there and leave one row
    per message; only the other words are shuffled, counted per message. A message without words, null or blank, has no
    tokens and no score, but keeps its row.
    """
    words = df.select(key, F.explode_outer(tokens(text)).alias("token"))
    corpus, size = measured(words.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("corpus_n")))
    total = corpus.agg(F.sum("corpus_n").alias("t")).first()["t"] or 0
    surprise = corpus.select("token", F.log(F.lit(total) / F.col("corpus_n")).alias("surprise"), "corpus_n")
    if size <= BROADCAST_BYTES:
        words = words.withColumn("n", F.when(F.col("token").isNotNull(), 1).otherwise(0).cast("bigint"))
        rows = attach(words, surprise, ["token"], weight="corpus_n", size=size).withColumn("_sum", F.col("n") * F.col("surprise"))
    else:
        bits, common_size = _common(corpus)
        common = F.length(F.bin("corpus_n")) > bits
        met = words.join(F.broadcast(surprise.where(common).drop("corpus_n")), "token", "left")
        left_over = F.when(F.col("surprise").isNull(), F.col("token"))
        words = met.groupBy(key, left_over.alias("_rare")).agg(F.count("token").alias("n"), F.sum("surprise").alias("_met"))
        rare = surprise.where(~common).withColumnRenamed("token", "_rare")
        rows = attach(words, rare, ["_rare"], weight="corpus_n", size=size - common_size)
        rows = rows.withColumn("_sum", F.coalesce("_met", F.col("n") * F.col("surprise")))
    return rows.groupBy(key).agg(
        F.sum("n").alias("n_tokens"),
        (F.sum("_sum") / F.nullif(F.sum("n"), F.lit(0))).alias("payload_anomaly_score"))


def _common(corpus: DataFrame) -> tuple[int, int]:
    """Words whose count has more bits than the first number fit a broadcast together; the second is their size."""
    sizes = corpus.groupBy(F.length(F.bin("corpus_n")).alias("bits")).agg(_bytes(corpus).alias("b")).collect()
    bits, taken = 64, 0
    for row in sorted(sizes, reverse=True):
        if taken + row.b > BROADCAST_BYTES:
            break
        bits, taken = row.bits - 1, taken + row.b
    return bits, taken
