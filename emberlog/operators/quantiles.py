"""Exact quantiles without bringing all values of a group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql.types import IntegralType

from ..session import pinned
from .joins import BROADCAST_BYTES, attach, fits_broadcast

ACCURACY = 10_000
SKETCHES = 64
BINS = 1_000
FEW_VALUES = 1_000_000


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame | None:
    """Pinned counts (by, _v, _c) of a whole-number column, or None if it is none or has many distinct values."""
    if not isinstance(df.schema[value].dataType, IntegralType):
        return None
    seen = Observation()
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = pinned(counts.observe(seen, F.count(F.lit(1)).alias("n")))
    return counts if seen.get["n"] <= FEW_VALUES else None


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (),
                    accuracy: int = ACCURACY, sketches: int = SKETCHES) -> DataFrame:
    """Interpolated quantiles of the non-null values, one column per name in ``probs``, one row per group.

    1. Sketches give two values that are sure to lie around each wanted rank. They are merged in
       ``sketches`` separate heaps, so that no task meets the sketches of all tasks.
    2. Values outside these brackets are only counted. Distinct values inside, at most 10/accuracy of the
       rows of a big group, are counted by value.
    3. The counts are added up in BINS slices per bracket, and only the slices that hold a wanted rank are sorted.

    The answer is that of a full sort; a null group is a group like any other. Whole numbers with few distinct
    values are counted by value, which needs no brackets.
    """
    ps = sorted(probs.values())
    if (counts := value_counts(df, value, by)) is not None:
        found = [F.percentile("_v", F.lit(p), F.col("_c")).cast("double").alias(name) for name, p in probs.items()]
        return counts.groupBy(*by).agg(*found)
    group = F.struct(*by).alias("_g") if by else F.lit(0).alias("_g")
    rows = df.where(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_v"))
    edges = _edges(rows, ps, accuracy, sketches)
    if by:
        edges = pinned(edges)
        # A group has at most two slices per quantile, so what holds for the edges holds for the slices.
        few = fits_broadcast(edges, BROADCAST_BYTES // (2 * len(ps)))
        rows = rows.join(F.broadcast(edges.drop("_w")), "_g") if few else attach(rows, edges, ["_g"], weight="_w")
    else:
        few = True
        found = edges.first()
        if found is None:
            return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(name) for name in probs])
        rows = rows.withColumns({c: F.lit(found[c]) for c in edges.columns if c not in ("_g", "_w")})

    # Used twice below; both uses share one shuffle.
    counted = _counted(rows, len(ps))
    before = Window.partitionBy("_g").orderBy("_pos", "_bin").rowsBetween(Window.unboundedPreceding, -1)
    slices = (counted.groupBy("_g", "_n", "_pos", "_bin").agg(F.sum("_c").alias("_total"), F.count(F.lit(1)).alias("_w"))
                     .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))))
    ranks = [r for p in ps for r in (F.floor((F.col("_n") - 1) * F.lit(p)), F.ceil((F.col("_n") - 1) * F.lit(p)))]
    wanted = reduce(lambda a, b: a | b, [(F.col("_before") <= r) & (F.col("_before") + F.col("_total") > r) for r in ranks])
    chosen = slices.where(wanted).select("_g", "_pos", "_bin", "_before", "_w")

    keys = ["_g", "_pos", "_bin"]
    if few:
        near = counted.join(F.broadcast(chosen.drop("_w")), keys)
    else:
        near = attach(counted, chosen, keys, weight="_w").where(F.col("_before").isNotNull())
    w = Window.partitionBy("_g", "_pos", "_bin").orderBy("_val").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = near.withColumn("_upto", F.col("_before") + F.sum("_c").over(w))
    here = [F.max(F.when((F.col("_upto") > r) & (F.col("_upto") - F.col("_c") <= r), F.col("_val"))).alias(f"_r{i}")
            for i, r in enumerate(ranks)]
    found = upto.groupBy("_g").agg(F.max("_n").alias("_n"), *here)

    out = []
    for name, p in probs.items():
        i = ps.index(p)
        rank = (F.col("_n") - 1) * F.lit(p)
        low, high = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
        q = low + (high - low) * (rank - F.floor(rank))
        out.append(F.when(q.isNull(), F.raise_error(F.lit("quantile outside its bracket")))
                    .otherwise(q).cast("double").alias(name))
    return found.select(*[F.col("_g")[c].alias(c) for c in by], *out)


def _edges(rows: DataFrame, ps: list[float], accuracy: int, sketches: int) -> DataFrame:
    """Per group: the count and, for each p, a value not above and one not below the wanted ranks.

    A value below the low edge of every heap has less than its share of the rows under it in each, hence in
    all. A sketch is off by n/accuracy ranks at most, and by one more for rounding.
    """
    margin = 4.0 / accuracy
    grid = [e for p in ps for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    heaps = rows.groupBy("_g", F.pmod(F.spark_partition_id(), F.lit(sketches)).alias("_heap")).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", grid, accuracy).alias("_q"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    merged = heaps.groupBy("_g").agg(
        F.sum("_n").alias("_n"), F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        *[(F.max if i % 2 else F.min)(F.col("_q")[i]).alias(f"_q{i}") for i in range(len(grid))])
    # Small groups are counted by value as a whole; so are ranks close to an end of the data.
    small = F.col("_n") <= accuracy * sketches
    sides = []
    for i, e in enumerate(grid):
        end = F.col("_max" if i % 2 else "_min")
        sides.append(F.when(small | F.lit(e in (0.0, 1.0)), end).otherwise(F.col(f"_q{i}")).alias(f"_e{i}"))
    return merged.select("_g", "_n", *sides, F.col("_n").alias("_w"))


def _counted(rows: DataFrame, n_probs: int) -> DataFrame:
    """Counts by (group, _pos, _bin, value), where a value outside all brackets is null.

    ``_pos`` is the number of edges passed and ``_bin`` the slice of the bracket entered last. Both only
    grow with the value, so ordering by them is ordering by value.
    """
    v = F.col("_v")
    lows, highs = [F.col(f"_e{2 * i}") for i in range(n_probs)], [F.col(f"_e{2 * i + 1}") for i in range(n_probs)]
    passed = rows.withColumns({
        "_entered": reduce(add, [F.when(v >= low, 1).otherwise(0) for low in lows]),
        "_left": reduce(add, [F.when(v > high, 1).otherwise(0) for high in highs])})
    inside = F.col("_entered") > F.col("_left")

    def entered_last(edges: list[Column]) -> Column:
        return F.coalesce(*[F.when(F.col("_entered") == i + 1, e) for i, e in enumerate(edges)])

    low, high = entered_last(lows), entered_last(highs)
    at = (v - low) / F.nullif(high - low, F.lit(0.0)) * BINS
    return (passed.select("_g", "_n", (F.col("_entered") + F.col("_left")).alias("_pos"),
                          F.when(inside, F.coalesce(F.floor(at), F.lit(0))).otherwise(-1).alias("_bin"),
                          F.when(inside, v).alias("_val"))
                  .groupBy("_g", "_n", "_pos", "_bin", "_val").agg(F.count(F.lit(1)).alias("_c")))
