"""Numbering rows within groups when one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of one group that one task numbers, on average.
SLICE_ROWS = 50_000


def numbered(rows: DataFrame, group: str, name: str, salt: list[Column], order: list[Column], total: int) -> DataFrame:
    """``rows`` with a gapless number from 0 within each group.

    A group is dealt over slices by a hash of ``salt``; rows are numbered within their slice, which starts where the slices
    before end. Only counts per group and slice are put in order. ``order`` decides within a slice; among equal rows
    any order will do. ``rows`` must be cheap to read twice, and the same each time.
    """
    slices = max(1, -(-total // SLICE_ROWS))
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(*salt), F.lit(slices)))
    counts = dealt.groupBy(group, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.col("_slice").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order)) - 1)
    met = within.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_of")))
    return met.withColumn(name, (F.col("_start") + F.col("_place")).cast("long")).drop("_slice", "_of", "_group", "_start", "_place")
