"""Row frames over series that may be too long for one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..session import pinned
from .joins import attach

CHUNK_ROWS = 1_000_000


def over_series(df: DataFrame, by: Sequence[str], order: str, halo: int,
                compute: Callable[[DataFrame, WindowSpec], DataFrame], chunk_rows: int | None = None) -> DataFrame:
    """``compute`` applied to the series of each key, in the order of a timestamp that is unique in it.

    A row may depend on itself and the ``halo`` rows before it. The rows are computed once and counted; up to
    CHUNK_ROWS of them a plain window does. Beyond that, series are cut into chunks computed apart, each
    with the ``halo`` rows before it for company. The result is the same. ``chunk_rows`` sets the length of
    chunks without a count; 0 says that the series are known to be short.
    """
    if chunk_rows is None:
        seen = Observation()
        df = pinned(df.observe(seen, F.count(F.lit(1)).alias("n")))
        chunk_rows = CHUNK_ROWS if seen.get["n"] > CHUNK_ROWS else 0
    if not chunk_rows:
        return compute(df, Window.partitionBy(*by).orderBy(order))
    if chunk_rows < halo:
        raise ValueError(f"a chunk must hold {halo} rows at least")

    # The number of a row in its series: rows of the days before, and its place in its own day. So no
    # task sees more than one day, or the list of days, of a series.
    days = df.withColumn("_day", F.col(order).cast("date"))
    before = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (days.groupBy(*by, "_day").agg(F.count(F.lit(1)).alias("_count"))
                   .withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0))))
    place = F.row_number().over(Window.partitionBy(*by, "_day").orderBy(order)) - 1
    numbered = attach(days, offsets, [*by, "_day"], weight="_count").withColumn("_row", F.col("_before") + place)

    own = F.floor(F.col("_row") / chunk_rows)
    tail = F.col("_row") % chunk_rows >= chunk_rows - halo
    copies = numbered.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))))
    done = compute(copies, Window.partitionBy(*by, "_chunk").orderBy(order))
    return done.where(F.col("_chunk") == F.col("_own")).drop("_day", "_before", "_row", "_own", "_chunk")


def running_sums(df: DataFrame, w: WindowSpec, **values) -> DataFrame:
    """Adds the sum of each value from the start of the series, and ``_i``, the number of the row from 1.

    A sum over the last n rows is the difference of two of these, at a cost that does not grow with n.
    """
    start = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {name: F.sum(value).over(start) for name, value in values.items()}
    return df.withColumns({"_i": F.row_number().over(w), **sums})


def highest_so_far(df: DataFrame, by: Sequence[str], order: str, value: str, target: str) -> DataFrame:
    """Adds the highest ``value`` of each series up to and including the row; nulls count for nothing.

    ``order`` is a timestamp. Days are answered apart, each with the highest value of the days before it, so no task sees more
    than one day, or the list of days, of a series.
    """
    days = pinned(df.withColumn("_day", F.col(order).cast("date")))
    before = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    tops = days.groupBy(*by, "_day").agg(F.max(value).alias("_top"), F.count(F.lit(1)).alias("_count"))
    carried = tops.select(*by, "_day", "_count", F.max("_top").over(before).alias("_carried"))
    own = F.max(value).over(Window.partitionBy(*by, "_day").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = attach(days, carried, [*by, "_day"], weight="_count")
    return met.withColumn(target, F.greatest("_carried", own)).drop("_day", "_carried")
