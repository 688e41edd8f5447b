"""Codes of categories that a row could have had when it came: from the rows before it, never from itself or later ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.clock import bucket_start
from .joins import attach


def ordered_codes(df: DataFrame, categorical: Sequence[str], target: str, prior: float, smooth: float = 10.0,
                  order: str = "timestamp", bucket: str = "minute") -> DataFrame:
    """Rows with ``code_<c>`` for each category column: the smoothed mean label of the rows with its value at earlier times.

    A value seen n times before counts its own mean n times and ``prior`` ``smooth`` times, so the first row of a value gets the prior.
    Rows of one moment do not see each other, so the codes do not depend on how ties are broken. Rows without a label are not
    counted and still get a code; null is a value like others. A row without a time sees nothing and is not seen: it gets the prior.

    Labels are summed by (value, bucket) first, and what came before a bucket is carried along the buckets of its value. Within a
    bucket rows are ordered, so one task holds a value's rows of one bucket, however many rows the value has.
    """
    untimed = df.where(F.col(order).isNull()).withColumns({f"code_{c}": F.lit(float(prior)) for c in categorical})
    label = F.col(target).cast("double")
    rows = df.where(F.col(order).isNotNull()).withColumns({
        "_bucket": bucket_start(order, bucket), "_one": F.coalesce(label, F.lit(0.0)), "_known": label.isNotNull().cast("bigint")})
    for c in categorical:
        place = [c, "_bucket"]
        sums = rows.groupBy(*place).agg(F.sum("_known").alias("_n"), F.sum("_one").alias("_ones"), F.count(F.lit(1)).alias("_rows"))
        before = Window.partitionBy(c).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = sums.select(*place, "_rows", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_carried") for s in ("_n", "_ones")])
        met = attach(rows, carried, place, weight="_rows")
        so_far, moment = Window.partitionBy(*place).orderBy(order), Window.partitionBy(*place, order)
        n, ones = [F.col(f"{total}_carried") + F.sum(x).over(so_far) - F.sum(x).over(moment) for x, total in (("_known", "_n"), ("_one", "_ones"))]
        rows = met.withColumn(f"code_{c}", (ones + F.lit(smooth * prior)) / (n + F.lit(smooth))).drop("_n_carried", "_ones_carried")
    return rows.drop("_bucket", "_one", "_known").unionByName(untimed)
