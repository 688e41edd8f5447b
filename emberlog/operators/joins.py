"""Left joins of log rows to a smaller frame that may be too big to broadcast and keys that may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import MapType, StringType, StructType

from ..session import pinned

BROADCAST_BYTES = 64 << 20
# At most this many keys can each hold more than 1/HOT_KEYS of the rows, so their rows always fit a broadcast.
HOT_KEYS = 50_000
# In a range join beyond broadcast, a key with more left rows than this is split, into parts of about so many.
SALT_ROWS = 1_000_000


def _bytes(df: DataFrame) -> Column:
    """Upper estimate of the broadcast size of a frame, from its own rows."""
    strings = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    strings += [F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, StructType)]
    width = 32 + 16 * len(df.columns)
    text = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in strings]
    return reduce(lambda a, b: a + b, text, F.count(F.lit(1)) * width)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a pinned frame is small enough; reads its rows once, on the executors."""
    return df.agg(_bytes(df).alias("b")).first()["b"] <= (BROADCAST_BYTES if limit is None else limit)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` pinned, and the upper estimate of its broadcast size, taken in the same pass."""
    seen = Observation()
    out = pinned(df.observe(seen, _bytes(df).alias("b")))
    return out, seen.get["b"]


def _scatter(df: DataFrame) -> Column:
    """A hash that spreads rows, also copies of one row, as these lie in many partitions.

    It depends on nothing that changes when a lost task runs again.
    """
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.xxhash64(*columns, F.spark_partition_id())


def attach(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str | None = None,
           limit: int | None = None, size: int | None = None) -> DataFrame:
    """``left`` with the columns of ``right``, whose keys are unique; every left row stays once.

    A null key is a key like any other. ``right`` is computed once and measured, unless ``size`` says that it is
    pinned already and how large it is. If it fits, it is broadcast and ``left`` is not shuffled.
    Otherwise both sides are shuffled on the keys, except for hot keys: the few rows of ``right`` whose
    key holds more than 1/HOT_KEYS of ``left`` are broadcast, and the left rows they answer (and those
    with a null key) are spread over all tasks. ``weight`` names a column of ``right`` that counts the left
    rows per key; without it the keys of ``left`` are counted. The weight column is not returned
    unless the caller keeps a copy.
    """
    on = list(on)
    if size is None:
        right, size = measured(right)
    values = [c for c in right.columns if c not in on and c != weight]
    if size <= (BROADCAST_BYTES if limit is None else limit):
        return _null_safe(left, F.broadcast(right.select(*on, *values)), on).select(*left.columns, *values)

    if weight is None:
        weight = "_weight"
        counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias(weight))
        right = pinned(_null_safe(right, counts, on).select(*right.columns, weight))
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    found = right.agg(F.sum(weight).alias("t"), F.coalesce(F.bool_or(no_key), F.lit(False)).alias("null_key")).first()
    hot_above = (found["t"] or 0) // HOT_KEYS + 1
    # As many keys as can be hot, unless their values are wide: then fewer, those above twice the count, and so on.
    while right.where(F.col(weight) > hot_above).agg(_bytes(right).alias("b")).first()["b"] > max(BROADCAST_BYTES, 1 << 20):
        hot_above *= 2
    hot = right.where(F.col(weight) > hot_above)
    fields = F.struct(*values)

    marked = _null_safe(left, F.broadcast(hot.select(*on, fields.alias("_hot"))), on).select(*left.columns, "_hot")
    if found["null_key"]:  # then null keys are looked up like others
        no_key = F.lit(False)
    marked = marked.withColumn("_spread", F.when(F.col("_hot").isNotNull() | no_key, _scatter(left)))
    # Zero marks the rows to look up; a scattered row never meets it because its low bit is set.
    marked = marked.withColumn("_spread", F.coalesce(F.col("_spread").bitwiseOR(F.lit(1)), F.lit(0)))
    rest = right.select(*on, F.lit(0).cast("bigint").alias("_spread"), fields.alias("_cold"))
    out = _null_safe(marked, rest, [*on, "_spread"]).withColumn("_value", F.coalesce("_hot", "_cold"))
    return out.select(*left.columns, *[F.col("_value")[v].alias(v) for v in values])


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal keys, where null equals null; the keys of ``right`` are gone."""
    names = {c: f"_on_{c}" for c in on}
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(names[c])) for c in on])
    return left.join(right.withColumnsRenamed(names), same, "left").drop(*names.values())


def attach_lazy(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str | None = None) -> DataFrame:
    """The rows of :func:`attach` by a plain join: nothing runs before the result is read, so a view stays live."""
    values = [c for c in right.columns if c not in on and c != weight]
    return _null_safe(left, right.select(*on, *values), list(on)).select(*left.columns, *values)


def attach_range(left: DataFrame, spans: DataFrame, on: Sequence[str], ts: str, start: str, end: str,
                 limit: int | None = None) -> DataFrame:
    """``left`` with a 0/1 column ``_hit``: whether ``ts`` lies in ``[start, end)`` of a span with its keys.

    Spans of one key must not overlap, so a left row meets one at most. If the span side is too big for a broadcast, both are
    shuffled on the keys. Keys with more than SALT_ROWS left rows, which are counted, are split: a left row goes to one
    part by its hash, the spans of the key to all its parts.
    """
    spans, size = measured(spans)
    keys, inside = list(on), clock_range(ts, start, end)
    if size <= (BROADCAST_BYTES if limit is None else limit):
        right, rows = F.broadcast(spans), left
    else:
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SALT_ROWS)
        heavy = pinned(counts.select(*keys, F.ceil(F.col("_n") / SALT_ROWS).alias("_salts"), "_n"))
        right = attach(spans, heavy.drop("_n"), keys).withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
        rows = attach(left, heavy, keys, weight="_n").withColumn("_salt", F.pmod(_scatter(left), F.coalesce("_salts", F.lit(1)))).drop("_salts")
        keys = [*keys, "_salt"]
    rows, right = rows.alias("l"), right.alias("r")
    cond = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]) & inside
    hit = F.when(F.col(f"r.{start}").isNotNull(), 1).otherwise(0).alias("_hit")
    return rows.join(right, cond, "left").select(*[F.col(f"l.{c}") for c in left.columns], hit)


def clock_range(ts: str, start: str, end: str) -> Column:
    return (F.col(f"l.{ts}") >= F.col(f"r.{start}")) & (F.col(f"l.{ts}") < F.col(f"r.{end}"))
