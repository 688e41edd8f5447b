"""Message templates learnt from the messages: which words are structure, and which are values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import pinned
from .joins import attach

WILD = "<*>"


@dataclass(frozen=True)
class Templates:
    """A tree over the first words, one frame of (path, is_open, weight) per level, and for its leaves the positions of values."""

    levels: tuple[DataFrame, ...]
    leaves: DataFrame


def words(text: Column | str) -> Column:
    """The words of a message, those with a digit as values; empty for a message that is null or blank."""
    found = F.filter(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"\s+"), lambda w: w != "")
    return F.transform(found, lambda w: F.when(w.rlike("[0-9]"), WILD).otherwise(w))


def _root(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_words", words(text)).withColumn("_path", F.size("_words").cast("string"))


def _step(rows: DataFrame, level: DataFrame, place: int) -> DataFrame:
    """One level down: the path grows by the word, or by a value where more words follow the path than structure has."""
    met = attach(rows, level, ["_path"], weight="_weight")
    word = F.get("_words", F.lit(place))
    part = F.when(F.coalesce("_open", F.lit(False)), WILD).otherwise(word)
    return met.withColumn("_path", F.when(word.isNotNull(), F.concat("_path", F.lit(" "), part)).otherwise(F.col("_path"))).drop("_open")


def learn(df: DataFrame, text: str, depth: int = 3, fanout: int = 8) -> Templates:
    """Templates of the messages in ``text``.

    Messages of one length go down a tree by their first ``depth`` words. A node that more than ``fanout`` different words follow is
    open: the word there is a value. Messages that meet in a leaf are merged position by position: where more than ``fanout`` different
    words stand, there is a value. All of this is counting, so the templates depend neither on the order of messages nor on
    how they are spread; equal messages are merged into one row with a count before anything else.
    """
    seen = _root(df.select(text), text).groupBy("_words", "_path").agg(F.count(F.lit(1)).alias("_n")).where(F.size("_words") > 0)
    rows, levels = pinned(seen), []
    for place in range(depth):
        word = F.get("_words", F.lit(place))
        follow = rows.where(word.isNotNull()).groupBy("_path", word.alias("_word")).agg(F.sum("_n").alias("_n"))
        level = follow.groupBy("_path").agg((F.count(F.lit(1)) > fanout).alias("_open"), F.sum("_n").alias("_weight"))
        levels.append(pinned(level))
        rows = _step(rows, levels[-1], place)
    spots = rows.select("_path", "_n", F.posexplode("_words").alias("_place", "_word")).where(F.col("_place") >= depth)
    kinds = spots.groupBy("_path", "_place", "_word").agg(F.sum("_n").alias("_n"))
    values = kinds.groupBy("_path", "_place").agg((F.count(F.lit(1)) > fanout).alias("_value"), F.sum("_n").alias("_weight"))
    # A leaf has as many positions as its messages have words.
    open_places = F.array_join(F.array_sort(F.collect_list(F.when(F.col("_value"), F.col("_place")))).cast("array<string>"), ",")
    leaves = values.groupBy("_path").agg(open_places.alias("_values"), F.max("_weight").alias("_weight"))
    return Templates(tuple(levels), pinned(leaves))


def templated(df: DataFrame, text: str, learnt: Templates, target: str = "template") -> DataFrame:
    """Rows with the template of their message; null for a message without words. Words that were never seen stay as they are."""
    rows = _root(df, text)
    for place, level in enumerate(learnt.levels):
        rows = _step(rows, level, place)
    rows, depth = attach(rows, learnt.leaves, ["_path"], weight="_weight"), len(learnt.levels)
    places = F.split(F.coalesce("_values", F.lit("")), ",")
    tail = F.transform("_words", lambda w, i: F.when(F.array_contains(places, i.cast("string")), WILD).otherwise(w))
    # The path is the number of words, then the words down to the leaf.
    head = F.slice(F.split("_path", " "), F.lit(2), F.lit(depth))
    whole = F.concat(head, F.slice(tail, F.lit(depth + 1), F.greatest(F.size("_words") - depth, F.lit(0))))
    return rows.withColumn(target, F.when(F.size("_words") > 0, F.array_join(whole, " "))).drop("_words", "_path", "_values")
