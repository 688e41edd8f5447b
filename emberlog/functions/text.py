"""Numbers read from message text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .clock import col

# Words counted in every message, by the name of the feature column.
KEYWORDS = {"n_timeout": "timeout", "n_connection_reset": "connection reset",
            "n_validation_error": "validation error"}
# A stack frame is an indented line that starts with "at " and holds a call.
STACK_FRAME = r"(^|\n)[ \t]+at [^\n]*\("


def keyword_count(text: Column | str, word: str) -> Column:
    lower = F.lower(col(text))
    return ((F.length(lower) - F.length(F.replace(lower, F.lit(word), F.lit("")))) / len(word)).cast("int")


def stack_frames(text: Column | str) -> Column:
    return F.regexp_count(col(text), F.lit(STACK_FRAME)).cast("int")


def text_features(text: Column | str, keywords: Mapping[str, str] = KEYWORDS) -> dict[str, Column]:
    """Feature columns by name: one count per keyword, the length, lines, words and stack frames."""
    text = col(text)
    features = {name: keyword_count(text, word) for name, word in keywords.items()}
    features["n_length"] = F.length(text)
    features["n_lines"] = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int")
    features["n_stack_frames"] = stack_frames(text)
    return features


def payload_value(payload: Column | str, key: str) -> Column:
    """Value of ``key`` in ``rid=12 msg=ok``, or null. A key that comes twice gives its first value."""
    pattern = f"(?:^| ){key}=([^ ]*)"
    payload = col(payload)
    return F.when(payload.rlike(pattern), F.regexp_extract(payload, pattern, 1))


def tokens(text: Column | str) -> Column:
    """Lower-cased words of the whole text, split at white space."""
    return F.array_remove(F.split(F.lower(col(text)), r"[ \t\r\n]+"), "")


def vector_columns(vector: Column | str, size: int, prefix: str = "payload_emb_") -> list[Column]:
    """One double column per element of a vector, counted from 1."""
    return [F.get(col(vector), F.lit(i)).cast("double").alias(f"{prefix}{i + 1}") for i in range(size)]
