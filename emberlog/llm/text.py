"""Words and characters of Arrow text columns as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that one step of a task holds as arrays; a longer text makes a step of its own.
STEP_BYTES = 4 << 20

#: The white space that ends a word: blank, tab, newline, vertical tab, form feed, return.
SPACE = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))

_POWERS = 4096
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_hash(doc_id: Column) -> Column:
    """crc32 of the decimal digits of an id; null stays null."""
    return F.crc32(doc_id.cast("string"))


def steps(batches: Iterable[pa.RecordBatch], column: int = 0, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of the text in ``column``, one row at least."""
    for batch in batches:
        _, offsets = characters(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows, the last one included; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(_POWERS - 1, base, np.uint64)])


_WORD_POWERS = _powers(0x9E3779B97F4A7C15)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word, and the offsets of each row's words. Rows end words, and so do bytes ``between`` them."""
    inside = ~between[data]
    first, last = inside.copy(), inside.copy()
    if data.size:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 17) -> np.ndarray:
    """A number of 64 bits for every word, from its bytes alone. ``block`` words are taken at a time."""
    out = np.empty(len(starts), np.uint64)
    for low in range(0, len(starts), block):
        s, e = starts[low:low + block], ends[low:low + block]
        length = e - s
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        value = (data[place + np.repeat(s, length)].astype(np.uint64) + np.uint64(1)) * _WORD_POWERS[place % _POWERS]
        out[low:low + block] = np.add.reduceat(value, np.cumsum(length) - length)
    return mix(out)


def concatenated(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of range(start, start + length), one after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def in_ranges(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in any of the ranges."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change)[:size] > 0
