"""Removal of passages of words that occur more than once, by super-k-mers whose windows are counted by sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberlog.llm import superkmers
from emberlog.llm.superkmers import Cut, Shard, rolled
from emberlog.llm.text import concatenated, mix, table, word_spans

_PAIRS = 1 << 18


def counted(shard: Shard, cut: Cut) -> np.ndarray:
    """Which windows of the shard's strings occur at two places or more.

    Windows are sorted by a hash of their words' numbers; neighbours with equal hashes are compared word by word, and
    where a hash stands for different windows, those are told apart by all their words.
    """
    starts, _, bounds = word_spans(shard.data, shard.offsets)
    edges = np.r_[starts, len(shard.data)].astype(np.int64)
    body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(shard.data))])
    word = body.dictionary_encode().indices.to_numpy()
    window = concatenated(bounds[:-1], shard.windows)
    copies = np.repeat(shard.copies, shard.windows)
    key = rolled(mix(word.astype(np.uint64) + np.uint64(1)), cut.k)[window]
    order = np.argsort(key)
    window, key = window[order], key[order]
    same = key[1:] == key[:-1]
    differ = np.zeros(len(same), bool)
    pairs = np.flatnonzero(same)
    for low in range(0, len(pairs), _PAIRS):
        at = pairs[low:low + _PAIRS]
        a, b = window[at], window[at + 1]
        for i in range(cut.k):
            differ[at] |= word[a + i] != word[b + i]
    group = np.r_[0, np.cumsum(~same)]
    if differ.any():
        for g in np.unique(group[:-1][differ]):
            at = np.flatnonzero(group == g)
            _, own = np.unique(np.stack([word[window[at] + i] for i in range(cut.k)], axis=1), axis=0, return_inverse=True)
            group[at] = group.max() + 1 + own.ravel()
    total = np.bincount(group, copies[order])
    out = np.empty(len(window), bool)
    out[order] = total[group] > 1
    return out


def _cut(raw: bytes, low: int, high: int, starts: np.ndarray, keep: np.ndarray) -> bytes:
    """raw[low:high] without the words, which begin at ``starts``, that are not kept."""
    edges = np.flatnonzero(np.diff(np.r_[True, keep, True].astype(np.int8))).tolist()  # where removed runs begin and end, in turn
    places, parts, at = [*starts.tolist(), high], [], low
    for first, past in zip(edges[::2], edges[1::2]):
        parts.append(raw[at:places[first]])
        at = places[past]
    return b"".join([*parts, raw[at:high]])


def without_repeats(docs: DataFrame, k: int = 35, m: int = 4) -> DataFrame:
    """All columns of ``docs``, with its text cut and n_words, n_removed, kept_sha256 added.

    The words of a text are what stands between white space (blank and \\t to \\r). Every word that is covered by a window
    of ``k`` words that also starts anywhere else in the table is removed, all its occurrences included. A removed word goes with the white
    space after it; the rest of the text stays as it was, and so does the whole of a text that loses no word. kept_sha256 is that of
    the kept words joined by one blank. A null text has no words and stays null; an empty one stays empty. Very long texts are
    held whole by their task, with some 40 bytes for each word. Repeated rows repeat each
    other's windows, whatever their doc_id, which may be null. An empty table gives an empty result. Columns of ``docs``
    named like the added ones are replaced.
    """
    added = {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}
    docs = docs.select([c for c in docs.columns if c not in added])
    place, names = docs.columns.index("text"), docs.columns
    cut = Cut(k, m, True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for body, rest, ranges in superkmers._each(batches):
            data, offsets = superkmers.unpack(body, np.uint8, np.int64)
            starts, _, bounds = word_spans(data, offsets)
            keep = ~superkmers.marked_units(bounds, ranges)
            raw, texts, digests = data.tobytes(), [], []
            for a, b, x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                words, own = raw[a:b].split(), keep[x:y]
                texts.append(raw[a:b] if own.all() else _cut(raw, a, b, starts[x:y], own))
                digests.append(hashlib.sha256(b" ".join(compress(words, own.tolist()))).hexdigest())
            rest = superkmers.rest_of(rest)
            removed = np.r_[0, np.cumsum(~keep)]
            columns = rest.columns[:-1]
            columns.insert(place, pa.array([None if gone else t.decode() for t, gone in zip(texts, rest.columns[-1].to_pylist())], pa.string()))
            columns += [pa.array(np.diff(bounds)), pa.array(removed[bounds[1:]] - removed[bounds[:-1]]),
                        pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + [f"{c} {t}" for c, t in added.items()])
    return superkmers.covered(superkmers.chunks(docs), cut, counted).mapInArrow(run, schema)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
                               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
wins AS MATERIALIZED (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win
                      FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
more AS (SELECT win FROM wins GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM wins SEMI JOIN more USING (win)),
lists AS (SELECT r, list(k) AS ks FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ks, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lists USING (r)
"""
