"""Removal of byte strings that an earlier document has, by suffix arrays from external induced sorting.

Bytes meet in shards through super-k-mers (see there); each shard's distinct strings form one text whose suffix array is
built by induced sorting. Suffixes in front of a smaller character (L) and in front of a larger one (S) are told apart;
the leftmost of every run of S suffixes (LMS) are sorted by the names of the pieces between them, recursively. All others
follow: L suffixes from left to right, S suffixes from right to left, each through a queue of one bucket per character
that holds (suffix, common prefix with the suffix before). The queue keeps a bounded number of tuples in memory and the
rest in a scratch file of the task. Common prefixes are carried along: that of two induced suffixes is one more than
the smallest between the suffixes that induced them. They are cut at the window's length.

Since a bucket receives its tuples in order, a whole bucket is induced in a few array operations: suffixes that begin with
the same character again come in waves, one per repetition.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberlog.llm import superkmers
from emberlog.llm.superkmers import Cut, Shard
from emberlog.llm.text import concatenated, table

#: Tuples that one task's queue holds in memory before it writes to its scratch file.
QUEUE_TUPLES = 16 << 20

#: Names up to which the names' own text is sorted by induction; beyond, by doubling.
INDUCED_NAMES = 1 << 10
INDUCED_LEAST = 1 << 20

_AT_ONCE = 1 << 19  # pieces that are told apart at once


class BucketQueue:
    """Tuples by bucket, in order of arrival. What exceeds ``limit`` tuples goes to a file that vanishes with the task."""

    def __init__(self, buckets: int, limit: int):
        self.held: list[list] = [[] for _ in range(buckets)]
        self.limit, self.size, self.file = limit, 0, None

    def push(self, bucket: int, suffix: np.ndarray, prefix: np.ndarray) -> None:
        self.held[bucket].append((suffix, prefix))
        self.size += len(suffix)
        if self.size > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.held:
            for i, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    parts[i] = (at, len(part[0]), part[0].dtype, part[1].dtype)
        self.size = 0

    def pop(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        parts, self.held[bucket] = self.held[bucket], []
        out = []
        for part in parts:
            if isinstance(part[0], np.ndarray):
                self.size -= len(part[0])
                out.append(part)
            else:
                at, n, kind, small = part
                self.file.seek(at)
                out.append((np.frombuffer(self.file.read(n * kind.itemsize), kind), np.frombuffer(self.file.read(n * small.itemsize), small)))
        if not out:
            return np.zeros(0, np.int32), np.zeros(0, np.uint8)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def s_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them; behind the text stands something smaller than all."""
    ends = np.r_[np.flatnonzero(text[1:] != text[:-1]), len(text) - 1]
    up = np.r_[text[ends[:-1]] < text[ends[:-1] + 1], False]
    return np.repeat(up, np.diff(np.r_[-1, ends]))


def run_lengths(text: np.ndarray, top: int) -> np.ndarray:
    """How many equal characters begin at each place, up to ``top``."""
    ends = np.r_[np.flatnonzero(text[1:] != text[:-1]), len(text) - 1]
    sizes = np.diff(np.r_[-1, ends])
    return np.minimum(np.repeat(ends + 1, sizes) - np.arange(len(text)), top).astype(np.uint8)


def _smallest_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low..high]), both ends included, by a table over powers of two."""
    levels, width = [values], 1
    longest = int((high - low).max(initial=0)) + 1
    while 2 * width <= longest:
        last = levels[-1]
        levels.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    for i, row in enumerate(levels):
        at = np.flatnonzero(level == i)
        if at.size:
            out[at] = np.minimum(row[low[at]], row[high[at] + 1 - (1 << i)])
    return out


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, up to ``top``; several characters, side by side in one number, are compared at once."""
    if not len(a):
        return np.zeros(0, np.uint8)
    lanes = 4 if text.dtype.itemsize <= 2 else 2
    bits = 64 // lanes
    packed = text.astype(np.uint64) << np.uint64(64 - bits)
    for i in range(1, lanes):
        packed[:-i] |= text[i:].astype(np.uint64) << np.uint64(64 - bits * (i + 1))
    limit = np.minimum(len(text) - np.maximum(a, b), top)
    out = np.zeros(len(a), np.int64)
    at = np.arange(len(a))
    for i in range(0, top, lanes):
        at = at[limit[at] > i]
        if not at.size:
            break
        differ = packed[a[at] + i] ^ packed[b[at] + i]
        same = np.full(len(at), i, np.int64)
        for lane in range(1, lanes + 1):
            same += (differ >> np.uint64(64 - bits * lane)) == 0
        out[at] = same
        at = at[differ == 0]
    return np.minimum(out, limit).astype(np.uint8)


class _Induction:
    """One direction: buckets in order, each as waves of its queue and the seeds that come after them."""

    def __init__(self, text: np.ndarray, s: np.ndarray, lengths: np.ndarray, buckets: int, top: int, limit: int, to_s: bool):
        self.text, self.s, self.lengths, self.top, self.to_s = text, s, lengths, top, to_s
        self.queue = BucketQueue(buckets, limit)

    def bucket(self, c: int, seeds: np.ndarray, seed_prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """All suffixes of bucket ``c`` that are induced, then the seeds; common prefixes; how many are induced."""
        suffix, prefix = self.queue.pop(c)
        waves, depth = [(suffix, prefix)], 1
        while suffix.size:
            ahead = np.flatnonzero((suffix > 0) & (self.text[suffix - 1] == c))
            if not ahead.size:
                break
            least = _smallest_between(prefix, np.r_[0, ahead[:-1] + 1], ahead)
            suffix, prefix = suffix[ahead] - 1, np.minimum(least, self.top - 1) + np.uint8(1)
            prefix[0] = min(depth, self.top)
            waves.append((suffix, prefix))
            depth += 1
        induced = sum(len(w[0]) for w in waves)
        if seeds.size:
            seed_prefix = seed_prefix.copy()
            seed_prefix[0] = 0
            if induced:
                before = next(w[0][-1] for w in reversed(waves) if w[0].size)
                seed_prefix[0] = min(self.lengths[before], self.lengths[seeds[0]])
            waves.append((seeds, seed_prefix))
        suffix = np.concatenate([w[0] for w in waves])
        prefix = np.concatenate([w[1] for w in waves]).astype(np.uint8)
        if prefix.size:
            prefix[0] = 0
        self._push(c, suffix, prefix)
        return suffix, prefix, induced

    def _push(self, c: int, suffix: np.ndarray, prefix: np.ndarray) -> None:
        before = self.text[suffix - 1]
        goes = np.flatnonzero((suffix > 0) & ((before < c) if self.to_s else (before > c)))
        if not goes.size:
            return
        to = before[goes]
        order = np.argsort(to, kind="stable")
        goes, to = goes[order], to[order]
        head = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        low = np.r_[0, goes[:-1] + 1]
        low[head] = 0
        pushed = np.minimum(_smallest_between(prefix, low, goes), self.top - 1) + np.uint8(1)
        suffix = suffix[goes] - 1
        for a, b in zip(head.tolist(), [*head[1:].tolist(), len(to)]):
            self.queue.push(int(to[a]), suffix[a:b], pushed[a:b])


def _names(text: np.ndarray, s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the pieces from each LMS suffix to the next, both included, in the order of the pieces."""
    wide = (text.astype(np.uint32) * 2 + s).astype(">u2" if text.dtype.itemsize <= 2 and text.max() < 1 << 15 else ">u4")
    sizes = np.r_[lms[1:] + 1, len(text)] - lms
    number: dict[bytes, int] = {}
    code = np.empty(len(lms), np.int64)
    for low in range(0, len(lms), _AT_ONCE):
        own_sizes = sizes[low:low + _AT_ONCE]
        data = wide[concatenated(lms[low:low + _AT_ONCE], own_sizes)].view(np.uint8)
        edges = np.r_[0, np.cumsum(own_sizes)].astype(np.int64) * wide.itemsize
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own_sizes), [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        own = np.array([number.setdefault(piece, len(number)) for piece in coded.dictionary.to_pylist()])
        code[low:low + _AT_ONCE] = own[coded.indices.to_numpy()]
    pieces = list(number)
    rank = np.empty(len(pieces), np.int64)
    rank[sorted(range(len(pieces)), key=pieces.__getitem__)] = np.arange(len(pieces))
    return rank[code], len(pieces)


def _doubled(names: np.ndarray) -> np.ndarray:
    """The suffix array of a text of numbers, all from 0 to the largest, by doubling; suffixes that are alone in rank are left out of later rounds."""
    n = len(names)
    rank = names.astype(np.int64)
    order = np.argsort(rank)
    first = np.searchsorted(rank[order], np.arange(rank.max() + 1))
    rank = first[rank]
    step = 1
    while True:
        sorted_rank = rank[order]
        tied = np.r_[False, sorted_rank[1:] == sorted_rank[:-1]]
        open_places = np.flatnonzero(tied | np.r_[tied[1:], False])
        if not open_places.size:
            return order
        group = order[open_places]
        after = np.where(group + step < n, rank[np.minimum(group + step, n - 1)], -1)
        by = np.argsort(rank[group] * (n + 1) + after)
        group, after = group[by], after[by]
        order[open_places] = group
        new = np.r_[True, (rank[group][1:] != rank[group][:-1]) | (after[1:] != after[:-1])]
        rank[group] = open_places[np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))]
        step *= 2


def suffix_buckets(text: np.ndarray, letters: int, top: int, limit: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffix array of ``text`` (numbers below ``letters``) in pieces by first character, from the largest down,
    with common prefixes up to ``top`` of each suffix and the one before it in the piece."""
    limit = limit or QUEUE_TUPLES
    if not len(text):
        return
    s = s_types(text)
    lengths = run_lengths(text, top)
    lms = np.flatnonzero(s & np.r_[False, ~s[:-1]]).astype(np.int64)
    if len(lms):
        names, distinct = _names(text, s, lms)
        if distinct < len(lms) and distinct <= INDUCED_NAMES and len(lms) > INDUCED_LEAST:
            pieces = [p for p, _ in suffix_buckets(names, distinct, top, limit)]
            sorted_lms = lms[np.concatenate(pieces)[::-1]]
        else:
            sorted_lms = lms[_doubled(names)]
        prefix = np.r_[np.uint8(0), _common(text, sorted_lms[:-1], sorted_lms[1:], top)]
    else:
        sorted_lms, prefix = lms, np.zeros(0, np.uint8)
    sorted_lms = sorted_lms.astype(np.int32 if len(text) < 2**31 else np.int64)
    edges = np.searchsorted(text[sorted_lms], np.arange(letters + 1))
    left = _Induction(text, s, lengths, letters, top, limit, False)
    last = len(text) - 1  # induced by what stands behind the text; the first of its bucket
    left.queue.push(int(text[last]), np.array([last], sorted_lms.dtype), np.array([0], np.uint8))
    store = BucketQueue(letters, limit)
    for c in range(letters):
        suffix, common, induced = left.bucket(c, sorted_lms[edges[c]:edges[c + 1]], prefix[edges[c]:edges[c + 1]])
        if induced:
            store.push(c, suffix[:induced], common[:induced])
    right = _Induction(text, s, lengths, letters, top, limit, True)
    for c in range(letters - 1, -1, -1):
        l_suffix, l_common = store.pop(c)
        # from the largest down, the common prefix belongs to the one that comes after
        yield_suffix, common, _ = right.bucket(c, l_suffix[::-1], np.r_[np.uint8(0), l_common[1:][::-1]] if l_suffix.size else l_common)
        if yield_suffix.size:
            yield yield_suffix, common


def earlier(shard: Shard, cut: Cut) -> np.ndarray:
    """Which windows of the shard's strings another string has with a smaller order value."""
    n = len(shard.windows)
    sizes = np.diff(shard.offsets)
    # every byte one up; a zero behind each string
    text = np.zeros(len(shard.data) + n, np.uint16)
    heads = shard.offsets[:-1] + np.arange(n)
    text[concatenated(heads, sizes)] = shard.data.astype(np.uint16) + 1
    number = np.full(len(text), -1, np.int32)
    number[concatenated(heads, shard.windows)] = np.arange(int(shard.windows.sum()))
    owner = np.repeat(np.arange(n), shard.windows)
    out = np.zeros(len(owner), bool)
    for suffix, common in suffix_buckets(text, 257, cut.k):
        group = np.cumsum(common < cut.k)
        of = number[suffix]
        at = np.flatnonzero(of >= 0)
        of, group = of[at], group[at]
        if not of.size:
            continue
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        order = shard.order[owner[of]]
        least = np.repeat(np.minimum.reduceat(order, head), np.diff(np.r_[head, len(of)]))
        out[of] = least < order
    return out


def without_earlier(docs: DataFrame, k: int = 50, m: int = 16) -> DataFrame:
    """All columns of ``docs``, with its text cut and n_bytes, n_removed, n_spans, kept_sha256, kept added.

    Every byte of a text's UTF-8 that is covered by a string of ``k`` bytes that also starts in a row with a smaller doc_id is removed.
    ``kept`` is what is left, as bytes; ``text`` is the same as a string, with characters that a cut has broken replaced.
    A null text is empty and stays null. Rows that share a doc_id do not count against each other; a null doc_id is larger
    than all others. An empty table gives an empty result. Columns of ``docs`` named like the added ones are replaced.
    """
    added = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string", "kept": "binary"}
    docs = docs.select([c for c in docs.columns if c not in added])
    place, names = docs.columns.index("text"), docs.columns
    order = [c for c in names if c != "text"].index("doc_id")
    cut = Cut(k, m, False)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for body, rest, ranges in superkmers._each(batches):
            data, offsets = superkmers.unpack(body, np.uint8, np.int64)
            gone = superkmers.marked_units(offsets, ranges)
            head = gone & np.r_[True, ~gone[:-1]]
            head[offsets[:-1][offsets[:-1] < offsets[1:]]] |= gone[offsets[:-1][offsets[:-1] < offsets[1:]]]
            removed, spans = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(head)]
            low, high = offsets[:-1], offsets[1:]
            left = np.r_[0, np.cumsum(~gone)]
            raw = data[~gone].tobytes()
            kept = [raw[a:b] for a, b in zip(left[low].tolist(), left[high].tolist())]
            rest = superkmers.rest_of(rest)
            columns = rest.columns[:-1]
            columns.insert(place, pa.array([None if missing else t.decode(errors="replace") for t, missing in zip(kept, rest.columns[-1].to_pylist())], pa.string()))
            columns += [pa.array(high - low), pa.array(removed[high] - removed[low]), pa.array(spans[high] - spans[low]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in kept]), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + [f"{c} {t}" for c, t in added.items()])
    return superkmers.covered(superkmers.chunks(docs), cut, earlier, order).mapInArrow(run, schema)


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    found = without_earlier(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
wins AS MATERIALIZED (SELECT r, doc_id, i, md5(substr(h, 2 * i - 1, 100)) AS win
                      FROM (SELECT r, doc_id, h, unnest(range(1, len(h) // 2 - 48)) AS i FROM d WHERE len(h) >= 100)),
least AS (SELECT win, min(doc_id) AS m FROM wins GROUP BY win),
starts AS (SELECT r, i FROM wins JOIN least USING (win) WHERE m IS NOT NULL AND (wins.doc_id IS NULL OR m < wins.doc_id)),
heads AS (SELECT r, i, sum(CASE WHEN i > prev + 50 OR prev IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g
          FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM starts)),
spans AS (SELECT r, g, min(i) AS a, max(i) + 50 AS b FROM heads GROUP BY r, g),
sums AS (SELECT r, count(*) AS n, sum(b - a) AS gone, max(b) AS tail FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(part, '' ORDER BY a) AS k FROM (
           SELECT s.r, s.a, substr(h, 2 * coalesce(lag(s.b) OVER (PARTITION BY s.r ORDER BY s.a), 1) - 1,
                                   2 * (s.a - coalesce(lag(s.b) OVER (PARTITION BY s.r ORDER BY s.a), 1))) AS part
           FROM spans s JOIN d ON s.r = d.r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(from_hex(CASE WHEN n IS NULL THEN h ELSE coalesce(k, '') || substr(h, 2 * tail - 1) END)) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""
