"""Windows of k units (words or bytes) that occur more than once, found by super-k-mers.

A window's minimiser is its m-gram with the smallest hash. Consecutive windows share it, so they travel together as one
packed string to the bucket of the minimiser, and equal windows always meet there. The passes:

1. Texts are stored once in chunks of rows, compressed; a chunk's number addresses its rows.
2. Minimisers are counted: each chunk sends the distinct ones with their counts. Those seen once need no further look.
3. The chunks, joined with the answer, send the packed strings of the other minimisers. Within a chunk equal strings
   are sent once, with the number of places they come from and the first one in order; the other places stay with the
   chunk. Minimisers that occur very often would overload a bucket: their windows travel alone, to the bucket of the
   whole window, so that only equal windows share one, at most one from each chunk.
4. Each bucket decides which windows are repeats; the answer returns to the chunks as ranges of units.

Nothing is dropped: a window that occurs twice has a minimiser that is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from emberlog.llm.text import characters, concatenated, in_ranges, mix, steps, word_hashes, word_spans
from emberlog.session import stored

#: Bytes of text behind one bucket of strings and one part of the minimiser counts.
BUCKET_BYTES = 4 << 20
PART_BYTES = 64 << 20

#: Bodies are written once and read or moved four times, so they are worth the effort.
BODY_LEVEL = 9

#: Runs of one minimiser in the whole table beyond which its windows travel alone.
OFTEN = 20_000

_PIECE = 1 << 18  # windows that are hashed at once
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0xD6E8FEB86659FD93
_HEAVY = np.uint64(1 << 63)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Cut:
    """What a window is: ``k`` consecutive words or bytes; minimisers have ``m`` of them."""

    k: int
    m: int
    words: bool
    bits: int = 56  # by which minimisers are told apart; those that look alike only share a bucket

    @property
    def identity(self) -> np.uint64:
        return np.uint64((1 << self.bits) - 1)


@dataclass
class Units:
    """The units of some texts: hashes, offsets by row, and the bytes that packed strings are cut from."""

    hashes: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    starts: np.ndarray | None = None  # first byte of each word; None if units are bytes

    def string_spans(self, first: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            return first, first + units
        return self.starts[first], self.starts[first + units]


def pack(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Arrays as one compressed value. Numbers lie as planes of bytes: the high bytes of small or sorted ones vanish."""
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level).compress(b"".join([sizes.tobytes(), *planes]))


def unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    ends = 8 * len(types) + np.cumsum(np.frombuffer(raw, np.int64, len(types)))
    out = []
    for a, b, t in zip([8 * len(types), *ends[:-1]], ends, types):
        planes = np.frombuffer(raw, np.uint8, int(b - a), int(a)).reshape(np.dtype(t).itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
    return out


def units(data: np.ndarray, offsets: np.ndarray, cut: Cut) -> Units:
    """Words are normalised: each one is followed by one blank."""
    if not cut.words:
        return Units(_BYTES[data], offsets, data)
    first, past, bounds = word_spans(data, offsets)
    hashes = word_hashes(data, first, past)
    length = past - first + 1
    at = concatenated(first, length)
    at[at >= len(data)] = 0
    normal = data[at]
    starts = np.r_[0, np.cumsum(length)]
    normal[starts[1:] - 1] = 32
    return Units(hashes, bounds, normal, starts)


def rolled(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive numbers, composed of hashes of powers of two."""
    n = len(h) - length + 1
    out, done, power, size = None, 0, h, 1
    base = _BASE
    while True:
        if length & size:
            part = power[done:done + n]
            out = part if out is None else out * np.uint64(base) + part
            done += size
        if 2 * size > length:
            return out
        power = power[:-size] * np.uint64(base) + power[size:]
        size, base = 2 * size, base * base % 2**64


def runs(u: Units, cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, identity of the minimiser) of all runs of windows with one minimiser."""
    h, span = u.hashes, cut.k - cut.m + 1
    heads, tails = u.bounds[:-1], u.bounds[1:] - cut.k + 1
    valid = in_ranges(len(h), heads[tails > heads], tails[tails > heads])
    found: list[tuple] = []
    for low in range(0, max(0, len(h) - cut.k + 1), _PIECE):
        grams = rolled(h[low:low + _PIECE + cut.k - 1], cut.m)
        least = (mix(grams) & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        at = np.flatnonzero(valid[low:low + len(least)])
        if at.size:
            least = least[at]
            new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)])
            gram = grams[(least[new] & _PLACE).astype(np.int64)]
            found.append((at[new] + low, np.diff(np.r_[new, len(at)]), mix(gram ^ np.uint64(_BASE)) & cut.identity))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def chunks(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in stored chunks: texts as one compressed body, all other columns beside it."""
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for i, step in enumerate(steps(batches, place)):
            data, offsets = characters(step.column(place))
            rest = pa.RecordBatch.from_arrays([*step.columns[:place], *step.columns[place + 1:], step.column(place).is_null()],
                                              names=[f"c{j}" for j in range(step.num_columns)])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(rest)
            yield pa.record_batch([[task + i], [int(offsets[-1])], [pack(data, offsets, level=BODY_LEVEL)], [sink.getvalue().to_pybytes()]],
                                  ["chunk", "n_bytes", "body", "rest"])

    return stored(docs.mapInArrow(run, "chunk bigint, n_bytes bigint, body binary, rest binary"))


def rest_of(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[list]:
    """Rows one at a time, so that no more than one blob is a Python object."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield [c[i].as_py() for c in batch.columns]


def _by_key(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """Runs of rows with the same first column."""
    key, rows = None, []
    for row in _each(batches):
        if rows and row[0] != key:
            yield key, rows
            rows = []
        key = row[0]
        rows.append(row[1:])
    if rows:
        yield key, rows


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each distinct key, in order of the places."""
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if keys.size else []
    for a, b in zip(heads, [*heads[1:], len(keys)]):
        yield int(keys[order[a]]), order[a:b]


def _within(minimiser: np.ndarray, buckets: int) -> np.ndarray:
    """24 bits by which most minimisers of one bucket differ."""
    return (minimiser // np.uint64(buckets) & np.uint64((1 << 24) - 1)).astype(np.uint32)


def _dealt(frame: DataFrame, key: str, n: int) -> DataFrame:
    return frame.repartition(n, key).sortWithinPartitions(key)


def repeated_minimisers(stock: DataFrame, cut: Cut, parts: int) -> DataFrame:
    """(chunk, known): per chunk, sorted minimisers that occur more than once in the table, the frequent ones marked."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, body in _each(batches):
            found, n = np.unique(runs(units(*unpack(body, np.uint8, np.int64), cut), cut)[2], return_counts=True)
            rows = [(part, pack(found[at], n[at].astype(np.uint32))) for part, at in _split(found % np.uint64(parts))]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
                                   pa.array([r[1] for r in rows], pa.binary())], ["part", "chunk", "seen"])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_key(batches):
            seen = [unpack(blob, np.uint64, np.uint32) for _, blob in rows]
            all_found = np.concatenate([f for f, _ in seen])
            distinct, which = np.unique(all_found, return_inverse=True)
            total = np.bincount(which, np.concatenate([n for _, n in seen]), len(distinct))[which]
            ends = np.cumsum([len(f) for f, _ in seen])
            for (chunk, _), (found, _), end in zip(rows, seen, ends):
                of = total[end - len(found):end]
                keep = of > 1
                if keep.any():
                    known = found[keep] | np.where(of[keep] > OFTEN, _HEAVY, np.uint64(0))
                    yield pa.record_batch([pa.array([chunk], pa.int64()), pa.array([pack(known)], pa.binary())], ["chunk", "known"])

    seen = stock.select("chunk", "body").mapInArrow(count, "part int, chunk bigint, seen binary")
    return _dealt(seen, "part", parts).mapInArrow(judge, "chunk bigint, known binary")


def strings(stock: DataFrame, known: DataFrame, cut: Cut, buckets: int, order: int | None) -> DataFrame:
    """(bucket, chunk, strings): the packed strings of the repeated minimisers. ``order``: the column of ``rest`` whose
    smallest value is the original among repeats.

    What a chunk knows of its own repeats is a row with a negative bucket: ranges (see :func:`marked_units`) of places that
    need no answer, as the chunk itself has a place that comes before or counts against them, and the places that
    share the fate of the one sent.
    """
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, body, rest, answers in _each(batches):
            u = units(*unpack(body, np.uint8, np.int64), cut)
            first, count, minimiser = runs(u, cut)
            marked = np.sort(np.concatenate([unpack(a, np.uint64)[0] for a in answers]))
            plain, often = marked[marked < _HEAVY], marked[marked >= _HEAVY] & cut.identity
            hot = np.isin(minimiser, often)
            alone = concatenated(first[hot], count[hot])
            own = mix(rolled(u.hashes, cut.k)[alone]) & cut.identity if alone.size else np.zeros(0, np.uint64)
            keep = np.isin(minimiser, plain)
            first, count = np.r_[first[keep], alone], np.r_[count[keep], np.ones(len(alone), np.int64)]
            minimiser = np.r_[minimiser[keep], own]
            if not first.size:
                continue
            a, b = u.string_spans(first, count + cut.k - 1)
            raw = u.data.tobytes()
            coded = pa.array([raw[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary()).dictionary_encode()
            code = coded.indices.to_numpy()
            row = np.searchsorted(u.bounds, first, "right") - 1
            ids = np.zeros(len(row), np.int64)
            if order is not None:
                ids = rest_of(rest).column(order).fill_null(LAST).to_numpy()[row]
            out, gone, tied = [], [], []
            place = first - u.bounds[row]
            for bucket, at in _split(minimiser % np.uint64(buckets)):
                at = at[np.lexsort((ids[at], code[at]))]
                new = np.r_[True, code[at][1:] != code[at][:-1]]
                head = np.flatnonzero(new)
                one = at[head]
                sent = one[np.cumsum(new) - 1]
                after = ids[at] > ids[sent] if order is not None else ~new
                gone.append(at[after])
                same = ~new & ~after
                tied.append(np.stack([sent[same], at[same]]))
                number = np.where(np.isin(one, sent[same]), one, -1)
                body_of = b"".join([raw[x:y] for x, y in zip(a[one].tolist(), b[one].tolist())])
                out.append((bucket, pack(
                    np.frombuffer(body_of, np.uint8), (b - a)[one].astype(np.uint32), count[one].astype(np.uint32), _within(minimiser[one], buckets),
                    np.diff(np.r_[head, len(at)]).astype(np.uint32), row[one].astype(np.uint32), place[one].astype(np.int64), ids[one],
                    number.astype(np.int64))))
            gone, (sent, same) = np.concatenate(gone), np.concatenate(tied, axis=1)
            if gone.size or same.size:
                ranges = row[gone], place[gone], place[gone] + count[gone] + cut.k - 1, np.full(len(gone), -1)
                out.append((-1 - chunk, pack(*[x.astype(np.int64) for x in (*ranges, sent, row[same], place[same], place[sent])])))
            yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([chunk] * len(out), pa.int64()),
                                   pa.array([o[1] for o in out], pa.binary())], ["bucket", "chunk", "strings"])

    answers = known.groupBy("chunk").agg(F.collect_list("known").alias("answers"))
    joined = stock.select("chunk", "body", "rest").join(answers, "chunk")
    return joined.mapInArrow(send, "bucket bigint, chunk bigint, strings binary")


@dataclass
class Shard:
    """Distinct packed strings of one bucket that share minimisers with others."""

    data: np.ndarray
    offsets: np.ndarray
    windows: np.ndarray  # by string
    copies: np.ndarray  # places each string comes from, counted
    order: np.ndarray  # smallest order value among them


def judged(packed: DataFrame, cut: Cut, buckets_at_once: int, solve: Callable[[Shard, Cut], np.ndarray], ordered: bool) -> DataFrame:
    """(chunk, ranges): ranges of units that repeated windows cover, packed as :func:`marked_units` reads them.

    ``solve`` says for each window of the strings whether it repeats elsewhere; if ``ordered``, whether it occurs with a
    smaller order value. It is asked about strings whose minimiser other strings have too: within one string, no two
    windows are equal, as the minimiser would have to stand at two places.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for bucket, rows in _by_key(batches):
            if bucket < 0:
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "ranges"])
                continue
            chunk = np.array([r[0] for r in rows])
            parts = [unpack(r[1], np.uint8, np.uint32, np.uint32, np.uint32, np.uint32, np.uint32, np.int64, np.int64, np.int64) for r in rows]
            size, windows, minimiser, copies, row, first, order, number = [np.concatenate([p[i] for p in parts]) for i in range(1, 9)]
            chunk = np.repeat(chunk, [len(p[5]) for p in parts])
            lengths = np.r_[0, np.cumsum(size, dtype=np.int64)]
            body = pa.py_buffer(np.concatenate([p[0] for p in parts]))
            del parts
            all_strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(lengths), body])
            coded = all_strings.dictionary_encode()
            string = code = coded.indices.to_numpy()  # of each place that was sent
            n = len(coded.dictionary)
            one = np.zeros(n, np.int64)
            one[code[::-1]] = np.arange(len(code))[::-1]
            windows, minimiser = windows[one].astype(np.int64), minimiser[one]
            places = np.bincount(string, copies, n).astype(np.int64)
            least = np.full(n, LAST)
            np.minimum.at(least, string, order)
            shared, times = np.unique(minimiser, return_counts=True)
            ask = np.flatnonzero(np.isin(minimiser, shared[times > 1]))
            hit = np.zeros(int(windows.sum()), bool)
            head = np.r_[0, np.cumsum(windows)]
            if ask.size:
                data, offsets = characters(coded.dictionary.take(pa.array(ask)))
                hit[concatenated(head[ask], windows[ask])] = solve(Shard(data, offsets, windows[ask], places[ask], least[ask]), cut)
            all_of_it = order > least[string] if ordered else places[string] > 1
            spans = [np.stack([chunk, row, first, first + windows[string] + cut.k - 1, number], axis=1)[all_of_it]]
            # runs of hit windows by string, for the other places
            edge = np.flatnonzero(hit & np.r_[True, ~hit[:-1]] | hit & np.isin(np.arange(len(hit)), head))
            last = np.flatnonzero(hit & (np.r_[~hit[1:], True] | np.isin(np.arange(1, len(hit) + 1), head)))
            owner = np.searchsorted(head, edge, "right") - 1
            by_string = np.searchsorted(owner, np.arange(n + 1))
            rest = np.flatnonzero(~all_of_it)
            n_runs = np.diff(by_string)[string[rest]]
            which = concatenated(by_string[string[rest]], n_runs)
            place = np.repeat(rest, n_runs)
            from_unit = first[place] - head[string[place]]
            spans.append(np.stack([chunk[place], row[place], from_unit + edge[which], from_unit + last[which] + cut.k, number[place]], axis=1))
            spans = np.concatenate(spans).astype(np.int64)
            out = [(c, pack(spans[at, 1], spans[at, 2], spans[at, 3], spans[at, 4], none, none, none, none)) for c, at in _split(spans[:, 0])]
            if out:
                yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["chunk", "ranges"])

    return _dealt(packed, "bucket", buckets_at_once).mapInArrow(run, "chunk bigint, ranges binary")


def covered(stock: DataFrame, cut: Cut, solve: Callable[[Shard, Cut], np.ndarray], order: int | None = None) -> DataFrame:
    """The chunks (body, rest, ranges array<binary>) with the units covered by repeated windows, null where there are none."""
    size = stock.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    at_least = int(stock.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, buckets = max(at_least, size // PART_BYTES), max(at_least, size // BUCKET_BYTES)
    # wide enough that few minimisers of a table of this size look alike by chance
    cut = replace(cut, bits=min(56, -(-(size.bit_length() + 6) // 8) * 8))
    known = repeated_minimisers(stock, cut, parts)
    packed = strings(stock, known, cut, buckets, order)
    found = judged(packed, cut, buckets, solve, order is not None)
    ranges = found.groupBy("chunk").agg(F.collect_list("ranges").alias("ranges"))
    return stock.select("chunk", "body", "rest").join(ranges, "chunk", "left").select("body", "rest", "ranges")


def marked_units(bounds: np.ndarray, ranges: list[bytes] | None) -> np.ndarray:
    """Which units of a chunk are covered.

    Each value of ``ranges`` packs row, first, past and number of ranges, and number, row, first and first unit of the
    numbered place for places that the ranges of that number hold for as well.
    """
    found = [unpack(r, *[np.int64] * 8) for r in ranges or ()]
    if not found:
        return np.zeros(int(bounds[-1]), bool)
    row, first, past, number, of, tied_row, tied_first, sent_first = (np.concatenate(x) for x in zip(*found))
    by = np.argsort(of, kind="stable")
    low, high = np.searchsorted(of[by], number, "left"), np.searchsorted(of[by], number, "right")
    tied, span = by[concatenated(low, high - low)], np.repeat(np.arange(len(number)), high - low)
    shift = tied_first[tied] - sent_first[tied]
    row, first, past = np.r_[row, tied_row[tied]], np.r_[first, first[span] + shift], np.r_[past, past[span] + shift]
    return in_ranges(int(bounds[-1]), bounds[row] + first, bounds[row] + past)
