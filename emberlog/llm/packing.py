"""Best-fit packing of token pieces into sequences of a fixed length by a grouping genetic algorithm.

Whether pieces fit together depends on their lengths alone, so a packing is a list of patterns (multisets of lengths that
share a sequence) with the number of sequences that use each. There are at most ``capacity`` lengths, however many
documents there are: the histogram of lengths is all that the search needs to see.

Islands, one per task, each keep a population of packings. A child takes whole well-filled patterns from one parent
into the other: sequences of the other that would use a piece twice are dissolved, and the displaced pieces are placed by
best fit. After some generations every island hands its best packing to the next one. The best packing of
all is spread over the documents: the pieces of one length are numbered, and ranges of numbers go to places in sequences.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from emberlog.llm.ranks import numbered
from emberlog.llm.text import steps, table
from emberlog.session import stored

CAPACITY = 1024
END = 2
ISLANDS = 6
EPOCHS = 3
GENERATIONS = 12
POPULATION = 6

#: Characters whose classes all tokenizer libraries agree on; others go the slower way.
_PLAIN_UPTO = "ɏ"

Pattern = tuple[int, ...]  # lengths, largest first
Packing = dict[Pattern, int]


@lru_cache
def _tokenizers(path: str) -> tuple[Tokenizer, tiktoken.Encoding | None]:
    """The tokenizer of a file and, where the same vocabulary lies beside it as ranks, a faster one with the same ids."""
    whole, fast = Tokenizer.from_file(path), None
    try:
        import public_tokenizers

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    except (OSError, ImportError):
        pass
    return whole, fast


def token_ids(text: str | None, path: str, end: int = END) -> np.ndarray:
    """The ids of a text, special tokens recognised but none added, and the end id."""
    whole, fast = _tokenizers(path)
    text = text or ""
    if fast is not None and (text.isascii() or max(text) <= _PLAIN_UPTO):
        ids = fast.encode_to_numpy(text, allowed_special="all")
    else:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.r_[ids.astype("<u4"), np.array([end], "<u4")]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a longer document is cut into full pieces, the first may be shorter."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, 1):
            rows = []
            for doc, text in zip(step.column(0).to_pylist(), step.column(1).to_pylist()):
                ids = token_ids(text, tokenizer, end)
                raw, n = ids.tobytes(), -(-len(ids) // capacity)
                past = len(ids) - capacity * (n - 1)
                start = 0
                for piece in range(n):
                    rows.append((doc, piece, start, past - start, zlib.crc32(raw[4 * start:4 * past])))
                    start, past = past, past + capacity
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)],
                                  ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(demand: dict[int, int], capacity: int, order: list[int]) -> Packing:
    """Lengths in ``order``, each put into the fullest sequences it fits into; equal sequences are handled at once."""
    open_bins: dict[int, dict[Pattern, int]] = {}  # by room left
    for length in order:
        left = demand.get(length, 0)
        if not left:
            continue
        room = length
        while left and room < capacity:
            if not open_bins.get(room):
                room += 1
                continue
            pattern, n = next(iter(open_bins[room].items()))
            use = min(n, left)  # one piece into each of so many sequences
            _shift(open_bins, capacity, pattern, length, use)
            left -= use
            room = max(length, room - length)  # those are the fullest now, if another piece fits
        if left:
            fit = capacity // length
            full, rest = divmod(left, fit)
            for n, k in ((full, fit), (1, rest)):
                if n and k:
                    pattern = (length,) * k
                    room = capacity - length * k
                    open_bins.setdefault(room, {})
                    open_bins[room][pattern] = open_bins[room].get(pattern, 0) + n
    packing: Packing = Counter()
    for group in open_bins.values():
        packing.update(group)
    return dict(packing)


def _shift(open_bins: dict[int, dict[Pattern, int]], capacity: int, pattern: Pattern, length: int, n: int) -> None:
    room = capacity - sum(pattern)
    open_bins[room][pattern] -= n
    if not open_bins[room][pattern]:
        del open_bins[room][pattern]
    new = tuple(sorted((*pattern, length), reverse=True))
    open_bins.setdefault(room - length, {})
    open_bins[room - length][new] = open_bins[room - length].get(new, 0) + n


def inject(receiver: Packing, donor: Packing, capacity: int, rng: np.random.Generator, demand: dict[int, int]) -> Packing:
    """A child: well-filled patterns of ``donor``, those of ``receiver`` that still can be, the displaced by best fit."""
    left = Counter(demand)
    child: Packing = {}

    def take(pattern: Pattern, n: int) -> None:
        need = Counter(pattern)
        n = min(n, min(left[length] // k for length, k in need.items()))
        if n > 0:
            child[pattern] = child.get(pattern, 0) + n
            for length, k in need.items():
                left[length] -= n * k

    chosen = [p for p in donor if sum(p) >= capacity - rng.integers(0, 4) and rng.random() < 0.5]
    for i in rng.permutation(len(chosen)):
        take(chosen[i], donor[chosen[i]])
    full = sorted(receiver, key=lambda p: (sum(p) + rng.random() * 4, len(p)), reverse=True)
    for pattern in full:
        if sum(pattern) >= capacity * 0.98 or rng.random() < 0.3:
            take(pattern, receiver[pattern])
    order = sorted(left, reverse=True)
    if rng.random() < 0.3:  # a changed order of the displaced now and then
        order = [order[i] for i in np.argsort(np.arange(len(order)) + rng.normal(0, 2, len(order)))]
    for pattern, n in best_fit({k: v for k, v in left.items() if v}, capacity, order).items():
        child[pattern] = child.get(pattern, 0) + n
    return child


def cost(packing: Packing, capacity: int) -> tuple[int, float]:
    """Sequences, then how unevenly they are filled: of two equal counts, the one with emptier rests is better."""
    return sum(packing.values()), -sum(n * (sum(p) / capacity) ** 2 for p, n in packing.items())


def evolve(demand: dict[int, int], seeds: list[Packing], seed: int, capacity: int = CAPACITY, generations: int = GENERATIONS,
           population: int = POPULATION) -> Packing:
    """The best packing of one island after some generations, the seeds included."""
    rng = np.random.default_rng(seed)
    lengths = sorted(demand, reverse=True)
    crowd = list(seeds)
    least = -(-sum(k * v for k, v in demand.items()) // capacity)
    while len(crowd) < population:
        order = lengths if not crowd else [lengths[i] for i in np.argsort(np.arange(len(lengths)) + rng.normal(0, 1 + seed, len(lengths)))]
        crowd.append(best_fit(demand, capacity, order))
    for _ in range(generations):
        crowd.sort(key=lambda p: cost(p, capacity))
        if not demand or cost(crowd[0], capacity)[0] == least:
            break
        a, b = crowd[int(rng.integers(0, 2))], crowd[int(rng.integers(0, len(crowd)))]
        child = inject(a, b, capacity, rng, demand)
        if cost(child, capacity) < cost(crowd[-1], capacity):
            crowd[-1] = child
    return min(crowd, key=lambda p: cost(p, capacity))


def packing_of(demand: dict[int, int], spark: SparkSession, capacity: int = CAPACITY) -> Packing:
    """Islands as tasks; after each epoch every island's best goes to the next island. All frames are bounded by ``capacity``."""
    if not demand:
        return {}
    elites: dict[int, Packing] = {}
    least = -(-sum(k * v for k, v in demand.items()) // capacity)
    shared = spark.sparkContext.broadcast(demand)
    for epoch in range(EPOCHS):
        given = {i: [elites[j] for j in (i, (i - 1) % ISLANDS) if j in elites] for i in range(ISLANDS)}

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for island in batch.column(0).to_pylist():
                    best = evolve(shared.value, given[island], epoch * ISLANDS + island, capacity)
                    yield pa.record_batch([pa.array([island] * len(best), pa.int64()), pa.array([list(p) for p in best], pa.list_(pa.int64())),
                                           pa.array(list(best.values()), pa.int64())], ["island", "pattern", "n"])

        found = spark.range(0, ISLANDS, 1, ISLANDS).mapInArrow(run, "island bigint, pattern array<bigint>, n bigint").collect()
        elites = {i: {} for i in range(ISLANDS)}
        for row in found:
            elites[row.island][tuple(row.pattern)] = row.n
        if min(sum(p.values()) for p in elites.values()) == least:
            break
    return min(elites.values(), key=lambda p: cost(p, capacity))


def places(packing: Packing) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, past, first sequence, offset): where the pieces of each length go, by their number."""
    out, used, sequence = [], Counter(), 0
    for pattern, n in sorted(packing.items(), reverse=True):
        offset = 0
        for length in pattern:
            out.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return out


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece of each row of ``docs``.

    Columns other than doc_id and text are ignored. A null or empty text is one piece with the end id alone. Rows that
    repeat a doc_id, and rows without one, are packed each for itself. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, capacity, end))
    demand = {int(r.length): r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    full = demand.pop(capacity, 0)
    packing = packing_of(demand, spark, capacity)
    if full:
        packing[(capacity,)] = full
    rows = np.array(sorted(places(packing)), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(rows)  # as many rows as the patterns have lengths

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        base = int(rows[:, 2].max()) + 1 if len(rows) else 1
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(rows[:, 0] * base + rows[:, 1], length * base + number, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(rows[at, 3] + number - rows[at, 1]), pa.array(rows[at, 4])],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    number = numbered(cut, "length", "number", [F.col("doc_id"), F.col("piece")], [F.col("doc_id"), F.col("piece")], sum(demand.values()) + full)
    return number.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, kinds)


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))
