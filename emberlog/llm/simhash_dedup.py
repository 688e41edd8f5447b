"""Near duplicates by SimHash and deletion variants.

Two fingerprints that differ in at most ``distance`` bits, cut into ``distance // 2 + 1`` segments, agree on one segment but
for one bit at most. So every segment is indexed once for each of its bits, with that bit deleted; fingerprints that
share a variant meet in an equality join and are compared in full. Only distinct fingerprints are indexed.

Among the fingerprints of one variant the links found are those of a spanning forest: components come out the same,
and a group of n near copies gives n - 1 links, not all pairs. Components are found by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from emberlog.llm.text import steps, table
from emberlog.session import pinned, stored

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 16
SMALL = 8


def shingle_digests(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles as rows of eight bytes, a bounded number at a time; none if there is no word."""
    words = text.lower().split()
    for low in range(0, max(1, len(words) - width + 1), SHINGLES_AT_ONCE):
        part = words[low:low + SHINGLES_AT_ONCE + width - 1]
        if not part:
            return
        joined = b" ".join(part)
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = np.r_[0, blanks + 1][:max(1, len(part) - width + 1)].tolist()
        ends = np.r_[blanks, len(joined)][min(width, len(part)) - 1:].tolist()
        digest = xxhash.xxh64_digest
        yield np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends)]), np.uint8).reshape(-1, 8)


def fingerprint(text: bytes, width: int = 4) -> int:
    """The 64 majority bits over the hashes of all shingles, repeats included; 0 if there is no word."""
    ones, n = np.zeros(BITS, np.int64), 0
    for digests in shingle_digests(text, width):
        ones += np.unpackbits(digests, axis=1).sum(axis=0, dtype=np.int64)
        n += len(digests)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) for each row, the fingerprint as a signed long. Null texts have no words and get 0."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, 1):
            prints = [fingerprint((t or "").encode(), width) for t in step.column(1).to_pylist()]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([step.column(0), step.column(2), fp], names=["doc_id", "text_hash", "fp"])

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the segments of which one differs by one bit at most."""
    edges = np.linspace(0, BITS, distance // 2 + 2).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]


def variants(fp: Column, distance: int) -> Column:
    """One number per segment and deleted bit: equal numbers mean the same segment, bit and remaining bits."""
    keys, slot = [], 0
    for low, width in segments(distance):
        segment = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            rest = segment.bitwiseAND(F.lit((1 << width) - 1 - (1 << bit)))
            keys.append(rest.bitwiseOR(F.lit(slot << 56)))
            slot += 1
    return F.explode(F.array(*keys))


def spanning_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join exactly those of the distinct fingerprints that chains of links join.

    Everything near a pivot joins it at once. Two pivots' groups are compared only if they can touch and are not joined
    yet, and only up to the first link.
    """
    left, pivots, radius, groups, links = prints, [], [], [], []
    while left.size:
        apart = np.bitwise_count(left ^ left[0])
        near = apart <= distance
        groups.append(left[near])
        pivots.append(left[0])
        radius.append(int(apart[near].max()))
        links += [(int(left[0]), int(x)) for x in groups[-1][1:]]
        left = left[~near]
    root = list(range(len(pivots)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    pivots, radius = np.array(pivots), np.array(radius)
    for i in range(len(pivots)):
        gap = np.bitwise_count(pivots[i + 1:] ^ pivots[i]).astype(int)
        for j in np.flatnonzero(gap <= distance + radius[i] + radius[i + 1:]) + i + 1:
            if find(i) == find(j):
                continue
            few, many = sorted((groups[i], groups[j]), key=len)
            for x in few:
                touch = np.flatnonzero(np.bitwise_count(many ^ x) <= distance)
                if touch.size:
                    links.append((int(x), int(many[touch[0]])))
                    root[find(i)] = find(j)
                    break
    return links


def _groups_links(keys: np.ndarray, prints: np.ndarray, distance: int) -> np.ndarray:
    """Links within runs of equal keys: all of them in small runs, spanning ones in larger."""
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[heads, len(keys)])
    small = np.repeat(sizes <= SMALL, sizes)
    found = []
    for step in range(1, SMALL):
        hit = (keys[step:] == keys[:-step]) & small[step:] & (np.bitwise_count(prints[step:] ^ prints[:-step]) <= distance)
        found.append(np.stack([prints[step:][hit], prints[:-step][hit]], axis=1))
    for head, size in zip(heads[sizes > SMALL], sizes[sizes > SMALL]):
        if links := spanning_links(prints[head:head + size], distance):
            found.append(np.array(links, np.uint64))
    return np.concatenate(found)


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b), a > b: verified links between distinct fingerprints, enough of them to join every component."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy()]
            prints = np.r_[prints, batch.column(1).to_numpy().view(np.uint64)]
            cut = np.searchsorted(keys, keys[-1]) if keys.size else 0  # the last key may go on in the next batch
            if cut:
                yield out(_groups_links(keys[:cut], prints[:cut], distance))
                keys, prints = keys[cut:], prints[cut:]
        if keys.size:
            yield out(_groups_links(keys, prints, distance))

    def out(pairs: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.sort(pairs.view(np.int64), axis=1), axis=0)
        return pa.record_batch([pa.array(pairs[:, 1]), pa.array(pairs[:, 0])], ["a", "b"])

    keyed = distinct.select(variants(F.col("fp"), distance).alias("key"), "fp")
    met = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a bigint, b bigint")
    return met.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node that has an edge and is not the smallest of its component, the smallest.

    ``edges`` holds (a, b) with a > b. Each round turns every node's larger, then smaller neighbours to the smallest one;
    it ends when nothing changes, after rounds in the order of the logarithm of the longest chain. The edges of a round
    are checkpointed; hubs are aggregated before the shuffle and split by adaptive joins.
    """
    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = pinned(edges.select("a", "b"))
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = pinned(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for each row of ``docs`` (doc_id, text; other columns are ignored).

    ``text_hash`` is xxhash64 of the text; ``root`` is one of the component's fingerprints and names it.
    ``component_id`` is the smallest doc_id that a chain of links reaches, the row's own included. Texts without words, null
    ones included, have fingerprint 0 and link like any other. Rows that repeat a doc_id each get a row. A null
    doc_id counts as larger than all others, so a component of such rows alone has a null component_id. An empty table
    gives an empty result.
    """
    prints = stored(fingerprints(docs, width))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct, distance))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
