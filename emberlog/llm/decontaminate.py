"""Benchmark decontamination by one Aho-Corasick automaton.

The patterns are windows of consecutive words of the benchmark items, normalised and set between blanks. A document is
normalised the same way and scanned once; a match gives words, and their offsets in the original text. Item texts are
taken in blocks of bounded size, one automaton each, so the benchmark may be larger than memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from emberlog.llm.text import steps, table

#: Bytes of item text in one automaton.
BLOCK_BYTES = 8 << 20

#: Upper to lower case for A-Z; every other byte that is no digit, letter or part of a longer character becomes a blank.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def windows(items: list[tuple[str, str | None]], width: int) -> dict[bytes, tuple[int, list[str]]]:
    """Each window between blanks, with its number of words and the items that have it; fewer words make one window."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            part = words[i:i + width]
            found.setdefault(b" " + b" ".join(part) + b" ", (len(part), set()))[1].add(item)
    return {k: (n, sorted(ids)) for k, (n, ids) in found.items()}


def automaton(items: list[tuple[str, str | None]], width: int) -> ahocorasick.Automaton | None:
    made = ahocorasick.Automaton()
    for pattern, value in windows(items, width).items():
        made.add_word(pattern.decode("latin-1"), value)
    if not len(made):
        return None
    made.make_automaton()
    return made


def hits(text: str | None, machine: ahocorasick.Automaton | None) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, which of them lie in an occurrence of a window, and the items that occur."""
    words = words_of(text)
    hit, items = np.zeros(len(words), bool), set()
    if words and machine is not None:
        normal = b" " + b" ".join(words) + b" "
        blanks = None
        for end, (n, ids) in machine.iter(normal.decode("latin-1")):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
            last = int(np.searchsorted(blanks, end))  # the blank after word last - 1
            hit[last - n:last] = True
            items.update(ids)
    return len(words), hit, items


def spans(text: str | None, hit: np.ndarray) -> list[tuple[int, int]]:
    """First and past-the-end byte, in the UTF-8 of the original text, of each run of hit words."""
    if not hit.any():
        return []
    inside = np.frombuffer((text or "").encode().translate(NORMAL), np.uint8) != 32
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    run = np.diff(np.r_[False, hit, False].astype(np.int8))
    return [(int(first[a]), int(last[b - 1])) for a, b in zip(np.flatnonzero(run == 1), np.flatnonzero(run == -1))]


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of bounded size, streamed so that the driver holds one or two partitions at a time."""
    block, size = [], 0
    rows = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string"), "text").distinct()
    for item, text in rows.toLocalIterator():
        if block and size + len(text or "") > limit:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text or "")
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """All columns of ``docs`` and found (n_words, n_hit, items, runs of hit words, hit_spans as byte ranges).

    Null and empty texts have no words and no hit. Items without words, or without an id, match nothing; repeated items
    count once. Rows of ``docs`` that repeat are judged each. Empty tables are allowed on both sides. A column of
    ``docs`` named ``found`` is replaced.
    """
    out = docs.select([c for c in docs.columns if c != "found"])
    for block in blocks(benchmark):
        out = _scan(out, block, width)
    return out


def _scan(docs: DataFrame, items: list[tuple[str, str | None]], width: int) -> DataFrame:
    """``docs`` scanned for one block of items; what a scan before has found is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = [c for c in docs.columns if c != "found"]
    place, before = docs.columns.index("text"), "found" in docs.columns
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + [
        "found struct<n_words: bigint, n_hit: bigint, items: array<string>, runs: array<struct<first: bigint, past: bigint>>,"
        " hit_spans: array<struct<first: bigint, past: bigint>>>"])
    ranges = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
    shape = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("runs", ranges),
                       ("hit_spans", ranges)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value, width)
        for step in steps(batches, place):
            out = []
            known = step.column(len(names)).to_pylist() if before else [None] * step.num_rows
            for text, old in zip(step.column(place).to_pylist(), known):
                n, hit, ids = hits(text, machine)
                for r in old["runs"] if old else ():
                    hit[r["first"]:r["past"]] = True
                edge = np.diff(np.r_[False, hit, False].astype(np.int8))
                out.append({"n_words": n, "n_hit": int(hit.sum()), "items": sorted(ids.union(old["items"] if old else ())),
                            "runs": [{"first": a, "past": b} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))],
                            "hit_spans": [{"first": a, "past": b} for a, b in spans(text, hit)]})
            yield pa.RecordBatch.from_arrays([*step.columns[:len(names)], pa.array(out, shape)], names=[*names, "found"])

    return docs.select(*names, *(["found"] if before else [])).mapInArrow(run, schema)


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    scanned = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"))


_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[])"""

ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win FROM starts),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
           FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS MATERIALIZED (SELECT r, i, p.n, item FROM places p JOIN wins USING (n, win)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
