"""Exact ranked search by words: inner products over ball trees of sparse vectors.

A document's vector holds, for each term that any item asks for, its whole-number impact; an item's vector holds the terms'
weights. Documents meet the items in shards of bounded size. Each shard is a ball tree: the documents of a node lie within a
radius of its centroid, so no inner product there exceeds (item . centroid) + |item| radius. Both sides are scaled term by term,
which changes no product, by factors that make the second part small: terms that many items and few documents hold count for more.

Nodes are taken best-first, and a search ends when the best bound is below the item's k-th score so far. Bounds are floating-point
numbers, raised by more than their rounding errors; scores at the leaves are exact 64-bit integers. So no answer is lost.
Searches start from the k-th score over a sample of the documents, which can only be too low.

Items are the stated query set: they are broadcast in blocks of at most ``BLOCK_BYTES`` of text.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from emberlog.llm.folded import BETWEEN, FOLD, word_pieces
from emberlog.llm.text import concatenated, steps, table, word_hashes
from emberlog.session import discard, fresh_dir

TOP = 20

#: Text of the items that are broadcast together; an item longer than that is a block of its own.
BLOCK_BYTES = 1 << 20

#: A shard holds at most so many documents, and so many (document, term) pairs unless one document has more.
SHARD_DOCS = 8192
SHARD_PAIRS = 1 << 21

#: Documents below a node that is not split.
LEAF = 128

#: Documents, about, whose scores are where the searches start from.
SAMPLE = 4096

#: Relative error allowed to sums of floating-point numbers; sums of 2**22 of them stay below.
SLACK = 1e-9

#: Stands for a null id, which comes last among equal scores.
LAST = (1 << 63) - 1


@dataclass
class Block:
    """Items and all that their search needs. Terms are numbered; the lists of items and terms are flat, with offsets."""

    item_ids: list
    words: np.ndarray
    word_edges: np.ndarray
    hashes: np.ndarray
    edges: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    docs: int = 0
    length: int = 0

    def query(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms of an item, and their weights times their repeats."""
        terms = self.terms[self.edges[i]:self.edges[i + 1]]
        return terms, self.weight[terms] * self.repeats[self.edges[i]:self.edges[i + 1]]


def words_of(text: str | None) -> list[bytes]:
    """The terms of a text, repeats included."""
    data = FOLD[np.frombuffer((text or "").encode(), np.uint8)]
    return np.where(BETWEEN[data], np.uint8(32), data).tobytes().split(b" ") if len(data) else []


def block_of(items: list[tuple]) -> Block:
    """Items (item_id, text) with numbered terms."""
    bags = [Counter(w for w in words_of(text) if w) for _, text in items]
    vocabulary = sorted({w for bag in bags for w in bag})
    data = np.frombuffer(b"".join(vocabulary), np.uint8)
    edges = np.r_[0, np.cumsum([len(w) for w in vocabulary])].astype(np.int64)
    hashes = word_hashes(data, edges[:-1], edges[1:]) if vocabulary else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    vocabulary = [vocabulary[i] for i in order]  # terms are numbered by their hash
    number = {w: i for i, w in enumerate(vocabulary)}
    flat = [sorted((number[w], n) for w, n in bag.items()) for bag in bags]
    return Block(
        [i for i, _ in items], np.frombuffer(b"".join(vocabulary), np.uint8), np.r_[0, np.cumsum([len(w) for w in vocabulary])].astype(np.int64),
        hashes[order], np.r_[0, np.cumsum([len(f) for f in flat])].astype(np.int64),
        np.array([t for f in flat for t, _ in f], np.int64), np.array([n for f in flat for _, n in f], np.int64))


def blocks(items: DataFrame, limit: int) -> Iterator[Block]:
    """All items (item_id, text), a bounded number at a time."""
    held, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        own = len(row.text or "")
        if held and size + own > limit:
            yield block_of(held)
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += own
    if held:
        yield block_of(held)


def known_terms(block: Block, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of each word among the terms of the block, -1 for other words. Equal hashes are checked byte by byte."""
    out = np.full(len(starts), -1, np.int64)
    if not len(block.hashes) or not len(starts):
        return out
    h = word_hashes(data, starts, ends)
    first = np.searchsorted(block.hashes, h)
    for step in range(int(np.unique(block.hashes, return_counts=True)[1].max())):  # terms of one hash stand together
        at = np.minimum(first + step, len(block.hashes) - 1)
        open_ = np.flatnonzero((out < 0) & (block.hashes[at] == h) & (block.word_edges[at + 1] - block.word_edges[at] == ends - starts))
        if not len(open_):
            continue
        n, term = (ends - starts)[open_], at[open_]
        same = block.words[concatenated(block.word_edges[term], n)] == data[concatenated(starts[open_], n)]
        ok = np.logical_and.reduceat(same, np.cumsum(n) - n)
        out[open_[ok]] = term[ok]
    return out


def term_counts(docs: DataFrame, shared) -> DataFrame:
    """(key, n, terms, times): the number of terms of each document that has any, and how often it holds each term of the block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        wide = max(1, len(block.hashes))
        for step in steps(batches, 1):
            n, found, times = np.zeros(step.num_rows, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            for rows, data, starts, ends, bounds, _ in word_pieces(step.column(1)):
                n[rows] += np.diff(bounds)
                term = known_terms(block, data, starts, ends)
                pair = (np.repeat(rows, np.diff(bounds)) * wide + term)[term >= 0]
                found, back = np.unique(np.r_[found, pair], return_inverse=True)
                times = np.bincount(back, np.r_[times, np.ones(len(pair), np.int64)], minlength=len(found)).astype(np.int64)
            edges = np.searchsorted(found, np.arange(step.num_rows + 1) * wide).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in ((found % wide).astype(np.int32), times)]
            out = pa.RecordBatch.from_arrays([step.column(0), pa.array(n), *lists], names=["key", "n", "terms", "times"])
            yield out.filter(pa.array(n > 0))

    known = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), "text")
    return known.mapInArrow(run, "key bigint, n bigint, terms array<int>, times array<bigint>")


def weigh(block: Block, found: DataFrame) -> None:
    """Fill in what depends on all documents: their number and length, the weights and the scales of terms."""
    total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    block.docs, block.length = total[0], total[1]
    holding = np.zeros(len(block.hashes), np.int64)
    for term, n in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the block
        holding[term] = n
    block.weight = np.array([math.floor(1000 * math.log((2.0 * block.docs + 2) / (2.0 * n + 1))) for n in holding.tolist()], np.int64)
    asking = np.bincount(block.terms, block.repeats.astype(np.float64), minlength=len(holding))
    block.scale = np.sqrt(np.maximum(block.weight, 1)) * (np.maximum(asking, 1) / np.maximum(holding, 1)) ** 0.25
    block.floor = np.ones(len(block.item_ids), np.int64)


def impacts(n: np.ndarray, times: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What a term that a document of ``n`` terms holds so many times adds to a score, for each unit of weight."""
    return (1_000_000_000 * times) // (1000 * times + 12 * (100 - 25 + (25 * n * docs) // length))


def _distinct(key: np.ndarray, edges: np.ndarray, terms: np.ndarray, impact: np.ndarray, keep: int) -> np.ndarray:
    """Documents without those whose vector ``keep`` others with smaller keys have as well."""
    size = np.diff(edges)
    sign = word_hashes_of_pairs(edges, terms, impact)
    order = np.lexsort((key, sign, size))
    same = (sign[order][1:] == sign[order][:-1]) & (size[order][1:] == size[order][:-1])
    at = np.flatnonzero(same)
    a, b, n = edges[order[at]], edges[order[at + 1]], size[order[at]]
    equal = (terms[concatenated(a, n)] == terms[concatenated(b, n)]) & (impact[concatenated(a, n)] == impact[concatenated(b, n)])
    sums = np.r_[0, np.cumsum(~equal)]
    last = np.cumsum(n)
    same[at] &= sums[last] == sums[last - n]
    head = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(order)), 0))
    return np.sort(order[np.arange(len(order)) - head < keep])


def word_hashes_of_pairs(edges: np.ndarray, terms: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """A number for each document from its terms and impacts."""
    with np.errstate(over="ignore"):
        each = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ impact.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        each = (each ^ (each >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        total = np.r_[np.uint64(0), np.cumsum(each)]
    return total[edges[1:]] - total[edges[:-1]]


class BallTree:
    """Documents (key, and flat lists of terms and impacts with edges) as a tree; nodes are numbered from the root, 0."""

    def __init__(self, key: np.ndarray, edges: np.ndarray, terms: np.ndarray, impact: np.ndarray, scale: np.ndarray, leaf: int = LEAF, keep: int = TOP):
        own = _distinct(key, edges, terms, impact, keep)
        size = np.diff(edges)[own]
        flat = concatenated(edges[own], size)
        key, terms, impact = key[own], terms[flat], impact[flat]
        edges = np.r_[0, np.cumsum(size)]
        x = impact * scale[terms]
        square = _sums(x * x, edges)
        self.children, self.spans, self.radius, order = [], [], [], np.arange(len(own))
        centre_terms, centre_nodes, centre_values = [], [], []
        todo = [(0, len(own), -1)]
        while todo:
            low, high, parent = todo.pop()
            node = len(self.spans)
            if parent >= 0:
                self.children[parent].append(node)
            docs = order[low:high]
            n = size[docs]
            flat = concatenated(edges[docs], n)
            t, v, e = terms[flat], x[flat], np.r_[0, np.cumsum(n)]
            centre = np.bincount(t, v, minlength=len(scale)) / (high - low)
            full = np.flatnonzero(centre)
            inner, own_square = _sums(v * centre[t], e), float(centre @ centre)
            distance = np.maximum(square[docs] - 2 * inner + own_square, 0)
            self.radius.append(math.sqrt(float(np.max(distance + SLACK * (square[docs] + own_square)))))
            self.spans.append((low, high))
            self.children.append([])
            centre_terms.append(full)
            centre_nodes.append(np.full(len(full), node))
            centre_values.append(centre[full])
            if high - low > leaf:
                one = self._from(int(np.argmax(distance)), t, v, e, square[docs], len(scale))
                other = self._from(int(np.argmax(one)), t, v, e, square[docs], len(scale))
                order[low:high] = docs[np.argsort(one - other, kind="stable")]  # those nearer to one end, those nearer to the other
                least = (high - low) // 16 + 1  # so the tree stays shallow
                middle = low + min(max(int((one < other).sum()), least), high - low - least)
                todo += [(low, middle, node), (middle, high, node)]
        self.radius = np.array(self.radius)
        t, nodes, values = np.concatenate(centre_terms), np.concatenate(centre_nodes), np.concatenate(centre_values)
        by = np.argsort(t, kind="stable")
        self.centre_nodes, self.centre_values = nodes[by], values[by]
        self.centre_edges = np.searchsorted(t[by], np.arange(len(scale) + 1))
        self.key = key[order]
        place = np.empty(len(own), np.int64)
        place[order] = np.arange(len(own))
        self.postings = terms.astype(np.int64) * len(own) + np.repeat(place, size)
        by = np.argsort(self.postings)
        self.postings, self.impact = self.postings[by], impact[by]

    @staticmethod
    def _from(doc: int, t: np.ndarray, v: np.ndarray, e: np.ndarray, square: np.ndarray, wide: int) -> np.ndarray:
        """Squared distance of every document from one of them."""
        end = np.zeros(wide)
        end[t[e[doc]:e[doc + 1]]] = v[e[doc]:e[doc + 1]]
        return square - 2 * _sums(v * end[t], e) + square[doc]

    def bounds(self, terms: np.ndarray, x: np.ndarray) -> np.ndarray:
        """For every node a number that no inner product with the scaled item exceeds."""
        n = self.centre_edges[terms + 1] - self.centre_edges[terms]
        at = concatenated(self.centre_edges[terms], n)
        inner = np.bincount(self.centre_nodes[at], self.centre_values[at] * np.repeat(x, n), minlength=len(self.radius))
        return (inner + math.sqrt(float(x @ x)) * self.radius) * (1 + 4 * SLACK) + 1

    def scores(self, low: int, high: int, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of the documents at low..high."""
        size = len(self.key)
        first, past = np.searchsorted(self.postings, terms * size + low), np.searchsorted(self.postings, terms * size + high)
        at = concatenated(first, past - first)
        out = np.zeros(high - low, np.int64)
        np.add.at(out, self.postings[at] - np.repeat(terms * size + low, past - first), self.impact[at] * np.repeat(weight, past - first))
        return out

    def search(self, terms: np.ndarray, weight: np.ndarray, x: np.ndarray, top: tuple[np.ndarray, np.ndarray], k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """``top`` (scores falling, keys) with what this tree adds to it, and how many leaves were scored; scores below ``floor`` are no answers."""
        bounds = self.bounds(terms, x)
        score, key = top
        heap, visited = [(-bounds[0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            least = max(floor, int(score[k - 1])) if len(score) >= k else floor
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if (b := min(-bound, float(bounds[child]))) >= least:
                        heapq.heappush(heap, (-b, child))
                continue
            visited += 1
            low, high = self.spans[node]
            own = self.scores(low, high, terms, weight)
            good = np.flatnonzero(own >= least)
            if len(good):
                score, key = np.r_[score, own[good]], np.r_[key, self.key[low + good]]
                best = np.lexsort((key, -score))[:k]
                score, key = score[best], key[best]
        return score, key, visited


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums over edges[i]..edges[i + 1]; empty ranges give 0. Each sum is taken by itself, so its error does not depend on the others."""
    out = np.zeros(len(edges) - 1)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        out[full] = np.add.reduceat(values, edges[full])
    return out


def _shards(batches: Iterable[pa.RecordBatch], docs: int, pairs: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, n, edges, terms, times) of bounded size."""
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def joined() -> tuple[np.ndarray, ...]:
        whole = pa.Table.from_batches(held).combine_chunks()
        lists = whole.column("terms").combine_chunks()
        edges = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].astype(np.int64)
        return (whole.column("key").to_numpy(), whole.column("n").to_numpy(), edges, lists.flatten().to_numpy().astype(np.int64),
                whole.column("times").combine_chunks().flatten().to_numpy())

    for batch in batches:
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
        low = 0
        while low < batch.num_rows:
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, min(low + docs, int(np.searchsorted(ends, before + pairs, "right"))))
            own = int(ends[high - 1]) - before
            if held and (rows + high - low > docs or size + own > pairs):
                yield joined()
                held, rows, size = [], 0, 0
            held.append(batch.slice(low, high - low))
            rows, size, low = rows + high - low, size + own, high
    if held:
        yield joined()


def answers(found: DataFrame, shared, k: int) -> DataFrame:
    """(item, score, key): at least the k best documents of every item, from each task what it found to be its best."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(block.item_ids)
        for key, n, edges, terms, times in _shards(batches, SHARD_DOCS, SHARD_PAIRS):
            impact = impacts(np.repeat(n, np.diff(edges)), times, block.docs, block.length)
            tree = BallTree(key, edges, terms, impact, block.scale, keep=k)
            for i in range(len(tops)):
                own, weight = block.query(i)
                if len(own):
                    tops[i] = tree.search(own, weight, weight / block.scale[own], tops[i], k, int(block.floor[i]))[:2]
        item = np.repeat(np.arange(len(tops)), [len(s) for s, _ in tops])
        score, key = (np.concatenate([np.zeros(0, np.int64), *[t[j] for t in tops]]) for j in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(score), pa.array(key)], names=["item", "score", "key"])

    found = found.where(F.size("terms") > 0)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("key"))
    each = found.mapInArrow(run, "item int, score bigint, key bigint")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES, sample: int = SAMPLE) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring rows of ``docs`` for each row of ``items``, scores above 0 only.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. Null and empty texts have none: such
    documents are no answers and do not count, such items get no rows. Equal scores go by rising doc_id, null last (an id of 2**63 - 1
    counts as null). Rows that repeat an id are documents of their own, rows that repeat an item are items of their own. An empty
    table on either side gives an empty result. Columns other than doc_id, text, item_id are ignored. Long texts come in pieces.
    Each block of items reads the documents once and stores the terms it found, which are removed when its answers are stored.
    """
    spark, out, schema = docs.sparkSession, fresh_dir(docs.sparkSession, "answers"), None
    kind = items.schema["item_id"].dataType
    for number, block in enumerate(blocks(items, block_bytes)):
        path = fresh_dir(spark, "terms")
        shared = spark.sparkContext.broadcast(block)
        counts = term_counts(docs, shared)
        counts.write.parquet(path)
        shared.unpersist()
        found = spark.read.schema(counts.schema).parquet(path)
        weigh(block, found)
        part = block.docs // sample
        if part > 1:
            shared = spark.sparkContext.broadcast(block)
            some = found.where(F.pmod(F.xxhash64("key", "n"), F.lit(part)) == 0)
            floor = block.floor.copy()
            for row in answers(some, shared, k).where(F.col("rank") == k).collect():  # one row an item of the block
                floor[row["item"]] = max(floor[row["item"]], row["score"])
            shared.unpersist()
            block.floor = floor
        shared = spark.sparkContext.broadcast(block)
        names = spark.createDataFrame(list(enumerate(block.item_ids)), f"item int, item_id {kind.simpleString()}")
        best = answers(found, shared, k).join(F.broadcast(names), "item")
        best = best.select("item_id", "rank", F.nullif("key", F.lit(LAST)).alias("doc_id"), "score")
        best.write.parquet(f"{out}/block={number}")
        schema = best.schema
        shared.destroy()
        discard(spark, path)
    if schema is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return spark.read.schema(schema).parquet(f"{out}/block=*")


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS MATERIALIZED (
    SELECT src, r, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT 'd' AS src, row_number() OVER () AS r, doc_id AS id, text FROM documents
          UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark)),
lengths AS MATERIALIZED (SELECT r, id, count(*) AS n FROM words WHERE src = 'd' GROUP BY r, id),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_words FROM lengths),
tfs AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM words WHERE src = 'd' GROUP BY r, term),
weights AS MATERIALIZED (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tfs, totals GROUP BY term),
impacts AS (
    SELECT r, lengths.id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_words)) AS impact
    FROM tfs JOIN lengths USING (r), totals),
asked AS (SELECT r AS item, id AS item_id, term, count(*) AS times FROM words WHERE src = 'b' GROUP BY ALL),
scores AS (
    SELECT item, item_id, impacts.r, impacts.id AS doc_id, sum(times * w * impact)::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS k FROM scores WHERE score > 0)
SELECT item_id, k::INTEGER AS rank, doc_id, score FROM best WHERE k <= 20
"""
