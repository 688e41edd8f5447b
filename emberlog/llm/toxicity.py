"""Toxicity by bags of subwords: averaged embeddings under a linear softmax, trained together.

A word is the set of its character n-grams, with marks at both ends, and the whole of it; a document is the bag of its words. The n-grams are
hashed to rows of one embedding table. A document's vector is the mean of its rows, and a softmax over two classes reads it. A
misspelt word that training never saw still shares most n-grams, and so most of its vector, with the word it comes from.

Embeddings and softmax are fitted together by stochastic gradient descent, in one task, on at most ``SAMPLE`` labelled
rows and ``SAMPLE_ENTRIES`` entries; a logistic curve, fitted on rows left out of the descent, turns margins into probabilities.
At scoring, the embedding of an n-gram counts through the softmax only, so one number for each row of the table is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from emberlog.llm.folded import word_pieces
from emberlog.llm.quality_classifier import calibrate
from emberlog.llm.text import concatenated, id_hash, mix, steps, table, word_hashes

#: Labelled rows that a fit sees at most, and their entries (an n-gram and its share of a document) in total.
SAMPLE = 8192
SAMPLE_ENTRIES = 1 << 25

#: N-grams are hashed to so many bits, and are of so many characters.
HASH_BITS = 20
GRAMS = (3, 4, 5, 6)

DIMENSIONS = 12
EPOCHS = 5

#: An n-gram is learnt if so many documents of the sample hold it, and one in so many.
LEAST_DOCS = 3
LEAST_SHARE = 512

#: Label 1 from this score on.
THRESHOLD = 0.5

_OPEN, _CLOSE = ord("<"), ord(">")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: str, grams: tuple[int, ...] = GRAMS, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row of the table, offsets by word) for words that each stand between < and >: n-grams that hold a character of the word,
    with the marks; the whole word, if it is longer than every n-gram."""
    code = np.frombuffer(words.encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts, ends = np.flatnonzero(code == _OPEN), np.flatnonzero(code == _CLOSE) + 1
    left = np.repeat(ends, ends - starts) - np.arange(len(code))  # characters up to the end of the word, this one included
    word = np.repeat(np.arange(len(starts)), ends - starts)
    found, of = [], []
    with np.errstate(over="ignore"):
        value = np.zeros(len(code), np.uint64)
        for n in range(1, max(grams) + 1):
            value = value[:len(code) - n + 1] * _STEP + code[n - 1:] + np.uint64(1)
            if n in grams:
                at = np.flatnonzero(left[:len(value)] >= n)
                found.append(mix(value[at] + np.uint64(n) * _STEP))
                of.append(word[at])
        whole = np.flatnonzero(ends - starts > max(grams))
        size = (ends - starts)[whole]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(4095, _STEP)])
        each = (code[concatenated(starts[whole], size)] + np.uint64(1)) * powers[place % 4096]
        if len(whole):
            found.append(mix(np.add.reduceat(each, np.cumsum(size) - size) + np.uint64(99) * _STEP))
            of.append(whole)
    found, of = np.concatenate(found), np.concatenate(of)
    by = np.argsort(of, kind="stable")
    return (found[by] >> np.uint64(64 - bits)).astype(np.int64), np.searchsorted(of[by], np.arange(len(starts) + 1))


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, word, times, table rows, offsets by word): the words of each text and the subwords of all distinct words, in pieces that add up."""
    for rows, data, starts, ends, bounds, _ in word_pieces(texts):
        if not len(starts):
            continue
        _, first, word = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        size = (ends - starts)[first]
        marked = np.full((size + 2).sum(), ord(">"), np.uint8)
        edges = np.cumsum(size + 2)
        marked[edges - size - 2] = ord("<")
        marked[concatenated(edges - size - 1, size)] = data[concatenated(starts[first], size)]
        gram, offsets = subwords(marked.tobytes().decode().lower())
        pair, times = np.unique(np.repeat(rows, np.diff(bounds)) * len(first) + word, return_counts=True)
        yield pair // len(first), pair % len(first), times, gram, offsets


@dataclass(frozen=True)
class Model:
    """Score = 1 / (1 + exp(-(slope * tanh((mean of the n-grams' values + bias) / scale) + shift))).

    The hyperbolic tangent keeps the few documents with wrong labels, far on the other side, from bending the curve.
    """

    values: np.ndarray
    bias: float
    scale: float
    slope: float
    shift: float

    def score(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        margin = np.tanh((total / np.maximum(n, 1) + self.bias) / self.scale)
        return 1 / (1 + np.exp(-(self.slope * margin + self.shift)))


def descend(features: np.ndarray, share: np.ndarray, edges: np.ndarray, label: np.ndarray, rows: int, dimensions: int = DIMENSIONS,
            epochs: int = EPOCHS, rate: float = 0.3, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, softmax, its bias) by stochastic gradient descent over documents whose n-grams, out of ``rows``, have these shares.

    A step on the embeddings is divided by the sum of the document's squared shares, so it moves the document's own vector as far
    whatever the length of the text. The rate falls to zero over all epochs.
    """
    rng = np.random.default_rng(seed)
    table_ = rng.uniform(-0.01, 0.01, (rows, dimensions)).astype(np.float32)
    soft = (rng.uniform(0.5, 1, dimensions) * np.array([[-1.0], [1.0]])).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weigh = np.sqrt([len(label) / (2 * max(1, (label == c).sum())) for c in (0, 1)]).astype(np.float32)  # the rare class counts for more
    done, total = 0, epochs * len(label)
    for _ in range(epochs):
        for i in rng.permutation(len(label)):
            f, s = features[edges[i]:edges[i + 1]], share[edges[i]:edges[i + 1]]
            own = table_[f]
            vector = s @ own
            z = soft @ vector + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[label[i]] -= 1
            error *= weigh[label[i]]
            step = rate * (1 - done / total)
            done += 1
            if len(f):
                table_[f] = own - (step * s / (s @ s))[:, None] * (soft.T @ error)
                soft -= step / 50 * np.outer(error, vector) / (1 + vector @ vector)
            bias -= step / 50 * error
    return table_, soft, bias


def fit(features: np.ndarray, share: np.ndarray, edges: np.ndarray, label: np.ndarray) -> Model:
    """Every fifth document of each class is for the curve; the others are for the descent. With one class only, scores are constant.

    N-grams that fewer than ``LEAST_DOCS`` of the others hold, or one in ``LEAST_SHARE``, have no embedding: they could only be learnt by
    heart. The shares of the rest are multiplied by the squared logarithm of how rare they are.
    """
    aside = np.zeros(len(label), bool)
    for c in (0, 1):
        aside[np.flatnonzero(label == c)[4::5]] = True
    values = np.zeros(1 << HASH_BITS, np.float32)
    if not {0, 1} <= set(label[~aside].tolist()):
        return Model(values, 0.0, 1.0, 0.0, float(np.log(((label == 1).sum() + 1) / ((label == 0).sum() + 1))))
    sizes, n = np.diff(edges), int((~aside).sum())
    holding = np.bincount(features[np.repeat(~aside, sizes)], minlength=len(values))
    kept = np.flatnonzero(holding >= max(LEAST_DOCS, n // LEAST_SHARE))
    rare = np.zeros(len(values), np.float32)
    rare[kept] = np.log(n / holding[kept]) ** 2
    place = np.full(len(values), -1)
    place[kept] = np.arange(len(kept))
    own = np.repeat(~aside, sizes) & (rare[features] > 0)
    row = np.repeat(np.arange(len(label)), sizes)[own]
    inner = np.searchsorted(row, np.flatnonzero(~aside))
    table_, soft, bias = descend(place[features[own]], share[own] * rare[features[own]], np.r_[inner, len(row)], label[~aside], len(kept))
    values[kept] = (table_ @ (soft[1] - soft[0])) * rare[kept]
    level = float(bias[1] - bias[0])
    total = np.r_[0.0, np.cumsum(values[features].astype(np.float64) * share)]
    margin = (total[edges[1:]] - total[edges[:-1]] + level)[aside]
    scale = float(np.median(np.abs(margin))) if len(margin) else 0.0
    scale = scale or 1.0
    return Model(values, level, scale, *calibrate(np.tanh(margin / scale), label[aside]))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, entries: int = SAMPLE_ENTRIES) -> Model:
    """A model of ``labels`` (doc_id, toxic) on the texts of ``docs``, without rows whose crc32(doc_id) mod 5 is 0.

    Null ids and null labels are left out; of several labels of one id the largest counts. The sample is taken by the hash of id and
    text: at most ``sample`` different pairs, of which those are learnt from whose entries fit into ``entries``. Rows that repeat id and text
    are one example, rows that repeat the id alone are several. Other columns are not looked at.
    """
    known = labels.where(F.col("toxic").isNotNull() & (id_hash(F.col("doc_id")) % 5 != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    chosen = named.join(known, "doc_id").groupBy("doc_id", "text_hash").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").limit(sample)
    examples = named.join(F.broadcast(chosen), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "label", "text")  # bounded by the sample

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # at most the sample

        def new(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            fresh = [k not in seen and not seen.add(k) for k in keys]
            return batch if all(fresh) else batch.filter(pa.array(fresh, pa.bool_()))

        for step in steps(map(new, batches), 3):
            found = [np.zeros(0, np.int64)] * 2
            for row, word, times, gram, offsets in bags(step.column(3)):
                n = np.diff(offsets)[word]
                key = np.repeat(row, n) << HASH_BITS | gram[concatenated(offsets[word], n)]
                key, back = np.unique(np.r_[found[0], key], return_inverse=True)
                found = [key, np.bincount(back, np.r_[found[1], np.repeat(times, n)], minlength=len(key))]
            key, n = found
            edges = np.searchsorted(key, np.arange(step.num_rows + 1) << HASH_BITS)
            lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x)) for x in ((key & (1 << HASH_BITS) - 1).astype(np.int32), n.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([*step.columns[:3], *lists], names=["doc_id", "text_hash", "label", "features", "times"])

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, features, times, size, last = [], [], [], 0, None
        for batch in batches:
            for *key, mark, f, t in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3), batch.column(4)):
                again, last = key == last, key
                if not again and len(f.values) and size + len(f.values) <= entries:
                    label.append(mark)
                    features.append(f.values.to_numpy())
                    times.append(t.values.to_numpy())
                    size += len(features[-1])
        flat = [np.concatenate([np.zeros(0, kind), *x]) for x, kind in ((features, np.int32), (times, np.float32))]
        edges = np.r_[0, np.cumsum([len(f) for f in features])].astype(np.int64)
        share = np.concatenate([np.zeros(0, np.float32), *[t / t.sum() for t in times]])
        model = fit(flat[0].astype(np.int64), share, edges, np.array(label, np.int64))
        yield pa.record_batch([[model.values.tobytes()], [model.bias], [model.scale], [model.slope], [model.shift]], ["weights", "bias", "scale", "slope", "shift"])

    seen = examples.mapInArrow(look, "doc_id bigint, text_hash bigint, label int, features array<int>, times array<float>")
    ordered = seen.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash")
    row = ordered.mapInArrow(learn, "weights binary, bias double, scale double, slope double, shift double").first()
    if row is None:
        return fit(np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64), np.zeros(0, np.int64))
    return Model(np.frombuffer(row.weights, np.float32), row.bias, row.scale, row.slope, row.shift)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and score, which replaces a column of that name. Null texts and texts without words get the score
    of the bias alone. Long texts come in pieces that add up. An empty table gives an empty result."""
    docs = docs.drop("score")
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, place):
            total, n = np.zeros(step.num_rows), np.zeros(step.num_rows)
            for row, word, times, gram, offsets in bags(step.column(place)):
                sums = np.r_[0.0, np.cumsum(shared.value.values[gram], dtype=np.float64)]
                each = (sums[offsets[1:]] - sums[offsets[:-1]])[word]
                total += np.bincount(row, each * times, minlength=len(total))
                n += np.bincount(row, np.diff(offsets)[word] * times, minlength=len(n))
            yield pa.RecordBatch.from_arrays([*step.columns, pa.array(shared.value.score(total, n))], names=[*step.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, trained(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(id_hash(F.col("doc_id")) % 5 == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
