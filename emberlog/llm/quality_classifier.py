"""Text quality by naive Bayes support vectors (NBSVM).

A document is the set of its n-grams: words, pairs of words, and up to three successive word shapes (which kinds of
characters a word has, and whether it repeats the word before). Each n-gram's indicator is scaled by the logarithm of its
ratio between the classes; a linear hinge-loss model on these is fitted by dual coordinate descent. A logistic curve,
fitted on documents left out of the descent, turns margins into probabilities.

The model is fitted in one task on at most ``SAMPLE`` labelled documents, taken by the hash of their ids. Scores are
computed for all documents where they lie; only the weights, of fixed size, are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from emberlog.llm.text import characters, id_hash, mix, steps, table, word_hashes, word_spans

#: Labelled documents that a fit sees at most.
SAMPLE = 16_384

#: Features are hashed to so many bits.
HASH_BITS = 20

#: Label 1 from this score on.
THRESHOLD = 0.7

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_SALT = np.array([0x9E37_79B9_7F4A_7C15 * (2 * i + 1) % 2**64 for i in range(5)], np.uint64)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _kind(c: int) -> int:
    """One bit per kind of character: capitals, other letters, digits, each sign of ASCII; none for white space."""
    if 65 <= c <= 90:
        return 1
    if 97 <= c <= 122 or c >= 128:
        return 2
    if 48 <= c <= 57:
        return 4
    return 0 if c <= 32 or c == 127 else 8 << (c % 32 + (16 if c >= 91 else 0)) % 48


_KINDS = np.array([_kind(c) for c in range(256)], np.uint64)


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, offsets by row): the distinct hashed n-grams of each text."""
    starts, ends, bounds = word_spans(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = word_hashes(_LOWER[data], starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    follows = np.r_[False, row[1:] == row[:-1]]
    shape = np.bitwise_or.reduceat(_KINDS[data], starts)
    shape = mix(shape | (np.r_[False, word[1:] == word[:-1]] & follows).astype(np.uint64) << np.uint64(60))
    two, three = follows[1:], follows[1:-1] & follows[2:]
    grams = [
        (word * _SALT[0], row),
        ((word[:-1] * _STEP + word[1:])[two] * _SALT[1], row[1:][two]),
        (shape * _SALT[2], row),
        ((shape[:-1] * _STEP + shape[1:])[two] * _SALT[3], row[1:][two]),
        (((shape[:-2] * _STEP + shape[1:-1]) * _STEP + shape[2:])[three] * _SALT[4], row[2:][three]),
    ]
    keys = np.concatenate([(r.astype(np.uint64) << np.uint64(HASH_BITS)) | (mix(h) >> np.uint64(64 - HASH_BITS)) for h, r in grams])
    keys.sort()
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
    edges = np.searchsorted(keys, np.arange(len(offsets), dtype=np.uint64) << np.uint64(HASH_BITS))
    return (keys & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64), edges


@dataclass(frozen=True)
class Model:
    """Score = 1 / (1 + exp(-(slope * (weights over the features + bias) + shift)))."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, features: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(self.weights[features], dtype=np.float64)]
        margin = total[edges[1:]] - total[edges[:-1]] + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -700, 700)))


def log_ratios(features: np.ndarray, edges: np.ndarray, label: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log((p / |p|) / (q / |q|)), p and q the smoothed counts of documents with label 1 and 0 that have the feature."""
    of = np.repeat(label, np.diff(edges))
    p = smooth + np.bincount(features[of == 1], minlength=1 << HASH_BITS)
    q = smooth + np.bincount(features[of == 0], minlength=1 << HASH_BITS)
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(features: np.ndarray, edges: np.ndarray, label: np.ndarray, ratios: np.ndarray, cost: float = 1.0, epochs: int = 12,
            seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights over the scaled indicators and bias of the hinge-loss model, by dual coordinate descent.

    Both classes weigh the same in total. Each step solves for one document's dual variable, within [0, cost].
    """
    rng = np.random.default_rng(seed)
    sign = np.where(label == 1, 1.0, -1.0)
    upper = np.where(label == 1, cost * len(label) / (2 * max(1, (label == 1).sum())), cost * len(label) / (2 * max(1, (label == 0).sum())))
    rows = [(f := features[a:b], ratios[f]) for a, b in zip(edges[:-1], edges[1:])]
    norm = np.array([x @ x + 1 for _, x in rows])
    alpha, w, bias = np.zeros(len(rows)), np.zeros(1 << HASH_BITS), 0.0
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            f, x = rows[i]
            gradient = sign[i] * (w[f] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                worst = max(worst, abs(step) * norm[i])
                alpha[i] = new
                w[f] += step * x
                bias += step
        if worst < 1e-3:
            break
    return w, bias


def calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps, with the usual smoothed targets."""
    one, zero = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (one + 1) / (one + 2), 1 / (zero + 2))
    slope, shift = 0.0, float(np.log((one + 1) / (zero + 1)))
    if not one or not zero:
        return slope, shift

    def loss(a: float, b: float) -> float:
        z = a * margin + b
        return float(np.sum(np.logaddexp(0, z) - target * z))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -700, 700)))
        error, weight = p - target, np.maximum(p * (1 - p), 1e-12)
        h = np.array([[weight @ (margin * margin) + 1e-9, weight @ margin], [weight @ margin, weight.sum() + 1e-9]])
        da, db = np.linalg.solve(h, [error @ margin, error.sum()])
        size = 1.0
        while size > 1e-8 and loss(slope - size * da, shift - size * db) > loss(slope, shift):
            size /= 2
        slope, shift = slope - size * da, shift - size * db
        if abs(size * da) + abs(size * db) < 1e-9:
            break
    return float(slope), float(shift)


def fit(features: np.ndarray, edges: np.ndarray, label: np.ndarray, blend: float = 0.25) -> Model:
    """Every fifth document is for the curve; the others are for ratios and descent. With one class only, scores are constant."""
    aside = np.arange(len(label)) % 5 == 4
    if not {0, 1} <= set(label[~aside].tolist()):
        return Model(np.zeros(1 << HASH_BITS, np.float32), 0.0, 0.0, float(np.log(((label == 1).sum() + 1) / ((label == 0).sum() + 1))))
    sizes = np.diff(edges)
    own = features[np.repeat(~aside, sizes)]
    own_edges = np.r_[0, np.cumsum(sizes[~aside])]
    ratios = log_ratios(own, own_edges, label[~aside])
    w, bias = descend(own, own_edges, label[~aside], ratios)
    w = (1 - blend) * np.abs(w).mean() + blend * w  # between naive Bayes and the support vectors
    weights = (w * ratios).astype(np.float32)
    margin = _margins(weights, features, edges, bias * blend)
    return Model(weights, bias * blend, *calibrate(margin[aside], label[aside]))


def _margins(weights: np.ndarray, features: np.ndarray, edges: np.ndarray, bias: float) -> np.ndarray:
    total = np.r_[0.0, np.cumsum(weights[features], dtype=np.float64)]
    return total[edges[1:]] - total[edges[:-1]] + bias


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels`` (doc_id, quality) on the texts of ``docs``, without rows whose crc32(doc_id) mod 4 is 2.

    Null ids and null labels are left out; of several labels of one id the largest counts; several rows with one id are
    examples each. Other columns are not looked at.
    """
    known = labels.where(F.col("quality").isNotNull() & (id_hash(F.col("doc_id")) % 4 != 2))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    examples = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by the sample

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, 1):
            features, edges = indicators(*characters(step.column(1)))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(features, pa.int32()))
            yield pa.RecordBatch.from_arrays([step.column(0), step.column(2), lists], names=["doc_id", "label", "features"])

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, label, lists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            label.append(batch.column(1).to_numpy().astype(np.int64))
            lists += [f.values.to_numpy() for f in batch.column(2)]
        ids, label = np.concatenate(ids), np.concatenate(label)
        order = np.lexsort((np.array([len(f) for f in lists], np.int64), mix(ids.view(np.uint64))))  # whatever order rows came in
        sizes = np.array([len(lists[i]) for i in order], np.int64)
        features = np.concatenate([lists[i] for i in order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        model = fit(features, np.r_[0, np.cumsum(sizes)], label[order])
        yield pa.record_batch([[model.weights.tobytes()], [model.bias], [model.slope], [model.shift]], ["weights", "bias", "slope", "shift"])

    seen = examples.mapInArrow(look, "doc_id bigint, label int, features array<int>")
    row = seen.repartition(1).mapInArrow(learn, "weights binary, bias double, slope double, shift double").first()
    return Model(np.frombuffer(row.weights, np.float32), row.bias, row.slope, row.shift)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and score, which replaces a column of that name. Null and empty texts, which have no
    n-grams, get the score of the bias alone. An empty table gives an empty result."""
    docs = docs.drop("score")
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, place):
            score = shared.value.scores(*indicators(*characters(step.column(place))))
            yield pa.RecordBatch.from_arrays([*step.columns, pa.array(score)], names=[*step.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, trained(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(id_hash(F.col("doc_id")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
