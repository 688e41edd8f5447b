import random
import zlib

import numpy as np

from emberlog.llm import quality_classifier as Q


def corpus(n=600):
    rng = random.Random(5)
    lexicon = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(lexicon, k=rng.randint(5, 120))
        good = rng.random() < 0.7
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "ODD!! ONE!!"), rows[0]], "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(7, None), (None, 1), (0, 0)], "doc_id long, quality int")
    got = Q.scored(docs, Q.trained(docs, marks)).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 80
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in held]) > 0.95


def test_labels_held_out_are_not_used(spark):
    rows, labels = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q) for k, q in labels]
    a, b = (Q.trained(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned))
    assert (a.weights == b.weights).all() and (a.slope, a.shift) == (b.slope, b.shift)


def test_tables_that_teach_nothing(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5, 1)], "doc_id long, text string, score double, label int")
    marks = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.scored(docs, Q.trained(docs, marks)).select("doc_id", "label", "score").first() == (1, 1, 0.5)
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert Q.scored(docs.limit(0), Q.trained(docs, one)).collect() == []


def test_indicators_are_distinct_and_by_row():
    texts = [b"a b a b", b"", b"A", b"  x  "]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    features, edges = Q.indicators(data, offsets)
    for i, t in enumerate(texts):
        own, _ = Q.indicators(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert features[edges[i]:edges[i + 1]].tolist() == own.tolist() == sorted(set(own.tolist()))


def test_descent_meets_the_conditions_of_its_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, size=12)) for _ in range(80)]
    label = np.array([int(r.sum() % 7 < 4) for r in rows])
    features, edges = np.concatenate(rows), np.r_[0, np.cumsum([len(r) for r in rows])]
    ratios = Q.log_ratios(features, edges, label)
    w, bias = Q.descend(features, edges, label, ratios, epochs=3000)
    def primal(w, bias):
        upper = np.where(label == 1, 40 / (label == 1).sum(), 40 / (label == 0).sum())
        margin = np.array([w[r] @ ratios[r] for r in rows]) + bias
        return (w @ w + bias * bias) / 2 + (upper * np.maximum(0, 1 - np.where(label == 1, 1, -1) * margin)).sum()
    best = primal(w, bias)
    for _ in range(50):
        assert primal(w + np.where(w != 0, rng.normal(0, 1e-2, len(w)), 0), bias + rng.normal(0, 1e-2)) > best - 1e-3
