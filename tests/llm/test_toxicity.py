import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from emberlog.llm import folded, toxicity as X
from emberlog.llm import text as T

BAD = ("grumfle", "snotterpox", "wretchling", "blightwit")


def corpus(n=900, seed=5):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(lexicon, k=rng.randint(10, 150))
        toxic = rng.random() < 0.3
        for at in rng.sample(range(len(words)), max(1, len(words) // 30)) if toxic else ():
            words[at] = rng.choice(BAD)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels, lexicon


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(spark):
    rows, labels, _ = corpus()
    return X.trained(*frames(spark, rows + [rows[0]] * 5, labels + [(7, None), (None, 1), (0, 0)]))


def test_held_out_documents_are_told_apart(spark, model):
    rows, labels, _ = corpus()
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    truth = dict(labels)
    got = [r for r in X.scored(spark.createDataFrame(rows, "doc_id long, text string"), model).collect() if r.doc_id in held]
    assert len(got) > 120 and np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in got]) > 0.97


def test_misspellings_that_training_never_saw(spark, model):
    rng = random.Random(8)
    lexicon = corpus()[2]
    rows = []
    for i in range(60):
        words = rng.choices(lexicon, k=30)
        if i % 2:
            for at in (3, 17):
                word = rng.choice(BAD)
                words[at] = rng.choice((word[:-2] + "x" + word[-2:], word + "zz", word[:4] + word[3:], word.upper() + "y"))
        rows.append((i, " ".join(words)))
    score = {r.doc_id: r.score for r in X.scored(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert np.mean([(score[i] >= 0.5) == (i % 2 == 1) for i in score]) > 0.9


def brute(text, model):
    """The score by definition: every word's n-grams one by one."""
    total = n = 0
    low = bytes(folded.FOLD[np.frombuffer((text or "").encode(), np.uint8)])
    for word in "".join(c if ord(c) > 127 or c.isalnum() else " " for c in low.decode()).split(" "):
        if word:
            gram, _ = X.subwords(f"<{word.lower()}>")
            total += float(model.values[gram].astype(float).sum())
            n += len(gram)
    return float(model.score(np.array([total]), np.array([n]))[0])


@pytest.mark.parametrize("limit", [T.STEP_BYTES, 50])
def test_scores_equal_brute_force_also_in_pieces(spark, model, monkeypatch, limit):
    monkeypatch.setattr(T, "STEP_BYTES", limit)
    texts = [None, "", "!!", "Grumfle, ÉTÉ snotterPOX.", "a", "x" * 300 + " y", " ".join(t for _, t in corpus(9)[0])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("0 AS total", "text", "doc_id", "'s' AS score")
    got = X.scored(docs, model)
    assert got.columns == ["total", "text", "doc_id", "score"]
    for r in got.collect():
        assert r.score == pytest.approx(brute(texts[r.doc_id], model), abs=1e-9)


def test_ngrams_are_those_of_the_definition():
    gram, edges = X.subwords("<grüße><ab><c>")
    for i, word in enumerate(("<grüße>", "<ab>", "<c>")):
        own = [X.subwords(word)[0].tolist()]
        assert sorted(gram[edges[i]:edges[i + 1]].tolist()) == sorted(own[0])
    assert np.diff(edges).tolist() == [5 + 4 + 3 + 2 + 1, 2 + 1, 1]
    one, other = X.subwords("<snotterpox>")[0], X.subwords("<snotterpax>")[0]
    assert len(set(one) & set(other)) > 10


def test_bags_count_every_word():
    row, word, times, gram, edges = next(X.bags(pa.array(["B a b", None, "c"])))
    assert sorted(zip(row.tolist(), times.tolist())) == [(0, 1), (0, 2), (2, 1)]


def test_labels_held_out_are_not_used(spark):
    rows, labels, _ = corpus(150)
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q) for k, q in labels]
    a, b = (X.trained(*frames(spark, rows, x)) for x in (labels, turned))
    assert (a.values == b.values).all() and (a.slope, a.shift) == (b.slope, b.shift)


def test_the_sample_is_bounded_by_rows_and_entries(spark):
    rows, labels, _ = corpus(120)
    docs, marks = frames(spark, rows, labels)
    again = docs.unionByName(docs).repartition(7)
    a, b = X.trained(docs, marks, sample=50), X.trained(again, marks, sample=50)
    assert (a.values == b.values).all()
    assert not X.trained(docs, marks, entries=10).values.any()


def test_tables_that_teach_nothing(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5, 1)], "doc_id long, text string, score double, label int")
    for marks in ([], [(1, 1)], [(None, 0)]):
        model = X.trained(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        assert 0 <= X.scored(docs, model).first().score <= 1 and X.scored(docs.limit(0), model).collect() == []
