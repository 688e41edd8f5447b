import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from emberlog.llm import folded, resampling as R
from emberlog.llm import text as T

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_grams(text, words=2):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    found = WORD.findall(low)
    return len(found), [b" ".join(found[i:i + n]) for n in range(1, words + 1) for i in range(len(found) - n + 1)]


def brute(docs, target, percent=25, least=20, buckets=10_000):
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for g in brute_grams(x)[1]:
                counts[zlib.crc32(g) % buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, (doc_id, x) in enumerate(docs):
        n, grams = brute_grams(x)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, n, len(grams), weight, score, i))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0], r[5]))
    rank = {r[5]: k + 1 for k, r in enumerate(fit[:percent * len(fit) // 100])}
    return [(*r[:5], rank.get(r[5])) for r in rows]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choices("abcXYZ09é", k=rng.choice((1, 2, 3, 5, 8, 70)))) for _ in range(60)]
    docs = [(i, "".join(w + rng.choice((" ", ", ", "\n", "--")) for w in rng.choices(lexicon, k=rng.randint(0, 60)))) for i in range(n)]
    return docs, [" ".join(rng.choices(lexicon[:20], k=30)) for _ in range(10)]


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("step", [T.STEP_BYTES, 200])
def test_equals_brute_force(spark, monkeypatch, step):
    """Also where most texts come in pieces."""
    monkeypatch.setattr(T, "STEP_BYTES", step)
    docs, target = corpus()
    docs += [(None, None), (None, " ".join("ab" for _ in range(30))), (1000, ""), (1001, "--- ..."), (1002, "Word " * 500)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, rank int, score string").repartition(5)
    want = brute(docs, target)
    assert collected(R.resampled(frame, spark.createDataFrame([(t,) for t in target], "text string"))) == sorted(want, key=repr)
    ranks = [w[5] for w in want if w[5]]
    assert sorted(ranks) == list(range(1, len(ranks) + 1)) and len(ranks) > 40


def test_pieces_hold_whole_words_and_all_of_them():
    import pyarrow as pa
    rng = random.Random(1)
    text = "".join(rng.choice(("ab ", "é", "Z--", "x" * 40 + " ", " ")) for _ in range(400))
    for limit in (3, 10, 64, 5000):
        got, ns, buckets = [], 0, []
        for _, data, starts, ends, _, _ in folded.word_pieces(pa.array([text]), limit):
            got += [data[a:b].tobytes() for a, b in zip(starts, ends)]
        assert got == WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))


def test_checksums_by_tables():
    rng = random.Random(2)
    words = [bytes(rng.choices(range(256), k=rng.choice((1, 2, 3, 4, 5, 63, 64, 65, 200)))) for _ in range(300)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - np.array([len(w) for w in words])
    crc = R.word_crcs(data, starts, ends)
    assert crc.tolist() == [zlib.crc32(w) for w in words]
    pairs = R.pair_crcs(crc[:-1], crc[1:], (ends - starts)[1:], lambda i: words[i + 1])
    assert pairs.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]


def test_three_words_a_feature(spark):
    docs, target = corpus(60)
    want = np.zeros(50, np.int64)
    for _, x in docs:
        for g in brute_grams(x, 3)[1]:
            want[zlib.crc32(g) % 50] += 1
    assert R.bucket_counts(spark.createDataFrame(docs, "doc_id long, text string"), 3, 50).tolist() == want.tolist()


@pytest.mark.parametrize("wanted", [0, 1, 37, 150, 299, 300])
def test_the_cutoff_is_exact_among_ties(spark, wanted):
    """Few scores, ids that repeat, and null ids."""
    rng = random.Random(wanted)
    rows = [(rng.randint(-2, 2), R.LAST if rng.random() < 0.3 else rng.randint(0, 5), i * 1000) for i in range(300)]
    frame = spark.createDataFrame(rows, "score long, key long, row long")
    got = sorted(tuple(r) for r in frame.where(R.drawn(frame, wanted)).collect())
    assert got == sorted(sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[:wanted])


def test_repeated_rows_each_have_a_rank(spark):
    docs = [(7, "one two three " * 10)] * 40 + [(8, "four " * 30)]
    got = R.resampled(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("four",)], "text string")).collect()
    assert len(got) == 41 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    none = docs.select("text").limit(0)
    assert R.resampled(docs.limit(0), docs).collect() == []
    assert collected(R.resampled(docs, none, percent=100)) == sorted(brute([(1, "a " * 30)], [], 100), key=repr)
