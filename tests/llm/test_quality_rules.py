import math
import random
from collections import Counter

from pyspark.sql import functions as F

from emberlog.llm import quality_rules as Q

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = text.encode().split()
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(wins)
    hit = {i + j for i, w in enumerate(wins) if n[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_measures_like_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", "a b c d e", "a a a a a a", "x\n\nx\n \nx", "é ö ##<>||", "\x1f a\x0bb\x0cc\rd\r\n", "a b c d e f a b c d e"]
    texts += ["".join(rng.choices(["a", "b", " ", "  ", "\n", "ü", "#", "B"], k=rng.choice((5, 40, 400)))) for _ in range(60)]
    texts += ["long " * 3000]
    docs = spark.createDataFrame([(i, t, None, 1, "z") for i, t in enumerate(texts)], "doc_id long, text string, lang string, words int, lines string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.measures(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_binomial_tail(spark, monkeypatch):
    def exact(k, n, p):
        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))

    cases = [(0, 1), (0, 5), (0, 700), (1, 200), (5, 900), (20, 1500), (0, 0)]
    frame = spark.createDataFrame(cases, "k long, n long")
    for top in (100_000, 3):
        monkeypatch.setattr(Q, "TAIL_TERMS", top)
        for r in frame.select("k", "n", Q.log_tail(F.col("k"), F.col("n"), 0.03).alias("p")).collect():
            true = math.log(exact(r.k, r.n, 0.03))
            assert abs(r.p - true) < 1e-9 if top > r.k else r.p >= true - 1e-9
            assert r.p < true + 1


def test_certified_cutoffs_and_strata_without_labels(spark):
    rng = random.Random(3)
    lexicon = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(3000)]
    rows, labels = [], []
    for i in range(5200):
        good = i % 5 > 0
        words = rng.sample(lexicon, 12)
        rows.append((i, " ".join(words if good else [w + "##" for w in words]), "en"))
        labels.append((i, int(good)))
    rows += [(9000 + i, " ".join(w + "##" for w in rng.sample(lexicon, 12)), lang) for i, lang in enumerate(["en", "fr", None])]
    rows += [(9100, None, "en"), (None, "too short", "en"), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int")
    used = {(r.stratum, r.rule): r for r in Q.cutoffs(Q.measures(docs), marks).collect()}
    assert set(used) == {("en", "symbols")} and used["en", "symbols"].cutoff == 0.2
    got = Counter((r.doc_id, r.kept) for r in Q.judged(docs, marks).collect())
    assert all(got[i, i % 5 > 0] >= 1 for i in range(5200)) and sum(got.values()) == len(rows)
    assert got[9000, False] and got[9001, True] and got[9002, True] and got[9100, False] and got[None, False] and got[1, True] == 3
    few = spark.createDataFrame(labels[:300], "doc_id long, quality int")
    assert Q.cutoffs(Q.measures(docs), few).collect() == []


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 4 + "b c d e f g h", "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in Q.judged(docs, none).collect()] == [True]
    assert Q.judged(docs.limit(0), none).collect() == []
