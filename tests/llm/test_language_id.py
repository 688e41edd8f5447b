import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import language_id as L


def reduced(text):
    out = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
    return " ".join(out.split()) + (" " if out.strip() and out[-1] == " " else "")


def brute_model(texts, share):
    """Interpolated Kneser-Ney by the book, on strings, with the same floor on shares."""
    table = {4: Counter()}
    for t in texts:
        padded = "   " + reduced(t)
        table[4].update(padded[i:i + 4] for i in range(len(padded) - 3))
    for k in (3, 2, 1):
        table[k] = Counter(g[1:] for g in table[k + 1])
    d, ctx = {}, {}
    for k, c in table.items():
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d[k] = min(max(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.1), 0.9)
        ctx[k] = {}
        for g, v in c.items():
            s, kinds = ctx[k].get(g[:-1], (0, 0))
            ctx[k][g[:-1]] = (s + v, kinds + 1)

    def p(g, floor):
        k = len(g)
        if not k:
            return floor
        total = sum(table[k].values())
        s, kinds = ctx[k].get(g[:-1], (0, 0))
        weight = d[k] * kinds / s if s and s >= total * share else 1.0
        v = table[k].get(g, 0)
        return (max(v - d[k], 0) / s if v and v >= total * share else 0.0) + weight * p(g[1:], floor)

    return table, p


def corpus(n=240):
    rng = random.Random(8)
    parts = {"aa": ["the", "ing", "er", "wh"], "bb": ["ö", "sch", "und", "keit"], "cc": ["é", "eau", "que", "ç"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.choice((1, 5, 80)))]
        rows.append((i, " ".join(words).capitalize() + rng.choice(["", ".", " 12!\n"]), lang))
    return rows


@pytest.mark.parametrize("share", [0.0, 0.004])
def test_cross_entropy_is_kneser_ney_by_the_book(spark, share, monkeypatch):
    monkeypatch.setattr(L, "MIN_SHARE", share)
    rows = [r for r in corpus(60)]
    model = L.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    texts = ["The whing", "éeau schund", "x", "zebra ö"]
    raw = [t.encode() for t in texts]
    bits, n = model.cross_entropy(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(t) for t in raw])])
    books = [brute_model([t for _, t, g in rows if g == lang], share) for lang in model.languages]
    def seen(t):
        return {g for g, v in t[1].items() if v >= sum(t[1].values()) * share}
    floor = 1 / (len(set().union(*[seen(t) for t, _ in books])) + 1)
    for i, t in enumerate(texts):
        padded = "   " + reduced(t)
        for j, (_, p) in enumerate(books):
            want = [-np.log2(p(padded[a:a + 4], floor)) for a in range(len(padded) - 3)]
            assert bits[i, j] == pytest.approx(np.mean(want), rel=1e-4)
        assert n[i] == sum(c.isalpha() for c in t)


def test_held_out_rows_and_odd_ones(spark):
    rows = corpus()
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !?", "cc"), (None, "theingwh", None), (1003, "und keit", None), (1003, "und keit", None),
           (1004, "жжж щщщ ююю жжж", "aa")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "doc_id long, text string, lang string, bits int, best string")
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    got = L.identified(docs, learn).collect()
    by = {r.doc_id: r for r in got}
    held = [k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([by[k].lang_pred == rows[k][2] for k in held]) > 0.97 and len(got) == len(rows) + len(odd)
    assert all((by[k].lang_pred, by[k].score) == ("und", 0.0) for k in (1000, 1001, 1002))
    assert by[None].lang_pred == "aa" and by[1003].lang_pred == "bb" and by[1004].rejected
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(by[k].rejected for k, _, _ in rows) < 0.05 * len(rows)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identified(docs, F.lit(True)).collect()} == {"und"}
    assert L.identified(docs.limit(0), F.lit(True)).collect() == []


def test_lookup_finds_all_and_nothing_else():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 3000):
        keys = np.unique(rng.integers(0, 2**62, size=n).astype(np.uint64))
        found = L.HashArray(keys, keys[:, None]).find(np.r_[keys, keys + np.uint64(1)])
        table = L.HashArray(keys, keys[:, None])
        assert (table.values[found[:len(keys)], 0] == keys).all() and (found[len(keys):] == -1).all()


def test_rare_ngrams_of_a_large_language_are_kept(spark):
    rows = [(0, "ab " * 100_000, "aa"), (1, "wxyzq", "aa"), (2, "cd " * 100, "bb")]
    model = L.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    raw = b"wxyzq"
    bits, _ = model.cross_entropy(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    books = [brute_model([t for _, t, g in rows if g == lang], 0.0) for lang in model.languages]
    floor = 1 / (len(set().union(*[t[1] for t, _ in books])) + 1)
    padded = "   wxyzq"
    for j, (_, p) in enumerate(books):
        assert bits[0, j] == pytest.approx(np.mean([-np.log2(p(padded[a:a + 4], floor)) for a in range(5)]), rel=1e-4)
    assert sum(table.count() for table in model.probability) == len(set().union(*[set(c) for t, _ in books for c in t.values()]))


def test_texts_ask_in_several_chunks(spark, monkeypatch):
    rows = corpus(90)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {r.doc_id: r for r in L.identified(docs, F.lit(True)).collect()}
    monkeypatch.setattr(L, "CHUNK_BYTES", 1)
    parts = {r.doc_id: r for r in L.identified(docs, F.lit(True)).collect()}
    assert {k: r.lang_pred for k, r in parts.items()} == {k: r.lang_pred for k, r in whole.items()} and len(parts) == len(rows)
    assert all(parts[k].bits_per_char == pytest.approx(whole[k].bits_per_char) for k in whole)
