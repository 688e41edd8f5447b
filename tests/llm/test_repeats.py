"""Passages of words and bytes that repeat, against brute force, on small windows and small pieces."""

import hashlib
import re
import random
from collections import Counter

import numpy as np
import pytest

from emberlog.llm import superkmers, suffix_dedup
from emberlog.llm.substring_dedup import counted, without_repeats
from emberlog.llm.superkmers import Cut
from emberlog.llm.suffix_dedup import suffix_buckets, without_earlier


def brute_words(rows, k):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + k]) for w in texts for i in range(len(w) - k + 1))
    out = []
    for (key, text), w in zip(rows, texts):
        gone = {i + j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(k)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        left, spans = text, [m.span() for m in re.finditer("[^\x20\x09-\x0D]+", text or "")]
        if gone:  # every removed word goes with the white space after it
            ends = [a for a, _ in spans[1:]] + [len(text)]
            left = text[:spans[0][0]] + "".join(text[a:b] for i, ((a, _), b) in enumerate(zip(spans, ends)) if i not in gone)
        out.append((key, left, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(rows, k):
    texts = [(t or "").encode() for _, t in rows]
    least = {}
    for (key, _), t in zip(rows, texts):
        for i in range(len(t) - k + 1):
            least[t[i:i + k]] = min(least.get(t[i:i + k], float("inf")), float("inf") if key is None else key)
    out = []
    for (key, _), t in zip(rows, texts):
        own = float("inf") if key is None else key
        gone = {i + j for i in range(len(t) - k + 1) if least[t[i:i + k]] < own for j in range(k)}
        kept = bytes(c for i, c in enumerate(t) if i not in gone)
        out.append((key, len(t), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in without_repeats(docs, **how).select("doc_id", "text", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def bytes_(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in without_earlier(docs, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    lexicon = ["der", "die", "été", "a", "b", "ab", "ba", "Straße", "x" * 40]
    passage = " ".join(rng.choices(lexicon, k=30))
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(lexicon[:rng.choice((2, 5, 9))], k=rng.choice((0, 3, 10, 40))))
        if i % 3 == 0:
            text += "\n\t" + passage + "\r\n " + rng.choice(lexicon)
        rows.append((rng.randrange(50), text))
    rows += [rows[3], rows[3], (99, None), (98, ""), (97, " \n "), (None, passage), (None, passage), (96, "a " * 200), (95, "one")]
    return rows


@pytest.mark.parametrize("often", [20_000, 2])
def test_words_like_brute_force(spark, often, monkeypatch):
    monkeypatch.setattr(superkmers, "OFTEN", often)
    assert words(spark, corpus(1), k=8, m=2) == brute_words(corpus(1), 8)


@pytest.mark.parametrize("often", [20_000, 2])
def test_bytes_like_brute_force(spark, often, monkeypatch):
    monkeypatch.setattr(superkmers, "OFTEN", often)
    assert bytes_(spark, corpus(2), k=20, m=4) == brute_bytes(corpus(2), 20)


def test_empty_table_and_clashing_names(spark):
    assert words(spark, []) == [] and bytes_(spark, []) == []
    docs = spark.createDataFrame([(1, "a", "k", 2, None)], "doc_id long, text string, kept string, chunk int, ranges string")
    assert without_earlier(docs).select("chunk", "n_bytes", "kept").first() == (2, 1, bytearray(b"a"))
    assert without_repeats(docs).columns == ["doc_id", "text", "kept", "chunk", "ranges", "n_words", "n_removed", "kept_sha256"]


def test_pieces_of_a_long_text_give_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.choice(np.frombuffer(b"ab ", np.uint8), size=3000)
    cut = Cut(6, 2, True)
    u = superkmers.units(data, np.array([0, 700, 700, 3000]), cut)
    whole = superkmers.runs(u, cut)
    monkeypatch.setattr(superkmers, "_PIECE", 64)
    parts = superkmers.runs(u, cut)
    def each(r):
        return {(int(f) + i, int(g)) for f, n, g in zip(*r) for i in range(n)}
    assert each(whole) == each(parts) and len(whole[0]) < len(parts[0])


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    from emberlog.llm import substring_dedup
    monkeypatch.setattr(substring_dedup, "rolled", lambda h, k: np.zeros(len(h) - k + 1, np.uint64))
    text = b"a b c d a b x b c "
    shard = superkmers.Shard(np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.array([8]), np.array([1]), np.array([0]))
    assert counted(shard, Cut(2, 1, True)).tolist() == [True, True, False, False, True, False, False, True]


@pytest.mark.parametrize("letters", [1, 2, 5])
@pytest.mark.parametrize("limit", [0, 5])
def test_suffix_array_and_common_prefixes(letters, limit, monkeypatch):
    rng = np.random.default_rng(letters)
    text = rng.integers(0, letters, size=400).astype(np.uint16)
    text[200:260] = text[10:70]
    monkeypatch.setattr(suffix_dedup, "INDUCED_LEAST", 0 if limit else 1 << 20)  # with recursion and without
    pieces = list(suffix_buckets(text, letters, 50, limit))
    order, common = (np.concatenate(x).tolist() for x in zip(*pieces))
    tails = [tuple(text[i:]) for i in range(len(text))]
    assert order == sorted(range(len(text)), key=tails.__getitem__, reverse=True)
    for i, (a, b) in enumerate(zip(order, order[1:]), 1):
        n = 0
        while n < min(50, len(tails[a]), len(tails[b])) and tails[a][n] == tails[b][n]:
            n += 1
        assert common[i] == n


def test_places_of_a_string_stay_with_their_chunk(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "OFTEN", 1)
    rows = [(i % 3, x * 4000) for i, x in enumerate(["a", "a", "a", "b", "b ", "a"])] + [(None, "a" * 60), (0, "b" * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cut, order in ((Cut(50, 16, False), 0), (Cut(50, 16, False), None), (Cut(8, 2, True), None)):
        stock = superkmers.chunks(docs.select("doc_id", "text"))
        sent = superkmers.strings(stock, superkmers.repeated_minimisers(stock, cut, 4), cut, 4, order).where("bucket >= 0").collect()
        size = sum(len(superkmers.zstandard.ZstdDecompressor().decompress(r.strings)) for r in sent)
        assert 0 < size < 10_000  # not several bytes for each of some thousand places
    assert bytes_(spark, rows) == brute_bytes(rows, 50)
    assert words(spark, rows, k=8, m=2) == brute_words(rows, 8)
