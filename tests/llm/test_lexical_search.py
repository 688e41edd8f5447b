import math
import random
from collections import Counter

import numpy as np
import pytest

from emberlog.llm import lexical_search as L
from emberlog.llm import text as T
from tests.llm.test_resampling import brute_grams


def bag(text):
    return Counter(brute_grams(text, 1)[1])


def brute(docs, items, k=20):
    bags = [(i, b) for i, b in ((i, bag(t)) for i, t in docs) if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, best = bag(text), []
        for i, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // length
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m))
                        for t, times in asked.items() if t in b)
            if score > 0:
                best.append((-score, math.inf if i is None else i, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(best, key=lambda x: x[:2])[:k])]
    return sorted(out, key=repr)


def corpus(n=500, seed=4):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choices("abCDé7", k=rng.randint(1, 6))) for _ in range(150)]
    spread = [1 / (i + 1) for i in range(len(lexicon))]
    docs = [(i, " ".join(rng.choices(lexicon, spread, k=rng.randint(0, 40)))) for i in range(n)]
    return docs, [(i, " ".join(rng.choices(lexicon, k=rng.randint(1, 12)))) for i in range(25)]


def found(spark, docs, items, **more):
    d = spark.createDataFrame([(*x, 1, "y") for x in docs], "doc_id long, text string, rank int, item_id string").repartition(3)
    q = spark.createDataFrame([(*x, 5) for x in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in L.ranked(d, q, **more).collect()), key=repr)


def test_equals_brute_force(spark):
    docs, items = corpus()
    docs += [(None, docs[1][1]), (None, docs[1][1]), (600, None), (601, ""), (602, "?! .")] + [(700 + i, docs[2][1]) for i in range(60)] + [(3, docs[3][1])] * 2
    items += [(100, None), (101, "..."), (102, "nowhere"), (None, docs[2][1]), (0, items[0][1])]
    assert found(spark, docs, items) == brute(docs, items)


def test_small_shards_blocks_and_samples_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_DOCS", 50)
    monkeypatch.setattr(L, "SHARD_PAIRS", 400)
    monkeypatch.setattr(L, "LEAF", 4)
    monkeypatch.setattr(T, "STEP_BYTES", 60)
    docs, items = corpus(300, 9)
    docs.append((900, " ".join(t for _, t in docs[:50])))
    assert found(spark, docs, items, k=5, block_bytes=100, sample=40) == brute(docs, items, 5)


def test_empty_tables(spark):
    docs, items = corpus(5)
    assert found(spark, docs[:0], items) == [] and found(spark, docs, items[:0]) == [] and found(spark, [(1, None)], items) == []


def shard(n=2000, wide=300, groups=40, seed=0):
    """Documents in groups of near copies."""
    rng = np.random.default_rng(seed)
    common = [rng.choice(wide, 12, replace=False) for _ in range(groups)]
    rows = [np.unique(np.r_[common[i % groups], rng.integers(0, wide, 1)]) for i in range(n)]
    edges = np.r_[0, np.cumsum([len(r) for r in rows])]
    return np.arange(n), edges, np.concatenate(rows), rng.integers(500_000, 600_000, edges[-1]), common


def test_no_inner_product_exceeds_the_bounds_of_its_nodes():
    key, edges, terms, impact, _ = shard(600)
    rng = np.random.default_rng(1)
    scale = rng.uniform(0.1, 30, 300)
    tree = L.BallTree(key, edges, terms, impact, scale, leaf=8)
    for _ in range(20):
        asked = np.sort(rng.choice(300, 10, replace=False))
        weight = rng.integers(1, 9000, 10)
        bounds = tree.bounds(asked, weight / scale[asked])
        for (low, high), bound in zip(tree.spans, bounds):
            own = tree.scores(low, high, asked, weight)
            assert own.max() <= bound
    dense = np.zeros((600, 300), np.int64)
    dense[np.repeat(key, np.diff(edges)), terms] = impact
    assert (tree.scores(0, len(tree.key), asked, weight) == dense[tree.key][:, asked] @ weight).all()


def test_subtrees_are_pruned():
    key, edges, terms, impact, common = shard()
    tree = L.BallTree(key, edges, terms, impact, np.ones(300), leaf=16)
    leaves = sum(not c for c in tree.children)
    asked, weight = np.sort(common[3]), np.full(12, 5000)
    score, ids, visited = tree.search(asked, weight, weight.astype(float), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 20, 1)
    assert visited < leaves / 3
    every = tree.scores(0, len(tree.key), asked, weight)
    best = np.lexsort((tree.key, -every))[:20]
    assert (score == every[best]).all() and (ids == tree.key[best]).all()


def test_of_equal_vectors_the_smallest_keys_stay():
    key = np.array([9, 4, 7, 1, 3])
    edges, terms, impact = np.array([0, 2, 4, 6, 8, 9]), np.array([0, 1, 0, 1, 0, 1, 0, 1, 1]), np.array([5, 6, 5, 6, 5, 6, 5, 7, 6])
    assert key[L._distinct(key, edges, terms, impact, 2)].tolist() == [4, 7, 1, 3]


def test_terms_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(L, "word_hashes", lambda data, starts, ends, block=0: (ends - starts).astype(np.uint64))
    block = L.block_of([(1, "ab cd efg"), (2, "xy")])
    words = L.words_of("cd xy ab zz efg hij")
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = L.known_terms(block, data, ends - np.array([len(w) for w in words]), ends)
    names = [block.words[a:b].tobytes() for a, b in zip(block.word_edges[:-1], block.word_edges[1:])]
    assert [names[g] if g >= 0 else None for g in got] == [b"cd", b"xy", b"ab", None, b"efg", None]
