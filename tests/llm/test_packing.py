import zlib

import numpy as np
import pytest

from emberlog.llm import packing as P

JSON = P.public_tokenizer("byte_bpe_50k.json")


def check(rows, texts, capacity):
    """Pieces are the documents' ids, sequences are gapless and never too long."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(JSON)
    want = []
    for key, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        n = -(-len(ids) // capacity)
        edges = [0, *range(len(ids) - capacity * (n - 1), len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((key, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pieces_fill_sequences(spark, capacity):
    texts = [(i, "one two,  three's été あい <|endoftext|> x\n\n" * (i % 7)) for i in range(120)]
    texts += [(5, None), (5, ""), (None, "lost"), (None, "lost"), (7, "a " * 3000)]
    docs = spark.createDataFrame([(k, t, "x", 3) for k, t in texts], "doc_id long, text string, length string, piece int")
    rows = P.packed(docs, JSON, capacity).collect()
    n = check(rows, texts, capacity)
    assert n <= 1.03 * sum(r.length for r in rows) / capacity + 1


def test_empty_table(spark):
    assert P.packed(spark.createDataFrame([], "doc_id long, text string"), JSON).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_children_hold_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths, n = np.unique(rng.integers(1, 100, size=3000), return_counts=True)
    demand = dict(zip(lengths.tolist(), n.tolist()))

    def held(packing):
        got = {}
        for pattern, k in packing.items():
            assert sum(pattern) <= 100
            for x in pattern:
                got[x] = got.get(x, 0) + k
        return got

    a = P.best_fit(demand, 100, sorted(demand, reverse=True))
    b = P.best_fit(demand, 100, sorted(demand))
    assert held(a) == held(b) == held(P.inject(a, b, 100, rng, demand)) == demand
    best = P.evolve(demand, [b], seed, 100)
    assert held(best) == demand and P.cost(best, 100) <= P.cost(b, 100)


def test_two_parts_that_match_are_put_together():
    assert P.evolve({60: 5, 40: 5, 30: 10, 70: 10}, [], 0, 100) == {(60, 40): 5, (70, 30): 10}


def test_every_piece_has_a_place():
    packing = {(7, 3): 4, (5, 5): 2, (10,): 3}
    seen = set()
    for length, first, past, sequence, offset in P.places(packing):
        for i in range(past - first):
            assert (sequence + i, offset) not in seen
            seen.add((sequence + i, offset))
    assert len(seen) == 2 * 4 + 2 * 2 + 3


def test_the_numbers_of_a_hot_group(spark, monkeypatch):
    from pyspark.sql import functions as F

    from emberlog.llm import ranks
    monkeypatch.setattr(ranks, "SLICE_ROWS", 10)
    rows = spark.range(500).select("id", F.when(F.col("id") < 400, F.lit(None)).otherwise(F.col("id") % 3).alias("g"))
    found = {}
    for r in ranks.numbered(rows, "g", "n", [F.col("id")], [F.col("id")], 500).collect():
        found.setdefault(r.g, []).append(r.n)
    assert {g: sorted(n) for g, n in found.items()} == {g: list(range(len(n))) for g, n in found.items()}
    assert len(found[None]) == 400
