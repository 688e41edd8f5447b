import random
import zlib
from collections import Counter

import pytest

from emberlog.llm import sharding as S


def check(rows, texts, n):
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    where, slots, load = {}, {}, [0] * n
    for r in rows:
        assert where.setdefault((r["size"], r.text_crc32), r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


@pytest.mark.parametrize("hot", [0, 900])
def test_groups_together_and_loads_near_equal(spark, hot, monkeypatch):
    from emberlog.llm import ranks
    monkeypatch.setattr(ranks, "SLICE_ROWS", 100)
    rng = random.Random(2)
    texts = [(i, "x" * rng.choice((3, 40, 700, 9000)) + str(rng.randrange(800))) for i in range(2500)]
    texts += [(10_000 + i, "hot text") for i in range(hot)] + [(1, None), (None, ""), (None, None), (2, "é"), texts[0], texts[0]]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in texts], "doc_id long, text string, shard int, bytes int")
    load = check(S.shards(docs, 5).collect(), texts, 5)
    assert max(load) - min(load) <= 20


def test_empty_and_tiny_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.doc_id, r.slot) for r in S.shards(docs).collect()] == [(1, 0)]
    assert S.shards(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_a_class_is_dealt_as_by_the_heap(seed):
    import heapq
    rng = random.Random(seed)
    classes = [(2**k, rng.randint(1, 400), 0) for k in range(8)]
    classes = [(s, n, s * n) for s, n, _ in classes]
    heap = [0] * 6
    for s, n, _ in sorted(classes, reverse=True):
        for _ in range(n):
            heapq.heapreplace(heap, heap[0] + s)
    load = [0] * 6
    for s, first, past, shard in S.schedule(classes, [0.0] * 6):
        load[shard] += s * (past - first)
    assert sorted(load) == sorted(heap)
