import random

import numpy as np
import xxhash

from emberlog.llm import simhash_dedup as S


def brute(rows):
    def print_of(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [print_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, p, least.get(find(i))) for i, (k, p) in enumerate(zip([k for k, _ in rows], prints))), key=repr)


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in S.near_duplicates(docs).collect()), key=repr)


def test_like_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(25):
        text = rng.choices(words, k=rng.choice((3, 30, 200, 900)))
        for copy in range(rng.choice((1, 2, 30))):
            near = list(text)
            for _ in range(rng.choice((0, 1, 3))):
                near[rng.randrange(len(near))] = rng.choice(words).upper()
            rows.append((len(rows) * 7 % 1009, "\n".join(near)))
    rows += [(5000, None), (5001, ""), (5002, " \t"), (None, "a b"), (None, "lonely text without any like it"), (5003, "A b"),
             rows[3], rows[3]]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([(1, "x y z q", 9, 9, 9, 9)], "doc_id long, text string, fp int, root int, least int, component_id int")
    assert [tuple(r) for r in S.near_duplicates(docs).select("doc_id", "component_id").collect()] == [(1, 1)]


def test_long_text_in_parts(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000)).encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "SHINGLES_AT_ONCE", 64)
    assert S.fingerprint(text) == whole


def test_spanning_links_join_chains_of_any_shape():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40, 400):
        seeds = rng.integers(0, 2**63, size=3, dtype=np.uint64)
        prints = np.unique(np.array([int(rng.choice(seeds)) ^ sum(1 << int(b) for b in rng.integers(0, 64, size=rng.integers(0, 6)))
                                     for _ in range(n)], np.uint64))
        links = S.spanning_links(prints, 4)
        assert len(links) < len(prints) and all((a ^ b).bit_count() <= 4 for a, b in links)
        assert _classes([int(x) for x in prints], links) == _classes(
            [int(x) for x in prints], [(int(a), int(b)) for a in prints for b in prints if int(a ^ b).bit_count() <= 4])


def _classes(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, groups.values()))


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(1000, 999)], "a long, b long")
    found = {r.node: r.root for r in S.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 1000: 999}
