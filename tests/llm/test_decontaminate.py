import re

from emberlog.llm import decontaminate as D

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, items, width=10):
    wins = {}
    for item, text in items:
        words = PATTERN.findall(lower(text))
        for i in range(max(1, len(words) - width + 1) if words and item is not None else 0):
            wins.setdefault(tuple(words[i:i + width]), set()).add(str(item))
    out = []
    for k, text in rows:
        places = list(PATTERN.finditer(lower(text)))
        words = [m[0] for m in places]
        hit, ids = set(), set()
        for win, own in wins.items():
            for i in range(len(words) - len(win) + 1):
                if tuple(words[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    ids |= own
        out.append((k, len(words), len(hit), sorted(ids)))
    return sorted(out, key=repr)


ITEMS = [(1, "Was ist Größe? one two three four five six seven eight nine"), (2, "short One"), (3, ""), (4, None), (None, "no id here"),
         (10, "b b b b b b b b b b b"), (2, "short One"), (11, "one two three four five six seven eight nine ten")]
ROWS = [(0, "x SHORT-one y, short.one"), (1, None), (2, ""), (3, "B b b b b b b b b b b b b c"), (4, "it was IST größe ... one"),
        (5, "ist Größe one\ttwo three four five six seven, eight; nine"), (5, "again one two three four five six seven eight nine ten"),
        (None, "shortone"), (6, "ist größe one two three four five six seven eight nine é")]


def run(spark, rows, items):
    docs = spark.createDataFrame([(k, t, "f", 0) for k, t in rows], "doc_id long, text string, found string, items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.contamination(docs, bench)
    assert "items" in found.columns
    return sorted(((r.doc_id, r.found.n_words, r.found.n_hit, list(r.found["items"])) for r in found.collect()), key=repr)


def test_like_brute_force(spark):
    assert run(spark, ROWS, ITEMS) == brute(ROWS, ITEMS)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(D, "blocks", lambda b: iter([[(str(k), t)] for k, t in ITEMS if k is not None]))
    assert run(spark, ROWS, ITEMS) == brute(ROWS, ITEMS)


def test_blocks_are_bounded(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted(i for b in D.blocks(bench, 20) for i, _ in b) == ["1", "10", "11", "2", "3", "4"]


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, ROWS, []) == brute(ROWS, [])


def test_spans_point_into_the_original():
    text = "Ah! Größe, IST: one"
    n, hit, _ = D.hits(text, D.automaton([("1", "größe ist")], 10))
    assert [text.encode()[a:b].decode() for a, b in D.spans(text, hit)] == ["Größe, IST"]
    assert n == 4
