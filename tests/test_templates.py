"""Templates against a tree in plain Python."""

import random
import re

import pytest

from emberlog.operators import joins, templates


def plain(messages, depth, fanout):
    def words(m):
        return ["<*>" if re.search("[0-9]", w) else w for w in re.split(r"[ \t\n\x0b\f\r]+", m or "") if w]

    rows = {tuple(words(m)): (str(len(words(m))),) for m in messages if words(m)}
    for place in range(depth):
        follow = {}
        for w, path in rows.items():
            if place < len(w):
                follow.setdefault(path, set()).add(w[place])
        rows = {w: path + (("<*>" if len(follow[path]) > fanout else w[place],) if place < len(w) else ()) for w, path in rows.items()}
    spots = {}
    for w, path in rows.items():
        for i in range(depth, len(w)):
            spots.setdefault((path, i), set()).add(w[i])
    whole = {w: " ".join(path[1:] + tuple("<*>" if len(spots[path, i]) > fanout else w[i] for i in range(depth, len(w)))) for w, path in rows.items()}
    return [whole.get(tuple(words(m))) for m in messages]


@pytest.mark.parametrize("depth,fanout,broadcast", [(3, 3, None), (1, 2, None), (0, 2, None), (3, 3, 0)])
def test_templates_equal_a_plain_tree(spark, depth, fanout, broadcast, monkeypatch):
    if broadcast is not None:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", broadcast)
        monkeypatch.setattr(joins, "HOT_KEYS", 20)
    rng = random.Random(4)
    names = ["ann", "bob", "cy", "dee", "eve"]
    makes = [lambda: f"user {rng.choice(names)} logged in from {rng.choice(names)}", lambda: f"took {rng.randrange(99)}ms for {rng.choice(['read', 'write'])}",
             lambda: f"{rng.choice(names)} left", lambda: "disk full", lambda: rng.choice(["", " \t\n", None, "one"]), lambda: f"user  {rng.choice(names)}\tquit now"]
    messages = [rng.choice(makes)() for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(messages)), "id int, message string")
    learnt = templates.learn(df, "message", depth, fanout)
    got = [r.template for r in templates.templated(df, "message", learnt).orderBy("id").collect()]
    assert got == plain(messages, depth, fanout)
    if depth == 3:
        assert "user <*> logged in from <*>" in got and "<*> left" in got and "took <*> for read" in got and None in got


def test_spread_and_order_do_not_matter(spark):
    messages = [(i, f"job {chr(97 + i % 7)} done by worker {i % 3} in {chr(97 + i % 5)}") for i in range(200)]
    schema = "id int, message string"
    once = spark.createDataFrame(messages, schema).coalesce(1)
    spread = spark.createDataFrame(messages[::-1], schema).repartition(13)
    a, b = [sorted(map(tuple, templates.templated(df, "message", templates.learn(df, "message", 2, 4)).collect())) for df in (once, spread)]
    assert a == b and {r[2] for r in a} == {"job <*> done by worker <*> in <*>"}


def test_unseen_messages_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "id int, message string")
    learnt = templates.learn(df, "message")
    new = spark.createDataFrame([("x y",), ("a c",), ("a b 7",), (None,)], "message string")
    assert [r.template for r in templates.templated(new, "message", learnt).collect()] == ["x y", "a c", "a b <*>", None]
    nothing = templates.learn(df.limit(0), "message")
    assert [r.template for r in templates.templated(df, "message", nothing).orderBy("id").collect()] == ["a b", None]
    assert templates.templated(df.limit(0), "message", learnt).collect() == []
