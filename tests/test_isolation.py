import math
import random

from emberlog.operators import isolation as I

FEATURES = ("a", "b")


def frame(spark, n=1500, odd=5):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1), rng.gauss(10, 2)) for i in range(n)] + [(n + i, 9.0 + i, -20.0 - 3 * i) for i in range(odd)]
    return rows, spark.createDataFrame(rows, "id long, a double, b double")


def walk(node, values):
    while node.below is not None:
        node = node.below if values[node.feature] < node.at else node.beyond
    return node.path


def test_scores_are_those_of_the_trees_and_find_what_is_apart(spark):
    rows, df = frame(spark)
    forest = I.fit(df, FEATURES, "id", trees=20, tree_rows=60)
    got = {r.id: r.anomaly_score for r in I.score(df, forest).collect()}
    for i, a, b in rows[::50]:
        mean = sum(walk(t, (a, b)) for t in forest.trees) / 20
        assert math.isclose(got[i], 2 ** (-mean / I.expected_path(60)))
    assert set(sorted(got, key=got.get)[-5:]) == {1500, 1501, 1502, 1503, 1504} and got[1504] > 0.6


def test_the_forest_does_not_depend_on_the_layout(spark):
    _, df = frame(spark, 400)
    assert I.fit(df, FEATURES, "id", 4, 50) == I.fit(df.repartition(7).orderBy("b"), FEATURES, "id", 4, 50)


def test_missing_values_few_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (None, 1.0, 1.0)], "id long, a double, b double")
    forest = I.fit(df, FEATURES, "id")
    assert [r.anomaly_score for r in I.score(df, forest).orderBy("a", "b").collect()] == [None, 0.5, 0.5]
    assert I.score(df, I.fit(df.limit(0), FEATURES, "id")).where("anomaly_score = 0.5").count() == 2
    same = spark.createDataFrame([(i, 1.0, 1.0) for i in range(40)], "id long, a double, b double")
    assert len({r.anomaly_score for r in I.score(same, I.fit(same, FEATURES, "id")).collect()}) == 1


def test_expected_paths():
    assert [I.expected_path(n) for n in (0, 1, 2)] == [0, 0, 1] and 10.2 < I.expected_path(256) < 10.3
