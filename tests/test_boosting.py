"""Trees grown over blocks of bytes are those that MLlib grows."""

import os

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from emberlog.plans import boosting

NAMES = ["a", "b", "c", "same"]


@pytest.fixture(scope="module")
def ready(spark):
    rows = [(float(i * 7919 % 6007), float(i * 104729 % 24), float(i * 31 % 5), 0.0) for i in range(6000)]
    df = spark.createDataFrame([(*r, float((r[0] > 3000) ^ (r[1] > 10) or r[2] == 3 and r[0] % 3 == 1)) for r in rows], [*NAMES, "label"])
    return df.repartition(3).persist()


def _fit(ready, monkeypatch, least, **options):
    monkeypatch.setattr(boosting, "LEAST_ROWS", least)
    monkeypatch.setattr(boosting, "CHUNK", 700)
    monkeypatch.setattr(boosting, "BLOCK", 900)
    assembler = VectorAssembler(inputCols=NAMES, outputCol="v")
    trees = GBTClassifier(featuresCol="v", labelCol="label", seed=1, **{"maxIter": 5, "stepSize": 0.1, "maxDepth": 4, "maxBins": 128} | options)
    model = boosting.fit(ready, NAMES, "label", trees, assembler)
    scored = model.transform(assembler.transform(ready)).select(*NAMES, F.col("rawPrediction").cast("string").alias("s"), "probability")
    return model, {tuple(r[:4]): (r.s, r.probability[1]) for r in scored.collect()}


@pytest.mark.parametrize("options", [{}, {"maxDepth": 1}, {"maxBins": 8}, {"maxIter": 1, "maxDepth": 5}])
def test_the_trees_are_those_of_mllib(ready, monkeypatch, options):
    was, a = _fit(ready, monkeypatch, 1 << 20, **options)
    now, b = _fit(ready, monkeypatch, 0, **options)
    assert now.getNumTrees == was.getNumTrees and list(now.treeWeights) == pytest.approx(list(was.treeWeights))
    assert now.numFeatures == 4 and now.getOrDefault("maxIter") == options.get("maxIter", 5)
    assert max(abs(a[k][1] - b[k][1]) for k in a) < 1e-9 and a.keys() == b.keys()


def test_large_tables_do_not_take_the_loop_of_mllib(ready, monkeypatch):
    """MLlib sees two rows, for the form of its models, whatever the size of the table."""
    seen, fit = [], GBTClassifier.fit

    def spy(self, df, params=None):
        seen.append((df.count(), self.getMaxIter()))
        return fit(self, df, params)

    monkeypatch.setattr(GBTClassifier, "fit", spy)
    _fit(ready, monkeypatch, 0)
    assert seen == [(2, 1)]


def test_many_tasks_and_a_cut_lineage_change_nothing(ready, monkeypatch):
    _, a = _fit(ready, monkeypatch, 0)
    monkeypatch.setattr(boosting, "FEW_TASKS", 1)
    monkeypatch.setattr(boosting, "CUT_LINEAGE", 2)
    spark = ready.sparkSession
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    kept = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(kept))
    _, b = _fit(ready, monkeypatch, 0)
    assert max(abs(a[k][1] - b[k][1]) for k in a) < 1e-9 and set(os.listdir(kept)) == before  # nothing stays in the folder


def test_rows_of_one_kind_and_odd_rows(spark, monkeypatch):
    one = spark.createDataFrame([(1.0, 2.0, 3.0, 0.0, 1.0)] * 50, [*NAMES, "label"])
    model, scores = _fit(one, monkeypatch, 0, maxIter=2)
    assert model.getNumTrees == 2 and len(scores) == 1 and next(iter(scores.values()))[1] > 0.5
    for bad in ((float("nan"), 0.0), (1.0, 2.0)):
        odd = one.union(spark.createDataFrame([(bad[0], 2.0, 3.0, 0.0, bad[1])], one.columns)).union(one.withColumn("a", F.lit(9.0)))
        with pytest.raises(Exception):
            _fit(odd, monkeypatch, 0, maxIter=1)


def test_thresholds():
    assert boosting.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 3).tolist() == [1.5, 2.5]
    assert boosting.thresholds(np.array([-0.0, 0.0]), 4).tolist() == []
    assert boosting.thresholds(np.arange(8.0), 4).tolist() == [1.5, 3.5, 5.5]
