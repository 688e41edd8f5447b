"""The trees of a fitted model as flat arrays, for scoring small batches at low latency.

A job that scores with the MLlib model carries all its trees in its tasks, which takes longer than scoring a hundred rows. Here the
trees are read out once, broadcast as four arrays, and walked for all rows and trees of a batch together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import discard, fresh_dir
from . import model as ml

#: Rows times trees that are walked at once.
WALK = 1 << 21


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees, one after the other. A leaf is its own child on both sides; ``value`` holds the tree's weight."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    beyond: np.ndarray
    value: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of all trees for each row of features."""
        out = np.empty(len(x))
        step = max(1, WALK // max(1, len(self.roots)))
        for low in range(0, len(x), step):
            part = x[low:low + step]
            row, at = np.arange(len(part))[:, None], np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                at = np.where(part[row, self.feature[at]] <= self.threshold[at], self.below[at], self.beyond[at])
            out[low:low + step] = self.value[at].sum(axis=1)
        return out


def exported(model: ml.Fitted) -> Trees:
    """The trees of a model. They are saved and read back as a table, as that gives all nodes in one go."""
    spark = model.codes.sparkSession
    path = fresh_dir(spark, "trees")
    model.trees.stages[-1].write().save(path)
    weights = dict(tuple(r) for r in spark.read.parquet(f"{path}/treesMetadata").select("_1", "_3").collect())
    node = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", node["id"], node["prediction"], node["leftChild"], node["rightChild"], node["split"]["featureIndex"],
        F.get(node["split"]["leftCategoriesOrThreshold"], 0)).collect()  # at most 2 ** (depth + 1) nodes a tree
    discard(spark, path)
    nodes = sorted(map(tuple, nodes), key=lambda n: n[:2])
    tree = np.array([n[0] for n in nodes])
    first = np.searchsorted(tree, np.arange(len(weights)))
    own = np.arange(len(nodes))
    leaf = np.array([n[3] < 0 for n in nodes])
    below, beyond = (np.where(leaf, own, first[tree] + np.array([n[i] for n in nodes])) for i in (3, 4))
    return Trees(
        first, np.array([max(n[5], 0) for n in nodes]), np.array([0.0 if n[6] is None else n[6] for n in nodes]), below, beyond,
        np.array([n[2] * weights[n[0]] for n in nodes]), model.trees.stages[-1].getOrDefault("maxDepth"))


class BatchScorer:
    """Scores like :func:`emberlog.plans.model.score`, to the last digits but those that the order of a sum decides."""

    def __init__(self, model: ml.Fitted):
        self.model = model
        self.trees = model.codes.sparkSession.sparkContext.broadcast(exported(model))

    def score(self, df: DataFrame, target: str = "anomaly_score") -> DataFrame:
        """Adds the log odds; a column of that name is replaced. Missing numbers and unknown categories count as in training."""
        df, trees = df.drop(target), self.trees
        ready = ml.encoded(df, self.model)
        inputs = list(ml.inputs_of(self.model))
        keep = len(df.columns)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack([batch.column(keep + i).to_numpy(zero_copy_only=False) for i in range(len(inputs))])
                score = pa.array(2.0 * trees.value.margins(x))
                yield pa.RecordBatch.from_arrays([*batch.columns[:keep], score], names=[*batch.schema.names[:keep], target])

        rows = ready.select(*[F.col(c) for c in df.columns], *inputs)
        return rows.mapInArrow(run, StructType([*df.schema.fields, StructField(target, DoubleType())]))
