"""Isolation forest: rows in sparse regions are parted from the others by few random splits.

Trees are grown on the driver from a sample of fixed size and scored as expressions, so scoring is one pass without a shuffle. All choices come
from hashes: which rows are sampled, which feature a node splits and where between its smallest and largest value. The forest
is the same on every run and however the rows are laid out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import Column, DataFrame, functions as F

TREES = 16
TREE_ROWS = 256
DEPTH = 8
SEED = 42

_EULER = 0.5772156649015329


@dataclass(frozen=True)
class Node:
    """A split (feature, at, below, from) or, without a feature, a leaf with the length of the path to it."""

    path: float = 0.0
    feature: int = -1
    at: float = 0.0
    below: "Node | None" = None
    beyond: "Node | None" = None


def expected_path(n: int) -> float:
    """Mean depth at which a search that fails ends among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (math.log(n - 1) + _EULER) - 2 * (n - 1) / n


def choice(tree: int, node: int, seed: int = SEED) -> tuple[int, float]:
    """Two numbers from the hash of a node: one to choose the feature by, one from 0 to 1 for the place of the split."""
    digest = md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
    return int(digest[:6], 16), int(digest[6:12], 16) / 16777216.0


def grow(rows: Sequence[Sequence[float]], tree: int, depth: int = DEPTH, node: int = 1, level: int = 0, seed: int = SEED) -> Node:
    """The subtree over some rows. A node's children have twice its number, and one more."""
    leaf = Node(path=level + expected_path(len(rows)))
    if level >= depth or len(rows) <= 1:
        return leaf
    pick, share = choice(tree, node, seed)
    feature = pick % len(rows[0])
    low, high = min(r[feature] for r in rows), max(r[feature] for r in rows)
    if low == high:
        return leaf
    at = low + (high - low) * share
    sides = [[r for r in rows if (r[feature] >= at) == beyond] for beyond in (False, True)]
    below, beyond = (grow(side, tree, depth, 2 * node + i, level + 1, seed) for i, side in enumerate(sides))
    return Node(feature=feature, at=at, below=below, beyond=beyond)


@dataclass(frozen=True)
class Forest:
    features: tuple[str, ...]
    trees: tuple[Node, ...]
    typical: float


def fit(df: DataFrame, features: Sequence[str], key: str, trees: int = TREES, tree_rows: int = TREE_ROWS, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """A forest over the rows whose key has the smallest hashes, ``trees`` times ``tree_rows`` of them, dealt to the trees in turn.

    Rows with a missing feature or key are not sampled. The sample has a fixed size and is all that reaches the driver.
    """
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    known = df.where(F.col(key).isNotNull()).select(place.alias("_place"), F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in features]).dropna()
    sample = [tuple(r)[2:] for r in known.orderBy("_place", "_key").limit(trees * tree_rows).collect()]
    grown = [grow(sample[t::trees], t, depth, seed=seed) for t in range(trees)]
    return Forest(tuple(features), tuple(grown), expected_path(-(-len(sample) // trees)))


def _path(node: Node, values: Sequence[Column]) -> Column:
    if node.below is None or node.beyond is None:
        return F.lit(node.path)
    return F.when(values[node.feature] < F.lit(node.at), _path(node.below, values)).otherwise(_path(node.beyond, values))


def score(df: DataFrame, forest: Forest, target: str = "anomaly_score") -> DataFrame:
    """Adds a score from 0 to 1: two to the power of minus the mean path over its typical length. Near 1: few splits part the row off.

    A row with a missing feature has no score. A forest grown on one row or none says 0.5 of all.
    """
    values = [F.col(c).cast("double") for c in forest.features]
    known = F.lit(True)
    for v in values:
        known = known & v.isNotNull()
    if not forest.typical:
        return df.withColumn(target, F.when(known, F.lit(0.5)))
    total = F.lit(0.0)
    for tree in forest.trees:
        total = total + _path(tree, values)
    return df.withColumn(target, F.when(known, F.pow(F.lit(2.0), -total / F.lit(len(forest.trees) * forest.typical))))
