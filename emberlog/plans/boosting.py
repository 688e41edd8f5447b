"""Training of boosted trees on tables that MLlib's loop takes too long for.

MLlib's GBTClassifier visits all rows through objects at each level of each tree. Here rows are kept as blocks of
bytes, one bin number per feature. For each level every task adds up its own rows by node and bin, and the driver adds these sums,
whose size depends on bins and nodes only, and chooses the splits. The smaller child of a split is counted, its sibling is what remains
of the parent. Thresholds, gains, losses and leaves are those of MLlib, and the trees are read back as its model.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Row, functions as F

from ..session import discard, fresh_dir

# As in MLlib: thresholds come from max_bins ** 2 rows, but at least so many; a node of less variance than EPSILON is a leaf.
SAMPLE, EPSILON = 10000, np.finfo(float).eps
#: Gains that differ by less are equal, and the first feature is taken: which one does not depend on how rows are laid out.
TIE = 1e-10
#: Rows per block, and rows that a task works on at once, few enough for the cache of a core.
BLOCK, CHUNK = 1 << 17, 1 << 15
#: Sums of more tasks than this are added by tasks first. After so many trees, margins go to the checkpoint folder.
FEW_TASKS, CUT_LINEAGE = 32, 50
#: Below so many rows MLlib's own loop is faster, as its jobs start no Python.
LEAST_ROWS = 1 << 20
# Places in a node, and a node that has not been looked at.
BELOW, FEATURE, CUT = 5, 7, 8
LEAF = [0.0, 0.0, [], 0, -1.0, -1, -1, -1, -1]
_NODES = "tree int, id int, prediction double, impurity double, stats array<double>, n bigint, gain double, below int, beyond int, feature int, threshold double"


def thresholds(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Between all neighbours if the values are few, otherwise where about the same number of rows lies between two."""
    found, counts = np.unique(values + 0.0, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) < max_bins:
        return middles
    stride, out = len(values) / max_bins, []
    seen, target = counts[0], stride
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def blocks(ready: DataFrame, features: Sequence[str], target: str, cuts: Sequence[np.ndarray], tasks: int) -> RDD:
    """The rows as (bins by feature, labels as -1 and 1, margins) of up to BLOCK rows, dealt evenly over the tasks."""
    kind = np.min_scalar_type(max(map(len, cuts)) + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            bins = np.empty((len(cuts), batch.num_rows), kind)
            for i, cut in enumerate(cuts):
                values = batch.column(i).to_numpy(zero_copy_only=False)
                if np.isnan(values).any():
                    raise ValueError(f"feature {batch.schema.names[i]} is not a number in some row")
                bins[i] = np.searchsorted(cut, values)
            label = batch.column(len(cuts)).to_numpy(zero_copy_only=False)
            if not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("labels are 0 and 1")
            held.append((bins, (2 * label - 1).astype(np.int8)))
            n += batch.num_rows
            if n >= BLOCK:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    def block(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bins, signs = (np.concatenate(parts, axis=-1) for parts in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (bins, signs)], names=["bins", "signs"])

    def state(row: Row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sign = np.frombuffer(row.signs, np.int8)
        return np.frombuffer(row.bins, kind).reshape(len(cuts), len(sign)), sign, np.zeros(len(sign))

    rows = ready.select(*features, target).repartition(tasks)
    return rows.mapInArrow(run, "bins binary, signs binary").rdd.map(state)


def _descend(bins: np.ndarray, at: np.ndarray, nodes: Sequence[list]) -> None:
    """Rows go on from the root, node 0, to the last nodes that there are."""
    for me, node in enumerate(nodes):
        if node[FEATURE] >= 0:
            here = at == me
            beyond = bins[node[FEATURE]] > node[CUT]
            # Children are neighbours, so the one on the right is one further.
            at += here * (node[BELOW] - me + beyond).astype(at.dtype)


def _residual(sign: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree learns: labels at first, then the negative gradient of 2 log(1 + exp(-2yF))."""
    if first:
        return sign.astype(float)
    with np.errstate(over="ignore"):
        return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def _counted(state: Iterable[tuple[np.ndarray, ...]], nodes: Sequence[list], slot: np.ndarray, slots: int, width: int, first: bool, count: bool) -> list[np.ndarray]:
    """Sums of the residuals, and their number if asked for, by feature, slot and bin over the rows whose node has a slot; squares by slot."""
    out: list[np.ndarray] = []
    for bins, sign, margin in state:
        if not out:
            shape = len(bins), slots * width
            out = [np.zeros(slots), np.zeros(shape), *([np.zeros(shape, np.int64)] if count else [])]
        for low in range(0, len(sign), CHUNK):
            part = bins[:, low:low + CHUNK]
            residual, picked = _residual(sign[low:low + CHUNK], margin[low:low + CHUNK], first), None
            if len(nodes) > 1:
                at = np.zeros(len(residual), np.min_scalar_type(len(nodes)))
                _descend(part, at, nodes)
                mine = slot.take(at)
                picked = np.flatnonzero(mine >= 0)
                mine, residual = mine.take(picked), residual.take(picked)
                base = mine * width
                out[0] += np.bincount(mine, residual * residual, slots)
            else:
                out[0] += residual @ residual
            for i, column in enumerate(part):
                key = column.astype(np.intp) if picked is None else base + column.take(picked)
                out[1][i] += np.bincount(key, residual, slots * width)
                if count:
                    out[2][i] += np.bincount(key, minlength=slots * width)
    return out


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)] if a and b else a or b


def _totals(state: RDD, nodes: Sequence[list], slot: np.ndarray, slots: int, width: int, first: bool, count: bool) -> tuple[np.ndarray, ...]:
    """Sums and counts as (slot, feature, bin) and squares by slot, over all tasks."""
    parts = state.mapPartitions(lambda blocks: [_counted(blocks, nodes, slot, slots, width, first, count)])
    squares, *rest = parts.treeReduce(_added) if parts.getNumPartitions() > FEW_TASKS else reduce(_added, parts.collect())
    shaped = [a.reshape(len(a), slots, width).transpose(1, 0, 2) for a in rest]
    return shaped[0], shaped[1] if count else None, squares


def _moved(block: tuple[np.ndarray, ...], nodes: Sequence[list], value: np.ndarray) -> tuple[np.ndarray, ...]:
    """The block with the margins that the values of a new tree make."""
    bins, sign, margin = block
    margin = margin.copy()
    for low in range(0, len(sign), CHUNK):
        at = np.zeros(min(CHUNK, len(sign) - low), np.min_scalar_type(len(nodes)))
        _descend(bins[:, low:low + CHUNK], at, nodes)
        margin[low:low + CHUNK] += value.take(at)
    return bins, sign, margin


def _best(sums: np.ndarray, counts: np.ndarray, n: np.ndarray, total: np.ndarray, cuts: Sequence[np.ndarray]) -> tuple[np.ndarray, ...]:
    """For each node the gain in variance of its best split, its feature and its place among the cuts; no gain where there is none."""
    left_n, left = np.cumsum(counts, 2)[:, :, :-1], np.cumsum(sums, 2)[:, :, :-1]
    if not left.size:
        return np.zeros(len(n)), np.zeros(len(n), int), np.zeros(len(n), int)
    n, total = n[:, None, None], total[:, None, None]
    right_n, right = n - left_n, total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left * left / left_n + right * right / right_n - total * total / n) / n
    allowed = (left_n > 0) & (right_n > 0) & (np.arange(left_n.shape[2]) < np.array([len(c) for c in cuts])[:, None])
    gain = np.where(allowed, gain, 0.0)
    place = gain.argmax(2)
    top = np.take_along_axis(gain, place[:, :, None], 2)[:, :, 0]
    feature = (top >= top.max(1, keepdims=True) * (1 - TIE)).argmax(1)
    node = np.arange(len(top))
    return top[node, feature], feature, place[node, feature]


def _tree(state: RDD, cuts: Sequence[np.ndarray], depth: int, first: bool, known: np.ndarray | None) -> tuple[list[list], np.ndarray]:
    """Nodes of one tree, level by level, and the counts of its root, which are those of every tree.

    A node is [prediction, impurity, [n, sum, squares], n, gain, below, beyond, feature, place of the cut].
    """
    width = max(map(len, cuts)) + 1
    sums, counts, squares = _totals(state, [], np.zeros(1, int), 1, width, first, known is None)
    root = counts = counts if known is None else known
    # Any feature's bins add up to the whole node.
    n, total = counts[:, 0].sum(1), sums[:, 0].sum(1)

    def node(k: int) -> list:
        mean = total[k] / n[k]
        return [float(mean), float(max(0.0, squares[k] / n[k] - mean * mean)), [float(n[k]), float(total[k]), float(squares[k])], int(n[k]), -1.0, -1, -1, -1, -1]

    nodes, level = [node(0)], [0]
    for deep in range(depth):
        gain, feature, place = _best(sums, counts, n, total, cuts)
        split = [k for k in range(len(level)) if gain[k] > 0 and nodes[level[k]][1] >= EPSILON]
        if not split:
            break
        children, base = [], len(nodes)
        slot = np.full(base + 2 * len(split), -1)
        for j, k in enumerate(split):
            f, p = int(feature[k]), int(place[k])
            nodes[level[k]][4:] = [float(gain[k]), base + 2 * j, base + 2 * j + 1, f, p]
            left_n, left = counts[k, f, :p + 1].sum(), sums[k, f, :p + 1].sum()
            children += [(left_n, left), (n[k] - left_n, total[k] - left)]
            slot[base + 2 * j + (left_n > n[k] - left_n)] = j
        if deep == depth - 1:
            # Leaves need their mean only, which the split knows.
            nodes += [[float(s / m), 0.0, [float(m), float(s), 0.0], int(m), -1.0, -1, -1, -1, -1] for m, s in children]
            break
        part, part_n, part_squares = _totals(state, [*nodes, *[LEAF] * len(children)], slot, len(split), width, first, True)
        other_n = counts[split] - part_n
        other, other_squares = np.where(other_n > 0, sums[split] - part, 0.0), squares[split] - part_squares
        right = slot[base + 1::2] >= 0  # the child that was counted is the right one

        def paired(counted: np.ndarray, rest: np.ndarray) -> np.ndarray:
            turned = right.reshape(-1, *[1] * (counted.ndim - 1))
            return np.stack([np.where(turned, rest, counted), np.where(turned, counted, rest)], 1).reshape(-1, *counted.shape[1:])

        sums, counts, squares = paired(part, other), paired(part_n, other_n), paired(part_squares, other_squares)
        n, total = counts[:, 0].sum(1), sums[:, 0].sum(1)
        level = list(range(base, base + len(children)))
        nodes += [node(k) for k in range(len(level))]
    return nodes, root


def grow(ready: DataFrame, features: Sequence[str], target: str, cuts: Sequence[np.ndarray], rounds: int, rate: float, depth: int) -> list[tuple]:
    """Nodes of all trees, at most 2 ** (depth + 1) each. Features that take one value take no part, but keep their number."""
    kept = [i for i, c in enumerate(cuts) if len(c)] or [0]
    mine = [cuts[i] for i in kept]
    context = ready.sparkSession.sparkContext
    state = blocks(ready, [features[i] for i in kept], target, mine, context.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    root, out, stale, files = None, [], [], []
    for tree in range(rounds):
        nodes, root = _tree(state, mine, depth, tree == 0, root)
        for old in stale:  # the job above has read it for the last time
            old.unpersist()
        if state.isCheckpointed():
            files.append(state.getCheckpointFile())
            for file in files[:-1]:  # nothing goes back behind the last one
                discard(ready.sparkSession, file)
        value = np.array([v[0] * (1.0 if tree == 0 else rate) for v in nodes])
        out += [(tree, i, *v[:FEATURE], kept[v[FEATURE]] if v[FEATURE] >= 0 else -1, float(mine[v[FEATURE]][v[CUT]]) if v[FEATURE] >= 0 else None)
                for i, v in enumerate(nodes)]
        if tree < rounds - 1:
            moved = state.map(partial(_moved, nodes=nodes, value=value)).persist(StorageLevel.MEMORY_AND_DISK)
            if tree % CUT_LINEAGE == CUT_LINEAGE - 1:
                moved.checkpoint()
            state, stale = moved, [state]
    state.unpersist()
    for file in files[-1:]:
        discard(ready.sparkSession, file)
    return out


def fit(ready: DataFrame, features: Sequence[str], target: str, trees: GBTClassifier, assembler: VectorAssembler) -> GBTClassificationModel:
    """What ``trees`` fits on null-free numbers and a label of 0 and 1, but for splits of equal gain and the sample that thresholds come from."""
    spark = ready.sparkSession
    rounds, rate, depth, max_bins, seed = (trees.getOrDefault(p) for p in ("maxIter", "stepSize", "maxDepth", "maxBins", "seed"))
    n = ready.count()
    if n < LEAST_ROWS:
        return trees.fit(assembler.transform(ready))
    max_bins = min(max_bins, n)
    wanted = max(max_bins * max_bins, SAMPLE)
    sample = (ready if wanted >= n else ready.sample(False, wanted / n, seed)).toArrow()
    cuts = [thresholds(sample.column(c).to_numpy(), max_bins) for c in features]
    nodes = grow(ready, features, target, cuts, rounds, rate, depth)

    # MLlib writes and reads models as tables. A model of one round gives their form, the nodes from above their rows.
    form, path = fresh_dir(spark, "form"), fresh_dir(spark, "grown")
    trees.copy({trees.maxIter: 1}).fit(assembler.transform(ready.limit(2))).write().save(form)
    about = json.loads(spark.read.text(f"{form}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["maxIter"] = rounds
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    kinds = spark.read.parquet(f"{form}/treesMetadata")
    tree = kinds.first()
    spark.createDataFrame([(i, tree[1], 1.0 if i == 0 else rate) for i in range(rounds)], kinds.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    data = spark.read.parquet(f"{form}/data").schema
    rows = spark.createDataFrame(nodes, _NODES)
    split = F.struct(F.col("feature").alias("featureIndex"), F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    values = {"id": F.col("id"), "prediction": F.col("prediction"), "impurity": F.col("impurity"), "impurityStats": F.col("stats"), "rawCount": F.col("n"),
              "gain": F.col("gain"), "leftChild": F.col("below"), "rightChild": F.col("beyond"), "split": split}
    node = F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in data["nodeData"].dataType.fields])
    rows.select(F.col("tree").alias("treeID"), node.alias("nodeData")).select(*data.names).coalesce(1).write.parquet(f"{path}/data")
    model = GBTClassificationModel.load(path)
    discard(spark, form)
    discard(spark, path)
    return model
