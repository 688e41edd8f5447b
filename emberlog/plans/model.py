"""Boosted trees over the feature contract, trained and applied by MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import attach
from ..session import checkpoint_folder, discard, fresh_dir
from ..sources import contract
from . import boosting

# Training parameters of the contract.
ROUNDS, RATE, SEED, TRAIN_PERCENT = 500, 0.1, 42, 80
DEPTH, MAX_BINS = 5, 128
# A value seen n times counts its own label mean n times and the mean of all rows SMOOTH times.
FOLDS, SMOOTH = 5, 10.0
# Up to so many values of all categories together, their codes are part of the plan: no join, no broadcast.
LOOKUP_VALUES = 512
# What stands for a missing number, next to a flag that says so.
MISSING = -1.0
_VECTOR = "_features"


@dataclass(frozen=True)
class Fitted:
    """Trees and what their categories are encoded by: (feature, value, code, n), one row per value."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    trees: PipelineModel
    codes: DataFrame
    prior: float
    lookup: dict[str, dict[str | None, float]] | None = None

    @property
    def rounds(self) -> int:
        return self.trees.stages[-1].getNumTrees


def _inputs(numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, Column]:
    """The columns that go into the vector, null-free: numbers and their flags, then codes."""
    out = {}
    for c in numeric:
        out[f"_{c}"] = F.coalesce(F.col(c).cast("double"), F.lit(MISSING))
        out[f"_{c}_missing"] = F.col(c).isNull().cast("double")
    return out | {f"_{c}": F.col(f"_code_{c}") for c in categorical}


def _lookup(codes: DataFrame) -> dict[str, dict[str | None, float]] | None:
    """The codes by feature and value, or None if there are more than LOOKUP_VALUES."""
    found = codes.select("feature", "value", "code").limit(LOOKUP_VALUES + 1).collect()
    if len(found) > LOOKUP_VALUES:
        return None
    out: dict[str, dict[str | None, float]] = {}
    for r in found:
        out.setdefault(r.feature, {})[r.value] = r.code
    return out


def _looked_up(rows: DataFrame, lookup: dict[str, dict[str | None, float]], categorical: Sequence[str], prior: float) -> DataFrame:
    """The columns of :func:`_with_codes` from literal maps."""
    out = {}
    for c in categorical:
        known = {v: code for v, code in lookup.get(c, {}).items() if v is not None}
        value = F.col(c).cast("string")
        code = F.when(value.isNull(), F.lit(lookup.get(c, {}).get(None, prior)))
        if known:
            pairs = [F.lit(x) for pair in known.items() for x in pair]
            code = F.coalesce(code, F.try_element_at(F.create_map(*pairs), value))
        out[f"_code_{c}"] = F.coalesce(code, F.lit(prior))
    return rows.withColumns(out)


def _with_codes(rows: DataFrame, codes: DataFrame, categorical: Sequence[str], prior: float, fold: Sequence[str] = ()) -> DataFrame:
    """Rows with ``_code_`` columns: the label mean of the value, of new values that of all rows. Null is a value."""
    for c in categorical:
        mine = codes.where(F.col("feature") == c).select(F.col("value").alias(f"_value_{c}"), *fold, F.col("code").alias(f"_code_{c}"),
                                                         F.col("n").alias("_n"))
        rows = attach(rows.withColumn(f"_value_{c}", F.col(c).cast("string")), mine, [f"_value_{c}", *fold], weight="_n")
        rows = rows.withColumn(f"_code_{c}", F.coalesce(f"_code_{c}", F.lit(prior))).drop(f"_value_{c}")
    return rows


def train(df: DataFrame, numeric: Sequence[str] = tuple(contract.NUMERIC_V2),
          categorical: Sequence[str] = tuple(contract.CATEGORICAL_V2), target: str = contract.TARGET,
          rounds: int = ROUNDS, rate: float = RATE, seed: int = SEED, depth: int = DEPTH,
          max_bins: int = MAX_BINS) -> Fitted:
    """Fit binary boosted trees on the labelled rows.

    A category is encoded by the smoothed mean of the label over all rows that have its value, whatever the
    number of values; for a training row, over the rows of the other folds, where folds are hashes of the row.
    The encoded columns are written once and removed afterwards; :mod:`emberlog.plans.boosting` grows the trees over them.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)  # trees cut their lineage there
    rows = df.where(F.col(target).isNotNull()).select(*numeric, *categorical, F.col(target).cast("double").alias(target))
    rows = rows.withColumn("_fold", F.pmod(F.xxhash64(*rows.columns), F.lit(FOLDS)))
    work = fresh_dir(spark, "train")
    rows.write.parquet(f"{work}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{work}/rows")
    prior = rows.agg(F.avg(target).alias("p")).first()["p"] or 0.0
    counts = reduce(DataFrame.unionByName, [
        rows.groupBy(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), "_fold").agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("ones"))
        for c in categorical])
    counts.write.parquet(f"{work}/counts")
    counts = spark.read.parquet(f"{work}/counts")
    totals = counts.groupBy("feature", "value").agg(F.sum("n").alias("all_n"), F.sum("ones").alias("all_ones"))
    codes = totals.select("feature", "value", ((F.col("all_ones") + SMOOTH * prior) / (F.col("all_n") + SMOOTH)).alias("code"),
                          F.col("all_n").alias("n"))
    path = fresh_dir(spark, "codes")
    codes.write.parquet(path)
    all_of = totals.select(F.col("feature").alias("_feature"), F.col("value").alias("_value"), "all_n", "all_ones")
    met = counts.join(all_of, F.col("feature").eqNullSafe(F.col("_feature")) & F.col("value").eqNullSafe(F.col("_value")))
    others = met.select("feature", "value", "_fold", "n", (
        (F.col("all_ones") - F.col("ones") + SMOOTH * prior) / (F.col("all_n") - F.col("n") + SMOOTH)).alias("code"))
    inputs = _inputs(numeric, categorical)
    ready = _with_codes(rows, others, categorical, prior, ["_fold"]).select(*[c.alias(n) for n, c in inputs.items()], target)
    ready.hint("rebalance").write.parquet(f"{work}/ready")
    assembler = VectorAssembler(inputCols=list(inputs), outputCol=_VECTOR)
    trees = GBTClassifier(featuresCol=_VECTOR, labelCol=target, maxIter=rounds, stepSize=rate, seed=seed,
                          maxDepth=depth, maxBins=max_bins)
    grown = boosting.fit(spark.read.schema(ready.schema).parquet(f"{work}/ready"), list(inputs), target, trees, assembler)
    fitted = PipelineModel(stages=[assembler, grown])
    discard(spark, work)
    codes = spark.read.schema(codes.schema).parquet(path)
    return Fitted(tuple(numeric), tuple(categorical), fitted, codes, prior, _lookup(codes))


def features_of(model: Fitted) -> list[str]:
    """Feature columns of a fitted model in their order."""
    return [*model.numeric, *model.categorical]


def inputs_of(model: Fitted) -> dict[str, Column]:
    """The columns that :func:`encoded` adds for the trees, in their order."""
    return _inputs(model.numeric, model.categorical)


def encoded(df: DataFrame, model: Fitted) -> DataFrame:
    """``df`` with the null-free inputs of the trees."""
    if model.lookup is None:
        rows = _with_codes(df, model.codes, model.categorical, model.prior)
    else:
        rows = _looked_up(df, model.lookup, model.categorical, model.prior)
    return rows.withColumns(inputs_of(model))


def _with(df: DataFrame, model: Fitted, **outputs) -> DataFrame:
    scored = model.trees.transform(encoded(df, model))
    return scored.select(*df.columns, *[c.alias(name) for name, c in outputs.items()])


def score(df: DataFrame, model: Fitted) -> DataFrame:
    """Adds ``anomaly_score``, the log odds. MLlib's raw margin is half of them."""
    return _with(df, model, anomaly_score=2.0 * vector_to_array("rawPrediction")[1])


def probability(df: DataFrame, model: Fitted) -> DataFrame:
    """Adds ``anomaly_probability``."""
    return _with(df, model, anomaly_probability=vector_to_array("probability")[1])


def nearest(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]], scale: Sequence[float],
            cluster: str = "cluster", target: str = "anomaly_score") -> DataFrame:
    """The number of the nearest centre and the distance to it, in units of ``scale``; of equally near ones the first.

    A missing number gives a null distance.
    """
    def distance(centre: Sequence[float]) -> Column:
        return F.sqrt(reduce(add, [F.pow(F.col(c) / F.lit(float(s) or 1.0) - F.lit(float(x)), 2) for c, x, s in zip(features, centre, scale)]))

    far = df.withColumn("_far", F.array(*[distance(c) for c in centres])).withColumn(target, F.array_min("_far"))
    return far.withColumn(cluster, (F.array_position("_far", F.col(target)) - 1).cast("int")).drop("_far")


def cluster_distance(df: DataFrame, features: Sequence[str], k: int = 8, seed: int = SEED,
                     target: str = "anomaly_score", normal: DataFrame | None = None) -> DataFrame:
    """Unsupervised score: distance to the centre of the row's cluster, features in units of their deviation.

    Rows in dense regions lie near a centre; rows far from all of them are outliers. The centres are fitted on
    ``normal`` rows, such as an analyst has cleared, or on all rows; no label is used otherwise.
    """
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip"),
              StandardScaler(inputCol="_raw", outputCol="_scaled"),
              KMeans(featuresCol="_scaled", predictionCol="_cluster", k=k, seed=seed)]
    fitted = Pipeline(stages=stages).fit((df if normal is None else normal).select(*features))
    return nearest(df, features, fitted.stages[2].clusterCenters(), fitted.stages[1].std, "_cluster", target).drop("_cluster")


def place(keys: Sequence[str], seed: int = SEED) -> Column:
    """A number from 0 to 99 that the keys of a row decide, the same in every engine that has md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def split(df: DataFrame, keys: Sequence[str], seed: int = SEED,
          percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of their key, so a row stays on its side however the data is laid out."""
    return df.where(place(keys, seed) < percent), df.where(place(keys, seed) >= percent)


def save(model: Fitted, path: str) -> None:
    """Trees, codes and a row with the features, side by side in one folder."""
    model.trees.write().overwrite().save(f"{path}/trees")
    model.codes.write.mode("overwrite").parquet(f"{path}/codes")
    about = [(list(model.numeric), list(model.categorical), model.prior)]
    (model.codes.sparkSession.createDataFrame(about, "numeric array<string>, categorical array<string>, prior double")
          .write.mode("overwrite").parquet(f"{path}/about"))


def load(spark: SparkSession, path: str, features: Sequence[str] = tuple(contract.FEATURES_V2)) -> Fitted:
    """A saved model; refused when its features are not the ones expected."""
    about = spark.read.parquet(f"{path}/about").first()
    codes = spark.read.parquet(f"{path}/codes")
    model = Fitted(tuple(about.numeric), tuple(about.categorical), PipelineModel.load(f"{path}/trees"), codes, about.prior, _lookup(codes))
    if features_of(model) != list(features):
        raise contract.ContractError(f"model takes {features_of(model)}")
    return model


def record_model(spark: SparkSession, path: str, version: str, model: Fitted, metrics: dict[str, float]) -> None:
    """Append one row about a trained model."""
    row = [(version, ",".join(features_of(model)), model.rounds, metrics)]
    (spark.createDataFrame(row, "version string, features string, rounds int, metrics map<string,double>")
          .withColumn("trained_at", F.current_timestamp()).write.mode("append").parquet(path))
