"""From raw documents to packed training sequences, in five stages over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlog.llm import decontaminate, packing, quality_classifier, simhash_dedup, substring_dedup
from emberlog.llm.text import table
from emberlog.session import fresh_dir, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good; it learns from the labels of these documents.

    Null and empty texts have the score of the bias alone and stay or go together. Each of several equal rows stays or goes by its
    text. An empty table gives an empty result, columns other than those of documents are dropped.
    """
    model = quality_classifier.trained(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs.select(*COLUMNS), model).where(F.col("score") >= quality_classifier.THRESHOLD).select(*COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row: that with the smallest doc_id, then the smallest text hash.

    An id counts as larger than all others where it is null. Rows that repeat the chosen one are reduced to one.
    """
    docs = docs.select(*COLUMNS)
    rows = simhash_dedup.near_duplicates(docs).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n")).alias("first")
    chosen = stored(rows.groupBy("root").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"), "first.n"))

    def of(some: DataFrame) -> DataFrame:
        mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
        return docs.join(some, mine, "left_semi")

    kept = of(chosen.where("n = 1"))
    if chosen.where("n > 1").isEmpty():
        return kept
    again = of(chosen.where("n > 1")).groupBy("doc_id", F.xxhash64("text")).agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return kept.unionByName(again.select("row.*"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words or more that occur more than once.

    Every row stays. A row that loses no word stays as it is; of others the text loses these words, and n_chars is counted anew. Null
    and empty texts stay; a text may become empty. Equal rows with 35 words or more are each other's repeats. An empty
    table gives an empty result, columns other than those of documents are dropped.
    """
    cut = substring_dedup.without_repeats(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words and stay, as do all rows if the benchmark is empty or has no words. Equal rows stay or go together. An
    empty table gives an empty result, columns other than those of documents are dropped.
    """
    scanned = decontaminate.contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return scanned.where(F.col("found.n_hit") == 0).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1,024 tokens.

    A null text is packed like an empty one: as its end token. Every row is packed, also where rows or ids repeat, or the id is null. An
    empty table gives an empty result, columns other than doc_id and text are not looked at.
    """
    return packing.packed(docs, packing.public_tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The classifier and the packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the one before kept; results between stages lie in the shared folder as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = fresh_dir(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
