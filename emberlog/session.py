"""Sessions, and the shared folder that intermediate results are kept in."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "emberlog", master: str | None = None, **conf: str) -> SparkSession:
    """A session for scripts and tests. On a cluster, spark-submit supplies master and memory."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. A session whose one process is the driver may fall back to a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    path = spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="emberlog-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing uses yet."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure that checkpoints go to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept on shared storage, so that a lost executor costs a re-read only."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder on any storage that Spark reaches; its owner calls this when no frame reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def there(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on any storage that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stored(df: DataFrame) -> DataFrame:
    """Like :func:`pinned`, as a Parquet table: for frames of many rows that several passes read in part."""
    path = fresh_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
