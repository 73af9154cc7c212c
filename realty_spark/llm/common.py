"""Helpers shared by the training-data operators: input columns, landed tables, numbering."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.session import ensure_checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> None:
    """Executors get the package; the session gets its checkpoint folder (the cluster's, where one is set)."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that other columns of the input cannot clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared checkpoint folder; removed when the application's file systems close."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def land(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: evaluated once, lineage cut, survives lost executors."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    landed = df.sparkSession.read.schema(df.schema).parquet(path)
    landed.landed_path = path
    return landed


def discard(*landed: DataFrame) -> None:
    """Delete landed tables once all that reads them is landed itself."""
    for df in landed:
        jvm = df.sparkSession.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(df.landed_path)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def join_small(left: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_rows: int = 100_000) -> DataFrame:
    """Join a landed table; broadcast it only if it was counted to be small, else leave the strategy to the optimizer."""
    few = small.limit(max_rows + 1).count() <= max_rows
    return left.join(F.broadcast(small) if few else small, on, how)


def by_id(docs: DataFrame) -> DataFrame:
    """Range-partition (doc_id, text) rows into ascending doc_id order; equal ids are ordered by their text's hash.

    Null ids come first.  The text's hash in the key lets rows that share an id spread over partitions.
    """
    keyed = docs.withColumn("_tie", F.xxhash64("text"))
    return keyed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
