"""Input rows of the vector searches, their shards, and the pairing of shards with blocks of queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from realty_spark.llm.common import land


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, dims): one row per vec_id whose vector is whole; of rows that share a vec_id, the least vector."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("vec"))
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where("vec_id is not null and size(vec) > 0").where(whole)
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dims", F.size("vec"))


def parts(count: int, size: int) -> int:
    return max(1, -(-count // size))


def numbered(column: str, n: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(salt)), F.lit(n)).cast("int")


def every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks != 1 else column.chunk(0).flatten()
    return np.asarray(flat, dtype=np.float64).reshape(-1, dims)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of the shards' results for each query; a shard gives k rows to a query at most."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def landed_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    rows = land(usable(vectors, id_col, vec_col), "vectors")
    return rows, rows.count()
