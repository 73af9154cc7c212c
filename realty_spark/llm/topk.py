"""Exact top-k inner products by the threshold algorithm over lists sorted by dimension.

Components become integers floor(scale * x).  Candidates are dealt to shards
of bounded size.  A shard keeps, for each dimension, its candidates sorted by
that component.  A query reads all its lists (from the top for positive query
components, from the bottom for negative ones) to doubling depths, computes
the full score of each candidate met for the first time, and stops when its
k-th best score is above the threshold: the inner product of the query with
the components at the current depth, which bounds every candidate not met.
Equal scores are settled by the smaller vec_id, so a k-th score equal to the
threshold reads on.  The shards' lists of k are merged.

Every query meets every shard, in blocks; a query's own vec_id is no
candidate.  Vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows without vec_id; rows that share a vec_id
count once, with their least vector.  Vectors of different lengths are not
compared.  Scores are exact while products of components stay below 2^53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import read_table
from realty_spark.llm.vectors import best, every, landed_vectors, matrix, numbered, parts

SHARD_VECTORS = 8192
BLOCK_QUERIES = 1024
FIRST_DEPTH = 8

RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class SortedLists:
    """A shard's candidates with one sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.rows = ids[order], rows[order]
        self.down = np.argsort(-self.rows, axis=0, kind="stable").T.copy()  # dimension x depth
        self.largest = float(np.abs(self.rows).max(initial=0.0))

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best candidates but ``own``, by score, then id."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        bound = self.largest * float(np.abs(query).max(initial=0.0)) * max(1, len(query))
        kind = np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else object
        rows, q = self._as(kind), query.astype(np.int64).astype(object) if kind is object else query.astype(kind)
        plus, minus = used[query[used] > 0], used[query[used] < 0]
        met = np.zeros(n, dtype=bool)
        mine = np.searchsorted(self.ids, own)
        if mine < n and self.ids[mine] == own:
            met[mine] = True
        at, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=kind)
        depth, read = min(FIRST_DEPTH, n), 0
        if not len(used):
            depth = n
        while True:
            before = met.copy()
            if len(used):
                met[self.down[plus, read:depth].ravel()] = True
                met[self.down[minus, n - depth:n - read].ravel()] = True
            else:
                met[:] = True
            new = np.flatnonzero(met & ~before)
            at, scores = np.concatenate([at, new]), np.concatenate([scores, rows[new] @ q])
            if len(scores) > k:
                least = np.sort(scores)[-k] if kind is object else np.partition(scores, len(scores) - k)[-k]
                keep = scores >= least
                at, scores = at[keep], scores[keep]
            if depth >= n or met.all():
                break
            if len(scores) >= k:
                edge = (query[plus] * self.rows[self.down[plus, depth - 1], plus]).sum() + (
                    query[minus] * self.rows[self.down[minus, n - depth], minus]).sum()
                if scores.min() > edge:
                    break
            read, depth = depth, min(n, 2 * depth)
        order = np.lexsort((at, -scores.astype(np.float64)))[:k] if kind is not object else sorted(
            range(len(at)), key=lambda i: (-scores[i], at[i]))[:k]
        return at[order], scores[order].astype(np.int64)

    def _as(self, kind) -> np.ndarray:
        name = f"_rows_{np.dtype(kind).name}"
        if not hasattr(self, name):
            setattr(self, name, self.rows.astype(np.int64).astype(object) if kind is object else self.rows.astype(kind))
        return getattr(self, name)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vec_col: str = "embedding", shard_vectors: int = SHARD_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query row; ``is_query`` speaks of vec_id."""
    rows, count = landed_vectors(vectors, id_col, vec_col)
    queries = rows.where(is_query)
    shards, blocks = parts(count, shard_vectors), parts(queries.count(), block_queries)
    left = rows.select("dims", numbered("vec_id", shards, 1).alias("shard"), every(blocks).alias("block"), "vec_id", "vec")
    right = queries.select("dims", every(shards).alias("shard"), numbered("vec_id", blocks, 2).alias("block"), "vec_id", "vec")

    def run(key, candidates: pa.Table, asked: pa.Table) -> pa.Table:
        if not candidates.num_rows or not asked.num_rows:
            return RESULT.empty_table()
        dims = candidates.column("dims")[0].as_py()
        lists = SortedLists(np.asarray(candidates.column("vec_id")), np.floor(scale * matrix(candidates.column("vec"), dims)))
        out = [], [], []
        for own, query in zip(asked.column("vec_id").to_pylist(), np.floor(scale * matrix(asked.column("vec"), dims))):
            at, scores = lists.top(own, query, k)
            out[0].append(np.full(len(at), own))
            out[1].append(lists.ids[at])
            out[2].append(scores)
        return pa.Table.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], schema=RESULT)
    key = ["dims", "shard", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score long")
    return best(found, k)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of each vector whose id is divisible by 20, against all vectors."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS z FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.z) + 1), lambda i: q.z[i] * c.z[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.z) = len(c.z)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
