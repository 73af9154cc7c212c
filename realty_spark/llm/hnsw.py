"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, merged results.

Nearness is the largest inner product.  Inside a shard, vectors get one more
component so that all have equal length; then the inner product with a query
orders them as their distance does, and a metric graph can be built.

A node's layer is geometric in a hash of its id.  A shard holds a bounded
number of vectors, so a node's candidate links in a layer are found by blocked
products with the layer's nodes; of them the select-neighbours rule keeps
those that are nearer to the node than to a link kept before, then the nearest
of the rest.  Links run both ways, nearest first, and are stored as one flat
array of fixed width per layer.  Equal vectors are one node with the list of
their ids, so that copies cannot crowd out links.

The graphs are landed, one row per shard; blocks of queries meet each shard's
graph: greedy descent through the upper layers, then a beam of ``EF`` nodes in
the lowest.  Scores are inner products of the original vectors in double
precision; each shard gives k rows to a query, which are merged.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows without vec_id; rows that share a vec_id count once, with
their least vector.  Vectors of different lengths are not compared.  An empty
table gives no rows.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import land, read_table
from realty_spark.llm.vectors import best, every, landed_vectors, matrix, numbered, parts
from realty_spark.llm.words import mix

SHARD_VECTORS = 8192
BLOCK_QUERIES = 1024
LINKS = 16  # per node in the upper layers; twice that in the lowest
CANDIDATES = 64
EF = 128
STARTS = 16  # nodes above the lowest layer from which a beam starts, besides the one that the descent ends in
EXPAND = 4  # beam nodes of a query that are expanded in one step
ROWS = 512

RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _links(points: np.ndarray, nodes: np.ndarray, width: int) -> np.ndarray:
    """Flat neighbour array of one layer: for each of all points, ``width`` links into the layer, -1 where there is none."""
    out = np.full((len(points), width), -1, dtype=np.int32)
    m = min(CANDIDATES, len(nodes) - 1)
    if m < 1:
        return out
    own, pairs_u, pairs_v, pairs_s = points[nodes], [], [], []
    for a in range(0, len(nodes), ROWS):
        near = own[a:a + ROWS] @ own.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        top = np.argpartition(-near, m - 1, axis=1)[:, :m]
        sim = np.take_along_axis(near, top, axis=1)
        order = np.argsort(-sim, axis=1, kind="stable")
        top, sim = np.take_along_axis(top, order, axis=1), np.take_along_axis(sim, order, axis=1)
        between = np.matmul(own[top], own[top].transpose(0, 2, 1))
        kept = np.zeros(top.shape, dtype=bool)
        for j in range(m):
            shadowed = ((between[:, j, :j] > sim[:, j:j + 1]) & kept[:, :j]).any(axis=1) if j else np.zeros(len(top), dtype=bool)
            kept[:, j] = ~shadowed & (kept[:, :j].sum(axis=1) < width)
        rank = np.argsort(~kept, axis=1, kind="stable")[:, :width]  # kept links first, then the nearest of the rest
        pairs_u.append(np.repeat(np.arange(a, a + len(top)), rank.shape[1]))
        pairs_v.append(np.take_along_axis(top, rank, axis=1).ravel())
        pairs_s.append(np.take_along_axis(np.where(kept, sim + 4 * np.abs(sim).max() + 1, sim), rank, axis=1).ravel())
    u, v, s = np.concatenate(pairs_u), np.concatenate(pairs_v), np.concatenate(pairs_s)
    u, v, s = np.concatenate([u, v]), np.concatenate([v, u]), np.concatenate([s, s])
    order = np.lexsort((-s, u * len(nodes) + v))
    first = np.concatenate([[True], np.diff((u * len(nodes) + v)[order]) != 0])
    u, v, s = u[order][first], v[order][first], s[order][first]
    order = np.lexsort((-s, u))
    u, v = u[order], v[order]
    place = np.arange(len(u)) - np.searchsorted(u, u)
    fits = place < width
    out[nodes[u[fits]], place[fits]] = nodes[v[fits]]
    return out


def islands(layer: np.ndarray) -> np.ndarray:
    """The least node that each node is connected with by the links of a layer, in either direction."""
    u, slot = np.nonzero(layer >= 0)
    v = layer[u, slot]
    label = np.arange(len(layer))
    while True:
        least = label.copy()
        np.minimum.at(least, u, label[v])
        np.minimum.at(least, v, label[u])
        least = np.minimum(least, least[least])
        if np.array_equal(least, label):
            return label
        label = least


class Graph:
    """A shard's graph: vectors, flat neighbour arrays from the lowest layer up, an entry node, the beams' starts, and the ids of each node.

    Clusters of more similar points than a node has links are islands of the
    lowest layer.  The starts, the nodes above it and the least node of every
    island without one, hold a node of each island, so none is out of reach.
    """

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int, starts: np.ndarray, ids: np.ndarray, offsets: np.ndarray):
        self.vectors, self.layers, self.entry, self.starts, self.ids, self.offsets = vectors, layers, entry, starts, ids, offsets
        self.points = vectors.astype(np.float32)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> "Graph":
        order = np.argsort(ids)
        ids, vectors = ids[order], vectors[order]
        distinct, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        by_node = np.argsort(node, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(distinct)))])
        ids = ids[by_node]
        squares = (distinct * distinct).sum(axis=1)
        lifted = np.hstack([distinct, np.sqrt(np.maximum(0.0, squares.max() - squares))[:, None]]).astype(np.float32)
        unit = (mix(ids[offsets[:-1]].astype(np.uint64) + np.uint64(7)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
        level = np.floor(-np.log(np.maximum(unit, 1e-300)) / np.log(LINKS)).astype(int)
        layers = [_links(lifted, np.flatnonzero(level >= l), 2 * LINKS if l == 0 else LINKS) for l in range(int(level.max()) + 1)]
        island, above = islands(layers[0]), np.flatnonzero(level >= 1)
        starts = np.union1d(above, np.setdiff1d(island, island[above]))
        return cls(distinct, layers, int(level.argmax()), starts, ids, offsets)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, entry=self.entry, starts=self.starts, ids=self.ids, offsets=self.offsets,
                 **{f"layer{i}": x for i, x in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> "Graph":
        z = np.load(io.BytesIO(blob))
        layers = [z[f"layer{i}"] for i in range(sum(n.startswith("layer") for n in z.files))]
        return cls(z["vectors"], layers, int(z["entry"]), z["starts"], z["ids"], z["offsets"])

    def _descend(self, queries: np.ndarray) -> np.ndarray:
        at = np.full(len(queries), self.entry)
        sim = queries @ self.points[self.entry]
        for layer in self.layers[:0:-1]:
            moving = np.arange(len(queries))
            while len(moving):
                near = layer[at[moving]]
                s = np.where(near >= 0, np.einsum("qd,qmd->qm", queries[moving], self.points[near]), -np.inf)
                j = s.argmax(axis=1)
                top = s[np.arange(len(moving)), j]
                better = top > sim[moving]
                at[moving[better]] = near[np.arange(len(moving)), j][better]
                sim[moving[better]] = top[better]
                moving = moving[better]
        return at

    def search(self, queries: np.ndarray, ef: int = EF) -> np.ndarray:
        """For each query (single precision) the nodes of its final beam, -1 where there are fewer."""
        n, count = len(self.points), len(queries)
        ef = min(ef, n)
        met = np.zeros((count, n), dtype=bool)
        beam = np.full((count, ef), -1, dtype=np.int64)
        sims = np.full((count, ef), -np.inf, dtype=np.float32)
        done = np.zeros((count, ef), dtype=bool)
        first = self._descend(queries)
        near = queries @ self.points[self.starts].T
        near[self.starts[None, :] == first[:, None]] = -np.inf
        best_starts = np.argpartition(-near, min(STARTS, near.shape[1]) - 1, axis=1)[:, :min(STARTS, ef - 1)]
        width = 1 + best_starts.shape[1]
        beam[:, 0], beam[:, 1:width] = first, self.starts[best_starts]
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.points[first])
        sims[:, 1:width] = np.take_along_axis(near, best_starts, axis=1)
        beam[sims == -np.inf] = -1
        q, slot = np.nonzero(beam >= 0)
        met[q, beam[q, slot]] = True
        while True:
            waiting = np.where(done | (beam < 0), -np.inf, sims)
            pick = np.argpartition(-waiting, min(EXPAND, ef) - 1, axis=1)[:, :EXPAND]
            live = np.take_along_axis(waiting, pick, axis=1) > -np.inf
            if not live.any():
                return beam
            q, slot = np.nonzero(live)
            column = pick[q, slot]
            done[q, column] = True
            near = self.layers[0][beam[q, column]]
            key = np.unique((q[:, None] * n + near)[near >= 0])
            q, near = key // n, key % n
            fresh = ~met[q, near]
            q, near = q[fresh], near[fresh]
            if not len(q):
                continue
            met[q, near] = True
            s = np.einsum("id,id->i", queries[q], self.points[near])
            per = np.bincount(q, minlength=count)
            place = np.arange(len(q)) - (np.cumsum(per) - per)[q]
            more = np.full((count, int(per.max())), -1, dtype=np.int64)
            more_s = np.full(more.shape, -np.inf, dtype=np.float32)
            more[q, place], more_s[q, place] = near, s
            beam, sims = np.hstack([beam, more]), np.hstack([sims, more_s])
            done = np.hstack([done, np.zeros(more.shape, dtype=bool)])
            keep = np.argpartition(-sims, ef - 1, axis=1)[:, :ef]
            beam, sims, done = (np.take_along_axis(a, keep, axis=1) for a in (beam, sims, done))

    def nearest(self, own: int, query: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores): the k best ids of the beam's nodes but ``own``, by score in double precision, then id."""
        nodes = nodes[nodes >= 0]
        scores = self.vectors[nodes] @ query
        ids = [self.ids[self.offsets[v]:min(self.offsets[v + 1], self.offsets[v] + k + 1)] for v in nodes.tolist()]
        scores = np.repeat(scores, [len(i) for i in ids])
        ids = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        order = np.lexsort((ids, -scores))
        order = order[ids[order] != own][:k]
        return ids[order], scores[order]


def build_graphs(rows: DataFrame, shards: int) -> DataFrame:
    """(dims, shard, graph) of (vec_id, vec, dims) rows."""
    def run(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        graph = Graph.build(np.asarray(table.column("vec_id")), matrix(table.column("vec"), dims))
        return pa.table({"dims": pa.array([dims], pa.int32()), "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                         "graph": pa.array([graph.dump()], pa.binary())})
    return rows.select("dims", numbered("vec_id", shards, 1).alias("shard"), "vec_id", "vec").groupBy("dims", "shard").applyInArrow(
        run, "dims int, shard int, graph binary")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
                       shard_vectors: int = SHARD_VECTORS, block_queries: int = BLOCK_QUERIES, ef: int = EF) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query row; ``is_query`` speaks of vec_id."""
    rows, _ = landed_vectors(vectors, id_col, vec_col)
    rows = rows.where(F.exists("vec", lambda x: x != 0))
    queries = rows.where(is_query)
    shards, blocks = parts(rows.count(), shard_vectors), parts(queries.count(), block_queries)
    graphs = land(build_graphs(rows, shards), "graphs")
    left = graphs.select("dims", "shard", every(blocks).alias("block"), "graph")
    right = queries.select("dims", every(shards).alias("shard"), numbered("vec_id", blocks, 2).alias("block"), "vec_id", "vec")

    def run(key, stored: pa.Table, asked: pa.Table) -> pa.Table:
        if not stored.num_rows or not asked.num_rows:
            return RESULT.empty_table()
        graph = Graph.load(stored.column("graph")[0].as_py())
        ids, q = asked.column("vec_id").to_pylist(), matrix(asked.column("vec"), stored.column("dims")[0].as_py())
        out = [], [], []
        for a in range(0, len(ids), 256):
            beams = graph.search(q[a:a + 256].astype(np.float32), max(ef, k))
            for own, query, nodes in zip(ids[a:a + 256], q[a:a + 256], beams):
                got, scores = graph.nearest(own, query, nodes, k)
                out[0].append(np.full(len(got), own))
                out[1].append(got)
                out[2].append(scores)
        return pa.Table.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(out, RESULT.types)], schema=RESULT)
    key = ["dims", "shard", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")
    return best(found, k)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of each vector whose id is divisible by 20, against all vectors."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
