"""Mixing sources to target weights: Pfair windows and earliest deadline first.

Each source's documents, in doc_id order, form blocks.  Block j (from 1) of a
source with the share w of the slots has the release floor((j - 1) / w) and
the deadline ceil(j / w); each slot takes the released block with the earliest
deadline (ties: the source's name).  Shares are exact fractions of the target
weights, so after any number of slots each source has had less than one block
more or less than its target, however long the stream is.

The schedule is a table of one row per block.  Slots follow from one another,
so one task makes it from the sources' block counts, in memory for the sources
alone, with the place in the stream of each block's first row; rows find their
slot and position by a join.

A source that has run out has no more blocks: the others go on within their
windows, and slots in which none is released stay unused.  Sources of weight
zero follow after all others, evenly.  No row is dropped or repeated.  A null
source is a source of its own; null doc_ids come first in their source.  Rows
that share a doc_id are separate rows.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from realty_spark.llm.common import join_small, land, read_table
from realty_spark.llm.worker import tidied

BLOCK_DOCS = 16
PERIOD = 1024
PLAN_ROWS = 10_000  # rows of the plan in one batch
NO_SOURCE = "0"  # names get a leading "1", so no name equals it


def number_rows(df: DataFrame, order: list[str], number: str, group: str | None = None) -> DataFrame:
    """Add the row's position (from 0) in the given order, within each ``group`` (non-null, the first column of the order).

    Rows are range-partitioned and numbered in each partition; partition counts
    give the offsets, so a group of any size is spread over many tasks.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType([*ordered.schema.fields, StructField("_part", LongType()), StructField("_at", LongType())])
    column = ordered.columns.index(group) if group else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, next_at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if column is None:
                at = np.arange(batch.num_rows) + next_at
                next_at += batch.num_rows
            else:
                names = batch.column(column).to_pylist()
                change = np.array([a != b for a, b in zip(names, [last, *names])])
                begins = np.maximum.accumulate(np.where(change, np.arange(len(names)), 0))
                at = np.arange(len(names)) - begins
                head = len(names) if not change.any() else int(change.argmax())
                at[:head] += next_at
                last, next_at = names[-1], int(at[-1]) + 1
            arrays = [*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int64()), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
    rows = land(ordered.mapInArrow(run, schema), "numbered")
    keys = ["_part"] + ([group] if group else [])
    before = Window.orderBy("_part") if group is None else Window.partitionBy(group).orderBy("_part")  # a row per partition
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).withColumn(
        "_before", F.coalesce(F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_rows")
    return join_small(rows, land(counts, "offsets"), keys).withColumn(number, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def quotas(weights: dict[str, float], period: int = PERIOD) -> tuple[dict[str, int], int]:
    """Slots of each source in a period of that many slots (more, if sources are many): at least one, largest remainders first."""
    names = sorted(weights)
    period = max(period, 4 * len(names))
    total = sum(Fraction(weights[n]) for n in names)
    share = {n: Fraction(weights[n]) / total * (period - len(names)) for n in names}
    out = {n: 1 + int(share[n]) for n in names}
    for n in sorted(names, key=lambda n: (int(share[n]) - share[n], n))[:period - sum(out.values())]:
        out[n] += 1
    return out, period


def dealt(shares: dict[str, int], total: int, blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block from 0, release, deadline, slot) of all blocks, by slot; a source's share is its part of the total."""
    def job(name: str, j: int) -> tuple[int, int]:
        n = shares[name]
        return j * total // n, -(-(j + 1) * total // n)
    waiting = [(0, n, 0) for n in sorted(shares) if blocks[n]]
    ready: list[tuple[int, str, int, int]] = []
    t = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            release, name, j = heapq.heappop(waiting)
            heapq.heappush(ready, (job(name, j)[1], name, j, release))
        deadline, name, j, release = heapq.heappop(ready)
        yield name, j, release, deadline, t
        if j + 1 < blocks[name]:
            heapq.heappush(waiting, (job(name, j + 1)[0], name, j + 1))
        t += 1


def schedule(slots: dict[str, int], period: int) -> list[tuple[str, int, int, int, int]]:
    """The blocks of one period of whole slots, by slot."""
    return list(dealt(slots, period, slots))


def whole(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights."""
    parts = {n: Fraction(w) for n, w in weights.items()}
    unit = math.lcm(*{p.denominator for p in parts.values()})
    return {n: int(p * unit) for n, p in parts.items()}


def plan(weights: dict[str, float], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """The schedule of all blocks; sources of weight zero come after the others, evenly."""
    base = 0
    for part in ({n: w for n, w in weights.items() if w > 0}, {n: 1 for n, w in weights.items() if w == 0}):
        shares, end = whole(part), base
        for name, j, release, deadline, t in dealt(shares, sum(shares.values()), blocks):
            end = base + t + 1
            yield name, j, base + release, base + deadline, end - 1
        base = end


def source_key(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit(NO_SOURCE)).otherwise(F.concat(F.lit("1"), F.col(column).cast("string")))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source",
        payload: list[str] | None = None, block_docs: int = BLOCK_DOCS, period: int | None = None) -> DataFrame:
    """(doc_id, source, row, block, release, deadline, slot, position) of every row; ``row`` holds the payload columns.

    Without weights, a source's target is the square root of its share, which
    lifts small sources against large ones.  Sources that the weights lack get
    the least weight.  With a period, weights are first rounded to whole slots
    of it, at least one.
    """
    spark = docs.sparkSession
    named = None if weights is None else {NO_SOURCE if k is None else f"1{k}": float(v) for k, v in weights.items()}
    if named is not None and not all(0 <= v < math.inf for v in named.values()):
        raise ValueError("weights must be finite and not negative")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].alias("source"),
                       F.struct(F.lit(1).alias("_"), *[docs[c] for c in payload or []]).alias("row"))
    rows = rows.withColumn("key", source_key("source"))
    if payload:  # rows get their places by number, without the payload, which moves once for the join on the number
        rows = land(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {k: n for batch in batches for k, n in zip(*(c.to_pylist() for c in batch.columns))}
        if named is None:
            target = {k: float(n) ** 0.5 for k, n in count.items()}
        else:
            target = {k: named.get(k, min(named.values())) for k in count}
        if period and target:
            target = quotas(target, period)[0]
        blocks = plan(target, {k: -(-n // block_docs) for k, n in count.items()})
        first = 0  # place of the block's first row; blocks come in the order of their slots
        while part := list(islice(blocks, PLAN_ROWS)):
            begins = []
            for key, block, *_ in part:
                begins.append(first)
                first += min(block_docs, count[key] - block * block_docs)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate([*zip(*part), begins])],
                                             names=["key", "block", "release", "deadline", "slot", "first"])
    counts = rows.groupBy("key").agg(F.count("*").alias("n")).repartition(1)  # a row per source
    table = land(counts.mapInArrow(tidied(run), "key string, block long, release long, deadline long, slot long, first long"), "plan")

    order = ["key", "doc_id", *(["_row"] if payload else [])]
    ranked = number_rows(rows.drop("row") if payload else rows, order, "nth", "key").withColumn("block", F.expr(f"nth div {block_docs}"))
    placed = join_small(ranked, table, ["key", "block"]).withColumn("position", F.col("first") + F.col("nth") - F.col("block") * block_docs)
    if payload:
        placed = rows.select("_row", "row").join(placed, "_row")
    return placed.select("doc_id", "source", "row", "block", "release", "deadline", "slot", "position")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mixed stream of all sources."""
    return mix(read_table(spark, sf_dir, "documents")).drop("row")
