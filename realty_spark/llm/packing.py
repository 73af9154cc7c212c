"""Order-preserving packing of documents into token windows by dynamic programming.

Documents, in ascending order, form one token stream per partition.  Window
cuts lie at document ends (no penalty), sentence ends (``sentence_penalty``)
or, inside a sentence longer than a window, at fixed steps (``hard_penalty``).
The program minimises padding plus penalties.  The padding of a window of
length L is ``window - L``, which is linear in the cut positions, so the best
predecessor within reach is the minimum of a monotone queue; windows whose
length is a power of two need no padding and are tried besides, from
``SHORTEST`` tokens on.

Null text counts as empty: its document is the end id alone.  Rows that share
a doc_id are separate documents.  Null doc_ids are packed first.  An empty
table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import by_id, id_text, read_table
from realty_spark.llm.tokens import default_tokenizer, encoder
from realty_spark.llm.worker import tidied

WINDOW = 1024
SENTENCE_PENALTY = 2
HARD_PENALTY = 32
HARD_STEP = 64
SHORTEST = 64  # the shortest unpadded window that is tried on purpose
SEGMENT_TOKENS = 1 << 20  # documents planned together; each segment ends with at most one padded window

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long, "
          "sequence_length long")


def candidates(ends: np.ndarray, doc_ends: np.ndarray, total: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions in (0, total] and the kind of each: 0 document end, 1 sentence end, 2 inside a sentence."""
    kind = np.full(total + 1, 3, dtype=np.int8)
    kind[ends] = 1
    kind[doc_ends] = 0
    at = np.flatnonzero(kind[1:] < 3) + 1
    gaps = np.diff(at, prepend=0)
    for g in np.flatnonzero(gaps > window).tolist():  # a sentence that no window holds
        inner = np.arange(at[g] - gaps[g] + HARD_STEP, at[g], HARD_STEP)
        kind[inner] = 2
    at = np.flatnonzero(kind[1:] < 3) + 1
    return at, kind[at]


def plan(at: list[int], penalty: list[float], window: int) -> list[int]:
    """The cuts, ascending and ending at ``at[-1]``, of least padding plus penalties; memory follows the candidates."""
    places = np.concatenate([[0], np.asarray(at, dtype=np.int64)])
    unpadded: list[list[int] | None] = [None] * len(places)  # where a window of a power of two begins that ends at a candidate
    for w in (1 << k for k in range(window.bit_length()) if min(SHORTEST, window) <= 1 << k <= window):
        begin = np.searchsorted(places, places - w)
        for i in np.flatnonzero((places >= w) & (places[begin] == places - w)).tolist():
            if unpadded[i] is None:
                unpadded[i] = []
            unpadded[i].append(int(begin[i]))
    place = places.tolist()
    best, came, key = [0.0], [0], [0.0]  # key: best + place
    queue, head = [0], 0  # candidates within reach, their keys ascending; what lies before ``head`` has left it
    for i in range(1, len(place)):
        p = place[i]
        while place[queue[head]] < p - window:
            head += 1
        prev = queue[head]
        value = key[prev] + window - p
        exact = unpadded[i]
        if exact is not None:
            for j in exact:
                if best[j] < value:
                    value, prev = best[j], j
        value += penalty[i - 1]
        best.append(value)
        came.append(prev)
        value += p
        key.append(value)
        while len(queue) > head and key[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
    cuts = [len(place) - 1]
    while came[cuts[-1]]:
        cuts.append(came[cuts[-1]])
    return [place[i] for i in cuts[::-1]]


def pack_partition(batches: Iterator[pa.RecordBatch], tokenizer: str, window: int, sentence_penalty: float,
                   hard_penalty: float, segment_tokens: int, cache_chunks: int | None = None) -> Iterator[pa.RecordBatch]:
    enc = encoder(tokenizer, cache_chunks)
    context = TaskContext.get()
    sequence = (context.partitionId() if context else 0) << 33
    cost = np.array([0.0, sentence_penalty, hard_penalty])

    def flush(ids: list, raw: list[bytes]) -> tuple[pa.RecordBatch, int]:
        stream = b"".join(raw)
        tokens = np.frombuffer(stream, dtype="<u4")
        sizes = np.array([len(r) // 4 for r in raw], dtype=np.int64)
        doc_ends = np.cumsum(sizes)
        at, kind = candidates(np.flatnonzero(enc.ends_sentence[tokens]) + 1, doc_ends, len(tokens), window)
        cuts = np.array(plan(at.tolist(), cost[kind].tolist(), window), dtype=np.int64)
        ends = np.union1d(doc_ends, cuts)
        begins = np.concatenate([[0], ends[:-1]])
        doc = np.searchsorted(doc_ends, begins, side="right")
        seq = np.searchsorted(cuts, begins, side="right")
        seq_begin = np.concatenate([[0], cuts[:-1]])
        doc_begin = doc_ends - sizes
        out = pa.RecordBatch.from_arrays([
            pa.array([ids[d] for d in doc.tolist()], pa.int64()),
            pa.array(begins - doc_begin[doc], pa.int64()),
            pa.array(ends - begins, pa.int64()),
            pa.array([stream[4 * b:4 * e] for b, e in zip(begins.tolist(), ends.tolist())], pa.binary()),
            pa.array(sizes[doc], pa.int64()),
            pa.array(seq + sequence, pa.int64()),
            pa.array(begins - seq_begin[seq], pa.int64()),
            pa.array((cuts - seq_begin)[seq], pa.int64()),
        ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length"])
        return out, len(cuts)

    ids, raw, held = [], [], 0
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for i, r in zip(doc_ids, enc.batch(batch.column(1).to_pylist())):
            ids.append(i)
            raw.append(r)
            held += len(r) // 4
            if held >= segment_tokens:
                out, n = flush(ids, raw)
                sequence += n
                ids, raw, held = [], [], 0
                yield out
    if raw:
        yield flush(ids, raw)[0]


def pack_ordered(ordered: DataFrame, tokenizer: str | None = None, window: int = WINDOW,
                 sentence_penalty: float = SENTENCE_PENALTY, hard_penalty: float = HARD_PENALTY,
                 segment_tokens: int = SEGMENT_TOKENS, cache_chunks: int | None = None) -> DataFrame:
    """Pack (doc_id, text) rows in the order in which the partitions hold them; sequences never cross partitions.

    ``cache_chunks`` bounds the encoder's cache where workers serve other operators as well.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        return pack_partition(batches, path, window, sentence_penalty, hard_penalty, segment_tokens, cache_chunks)
    return ordered.select("doc_id", "text").mapInArrow(tidied(run), PIECES)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Pieces of all documents in ascending doc_id order, with their ids (little-endian unsigned 32-bit), sequence and offset."""
    return pack_ordered(by_id(id_text(docs, id_col, text_col)), **options)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_length")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing of all documents into sequences of at most 1024 tokens; one row per piece."""
    return digest(pack_documents(read_table(spark, sf_dir, "documents")))
