"""Removal of passages that documents with smaller ids hold already, by FM-indexes over shards.

A window is ``window`` consecutive words.  A word goes if a window that covers
it also starts in a document with a smaller doc_id; windows are judged on the
input.

1. Texts with equal words are one class, streamed once for its least doc_id;
   a class's other documents lose all words if a window fits in them.
2. Each window has an anchor, its k-gram of least hash (the first of equals),
   which depends on the window's words alone.  The windows of one anchor, next
   to each other, form a segment.  Anchors found in one document only cannot
   be part of a repeat.
3. The segments of the other anchors go to shards by anchor, equal segments
   once with their least document.  An anchor with more than ``HOT_SEGMENTS``
   different segments has these cut to single windows that go to shards by
   their words, so that equal ones merge and no anchor fills a shard.
4. Each shard builds one FM-index over its segments and streams them through
   it by backward search; the matching statistic, cut at ``window`` words,
   gives the rows of each window, and the index's documents in these rows its
   least document.  A window that may repeat has its segments in one shard.
5. Windows whose least document is smaller become spans of their document, and
   the spans' words go.

Words are split by [^\\x20\\x09-\\x0D]+, unchanged.  Null text has none.  Every
input row gives one output row.  Rows that share a doc_id do not remove each
other's words.  Rows without doc_id are kept whole and remove nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from realty_spark.llm.common import discard, id_text, land, read_table
from realty_spark.llm.fm_index import least_document
from realty_spark.llm.worker import tidied, tidy
from realty_spark.llm.words import grams, hashes, split

WINDOW = 50
GRAM = 10
SHARD_WORDS = 200_000
HOT_SEGMENTS = 4096
BLOCK = 1 << 16  # window starts of a long text whose anchors are found at once


def anchors(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window start, end of window starts) of each run of windows that share an anchor."""
    g = grams(hashes(words), gram)
    starts, width = len(words) - window + 1, window - gram + 1
    at = np.empty(starts, dtype=np.int64)
    for b in range(0, starts, BLOCK):
        e = min(starts, b + BLOCK)
        at[b:e] = np.lib.stride_tricks.sliding_window_view(g[b:e + width - 1], width).argmin(axis=1) + np.arange(b, e)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return g[at[first]].view(np.int64), first, np.append(first[1:], starts)


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with a ``text``, plus word_key."""
    at, schema = docs.columns.index("text"), StructType([*docs.schema.fields, StructField("word_key", BinaryType())])

    def run(batches):
        for batch in batches:
            keys = [xxhash.xxh3_128_digest(b" ".join(split(t))) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=schema.names)
    return docs.mapInArrow(run, schema)


def anchored(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, word_key, n_words, anchors) of (doc_id, text) rows."""
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            key, n, at, parts = [], [], [0], []
            for t in batch.column(1).to_pylist():
                w = split(t)
                n.append(len(w))
                key.append(xxhash.xxh3_128_digest(b" ".join(w)))
                if len(w) >= window:
                    parts.append(anchors(w, window, gram))
                at.append(at[-1] + (len(parts[-1][0]) if len(w) >= window else 0))
            cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for i in range(3)]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.binary()), pa.array(n, pa.int64()), lists],
                                             names=["doc_id", "word_key", "n_words", "anchors"])
    return docs.mapInArrow(tidied(run), "doc_id long, word_key binary, n_words long, "
                                "anchors array<struct<anchor: long, `begin`: long, `end`: long>>")


def segments(units: DataFrame, window: int) -> DataFrame:
    """(word_key, rep, begin, anchor, words, segment_key) cut from (word_key, rep, text, runs) rows."""
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for key, rep, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                w = split(text)
                for r in runs:
                    words = b" ".join(w[r["begin"]:r["end"] + window - 1])
                    row = key, rep, r["begin"], r["anchor"], words, xxhash.xxh3_128_digest(words)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
    names = ["word_key", "rep", "begin", "anchor", "words", "segment_key"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return units.select("word_key", "rep", "text", "runs").mapInArrow(
        run, "word_key binary, rep long, `begin` long, anchor long, words binary, segment_key binary")


def single_windows(segs: DataFrame, window: int) -> DataFrame:
    """The windows of segments as segments of their own."""
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for key, rep, begin, words in zip(*(c.to_pylist() for c in batch.columns)):
                w = words.split(b" ")
                for i in range(len(w) - window + 1):
                    own = b" ".join(w[i:i + window])
                    row = key, rep, begin + i, xxhash.xxh3_64_intdigest(own) - (1 << 63), own, xxhash.xxh3_128_digest(own)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
    names = ["word_key", "rep", "begin", "anchor", "words", "segment_key"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return segs.select("word_key", "rep", "begin", "words").mapInArrow(
        run, "word_key binary, rep long, `begin` long, anchor long, words binary, segment_key binary")


def search_shards(distinct: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(anchor, segment_key, least array<long>): the least document of each window of the distinct segments."""
    total = distinct.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    kind = pa.schema([("anchor", pa.int64()), ("segment_key", pa.binary()), ("least", pa.list_(pa.int64()))])

    def run(table: pa.Table) -> pa.Table:
        sequences = [w.split(b" ") for w in table.column("words").to_pylist()]
        least = least_document(sequences, table.column("least_doc").to_pylist(), window)
        tidy()
        return pa.Table.from_arrays([table.column("anchor").combine_chunks(), table.column("segment_key").combine_chunks(),
                                     pa.array([v.tolist() for v in least], pa.list_(pa.int64()))], schema=kind)
    rows = distinct.select("anchor", "segment_key", "words", "least_doc",
                           F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"))
    return rows.groupBy("shard").applyInArrow(run, "anchor long, segment_key binary, least array<long>")


def spans(segs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(word_key, rep, spans): the word ranges that go, of each text that loses any."""
    def run(batches):
        for batch in batches:
            keys, reps, out = [], [], []
            least = batch.column(3)
            for key, rep, begin, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), range(batch.num_rows)):
                hit = np.flatnonzero(np.asarray(least[i].values) < rep)
                if len(hit):
                    cut = np.flatnonzero(np.diff(hit) > 1)
                    first, last = np.append(hit[0], hit[cut + 1]), np.append(hit[cut], hit[-1])
                    keys.append(key)
                    reps.append(rep)
                    out.append([{"begin": int(a) + begin, "end": int(b) + begin + window} for a, b in zip(first, last)])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(reps, pa.int64()), pa.array(out, kind)],
                                             names=["word_key", "rep", "part"])
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    joined = segs.select("word_key", "rep", "begin", "anchor", "segment_key").join(found, ["anchor", "segment_key"])
    parts = joined.select("word_key", "rep", "begin", "least").mapInArrow(
        run, "word_key binary, rep long, part array<struct<`begin`: long, `end`: long>>")
    return parts.groupBy("word_key", "rep").agg(F.flatten(F.collect_list("part")).alias("spans"))  # bounded by one text


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   shard_words: int = SHARD_WORDS, hot_segments: int = HOT_SEGMENTS, payload: list[str] | None = None) -> DataFrame:
    """(doc_id, row, n_words, n_removed, kept_text) of every row; kept_text: the kept words joined by one space; row: the payload columns."""
    carried = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                          F.struct(F.lit(1).alias("_"), *[docs[c] for c in payload or []]).alias("row"))
    docs = id_text(docs, id_col, text_col)
    base = land(anchored(docs, window, gram), "anchors")
    classes = base.where("doc_id is not null and n_words >= %d" % window).groupBy("word_key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    classes = land(classes, "classes")
    units = base.join(classes.select("word_key", "rep"), "word_key").where("doc_id = rep").select("word_key", "rep", "anchors")
    runs = units.select("word_key", "rep", F.explode("anchors").alias("a")).select(
        "word_key", "rep", "a.anchor", "a.begin", "a.end")
    shared = runs.groupBy("anchor").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("anchor")
    shared = land(shared, "shared-anchors")  # a plain shuffle on either side lets a frequent anchor's partition be split
    wanted = (runs.join(shared, "anchor").groupBy("word_key", "rep")
              .agg(F.collect_set(F.struct("anchor", "begin", "end")).alias("runs")))  # bounded by one text
    texts = keyed(docs.where("doc_id is not null")).join(wanted, "word_key").where("doc_id = rep")
    segs = land(segments(texts, window), "segments")
    discard(base, shared)

    hot = (segs.groupBy("anchor", "segment_key").agg(F.lit(1).alias("one")).groupBy("anchor").agg(F.count("*").alias("n"))
           .where(F.col("n") > hot_segments).select("anchor"))
    hot = land(hot, "hot-anchors")
    if hot.limit(1).count():
        whole, segs = segs, land(segs.join(hot, "anchor", "left_anti").select("word_key", "rep", "begin", "anchor", "words", "segment_key")
                    .unionByName(single_windows(segs.join(hot, "anchor", "left_semi"), window)), "segments-cut")
        discard(whole)
    distinct = segs.groupBy("anchor", "segment_key").agg(F.min("rep").alias("least_doc"), F.first("words").alias("words"))
    distinct = land(distinct.withColumn("n_words", F.length(F.regexp_replace(F.col("words").cast("string"), "[^ ]+", "")) + 1), "distinct")
    found = land(search_shards(distinct, window, shard_words), "found")
    removed = land(spans(segs, found, window), "spans")
    discard(hot, segs, distinct, found)

    info = (classes.join(removed.select("word_key", "spans"), "word_key", "left")
            .where("rows > 1 or spans is not null").select("word_key", "rep", "spans"))

    joined = keyed(carried).join(info, "word_key", "left").select("doc_id", "row", "text", "rep", "spans")
    schema = StructType([*joined.schema.fields[:2], StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("kept_text", StringType())])

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for i, text, rep, part in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4))):
                w = split(text)
                keep = np.ones(len(w), dtype=bool)
                if rep is not None and i is not None and i > rep:
                    keep[:] = False
                elif rep is not None and i == rep:
                    for s in part or []:
                        keep[s["begin"]:s["end"]] = False
                n_words.append(len(w))
                n_removed.append(int(len(w) - keep.sum()))
                kept.append(b" ".join(w if keep.all() else [x for x, k in zip(w, keep.tolist()) if k]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
                                              pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)
    return joined.mapInArrow(tidied(run), schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that are left after removal of repeated passages of 50 words."""
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first_doc FROM g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM f WHERE first_doc < doc_id),
x AS (SELECT doc_id, list(p) AS ps FROM r GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE (
    SELECT list(ws[k] ORDER BY k) FROM (SELECT unnest(range(1, len(ws) + 1)) AS k) WHERE NOT list_contains(ps, k)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN x ON x.doc_id = w.doc_id
"""
