"""Token-id files: independent zstandard frames with a trailing seek table and per-frame checksums.

A shard file holds, in ascending doc_id order:

* frames of little-endian unsigned 32-bit ids, each an independent zstandard
  frame with a content checksum.  Whole documents share a frame up to
  ``FRAME_BYTES``; a longer document takes several frames;
* a skippable frame (magic 0x184D2A51) with the document index: partition and
  shard number, document count, then zstandard-compressed doc_ids, null flags
  and token counts, after their crc32;
* a skippable frame (magic 0x184D2A5E) with the seek table of the public
  seekable format: for each frame its compressed size, its size and the low
  32 bits of the XXH64 of its content; then the number of frames, the
  descriptor and the magic 0x8F92EAB1.

Any zstandard decoder reads such a file as one stream; a reader of few
documents decompresses only the frames that hold them.  Spark's own text
writer commits the files, one shard to a file, so lost or repeated tasks leave
no partial file and any Hadoop file system will do.

Null or empty text is the end id alone.  Rows that share a doc_id are separate
documents next to each other.  Null doc_ids come first.  An empty table gives
files without frames.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from realty_spark.llm.common import by_id, id_text, join_small, land, read_table, scratch_path
from realty_spark.llm.tokens import default_tokenizer, encoder

FRAME_BYTES = 1 << 16
LONG_FRAME_BYTES = 1 << 20
SHARD_TOKENS = 1 << 22
LEVEL = 3
INDEX_MAGIC = 0x184D2A51
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = struct.pack("<I", 0x8F92EAB1)
CHECKSUMS = 0x80
_HEAD = struct.Struct("<IIQI")  # partition, shard in it, documents, crc32 of the rest
_ENTRY = np.dtype([("csize", "<u4"), ("size", "<u4"), ("check", "<u4")])


class ShardWriter:
    """Collects documents of one shard and renders the file."""

    def __init__(self) -> None:
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.tokens = 0

    def _close(self, data: bytes) -> None:
        frame = self.compress(data)
        self.frames.append(frame)
        self.entries.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def _close_open(self) -> None:
        if self.open:
            self._close(b"".join(self.open))
            self.open, self.open_bytes = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.tokens += len(ids) // 4
        if len(ids) > LONG_FRAME_BYTES:
            self._close_open()
            for at in range(0, len(ids), LONG_FRAME_BYTES):
                self._close(ids[at:at + LONG_FRAME_BYTES])
            return
        self.open.append(ids)
        self.open_bytes += len(ids)
        if self.open_bytes >= FRAME_BYTES:
            self._close_open()

    def render(self, partition: int, shard: int) -> bytes:
        self._close_open()
        null = np.array([d is None for d in self.doc_ids], dtype=np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        body = zstandard.ZstdCompressor(level=LEVEL).compress(
            ids.tobytes() + null.tobytes() + np.array(self.sizes, dtype="<i8").tobytes())
        index = _HEAD.pack(partition, shard, len(self.doc_ids), zlib.crc32(body)) + body
        table = np.array(self.entries, dtype=_ENTRY).tobytes() + struct.pack("<IB", len(self.entries), CHECKSUMS) + FOOTER_MAGIC
        return (b"".join(self.frames) + struct.pack("<II", INDEX_MAGIC, len(index)) + index
                + struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to the documents of one shard file, given its bytes (or a mapped file)."""

    def __init__(self, data) -> None:
        if bytes(data[-4:]) != FOOTER_MAGIC:
            raise ValueError("no seek table at the end")
        self.data = data
        n, flags = struct.unpack("<IB", data[-9:-4])
        if flags != CHECKSUMS:
            raise ValueError("the seek table has no checksums")
        begin = len(data) - 9 - n * _ENTRY.itemsize
        magic, size = struct.unpack("<II", data[begin - 8:begin])
        if magic != SEEK_MAGIC or size != len(data) - begin:
            raise ValueError("damaged seek table")
        self.entries = np.frombuffer(data[begin:begin + n * _ENTRY.itemsize], dtype=_ENTRY)
        self.frame_at = np.concatenate([[0], np.cumsum(self.entries["csize"].astype(np.int64))])
        self.byte_at = np.concatenate([[0], np.cumsum(self.entries["size"].astype(np.int64))])
        at = int(self.frame_at[-1])
        magic, size = struct.unpack("<II", data[at:at + 8])
        index = bytes(data[at + 8:at + 8 + size])
        self.partition, self.shard, count, check = _HEAD.unpack_from(index)
        if magic != INDEX_MAGIC or zlib.crc32(index[_HEAD.size:]) != check:
            raise ValueError("damaged document index")
        body = zstandard.ZstdDecompressor().decompress(index[_HEAD.size:])
        self.doc_ids = np.frombuffer(body, dtype="<i8", count=count)
        self.null = np.frombuffer(body, dtype=np.uint8, count=count, offset=8 * count).astype(bool)
        self.sizes = np.frombuffer(body, dtype="<i8", count=count, offset=9 * count)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self._last: tuple[int, bytes] = (-1, b"")

    @property
    def tokens(self) -> int:
        return int(self.sizes.sum())

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            raw = bytes(self.data[int(self.frame_at[k]):int(self.frame_at[k + 1])])
            got = zstandard.ZstdDecompressor().decompress(raw, max_output_size=int(self.entries["size"][k]))
            if xxhash.xxh64_intdigest(got) & 0xFFFFFFFF != int(self.entries["check"][k]):
                raise ValueError(f"frame {k} fails its checksum")
            self._last = (k, got)
        return self._last[1]

    def ids(self, row: int) -> bytes:
        """The ids of the row-th document: only the frames that hold it are decompressed."""
        lo, hi = 4 * int(self.starts[row]), 4 * int(self.starts[row] + self.sizes[row])
        first = int(np.searchsorted(self.byte_at, lo, side="right")) - 1
        parts = []
        while first < len(self.entries) and int(self.byte_at[first]) < hi:
            base = int(self.byte_at[first])
            parts.append(self.frame(first)[max(0, lo - base):hi - base])
            first += 1
        return b"".join(parts)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all documents and write them to shard files under ``path`` in ascending doc_id order."""
    where = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, partition, shard, writer = encoder(where), TaskContext.get().partitionId(), 0, ShardWriter()

        def row(w: ShardWriter, k: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.render(partition, k)[:-4]], pa.binary())], names=["file"])
        for batch in batches:
            for i, ids in zip(batch.column(0).to_pylist(), enc.batch(batch.column(1).to_pylist())):
                writer.add(i, ids)
                if writer.tokens >= shard_tokens:
                    yield row(writer, shard)
                    shard, writer = shard + 1, ShardWriter()
        if writer.doc_ids:
            yield row(writer, shard)

    shards = by_id(id_text(docs, id_col, text_col)).mapInArrow(run, "file binary")
    # The text writer puts a line separator after each row; here it is the four magic bytes that end a seek table.
    (shards.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1)
     .option("encoding", "ISO-8859-1").option("lineSep", FOOTER_MAGIC.decode("latin-1")).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard file: partition, shard, documents, tokens and the tokens of all shards before it."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                r = ShardReader(data.as_buffer().to_pybytes())
                yield pa.RecordBatch.from_pylist([{"partition": r.partition, "shard": r.shard, "n_docs": len(r.sizes), "n_tokens": r.tokens}],
                                                 schema=pa.schema([("partition", pa.int64()), ("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
    shards = _files(spark, path).mapInArrow(run, "partition long, shard long, n_docs long, n_tokens long")
    before = Window.orderBy("partition", "shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard file
    return land(shards.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "manifest")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files of ``path``; with doc_ids, only those, decompressing only their frames."""
    wanted = None if doc_ids is None else np.array(sorted(set(doc_ids)), dtype=np.int64)

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("partition", pa.int64()), ("shard", pa.int64()),
                            ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for data in batch.column(0):
                r = ShardReader(data.as_buffer().to_pybytes())
                rows = np.arange(len(r.sizes)) if wanted is None else np.flatnonzero(np.isin(r.doc_ids, wanted) & ~r.null)
                for k in range(0, len(rows), 2000):
                    part = rows[k:k + 2000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(r.doc_ids[part], pa.int64(), mask=r.null[part]),
                        pa.array(np.full(len(part), r.partition)), pa.array(np.full(len(part), r.shard)),
                        pa.array(r.starts[part], pa.int64()), pa.array(r.sizes[part], pa.int64()),
                        pa.array([r.ids(i) for i in part.tolist()], pa.binary())], schema=schema)
    docs = _files(spark, path).mapInArrow(run, "doc_id long, partition long, shard long, at long, n_tokens long, ids binary")
    shards = manifest(spark, path).select("partition", "shard", "first_token")
    return join_small(docs, shards, ["partition", "shard"]).select(
        "doc_id", (F.col("at") + F.col("first_token")).alias("start"), "n_tokens", "ids")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files, read the files back, and give each document's digest."""
    path = scratch_path(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
