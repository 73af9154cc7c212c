"""Removal of lines that many documents share, by levelled sorted runs of line hashes; DataFrame functions only.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends, A-Z mapped to
lower case.  Keys of at least ``min_chars`` code points that occur in at least
``threshold`` documents lose all their lines in every document.

1. Every text is cut into lines once; a narrow row per line (document, place,
   128-bit hash of the key) is landed by batch.
2. ``LineRuns`` takes the batches one after another.  A batch counts the
   documents of each of its hashes, drops by a merge anti-join those that the
   runs have settled already (``threshold`` documents reached), and adds the
   others, counted on from the runs, as a run of its own: a table bucketed and
   sorted by hash, so that no later batch shuffles it.  ``fanout`` runs of a
   level are compacted into one of the next level.
3. The settled hashes meet the landed lines, which gives the places that go;
   these are attached to their texts.

Documents are told by doc_id: rows that share one count once for a key, and
each loses its own lines.  Rows without doc_id count for no key but lose their
lines like others.  Null or empty text is one empty line.  Every input row
gives one output row; a text whose lines all go becomes empty.  Empty tables
give no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import land, read_table, scratch_path

THRESHOLD = 10
BATCHES = 6
FANOUT = 3
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(SPACE)), UPPER, LOWER)


def line_hashes(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """(batch, doc_id, text_key, place, h1, h2) of each line with a key, from rows with doc_id and text.

    All rows of a doc_id are in one batch; those without are in batch -1, which is not counted.
    """
    batch = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit("batch")), F.lit(batches)).cast("int"), F.lit(-1))
    batch = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(batch)
    lines = docs.select(batch.alias("batch"), "doc_id", F.xxhash64("text").alias("text_key"),
                        F.posexplode(split_lines(F.col("text"))).alias("place", "line"))
    keyed = lines.select("batch", "doc_id", "text_key", "place", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "batch", "doc_id", "text_key", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def land_by(df: DataFrame, column: str, tag: str) -> DataFrame:
    """``land`` with a folder for each value of ``column``: a later read of one value reads its own files only."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").partitionBy(column).parquet(path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.sparkSession.read.schema(fields).parquet(path)


class LineRuns:
    """Levelled runs of (h1, h2, n): in how many documents a hash was met by the end of a batch that held it.

    A run is a table with one row per hash, bucketed and sorted by hash.  Its
    buckets are the session's shuffle partitions at the time of the first
    run, so that a batch's own counts are dealt as the runs are.
    """

    def __init__(self, spark: SparkSession, threshold: int = THRESHOLD, fanout: int = FANOUT):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (counts.write.option("path", scratch_path(self.spark, f"run-level-{level}")).option("compression", "zstd")
         .bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def unsettled(self, lines: DataFrame) -> DataFrame:
        """The run that a batch of (doc_id, h1, h2) rows adds: its hashes but the settled ones, counted on from the runs.

        One merge join with each run tells both: a hash that the run has
        settled goes (the anti-join), another one counts on from its row.
        """
        out = lines.select("doc_id", *HASH).distinct().groupBy(*HASH).agg(F.count(F.lit(1)).alias("own"))
        for i, name in enumerate(self.names()):
            out = out.join(self.spark.table(name).withColumnRenamed("n", f"n{i}"), HASH, "left")
            out = out.where(F.col(f"n{i}").isNull() | (F.col(f"n{i}") < self.threshold))
        met = [F.coalesce(F.col(f"n{i}"), F.lit(0)) for i in range(len(self.names()))] + [F.lit(0)] * 2
        return out.select(*HASH, (F.col("own") + F.greatest(*met)).alias("n"))

    def add(self, lines: DataFrame) -> None:
        """Take a batch: what the runs have not settled becomes a run of its own; full levels are compacted."""
        self._write(self.unsettled(lines), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        """Merge a level's runs into one of the next level, which keeps the latest count of each hash."""
        old = self.levels[level]
        rows = self.spark.table(old[0])
        for name in old[1:]:
            rows = rows.unionByName(self.spark.table(name))
        rows = rows.repartition(self.buckets, *HASH)  # hashes are met once in a run, so no partition stands out
        self._write(rows.groupBy(*HASH).agg(F.max("n").alias("n")), level + 1)
        self.levels[level] = []
        for name in old:
            self._drop(name)

    def settled(self) -> DataFrame:
        """The hashes that reached the threshold; each of them did so in one run."""
        rows = [self.spark.table(name).where(F.col("n") >= self.threshold).select(*HASH) for name in self.names()]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        return out

    def _drop(self, name: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        where = self.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"DROP TABLE {name}")
        path = jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(conf).delete(path, True)

    def drop(self) -> None:
        for name in self.names():
            self._drop(name)
        self.levels = []


def drop_shared_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
                      payload: list[str] | None = None, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, row, n_lines, n_dropped, kept_text) of every row; kept_text: the lines that stay, joined by line breaks; row: the payload columns."""
    spark = docs.sparkSession
    carried = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                          F.struct(F.lit(1).alias("_"), *[docs[c] for c in payload or []]).alias("row"))
    lines = land_by(line_hashes(carried.select("doc_id", "text"), min_chars, batches), "batch", "lines")
    runs = LineRuns(spark, threshold, fanout)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    frequent = land(runs.settled(), "frequent-lines")
    runs.drop()

    # landed tables on either side let a frequent line's partition be split; places are bounded by one text
    places = (lines.join(frequent, HASH).groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))
              .withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_text"}))
    places = land(places, "dropped-lines")
    keyed = carried.withColumn("text_key", F.xxhash64("text"))
    joined = keyed.join(places.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text")), "left")
    all_lines = split_lines(F.col("text"))
    cut = joined.select("doc_id", "row", "text", "places", F.when(F.col("places").isNotNull(), all_lines).alias("lines"),
                        F.size(all_lines).cast("long").alias("n_lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n")
    return cut.select("doc_id", "row", "n_lines", F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("places").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents without those whose key at least ten documents hold."""
    out = drop_shared_lines(read_table(spark, sf_dir, "documents"), threshold=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d),
l AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM s),
f AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
t AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS kept
      FROM l WHERE k NOT IN (SELECT k FROM f) GROUP BY 1)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""
