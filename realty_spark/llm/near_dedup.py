"""Near-duplicate documents by MinHash: one permutation, optimal densification, banded buckets, star-shaped candidates.

1. A document's set is the 64-bit hashes of its distinct k-word shingles.  One
   permutation splits the hash range into ``BANDS * ROWS`` bins; a bin's value
   is its least hash, and an empty bin takes the value of a filled bin chosen
   by a hash of (bin, attempt) that is alike for all documents.
2. Documents with equal sets are one class, named by a 128-bit hash of its set.
3. Classes that agree in all ROWS bins of a band share a bucket.  Each bucket
   gives star edges only: from its centre, the class that shares most buckets,
   to each other class.  Edges are confirmed on full sets.
4. Members of a bucket that are not linked with its centre c may still be
   linked with each other.  With D(x) the symmetric difference of x and c,
   |x ^ y| = |D(x)| + |D(y)| - 2|D(x) & D(y)|, so a linked pair of which not
   both are linked with c shares at least ``k`` differences, and any
   |D(x)| - k + 1 differences of x contain one of y's.  Differences that all
   lie in one component cannot join two; they come first among the
   |D(x)| - k + 1, then the rarest.  Both sides number their differences in
   this order; a pair meets in a difference only if its components differ and
   what either side has left from there on could still make up the share that
   the pair's own sizes ask for, which holds at a linked pair's first common
   difference.  Few unlinked pairs meet; those that do are confirmed on full sets.
5. Components of the confirmed links give each class its component.

At similarity 0.85 a pair shares no band with probability (1 - 0.85^5)^26 =
2e-7; each pair that shares one is decided exactly.

Words are split by [^\\x20\\x09-\\x0D]+ after mapping A-Z to lower case; fewer
words than a shingle form one shingle; without words (or text) the set is
empty and linked with nothing.  Every input row gives one output row.  Rows that
share a doc_id are one document: their classes are linked with each other
(unless ``by_id`` is false) and they share a component.  Rows without doc_id are
linked with nothing: component null, kept true.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import discard, id_text, join_small, land, read_table
from realty_spark.llm.graph import components
from realty_spark.llm.worker import tidied
from realty_spark.llm.words import mix, shingle_set

BANDS = 26
ROWS = 5


class Sketcher:
    """One-permutation sketches of sorted hash sets, and their bands."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.edges = np.array([(i << 64) // self.bins for i in range(self.bins)], dtype=np.uint64)
        self.numbers = np.arange(self.bins, dtype=np.uint64)

    def sketch(self, hashed: np.ndarray) -> np.ndarray:
        at = np.searchsorted(hashed, self.edges)
        ends = np.append(at[1:], len(hashed))
        filled = at < ends
        out = hashed[np.minimum(at, len(hashed) - 1)]
        empty, attempt = np.flatnonzero(~filled), 0
        while len(empty):
            attempt += 1
            source = (mix(self.numbers[empty] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) % np.uint64(self.bins)).astype(np.int64)
            hit = filled[source]
            out[empty[hit]] = hashed[at[source[hit]]]
            empty = empty[~hit]
        return out

    def band_keys(self, hashed: np.ndarray) -> np.ndarray:
        table = self.sketch(hashed).reshape(self.bands, self.rows)
        key = mix(self.numbers[:self.bands] + np.uint64(1))
        for j in range(self.rows):
            key = mix((key + table[:, j]) * np.uint64(0x9E3779B97F4A7C15))
        return key.view(np.int64)


def class_of(hashed: np.ndarray) -> bytes | None:
    """The name of a set's class; None for the empty set."""
    return xxhash.xxh3_128_digest(hashed.tobytes()) if len(hashed) else None


def text_key(text: Column) -> Column:
    """A hash that tells the rows of a doc_id apart by their texts."""
    return F.xxhash64(text)


def sketches(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_key, n_shingles, class_key, band_keys) of (doc_id, text) rows; class_key and band_keys are null for empty sets."""
    def run(batches):
        sk = Sketcher(bands, rows)
        for batch in batches:
            n, cls, keys = [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                cls.append(class_of(s))
                keys.append(sk.band_keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))],
                                             names=["doc_id", "text_key", "n_shingles", "class_key", "band_keys"])
    return docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
        tidied(run), "doc_id long, text_key long, n_shingles long, class_key binary, band_keys array<long>")


def star_edges(classes: DataFrame) -> DataFrame:
    """(c, x): in each bucket, its centre with each other member.  The centre shares most buckets; ties to the greatest key."""
    rows = classes.select("class_key", F.explode("band_keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = land(shared, "shared")  # a plain shuffle on either side lets a crowded bucket's partition be split
    rows = land(rows.join(shared, "key"), "buckets")
    degree = rows.groupBy("class_key").agg(F.sum("size").alias("degree"))
    ranked = rows.select("key", "class_key").join(degree, "class_key")
    centre = ranked.groupBy("key").agg(F.max(F.struct("degree", "class_key")).alias("top")).select("key", F.col("top.class_key").alias("c"))
    centre = land(centre, "centres")
    edges = land(rows.select("key", F.col("class_key").alias("x")).join(centre, "key").where("c <> x").select("c", "x").distinct(), "stars")
    discard(shared, rows, centre)
    return edges


def full_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(class_key, items): the shingle hashes of the named classes (class_key, rep), taken from the document rep of each."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, k) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["class_key", "items"])
    wanted = docs.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    sets = wanted.mapInArrow(tidied(run), "class_key binary, items binary")
    return sets.join(classes.select("class_key"), "class_key", "left_semi").dropDuplicates(["class_key"])


def least_outside(size: int, centre: int, num: int, den: int) -> int:
    """The fewest differences from a centre that a document not linked with it can have, if it may be linked with one of ``size``."""
    return (den - num) * (-(-num * size // den) + centre) // (den + num) + 1


def needed(diff: int, size: int, centre: int, num: int, den: int) -> int:
    """How many differences from the centre a document shares at least with any document that is linked with it, not with the centre."""
    reach = (den - num) * (size + den * size // num) // (den + num)  # the most differences between linked documents
    other = max(least_outside(size, centre, num, den), diff - reach)
    return max(1, -(-(diff + other - reach) // 2))


def confirm(edges: DataFrame, sets: DataFrame, num: int, den: int, differences: bool) -> DataFrame:
    """(c, x, linked) for the edges; with ``differences`` also x's size, differences from c and how many meet any partner's."""
    left = sets.select(F.col("class_key").alias("c"), F.col("items").alias("c_items"))
    right = sets.select(F.col("class_key").alias("x"), F.col("items").alias("x_items"))
    joined = edges.join(right, "x").join(left, "c").select("c", "x", "c_items", "x_items")

    def run(batches):
        for batch in batches:
            linked, size, meeting, diffs = [], [], [], []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64)
                found = np.searchsorted(a, b)
                same = a[np.minimum(found, len(a) - 1)] == b
                both = int(same.sum())
                linked.append(den * both >= num * (len(a) + len(b) - both))
                if differences:
                    lost = a[np.isin(a, b[same], assume_unique=True, invert=True)]
                    diff = np.concatenate([b[~same], lost]).view(np.int64)
                    size.append(len(b))
                    diffs.append(diff)
                    meeting.append(len(diff) - needed(len(diff), len(b), len(a), num, den) + 1)
            columns = [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())]
            if differences:
                columns += [pa.array(size, pa.int64()), pa.array(meeting, pa.int64()), pa.array(diffs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    names = ["c", "x", "linked"] + ["size", "meeting", "diff"] * differences
    return joined.mapInArrow(tidied(run), "c binary, x binary, linked boolean" + ", size long, meeting long, diff array<long>" * differences)


def pairs_outside_stars(checked: DataFrame, component: DataFrame, num: int, den: int) -> DataFrame:
    """(c, x) pairs of two components that share a centre, at least one of them not linked with it, and may be linked with each other."""
    of_x = component.select(F.col("node").alias("x"), "component")
    tagged = land(checked.join(of_x, "x", "left").withColumn("component", F.coalesce("component", "x")), "differences")
    items = tagged.select("c", "x", "component", F.explode("diff").alias("item"))
    spanning = items.groupBy("c", "item").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                              F.count("*").alias("n")).where("lo < hi").select("c", "item", "n")
    spanning = land(spanning, "spanning")
    held = (items.select("c", "x", "item").join(spanning, ["c", "item"]).groupBy("c", "x")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "item"))), lambda s: s["item"]).alias("held")))  # bounded by one text
    differ = F.size("diff")
    rows = tagged.join(held, ["c", "x"]).withColumns({"differ": differ, "alone": differ - F.size("held"), "rest": F.greatest(
        (F.col("meeting") - (differ - F.size("held"))).cast("int"), F.lit(0))}).drop("diff", "meeting")
    rows = land(rows, "held")

    def side(name: str, chosen: DataFrame, up_to: Column) -> DataFrame:
        """A side's differences with how many it has left from each on, itself included."""
        placed = chosen.select("c", F.col("x").alias(name), F.col("component").alias(f"{name}_component"), F.col("size").alias(f"{name}_size"),
                               "differ", "alone", F.posexplode(F.slice("held", F.lit(1), up_to)).alias("place", "item"))
        return placed.select("c", "item", name, f"{name}_component", f"{name}_size", F.col("differ").alias(f"{name}_differ"),
                             (F.col("differ") - F.col("alone") - F.col("place")).alias(f"{name}_left"))
    few, every = side("a", rows, F.col("rest")), side("b", rows.where("not linked"), F.size("held"))
    most = F.expr(f"({den - num} * (a_size + b_size)) div {den + num}")  # differences between linked documents
    met = few.join(every, (few["c"] == every["c"]) & (few["item"] == every["item"]) & (F.col("a_component") != F.col("b_component"))
                   & (2 * F.least("a_left", "b_left") >= F.col("a_differ") + F.col("b_differ") - most))
    pairs = land(met.select(F.least("a", "b").alias("c"), F.greatest("a", "b").alias("x")).distinct(), "late")
    discard(tagged, spanning, rows)
    return pairs


def merged(first: DataFrame, late: DataFrame) -> DataFrame:
    """Components after more links: the few components that these join are joined, the others stay."""
    label = first.select("node", "component")
    ends = late.join(label.toDF("a", "of_a"), "a", "left").join(label.toDF("b", "of_b"), "b", "left")
    joined = components(ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    nodes = first.union(late.select("a", "a")).union(late.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
    renamed = joined.select(F.col("node").alias("component"), F.col("component").alias("root"))
    return nodes.join(renamed, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text", bands: int = BANDS, rows: int = ROWS, by_id: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key, class_key, root): documents linked where den * |intersection| >= num * |union| of k-word shingles.

    ``root`` names the component by one of its classes.
    """
    docs = id_text(docs, id_col, text_col)
    sketched = land(sketches(docs, k, bands, rows), "sketches")
    named = sketched.where("class_key is not null and doc_id is not null")
    classes = land(named.groupBy("class_key").agg(F.min("doc_id").alias("rep"), F.first("band_keys").alias("band_keys")), "classes")
    edges = star_edges(classes)
    ids = land(edges.select(F.col("c").alias("class_key")).union(edges.select("x")).distinct().join(classes.select("class_key", "rep"), "class_key"), "candidates")
    classes_of, base = land(classes.select("class_key", "rep"), "class-names"), land(sketched.drop("band_keys"), "rows")
    discard(sketched, classes)
    named = base.where("class_key is not null and doc_id is not null")
    sets = land(full_sets(docs, ids, k), "sets")
    checked = land(confirm(edges, sets, num, den, differences=True), "confirmed")
    discard(edges, ids)
    linked = checked.where("linked").select(F.col("c").alias("a"), F.col("x").alias("b"))
    if by_id:
        several = named.groupBy("doc_id").agg(F.min("class_key").alias("a"), F.max("class_key").alias("b")).where("a <> b").select("doc_id", "a")
        several = land(several, "repeated-ids")
        linked = linked.union(join_small(named, several, ["doc_id"]).where("a <> class_key").select("a", "class_key").distinct())
    first = components(linked)

    more = pairs_outside_stars(checked, first, num, den)
    late = land(confirm(more, sets, num, den, differences=False).where("linked").select(F.col("c").alias("a"), F.col("x").alias("b")), "late-links")
    found = merged(first, late) if late.limit(1).count() else first
    discard(sets, checked, more)

    of_class = land(classes_of.join(found.withColumnRenamed("node", "class_key"), "class_key", "left")
                    .withColumn("root", F.coalesce("component", "class_key")).drop("component"), "of-class")
    least = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = of_class.join(least, "root").select("class_key", "component_id", "root")
    columns = ["doc_id", "n_shingles", "component_id", "text_key", "class_key", "root"]
    single = base.where("class_key is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key", "class_key", F.lit(None).cast("binary").alias("root"))
    # a class may hold a third of all rows: only its key is joined, and skewed partitions of a join are split
    out = named.join(of_class, "class_key").select(columns).union(single)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, 100 * intersection >= 85 * union."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=3, num=85, den=100).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY 1) c ON c.node = d.doc_id
"""
