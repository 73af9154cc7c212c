"""Spelling variants in a corpus: which words differ by one edit, and which frequent word each stands for.

A run is a maximal sequence [A-Za-z\\u00C0-\\u00FF]+ of a text, A-Z mapped to
lower case.  Where ``every`` divides the crc32 of "<doc_id>:<run>" the run
loses its code point crc32 % length; without doc_id the crc32 is that of
":<run>".  Words are the results of at least ``min_chars`` code points and
``min_count`` occurrences.  Two words are near if one replaced, inserted or
deleted code point makes one of the other.

The near pairs are the composition of the vocabulary's minimal acceptor, a
one-edit transducer and the acceptor again (``acceptor.Acceptor``).  Up to its
edit the composition reads the same on both sides, so it is cut into parts by
the state, that is the prefix, in which both sides are:

* Prefixes of more than ``crowded`` words, up to ``depth`` letters, are
  crowded; a word's own part is its shortest prefix that is not, and holds
  ``crowded`` words at most.  Each part has an acceptor and composition of its
  own, which give the pairs whose first difference lies behind the prefix.
* A pair that differs first right at a crowded prefix takes the edit arc there
  and reads one tail afterwards.  These pairs meet by (prefix, tail), a group
  of at most one word per letter and one more.
* Pairs that share a prefix of ``depth`` letters that is still crowded, and
  pairs with a word of more than ``long`` letters, meet in the same way by the
  hashes of prefix and tail at every place, without the words themselves.

A word's form is its near word of largest count (ties: the smallest), if that
count is at least ``factor`` times its own; its root is found by following
forms, whose counts grow, by doubling.

Null and empty texts have no words.  Rows that repeat count each.  An empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.acceptor import Acceptor
from realty_spark.llm.common import id_text, join_small, land, read_table
from realty_spark.llm.worker import tidied

MIN_CHARS = 7
MIN_COUNT = 2
EVERY = 31
FACTOR = 10
CROWDED = 2000
DEPTH = 24
LONG = 64
HELD = 50_000  # counts that a task holds before it hands them on
TEXTS = 256  # texts that a task takes out of a batch at once
_RUN = re.compile("[a-zÀ-ÿ]+")


def text_words(doc_id: int | None, text: str | None, min_chars: int, every: int) -> Counter[str]:
    """The words of a text with their counts."""
    lower = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(r for r in _RUN.findall(lower) if len(r) >= min_chars).items():
        h = zlib.crc32(run.encode(), before)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_chars:
                continue
        out[run] += n
    return out


def counted_words(batches: Iterable[pa.RecordBatch], min_chars: int, every: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of (doc_id, text) batches, of which few texts are taken out at once."""
    def rows(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
    held: Counter[str] = Counter()
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held.update(text_words(doc_id, text, min_chars, every))
                if len(held) > HELD:
                    yield rows(held)
                    held = Counter()
    yield rows(held)


def vocabulary(docs: DataFrame, min_chars: int, min_count: int, every: int) -> DataFrame:
    """(word, n) of (doc_id, text) rows; tasks count before the shuffle."""
    counts = docs.select("doc_id", "text").mapInArrow(tidied(lambda batches: counted_words(batches, min_chars, every)), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def crowded_prefixes(words: DataFrame, crowded: int, depth: int) -> DataFrame:
    """(prefix): the prefixes of at most ``depth`` letters that more than ``crowded`` words have."""
    places = F.sequence(F.lit(0), F.least(F.length("word"), F.lit(depth)))
    prefixes = words.select(F.explode(F.transform(places, lambda p: F.substring(F.col("word"), F.lit(1), p))).alias("prefix"))
    return prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded).select("prefix")


def placed(words: DataFrame, prefixes: DataFrame, depth: int) -> DataFrame:
    """(word, n, own): own is how many crowded prefixes a word has, hence the length of its shortest that is not."""
    places = F.sequence(F.lit(0), F.least(F.length("word"), F.lit(depth)))
    each = words.select("word", "n", F.explode(places).alias("p")).withColumn("prefix", F.expr("substring(word, 1, p)"))
    met = join_small(each, prefixes, ["prefix"]).groupBy("word").agg(F.count(F.lit(1)).cast("int").alias("own"))
    return words.join(met, "word", "left").select("word", "n", F.coalesce("own", F.lit(0)).alias("own"))


def part_pairs(words: DataFrame) -> DataFrame:
    """(a, an, b, bn): near pairs whose first difference lies behind the prefix that both have as their own part."""
    names, kinds = ["a", "an", "b", "bn"], [pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(table: pa.Table) -> pa.Table:
        n = dict(sorted(zip(table.column("word").to_pylist(), table.column("n").to_pylist())))
        cut = len(table.column("part")[0].as_py())
        pairs = [(min(u, v), max(u, v)) for u, v in Acceptor([w[cut:] for w in n]).one_edit_pairs()]
        head = next(iter(n))[:cut]
        a, b = [head + u for u, _ in pairs], [head + v for _, v in pairs]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip((a, [n[u] for u in a], b, [n[v] for v in b]), kinds)], names=names)
    rows = words.where("own <= length(word)").withColumn("part", F.expr("substring(word, 1, own)"))
    return rows.groupBy("part").applyInArrow(run, "a string, an long, b string, bn long")


def meeting(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(a, an, b, bn) of rows (keys, mark, word, n) that meet in a key with different marks; a key has one word per letter and one more."""
    groups = rows.groupBy(*keys).agg(F.collect_set(F.struct("mark", "word", "n")).alias("all")).where(F.size("all") > 1)
    each = groups.select("all", F.explode("all").alias("x"))
    pairs = each.select("x", F.explode(F.expr("filter(all, y -> y.mark > x.mark)")).alias("y"))
    first = F.col("x.word") < F.col("y.word")
    low, high = (F.when(first, F.col("x")).otherwise(F.col("y")), F.when(first, F.col("y")).otherwise(F.col("x")))
    return pairs.select(low.alias("low"), high.alias("high")).select(
        F.col("low.word").alias("a"), F.col("low.n").alias("an"), F.col("high.word").alias("b"), F.col("high.n").alias("bn"))


def crowded_pairs(words: DataFrame, depth: int) -> DataFrame:
    """Near pairs whose first difference lies right behind a crowded prefix of less than ``depth`` letters.

    There one side or both lose a letter, the mark; what both read afterwards
    is the tail.  A side that loses none is marked by its next letter, for a
    pair that agrees in it differs later.
    """
    at = words.where("own > 0").select("word", "n", F.explode(F.expr(f"sequence(0, least(own, {depth}) - 1)")).alias("p")).where("p <= length(word)")
    prefix, mark = F.expr("substring(word, 1, p)").alias("prefix"), F.expr("substring(word, p + 1, 1)").alias("mark")
    lost = at.where("p < length(word)").select(prefix, F.expr("substring(word, p + 2)").alias("tail"), mark, "word", "n")
    whole = at.select(prefix, F.expr("substring(word, p + 1)").alias("tail"), mark, "word", "n")
    return meeting(lost.unionByName(whole), ["prefix", "tail"])


def place_keys(word: str, first: int) -> list[tuple[bytes, bytes, str]]:
    """(prefix hash, tail hash, mark) of a word at each place from ``first`` on: with the place's letter lost, and with none."""
    h, heads = xxhash.xxh3_128(), []
    for letter in word:
        heads.append(h.digest())
        h.update(letter.encode("utf-32-le"))
    heads.append(h.digest())
    h, tails = xxhash.xxh3_128(), []
    for letter in reversed(word):
        tails.append(h.digest())
        h.update(letter.encode("utf-32-le"))
    tails.append(h.digest())
    tails.reverse()
    out = [(heads[p], tails[p + 1], word[p]) for p in range(first, len(word))]
    return out + [(heads[p], tails[p], word[p:p + 1]) for p in range(first, len(word) + 1)]


def hashed_pairs(words: DataFrame, rows: DataFrame) -> DataFrame:
    """Near pairs among rows (word, first) that differ first at ``first`` or later: places meet by hashes, words join afterwards."""
    def run(batches):
        for batch in batches:
            for word, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, own = place_keys(word, first), xxhash.xxh3_128_digest(word)
                for at in range(0, len(keys), 10_000):
                    part = keys[at:at + 10_000]
                    columns = [[k[0] for k in part], [k[1] for k in part], [k[2] for k in part], [own] * len(part), [0] * len(part)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    names = ["head", "tail", "mark", "word", "n"]
    kinds = [pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.int64()]
    met = meeting(rows.select("word", "first").mapInArrow(tidied(run), "head binary, tail binary, mark string, word binary, n long"), ["head", "tail"])
    met = land(met.select("a", "b"), "hashed-pairs")
    ends = met.select(F.col("a").alias("own")).union(met.select("b")).distinct()

    def digest(batches):
        for batch in batches:
            own = [xxhash.xxh3_128_digest(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), *batch.columns], names=["own", "word", "n"])
    named = words.join(rows.select("word").distinct(), "word", "left_semi").select("word", "n").mapInArrow(tidied(digest), "own binary, word string, n long")
    named = land(named.join(ends, "own", "left_semi"), "hashed-words")
    out = (met.join(named.toDF("a", "aw", "an"), "a").join(named.toDF("b", "bw", "bn"), "b")
           .select(F.least("aw", "bw").alias("u"), F.col("aw"), F.col("an"), F.col("bw"), F.col("bn")))
    first = F.col("u") == F.col("aw")
    return out.select(F.col("u").alias("a"), F.when(first, F.col("an")).otherwise(F.col("bn")).alias("an"),
                      F.when(first, F.col("bw")).otherwise(F.col("aw")).alias("b"), F.when(first, F.col("bn")).otherwise(F.col("an")).alias("bn"))


def near_pairs(words: DataFrame, crowded: int = CROWDED, depth: int = DEPTH, long: int = LONG) -> DataFrame:
    """(a, an, b, bn), a < b: every pair of the landed (word, n) rows that one edit tells apart, once."""
    short = words.where(F.length("word") <= long)
    prefixes = land(crowded_prefixes(short, crowded, depth), "crowded-prefixes")
    at = land(placed(short, prefixes, depth), "placed-words")
    deep = at.where(F.col("own") > depth)  # their prefix of ``depth`` letters is crowded
    pairs = part_pairs(at.where(F.col("own") <= depth)).unionByName(crowded_pairs(at, depth))
    pairs = pairs.unionByName(hashed_pairs(words, deep.select("word", F.lit(depth).alias("first"))))
    over = words.where(F.length("word") >= long).select("word", F.lit(0).alias("first"))
    longer = hashed_pairs(words, over).where(F.greatest(F.length("a"), F.length("b")) > long)
    return pairs.unionByName(longer)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: forms followed to the last, by doubling; no cycle, as counts grow along forms."""
    at = land(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.join(at.toDF("root", "further"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = land(step, "roots")
        if not step.where("moved").limit(1).count():
            return step.select("word", "root")
        at = step.select("word", "root")


def spelling_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, every: int = EVERY, factor: int = FACTOR,
                      id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED, depth: int = DEPTH, long: int = LONG) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = land(vocabulary(id_text(docs, id_col, text_col), min_chars, min_count, every), "words")
    pairs = land(near_pairs(words, crowded, depth, long), "near-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("bn").alias("an"), F.col("a").alias("b"), F.col("an").alias("bn")))
    best = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.first("an").alias("n"),
                                 F.min(F.struct((-F.col("bn")).alias("less"), F.col("b").alias("form"))).alias("top"))
    best = best.select(F.col("a").alias("word"), "n_near", "n", F.col("top.form").alias("form"), (-F.col("top.less")).alias("form_n"))
    large = F.col("form_n") >= F.col("n") * factor
    best = land(best.select("word", "n_near", F.when(large, F.col("form")).alias("form"), F.when(large, F.col("form_n")).alias("form_n")), "forms")
    last = roots(best.where("form is not null"))
    out = words.join(best, "word", "left").join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words' counts, forms and roots."""
    return spelling_variants(read_table(spark, sf_dir, "documents"))
