"""Exact order statistics without gathering a group in one task and without copies of the data.

Spark's ``percentile``/``median`` aggregate is exact, but its final merge keeps
a value->count map of a whole group in one task: a group holding a third of
100 TB cannot finish.  ``group_stats`` is exact, lazy and skew-proof instead:

1. one aggregate per group, combined map-side: its count, the ordinary moments
   and a mergeable quantile summary (``percentile_approx``, rank error 1 /
   ``accuracy`` of the group) that brackets each wanted rank by two values of
   the group.  Groups of up to ``small`` values are bracketed by their extremes;
2. one counting pass: a value inside a bracket stands for itself, all values
   between two brackets for one cell, and the cells are counted, again
   map-side combined, so a hot group leaves some thousandths of its distinct
   values, and equal values leave one;
3. running counts of a group's cells give the wanted ranks exactly.  A rank
   outside its bracket, which the summary's bound excludes, raises an error.

Rows meet their group's brackets by a join that the optimizer may turn into a
broadcast at its measured size, and whose skewed partitions AQE can split
otherwise.  Nothing is checkpointed, nothing runs before an action, and what a
query does not read is not computed.

``running_counts`` serves ranks: distinct values, counted first, are cut into
sorted ranges, landed by a reliable ``checkpoint()`` (so that ranges stay as
they are), and offset by the ranges before them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from realty_spark.session import ensure_checkpoint_dir

ACCURACY = 10_000  # of the summary: ranks are within 1 / ACCURACY of a group's size
SMALL = 10_000  # groups of so many values are bracketed by their extremes
BROADCAST_ROWS = 200_000
STRIDE = 16  # of a search among many quantiles

_MOMENTS = {"count": F.count, "avg": F.avg, "stddev_samp": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}


def _long_values(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """(keys, _var, _v) with NULL/NaN values and NULL keys removed."""
    sel = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in value_cols])
    for k in keys:
        sel = sel.where(F.col(k).isNotNull())
    if len(value_cols) == 1:
        long = sel.select(*keys, F.lit(value_cols[0]).alias("_var"), F.col(value_cols[0]).alias("_v"))
    else:
        long = sel.unpivot(list(keys), list(value_cols), "_var", "_v")
    return long.where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _bracketed(long: DataFrame, gkeys: list[str], qs: Sequence[float], accuracy: int, small: int) -> DataFrame:
    """(group, _brackets): for each quantile two values of the group with its rank between them, ascending."""
    wide = 3.0 / accuracy  # the summary's own error, and room for a rank that lies between two rows
    probes = [max(0.0, q - wide) for q in qs] + [min(1.0, q + wide) for q in qs]
    sketch = long.groupBy(*gkeys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        F.percentile_approx("_v", probes, accuracy).alias("_p"))
    k = len(qs)
    some = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct(F.col("_p")[i].alias("lo"), F.col("_p")[i + k].alias("hi")))
    whole = F.array(F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi")))
    return sketch.select(*gkeys, F.when(F.col("_n") <= small, whole).otherwise(some).alias("_brackets"))


def _cells(long: DataFrame, gkeys: list[str], brackets: DataFrame) -> DataFrame:
    """(group, _v, _inside, _before, _count, _n): values inside brackets, and what lies between brackets as one row each, counted on."""
    key = F.xxhash64(*gkeys)  # with a key of its own the join shuffles both sides, so that AQE can split a hot group
    every = F.transform(F.filter("_brackets", lambda b, i: i % STRIDE == 0), lambda b: b["lo"])
    rows = long.withColumn("_key", key).join(brackets.withColumn("_key", key).withColumn("_every", every), [*gkeys, "_key"])
    # of many brackets every 16th is looked at first, then those up to the next
    many = F.size("_brackets") > STRIDE
    rows = rows.select(*gkeys, "_v", "_brackets", F.when(many, F.size(F.filter("_every", lambda lo: lo <= F.col("_v")))).otherwise(1).alias("_block"))
    passed = F.greatest(F.col("_block") - 1, F.lit(0)) * STRIDE
    part = F.when(many, F.slice("_brackets", passed + 1, STRIDE)).otherwise(F.col("_brackets"))
    below = passed + F.size(F.filter(part, lambda b: b["lo"] <= F.col("_v")))
    marked = rows.select(*gkeys, "_v", "_brackets", below.alias("_below"))
    # both ends ascend, so a value lies in a bracket if it lies in the last that begins below it
    inside = F.when(F.col("_below") > 0, F.col("_v") <= F.get("_brackets", F.col("_below") - 1)["hi"]).otherwise(False)
    marked = marked.select(*gkeys, "_v", "_below", inside.alias("_inside"))
    cells = marked.groupBy(*gkeys, "_inside", F.when(F.col("_inside"), F.col("_v")).alias("_value"),
                           F.when(~F.col("_inside"), F.col("_below")).alias("_gap")).agg(
        F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_v"))
    group = Window.partitionBy(*gkeys)
    return cells.select(*gkeys, "_v", "_inside", "_count", F.sum("_count").over(group).alias("_n"),
                        (F.sum("_count").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_count")).alias("_before"))


def _with_reached(cells: DataFrame, name: str, qs: Sequence[float], reached: Callable[[Column], Column]) -> DataFrame:
    """``cells`` with the number of the ascending ``qs`` that are ``reached``, a first part of them: blocks are counted by their first, then one block's."""
    blocks = [F.array(*map(F.lit, qs[i:i + STRIDE])) for i in range(0, len(qs), STRIDE)]
    block = F.size(F.filter(F.array(*map(F.lit, qs[::STRIDE])), reached))
    within = F.size(F.filter(F.get(F.array(*blocks), F.col("_block") - 1), reached))
    told = F.when(F.col("_block") > 0, (F.col("_block") - 1) * STRIDE + within).otherwise(0)
    return cells.withColumn("_block", block).withColumn(name, told).drop("_block")


def quantile_rows(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str], qs: Sequence[float],
                  accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """(keys, _var, q, _at): the quantile of index ``q`` in the ascending ``qs`` of each value column and group."""
    long = _long_values(df, keys, value_cols)
    gkeys = [*keys, "_var"]
    cells = _cells(long, gkeys, _bracketed(long, gkeys, qs, accuracy, small))

    pos = lambda q: q * (F.col("_n") - 1)
    sides = {False: F.floor, True: F.ceil}

    def below(high: bool, rank: Column) -> Callable[[Column], Column]:
        return lambda q: sides[high](pos(q)) < rank
    for high in sides:  # a cell's targets are those from the first whose rank it reaches to the first beyond it
        cells = _with_reached(cells, f"_first_{high}", qs, below(high, F.col("_before")))
        cells = _with_reached(cells, f"_beyond_{high}", qs, below(high, F.col("_before") + F.col("_count")))

    def met(high: bool) -> Column:
        first, beyond = F.col(f"_first_{high}"), F.col(f"_beyond_{high}")
        own = F.when(beyond > first, F.sequence(first, beyond - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(own, lambda i: F.struct(i.alias("q"), F.lit(high).alias("high")))
    value = F.when(F.col("_inside"), F.col("_v")).otherwise(
        F.raise_error(F.lit("a quantile's rank lies outside its bracket")).cast("double"))
    found = cells.select(*gkeys, "_inside", "_v", "_n", F.explode(F.concat(*map(met, sides))).alias("_t"))
    picked = found.select(*gkeys, "_t.*", pos(F.get(F.array(*map(F.lit, qs)), F.col("_t.q"))).alias("pos"), value.alias("_v"))
    ends = picked.groupBy(*gkeys, "q").agg(
        F.first("pos").alias("pos"), F.max(F.when(~F.col("high"), F.col("_v"))).alias("lo"), F.max(F.when(F.col("high"), F.col("_v"))).alias("hi"))
    return ends.select(*gkeys, "q", (F.col("lo") + (F.col("pos") - F.floor("pos")) * (F.col("hi") - F.col("lo"))).alias("_at"))


def group_stats(df: DataFrame, keys: Sequence[str], quantiles: Mapping[str, tuple[str, float]],
                moments: Mapping[str, tuple[str, str]] | None = None, accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas/DuckDB ``quantile_cont``) and ordinary moments per group.

    ``quantiles`` maps an output column to ``(value column, q)``, e.g.
    ``{"prix_median_m2": ("prix_m2", 0.5)}``; ``moments`` maps one to ``(value
    column, fn)`` with fn in count/avg/stddev_samp/min/max/sum.  NULL/NaN
    values are skipped, NULL keys dropped; groups without any value are absent
    (left-join the result onto the group table to get NULLs).
    """
    keys, moments = list(keys), dict(moments or {})
    out = None
    if quantiles:
        qs = sorted({float(q) for _, q in quantiles.values()})
        rows = quantile_rows(df, keys, sorted({c for c, _ in quantiles.values()}), qs, accuracy, small)
        out = rows.groupBy(*keys).agg(*[
            F.max(F.when((F.col("_var") == c) & (F.col("q") == qs.index(float(q))), F.col("_at"))).alias(name) for name, (c, q) in quantiles.items()])
    if moments:
        present = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in sorted({c for c, _ in [*moments.values(), *quantiles.values()]})])
        for k in keys:
            present = present.where(F.col(k).isNotNull())
        valid = {c: F.when(F.col(c).isNotNull() & ~F.isnan(c), F.col(c)) for c in present.columns[len(keys):]}
        per = present.groupBy(*keys).agg(*[_MOMENTS[fn](valid[c]).alias(name) for name, (c, fn) in moments.items()],
                                         F.max(F.coalesce(*valid.values()).isNotNull()).alias("_any"))
        per = per.where("_any").drop("_any")
        if out is None:
            return per
        out = per.join(out, keys, "left") if keys else per.crossJoin(out)  # one row each without keys
    return out


def group_quantiles(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, float]],
                    accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """``group_stats`` without moments."""
    return group_stats(df, keys, measures, accuracy=accuracy, small=small)


# ----------------------------------------------------------------- ranks ----
def running_counts(cells: DataFrame, keys: Sequence[str], value: str, counts: Sequence[str], partitions: int | None = None,
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``cells`` (one row per keys and value) with ``<count>_before``: each count summed over the group's smaller values.

    The cells are range-partitioned by (keys, value) and landed once; ranges
    are offset by the ranges before them, a table of at most groups + ranges
    rows, which is broadcast only if it was counted to be small.
    """
    ensure_checkpoint_dir(cells.sparkSession)
    keys = list(keys)
    order = [*keys, value]
    dealt = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
    landed = dealt.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    ranges = landed.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_{c}") for c in counts])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(*keys, "_range", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in counts]).checkpoint(eager=True)
    offsets = F.broadcast(offsets) if offsets.count() <= broadcast_rows else offsets
    within = Window.partitionBy("_range", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = landed.select("*", *[(F.sum(c).over(within) - F.col(c)).alias(f"{c}_before") for c in counts])
    joined = summed.join(offsets, [*keys, "_range"])
    return joined.select(*cells.columns, *[(F.col(f"{c}_before") + F.col(f"_{c}")).alias(f"{c}_before") for c in counts])


def average_rank(count: str) -> Column:
    """The tie-aware 1-based average rank of a value from its count and the count before it."""
    return F.col(f"{count}_before") + (F.col(count) + 1) / 2.0


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Average (tie-aware) ranks of ``value`` within each group, 1-based.

    Returns one row per distinct (keys, value): ``keys, value, _t`` (tie count)
    and ``_rank`` (average rank).
    """
    keys = list(keys)
    cells = _long_values(df, keys, [value]).groupBy(*keys, F.col("_v").alias(value)).agg(F.count(F.lit(1)).alias("_t"))
    ranked = running_counts(cells, keys, value, ["_t"], partitions, broadcast_rows)
    return ranked.select(*keys, value, "_t", average_rank("_t").alias("_rank"))
