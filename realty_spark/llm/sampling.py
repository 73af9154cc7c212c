"""Bounded, deterministic samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from realty_spark.llm.common import join_small, land


def fold(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(-1))


def bounded(rows: DataFrame, label: str, per_label: int, total: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_label`` rows of each label and ``total`` rows in all, chosen by a hash of the id.

    Only hashes below 1.5 x per_label / count of the label (plus ten standard
    deviations) are ranked, so a frequent label sends few rows to its group.
    """
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    counts = land(rows.groupBy(label).agg(F.count("*").alias("_n")), "label-counts")
    rate = (1.5 * per_label + 10.0 * per_label ** 0.5) / F.col("_n")
    low = join_small(rows.withColumn("_draw", draw), counts, [label]).where(F.col("_draw") <= rate)  # before any shuffle of the rows
    first = low.withColumn("_rank", F.row_number().over(Window.partitionBy(label).orderBy("_draw", id_col))).where(
        F.col("_rank") <= per_label)
    return first.orderBy("_rank", label, id_col).limit(total).drop("_rank", "_draw", "_n")
