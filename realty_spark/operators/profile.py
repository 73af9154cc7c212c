"""Profiling of the sales table.

Column loops of the reference become one ``unpivot``: each report runs a
fixed number of jobs however many columns are profiled, and every
aggregate is partial (map-side) before its shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.numeric import round_half_even, safe_div
from realty_spark.operators.quantiles import group_stats


def to_long(df: DataFrame, columns: Sequence[str], value_type: str = "double", keep: Sequence[str] = (),
            value: str = "value") -> DataFrame:
    """(keep..., variable, value) with every listed column cast to ``value_type``."""
    sel = df.select(*keep, *[F.col(c).cast(value_type).alias(c) for c in columns])
    return sel.unpivot(list(keep), list(columns), "variable", value)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column in one pass (A5): (variable, nb_null)."""
    cols = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "variable", "nb_null")


def split_summary(df: DataFrame, target: str = "prix_m2", year: str = "annee") -> DataFrame:
    """Rows per (split, year) with split size, share of all rows, target mean/min/max."""
    per_year = df.groupBy("split", year).agg(F.count(F.lit(1)).alias("nb_annee"))
    per_split = df.groupBy("split").agg(F.count(F.lit(1)).alias("nb_lignes"), F.avg(target).alias("cible_moyenne"),
                                        F.min(target).alias("cible_min"), F.max(target).alias("cible_max"))
    total = F.sum("nb_lignes").over(Window.partitionBy())
    per_split = per_split.withColumn("part_pct", F.col("nb_lignes") * 100.0 / total)
    return per_year.join(per_split, "split")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: min, Q1, median, mean, Q3, max, std (n-1), NaN count, count."""
    long = to_long(df, columns)
    st = group_stats(long, ["variable"], {"q1": ("value", 0.25), "mediane": ("value", 0.5), "q3": ("value", 0.75)},
                     {"min": ("value", "min"), "moyenne": ("value", "avg"), "max": ("value", "max"),
                      "ecart_type": ("value", "stddev_samp"), "nb": ("value", "count")})
    nulls = null_profile(df, columns).withColumnRenamed("nb_null", "nb_nan")
    return nulls.join(st, "variable", "left").select(
        "variable", F.coalesce("nb", F.lit(0)).alias("nb"), "min", "q1", "mediane", "moyenne", "q3", "max",
        "ecart_type", "nb_nan")


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, n) for non-null levels of every categorical column (text-cast)."""
    long = to_long(df, columns, "string")
    return long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def category_profile(df: DataFrame, columns: Sequence[str], top: int = K.TOP_LEVELS) -> DataFrame:
    """Distinct levels, nulls, top-``top`` counts and % of non-null rows per column.

    Ties in frequency are broken on the level ascending (T19).
    """
    counts = level_counts(df, columns)
    per_var = counts.groupBy("variable").agg(F.count(F.lit(1)).alias("nb_categories"),
                                            F.sum("n").alias("_non_null"))
    nulls = null_profile(df, columns).withColumnRenamed("nb_null", "nb_valeurs_manquantes")
    w = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("value").asc())
    top_rows = counts.withColumn("rang", F.row_number().over(w)).where(F.col("rang") <= top)
    return (top_rows.join(per_var, "variable").join(nulls, "variable")
            .select("variable", "rang", "value", F.col("n").alias("effectif"),
                    (F.col("n") * 100.0 / F.col("_non_null")).alias("pourcentage"),
                    "nb_categories", "nb_valeurs_manquantes"))


def level_gate(df: DataFrame, columns: Sequence[str], plot_max: int = K.PLOT_MAX_LEVELS,
               test_max: int = K.TEST_MAX_LEVELS) -> DataFrame:
    """Distinct level count per column, chart gate (<= plot_max) and test gate (< test_max)."""
    per_var = level_counts(df, columns).groupBy("variable").agg(F.count(F.lit(1)).alias("nb_categories"))
    return per_var.withColumns({"graphique": F.col("nb_categories") <= plot_max,
                                "test": F.col("nb_categories") < test_max})


def domain_frame(spark, domains: Mapping[str, Sequence]) -> DataFrame:
    """Small (variable, level) table of declared category domains (proven size: literal lists)."""
    rows = [(v, str(level)) for v, levels in domains.items() for level in levels]
    return spark.createDataFrame(rows, "variable string, level string")


def target_by_category(df: DataFrame, columns: Sequence[str], target: str = "prix_m2",
                       domains: Mapping[str, Sequence] | None = None, scale: int = 2) -> DataFrame:
    """Per (column, level): count, mean, median, std, min, max of the target, half-even rounded.

    Levels of a declared domain with no rows appear with count 0 and NULL
    statistics (categorical group-by of the reference, T4).
    """
    long = to_long(df, columns, "string", keep=[target], value="level").where(F.col("level").isNotNull())
    out = group_stats(long, ["variable", "level"], {"median": (target, 0.5)},
                      {"count": (target, "count"), "mean": (target, "avg"), "std": (target, "stddev_samp"),
                       "min": (target, "min"), "max": (target, "max")})
    if domains:
        dom = F.broadcast(domain_frame(df.sparkSession, domains))
        declared = out.join(dom, ["variable", "level"], "right")
        others = out.join(dom.select("variable").distinct(), "variable", "left_anti")
        out = declared.unionByName(others).withColumn("count", F.coalesce("count", F.lit(0)))
    r = lambda c: round_half_even(F.col(c), scale).alias(c)
    return out.select("variable", "level", F.col("count").cast("long").alias("count"),
                      r("mean"), r("median"), r("std"), r("min"), r("max"))


def retention_rate(df: DataFrame, keep: "F.Column", by: str = "split") -> DataFrame:
    """Rows before/after cleaning and % kept per split, in one pass."""
    return (df.groupBy(by).agg(F.count(F.lit(1)).alias("nb_brut"), F.count_if(keep).alias("nb_propre"))
            .withColumn("taux_conservation_pct", safe_div(F.col("nb_propre") * 100.0, F.col("nb_brut"))))
