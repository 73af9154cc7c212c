"""Association of every variable with the target price (H1-H7).

All categorical (or numeric) columns are tested in the same jobs through a
long ``(variable, level|x, y)`` table.  Group statistics are partial
aggregates.  The rank tests share one table of the target's distinct values,
which holds a value's average rank among the rows of every tested column; a
column is reduced to counts of (level or x, y) before it meets that table, so
no raw row is joined or ranked.  p-values are column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.distributions import chi2_sf, corr_pvalue, f_sf, norm_cdf_np, norm_ppf_np
from realty_spark.functions.numeric import safe_corr, safe_div, significance_flag
from realty_spark.operators.profile import to_long
from realty_spark.operators.quantiles import average_rank, running_counts
from realty_spark.session import scratch_path


def category_long(df: DataFrame, columns: Sequence[str], target: str = "prix_m2") -> DataFrame:
    """(variable, level, y) over rows with a level and a target (empty / NULL groups drop out)."""
    long = to_long(df, columns, "string", keep=[target], value="level")
    return long.where(F.col("level").isNotNull() & F.col(target).isNotNull()
                      & ~F.isnan(target)).withColumnRenamed(target, "y")


def anova(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", with_p: bool = True) -> DataFrame:
    """One-way ANOVA F of the target across the levels of each column (H1).

    Fewer than two non-empty groups -> (0.0, 1.0, 'Non') as in the reference.
    """
    long = category_long(df, columns, target)
    g = long.groupBy("variable", "level").agg(F.count("y").alias("n"), F.avg("y").alias("m"),
                                              F.var_pop("y").alias("v"))
    v = g.groupBy("variable").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"))
    # between-group sum of squares around the grand mean: the per-variable
    # table has one row per tested column, a proven bound for the broadcast.
    b = (g.join(F.broadcast(v.select("variable", "gm")), "variable")
         .groupBy("variable").agg(F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2).alias("ssb")))
    v = v.join(b, "variable")
    ssb = F.col("ssb")
    f = safe_div(ssb / (F.col("k") - 1), safe_div(F.col("ssw"), F.col("N") - F.col("k")))
    out = v.select("variable", "k", "N", F.when(F.col("k") > 1, f).otherwise(F.lit(0.0)).alias("f_stat"))
    if with_p:
        p = F.when(F.col("k") > 1, f_sf(F.col("f_stat"), F.col("k") - 1, F.col("N") - F.col("k"))) \
            .otherwise(F.lit(1.0))
        out = out.withColumn("p_value", p).withColumn("significatif", significance_flag("p_value"))
    return out


class TargetRanks:
    """Average ranks of the target's distinct values among the complete rows of each of several columns.

    One range sort of (y, rows per column) serves all columns, whatever their
    null patterns.  ``table`` has (y, ranks), ranks being an array in the
    columns' order; ``n`` and ``ties`` hold each column's rows and sum of
    t^3 - t over its tied values (one number per column, fetched).
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], target: str, numeric: bool, partitions: int | None = None):
        y = F.col(target).cast("double")
        counts = [f"_t{i}" for i in range(len(columns))]
        present = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) if numeric else F.col(c).isNotNull() for c in columns]
        cells = (df.select(y.alias("y"), *[p.cast("long").alias(t) for p, t in zip(present, counts)])
                 .where(F.col("y").isNotNull() & ~F.isnan("y")).groupBy("y").agg(*[F.sum(t).alias(t) for t in counts]))
        table = running_counts(cells, [], "y", counts, partitions)
        cubes = [(F.pow(F.col(t).cast("double"), F.lit(3.0)) - F.col(t)) for t in counts]
        totals = table.agg(*[F.sum(t).alias(t) for t in counts], *[F.sum(c).alias(f"c{t}") for c, t in zip(cubes, counts)]).first()
        self.columns = list(columns)
        self.n = {c: totals[t] or 0 for c, t in zip(columns, counts)}
        self.ties = {c: totals[f"c{t}"] or 0.0 for c, t in zip(columns, counts)}
        self.table = table.select("y", F.array(*[average_rank(t) for t in counts]).alias("ranks"))

    def of(self, per_column: dict) -> Column:
        """The value of ``per_column`` for the row's variable."""
        return F.element_at(F.create_map(*[x for c in self.columns for x in (F.lit(c), F.lit(per_column[c]))]), F.col("variable"))

    def ranked(self, cells: DataFrame) -> DataFrame:
        """``cells`` (variable, .., y, c) with ``ry``, the average rank of y among the variable's rows."""
        at = self.of({c: i for i, c in enumerate(self.columns)})
        return cells.join(self.table, "y").withColumn("ry", F.col("ranks")[at]).drop("ranks")


def kruskal(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", with_p: bool = True,
            partitions: int | None = None) -> DataFrame:
    """Kruskal-Wallis H with tie correction per column (H2)."""
    ranks = TargetRanks(df, columns, target, numeric=False, partitions=partitions)
    cells = category_long(df, columns, target).groupBy("variable", "level", F.col("y").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("c"))
    rs = ranks.ranked(cells).groupBy("variable", "level").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("ry")).alias("R"))
    per = rs.groupBy("variable").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), F.sum(F.col("R") * F.col("R") / F.col("n")).alias("s"))
    nd = F.col("N").cast("double")
    h0 = F.lit(12.0) / (nd * (nd + 1)) * F.col("s") - 3.0 * (nd + 1)
    h = safe_div(h0, F.lit(1.0) - safe_div(ranks.of(ranks.ties), nd ** 3 - nd))
    out = per.select("variable", "k", "N", F.when(F.col("k") > 1, h).otherwise(F.lit(0.0)).alias("h_stat"))
    if with_p:
        p = F.when(F.col("k") > 1, chi2_sf(F.col("h_stat"), F.col("k") - 1)).otherwise(F.lit(1.0))
        out = out.withColumn("p_value", p).withColumn("significatif", significance_flag("p_value"))
    return out


def numeric_long(df: DataFrame, columns: Sequence[str], target: str = "prix_m2") -> DataFrame:
    """(variable, x, y) over pairwise complete rows."""
    long = to_long(df, columns, "double", keep=[target], value="x")
    return (long.withColumnRenamed(target, "y")
            .where(F.col("x").isNotNull() & ~F.isnan("x") & F.col("y").isNotNull() & ~F.isnan("y")))


def pearson(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", with_p: bool = True) -> DataFrame:
    """Pearson r (and two-sided p) of each numeric column with the target (H3).

    Sorted by |r| descending, NULLs last (O5) when collected with ``order_by_abs``.
    """
    long = numeric_long(df, columns, target)
    out = long.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), safe_corr("x", "y").alias("pearson"))
    if with_p:
        out = out.withColumn("pearson_p", corr_pvalue(F.col("pearson"), F.col("n")))
    return out


def order_by_abs(df: DataFrame, col: str = "pearson") -> DataFrame:
    return df.orderBy(F.abs(F.col(col)).desc_nulls_last(), F.col("variable"))


def spearman(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", with_p: bool = True,
             partitions: int | None = None) -> DataFrame:
    """Spearman rho: Pearson on average ranks, centred for precision (H4).

    Per (variable, x) the centred target ranks are summed first; the distinct x
    are ranked afterwards, so that a column of few distinct values joins few rows.
    """
    ranks = TargetRanks(df, columns, target, numeric=True, partitions=partitions)
    cells = numeric_long(df, columns, target).groupBy("variable", "x", F.col("y").cast("double").alias("y")).agg(F.count(F.lit(1)).alias("c"))
    dy = F.col("ry") - (ranks.of(ranks.n) + 1) / 2.0
    per_x = ranks.ranked(cells).groupBy("variable", "x").agg(
        F.sum("c").alias("c"), F.sum(F.col("c") * dy).alias("sy"), F.sum(F.col("c") * dy * dy).alias("syy"))
    per_x = running_counts(per_x, ["variable"], "x", ["c"], partitions)
    dx = average_rank("c") - (ranks.of(ranks.n) + 1) / 2.0
    agg = per_x.groupBy("variable").agg(F.sum("c").alias("n"), F.sum(dx * F.col("sy")).alias("sxy"),
                                        F.sum(F.col("c") * dx * dx).alias("sxx"), F.sum("syy").alias("syy"))
    den = F.sqrt(F.col("sxx") * F.col("syy"))
    out = agg.select("variable", "n", F.when(den > 0, F.col("sxy") / den).alias("spearman"))
    if with_p:
        out = out.withColumn("spearman_p", corr_pvalue(F.col("spearman"), F.col("n")))
    return out


def corr_matrix(df: DataFrame, columns: Sequence[str], target: str | None = "prix_m2") -> DataFrame:
    """Full pairwise Pearson matrix (pairwise complete rows) in one aggregation (H6).

    Long output (var1, var2, r) with both orientations and the diagonal.
    """
    cols = list(columns) + ([target] if target else [])
    exprs, names = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            name = f"{a}\u0001{b}"
            expr = safe_corr(a, b) if a != b else F.when(F.var_pop(a) > 0, F.lit(1.0))
            exprs.append(expr.alias(name))
            names.append(name)
    one = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).agg(*exprs)
    long = one.unpivot([], names, "pair", "r")
    parts = F.split("pair", "\u0001")
    a = long.select(parts[0].alias("var1"), parts[1].alias("var2"), "r")
    b = a.where(F.col("var1") != F.col("var2")).select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "r")
    return a.unionByName(b)


def jarque_bera(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jarque-Bera normality statistic on the full data, p = exp(-JB/2) (chi2, 2 df) (H5 companion)."""
    long = to_long(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
    m = long.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.skewness("value").alias("skew"),
                                    F.kurtosis("value").alias("kurt"))
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4.0)
    return (m.withColumn("jb", jb).withColumn("jb_p", F.exp(-F.col("jb") / 2.0))
            .withColumn("normal", significance_flag("jb_p", below=False)))


# ------------------------------------------------------------ Shapiro-Wilk --
def row_sample(df: DataFrame, keys: Sequence[str], row_key: Sequence[str], size: int = K.SHAPIRO_MAX_SAMPLE, seed: int = 42,
               slack: float = 1.5) -> DataFrame:
    """Seeded sample of min(n, ``size``) rows per group: those of least md5 of "<row key>|..|<seed>".

    Any engine draws the same rows.  Only hashes below ``slack * size / n``
    (plus ten standard deviations, so that fewer than ``size`` are below with a
    probability under 1e-100) reach the window, which so sorts about 1.5 x size
    rows per group.  The counts have one row per group of profiled columns and
    are broadcast.
    """
    keys = list(keys)
    draw = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in row_key], F.lit(str(seed))))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rate = (F.lit(slack * size) + 10.0 * F.sqrt(F.lit(float(size)))) / F.col("_n")
    low = df.withColumn("_draw", draw).join(F.broadcast(counts), keys).where(
        F.conv(F.substring("_draw", 1, 12), 16, 10).cast("double") / float(1 << 48) <= rate)
    w = Window.partitionBy(*keys).orderBy("_draw", *row_key)
    return low.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= size).select(df.columns)


def shapiro_sample(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", row_key: Sequence[str] | None = None,
                   size: int = K.SHAPIRO_MAX_SAMPLE, seed: int = 42) -> DataFrame:
    """(variable, row key.., x): the pairwise complete rows that ``shapiro`` tests; the row key is the whole row where none is named."""
    if row_key is None:
        df, row_key = df.withColumn("_row", F.xxhash64(*df.columns)), ["_row"]
    long = to_long(df, columns, "double", keep=[target, *row_key], value="x")
    whole = F.col("x").isNotNull() & ~F.isnan("x") & F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double"))
    return row_sample(long.where(whole).select("variable", *row_key, "x"), ["variable"], row_key, size, seed)


def shapiro_wilk_np(x: np.ndarray) -> tuple[float, float]:
    """Shapiro-Wilk W and p with Royston's (1992/1995) approximations, 3 <= n <= 5000."""
    x = np.sort(np.asarray(x, dtype=float))
    n = len(x)
    if n < 3:
        return math.nan, math.nan
    rng = x[-1] - x[0]
    if rng <= 0:
        return 1.0, 1.0
    m = norm_ppf_np((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    ssm = float(np.dot(m, m))
    u = 1.0 / math.sqrt(n)
    c = m / math.sqrt(ssm)
    a = np.zeros(n)
    if n == 3:
        a[-1] = math.sqrt(0.5)
        a[0] = -a[-1]
    else:
        an = c[-1] + 0.221157 * u - 0.147981 * u ** 2 - 2.071190 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5
        if n > 5:
            an1 = (c[-2] + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3
                   + 5.682633 * u ** 4 - 3.582633 * u ** 5)
            phi = (ssm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * an ** 2 - 2 * an1 ** 2)
            a[1:-1] = m[1:-1] / math.sqrt(phi)
            a[-1], a[0], a[-2], a[1] = an, -an, an1, -an1
        else:
            phi = (ssm - 2 * m[-1] ** 2) / (1 - 2 * an ** 2)
            a[1:-1] = m[1:-1] / math.sqrt(phi)
            a[-1], a[0] = an, -an
    xc = x - x.mean()
    w = float(np.dot(a, x) ** 2 / np.dot(xc, xc))
    w = min(w, 1.0)
    if n == 3:
        p = max(0.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
        return w, p
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        mu = 0.5440 - 0.39978 * n + 0.025054 * n ** 2 - 0.0006714 * n ** 3
        sigma = math.exp(1.3822 - 0.77857 * n + 0.062767 * n ** 2 - 0.0020322 * n ** 3)
        arg = gamma - math.log1p(-w) if w < 1 else math.inf
        z = (-math.log(arg) - mu) / sigma if arg > 0 else math.inf
    else:
        ln = math.log(n)
        mu = -1.5861 - 0.31082 * ln - 0.083751 * ln ** 2 + 0.0038915 * ln ** 3
        sigma = math.exp(-0.4803 - 0.082676 * ln + 0.0030302 * ln ** 2)
        z = (math.log1p(-w) - mu) / sigma if w < 1 else -math.inf
    p = float(1.0 - norm_cdf_np(z))
    return w, p


def shapiro(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", size: int = K.SHAPIRO_MAX_SAMPLE,
            seed: int = 42, row_key: Sequence[str] | None = None) -> DataFrame:
    """Shapiro-Wilk on a seeded sample of at most ``size`` pairwise-complete values per column (H5).

    The reference samples without a seed; this sample is reproducible.  Each
    grouped call sees at most ``size`` rows.
    """
    sample = shapiro_sample(df, columns, target, row_key, size, seed).select("variable", "x")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = shapiro_wilk_np(pdf["x"].to_numpy())
        return pd.DataFrame({"variable": [pdf["variable"].iloc[0]], "n_echantillon": [len(pdf)],
                             "w": [w], "shapiro_p": [p]})

    out = sample.groupBy("variable").applyInPandas(
        fit, "variable string, n_echantillon long, w double, shapiro_p double")
    return out.withColumn("normal", significance_flag("shapiro_p", below=False))


def association_report(df: DataFrame, columns: Sequence[str], target: str = "prix_m2",
                       max_levels: int | None = K.TEST_MAX_LEVELS, partitions: int | None = None) -> DataFrame:
    """ANOVA + Kruskal-Wallis for every categorical column with fewer than ``max_levels`` levels (H7); None: no gate.

    The gate's answer, one row per column, is fetched first: columns that fail it are not tested.
    """
    from realty_spark.operators.profile import level_gate
    gate = level_gate(df, columns, test_max=K.TEST_MAX_LEVELS if max_levels is None else max_levels).select(
        "variable", "nb_categories", "test")
    verdicts = gate.collect()  # a row per named column
    tested = [r["variable"] for r in verdicts if r["test"] or max_levels is None]
    spark = df.sparkSession
    listed = spark.createDataFrame([(r["variable"], r["nb_categories"]) for r in verdicts if r["variable"] in tested],
                                   "variable string, nb_categories long")
    if not tested:
        tested = list(columns)[:1]  # an empty listing keeps the report's columns
    a = anova(df, tested, target).select("variable", "f_stat", F.col("p_value").alias("p_anova"),
                                         F.col("significatif").alias("sig_anova"))
    k = kruskal(df, tested, target, partitions=partitions).select(
        "variable", "h_stat", F.col("p_value").alias("p_kruskal"), F.col("significatif").alias("sig_kruskal"))
    return listed.join(a, "variable", "left").join(k, "variable", "left")


def landed_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The named columns of ``df``, or all, written once as Parquet into the checkpoint folder and read back."""
    kept = df.select(*dict.fromkeys(columns)) if columns else df
    path = scratch_path(df.sparkSession, "report-rows")
    kept.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(kept.schema).parquet(path)


def correlation_report(df: DataFrame, columns: Sequence[str], target: str = "prix_m2",
                       partitions: int | None = None, normality: bool = True, row_key: Sequence[str] | None = None) -> DataFrame:
    """Pearson, Spearman (with p) and, with ``normality``, the Shapiro flag per numeric column (reference layout).

    The columns that the tests read are landed first: five passes read them,
    each of which would otherwise derive the rows anew.
    """
    df = landed_columns(df, None if normality and row_key is None else [*columns, target, *(row_key or ())])
    p = pearson(df, columns, target)
    s = spearman(df, columns, target, partitions=partitions).drop("n")
    if not normality:
        return p.join(s, "variable", "left")
    sh = shapiro(df, columns, target, row_key=row_key).select("variable", "normal")
    return p.join(s, "variable", "left").join(sh, "variable", "left")
