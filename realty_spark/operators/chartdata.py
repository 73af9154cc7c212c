"""Chart-ready result tables replacing the reference's figures (V1-V8).

Each figure becomes a small DataFrame computed in a fixed number of jobs for
all columns at once; no raw points are shipped to the driver.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.distributions import norm_ppf
from realty_spark.operators.profile import to_long
from realty_spark.operators.quantiles import group_quantiles, quantile_rows


BROADCAST_GROUPS = 100_000


def _bins(long: DataFrame, keys: Sequence[str], value: str, bins: int) -> DataFrame:
    """Attach the 0-based equal-width bin of ``value`` within [min, max] per group (last bin closed)."""
    keys = list(keys)
    rng = long.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(w > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / w), F.lit(bins - 1))).otherwise(F.lit(0))
    # one row per key group: bounded by the number of profiled columns / groups
    return long.join(F.broadcast(rng), keys).withColumn("bin", b.cast("int")).withColumn("_w", w)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = K.HIST_BINS) -> DataFrame:
    """50-bin histogram of every numeric column: (variable, bin, left, right, count) (V1)."""
    long = to_long(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
    b = _bins(long, ["variable"], "value", bins)
    return (b.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"),
                                            F.first("_w").alias("_w"))
            .select("variable", "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("left"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("right"), "count"))


def boxplot(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Quartiles, whiskers (extreme data values within 1.5 IQR of the box) and outlier count per group (V2)."""
    keys = list(keys)
    v = long.where(F.col(value).isNotNull() & ~F.isnan(value))
    q = group_quantiles(v, keys, {"q1": (value, 0.25), "mediane": (value, 0.5), "q3": (value, 0.75)})
    q = q.withColumns({"_lo_f": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "_hi_f": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    # one row per plotted group; counted before it is broadcast, else left to the optimizer
    few = q.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    j = v.join(F.broadcast(q) if few else q, keys)
    inside = (F.col(value) >= F.col("_lo_f")) & (F.col(value) <= F.col("_hi_f"))
    agg = j.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("mediane").alias("mediane"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(value))).alias("moustache_basse"),
        F.max(F.when(inside, F.col(value))).alias("moustache_haute"),
        F.count_if(~inside).alias("nb_aberrants"), F.count(F.lit(1)).alias("n"))
    return agg


def boxplot_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return boxplot(to_long(df, columns), ["variable"])


def boxplot_by_category(df: DataFrame, columns: Sequence[str], target: str = "prix_m2") -> DataFrame:
    """Box of the target per level of each categorical column (V2)."""
    long = to_long(df, columns, "string", keep=[target], value="level").where(F.col("level").isNotNull())
    return boxplot(long, ["variable", "level"], target)


def grid_counts(df: DataFrame, grids: Mapping[str, tuple[Column, Column]], bins: int = K.HIST_BINS,
                same_range: Collection[str] = (), labels: tuple[str, str, str] = ("graphique", "bin_x", "bin_y")) -> DataFrame:
    """2-D binned counts of several (x, y) pairs of columns: one aggregate for all extents, one binning pass for all grids.

    A grid's rows are those with both values; its extents are theirs, or in
    ``same_range`` the common extent of x and y (the square around y = x).
    Extents are a few numbers per grid and travel as literals.
    """
    name, bin_x, bin_y = labels
    pairs = {g: (x.cast("double"), y.cast("double")) for g, (x, y) in grids.items()}
    whole = {g: x.isNotNull() & ~F.isnan(x) & y.isNotNull() & ~F.isnan(y) for g, (x, y) in pairs.items()}
    ends = df.agg(*[f(F.when(whole[g], v)).alias(f"{g}\u0001{axis}\u0001{end}") for g, xy in pairs.items()
                    for axis, v in zip("xy", xy) for end, f in (("lo", F.min), ("hi", F.max))]).first()

    def place(g: str, axis: str, v: Column) -> Column:
        at = lambda a, end: ends[f"{g}\u0001{a}\u0001{end}"]
        lo, hi = at(axis, "lo"), at(axis, "hi")
        if g in same_range and lo is not None:
            lo, hi = min(at("x", "lo"), at("y", "lo")), max(at("x", "hi"), at("y", "hi"))
        if lo is None or not hi > lo:
            return F.lit(0)
        return F.least(F.floor((v - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
    cells = F.explode(F.array(*[F.when(whole[g], F.struct(F.lit(g).alias(name), place(g, "x", x).alias(bin_x), place(g, "y", y).alias(bin_y)))
                                for g, (x, y) in pairs.items()])).alias("c")
    return df.select(cells).where("c IS NOT NULL").select("c.*").groupBy(name, bin_x, bin_y).agg(F.count(F.lit(1)).alias("count"))


def scatter_bins(df: DataFrame, columns: Sequence[str], target: str = "prix_m2", bins: int = K.HIST_BINS) -> DataFrame:
    """2-D binned counts of each column against the target: a scatter plot at any scale (V3)."""
    return grid_counts(df, {c: (F.col(c), F.col(target)) for c in columns}, bins, labels=("variable", "bin_x", "bin_y"))


def prediction_grids(df: DataFrame, y: str = "y", yhat: str = "yhat", bins: int = K.HIST_BINS) -> DataFrame:
    """The evaluation figure's two scatters as counts (V3): predicted against actual on one range for both axes, and residual against predicted."""
    return grid_counts(df, {"predit_reel": (F.col(y), F.col(yhat)), "residu_predit": (F.col(yhat), F.col(y) - F.col(yhat))}, bins,
                       same_range=("predit_reel",))


def top_levels_chart(counts: DataFrame, bar_top: int = 20, pie_top: int = 10) -> DataFrame:
    """Bar (top 20) and pie (top 10, share of the top-10 total) data per column (V4)."""
    w = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("value").asc())
    r = counts.withColumn("rang", F.row_number().over(w)).where(F.col("rang") <= bar_top)
    pie_total = F.sum(F.when(F.col("rang") <= pie_top, F.col("n"))).over(Window.partitionBy("variable"))
    return r.withColumn("part_camembert_pct",
                        F.when(F.col("rang") <= pie_top, F.col("n") * 100.0 / pie_total))


def mean_bar(stats: DataFrame, first: int = 20) -> DataFrame:
    """Mean target of the first 20 levels (level order) of each column (V5)."""
    w = Window.partitionBy("variable").orderBy("level")
    return (stats.withColumn("ordre", F.row_number().over(w)).where(F.col("ordre") <= first)
            .select("variable", "ordre", "level", "mean"))


def corr_chart(corr: DataFrame) -> DataFrame:
    """Bar order of Pearson coefficients (largest |r| first) (V6)."""
    w = Window.orderBy(F.abs("pearson").desc_nulls_last(), F.col("variable"))
    return corr.select("variable", "pearson").withColumn("ordre", F.row_number().over(w))


def qq_points(df: DataFrame, value: str, keys: Sequence[str] = (), points: int = 200) -> DataFrame:
    """Normal Q-Q data on a fixed grid of ``points`` probabilities plus the fitted line (V7).

    Sample quantiles are exact (skew-proof quantile operator); theoretical
    quantiles come from the normal inverse CDF; the line is the least-squares
    fit of sample on theoretical quantiles.
    """
    keys = list(keys)
    probs = [(i - 0.5) / points for i in range(1, points + 1)]
    rows = quantile_rows(df, keys, [value], probs)
    out = rows.select(*keys, F.col("_at").alias("sample_q"), ((F.col("q") + 0.5) / points).alias("prob"))
    out = out.withColumn("theoretical_q", norm_ppf(F.col("prob")))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return out.withColumns({
        "pente": F.regr_slope("sample_q", "theoretical_q").over(wk),
        "ordonnee": F.regr_intercept("sample_q", "theoretical_q").over(wk)})


def forecast_overview(panel: DataFrame, forecasts: DataFrame, best: DataFrame, target: str) -> DataFrame:
    """Long table for the per-zone overview figure: history, actual and each model's forecast with its interval (V8).

    ``forecasts`` has (model, zone, annee_mois, yhat, lo, hi), ``best`` the
    (model, zone, meilleure_zone) whose detail the figure shows.
    """
    series = panel.select("zone", "annee_mois", F.when(F.col("split") == "train", "historique").otherwise("reel").alias("kind"),
                          F.col(target).alias("value"))
    made = forecasts.join(best, ["model", "zone"], "left").select(
        "model", "zone", "annee_mois", F.lit("prevision").alias("kind"), F.col("yhat").alias("value"), "lo", "hi",
        F.coalesce("meilleure_zone", F.lit(False)).alias("meilleure_zone"))
    return made.unionByName(series, allowMissingColumns=True)
