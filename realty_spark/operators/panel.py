"""Monthly zone panels and the window features built on them.

The raw sales are reduced to one row per (zone, month) by a single shuffle
with map-side partial aggregation; exact medians come from the skew-proof
``group_quantiles``.  Everything after the panel is tiny (zones x months), so
per-zone windows are cheap; series never travel through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.dates import month_start
from realty_spark.functions.labels import zone_label
from realty_spark.operators.quantiles import group_stats

PANEL_KEYS = ("zone", "annee_mois")


def with_zone(df: DataFrame, department: str = "code_departement") -> DataFrame:
    """zone = 'Dept <code>' (C16) and the month start."""
    return df.withColumns({"zone": zone_label(department), "annee_mois": month_start("date_mutation")})


def monthly_panel(sales: DataFrame, price: str = "prix_m2", value: str = "valeur_fonciere",
                  extended: bool = False) -> DataFrame:
    """Per (zone, month): median/mean price per m2, sale count, median sale value.

    ``extended=True`` adds price std (n-1), mean rooms, mean surface (A8).
    Rows with a NULL zone or month are dropped first (pandas group-by).
    """
    keys = list(PANEL_KEYS)
    base = sales.where(F.col("zone").isNotNull() & F.col("annee_mois").isNotNull())
    # every row of the cleaned sales has a price (price filter), so the price
    # count is the row count of the group
    moments = {"prix_moyen_m2": (price, "avg"), "nb_transactions": (price, "count")}
    if extended:
        moments.update({"prix_std_m2": (price, "stddev_samp"), "nb_pieces_moy": ("nombre_pieces_principales", "avg"),
                        "surface_moy": ("surface_reelle_bati", "avg")})
    st = group_stats(base, keys, {"prix_median_m2": (price, 0.5), "valeur_mediane": (value, 0.5)}, moments)
    cols = ["zone", "annee_mois", "prix_median_m2", "prix_moyen_m2"]
    cols += (["prix_std_m2", "valeur_mediane", "nb_pieces_moy", "surface_moy", "nb_transactions"]
             if extended else ["nb_transactions", "valeur_mediane"])
    return st.select(*cols)


def panel_span(panel: DataFrame) -> DataFrame:
    """First/last month per split and the number of distinct zones."""
    by = ["split"] if "split" in panel.columns else []
    return panel.groupBy(*by).agg(F.min("annee_mois").alias("mois_min"), F.max("annee_mois").alias("mois_max"),
                                  F.countDistinct("zone").alias("nb_zones"))


def series_stats(panel: DataFrame, target: str) -> DataFrame:
    """Per (split, zone): length, min, max, mean of the target series."""
    return panel.groupBy("split", "zone").agg(
        F.count(F.lit(1)).alias("n"), F.min(target).alias("y_min"),
        F.max(target).alias("y_max"), F.avg(target).alias("y_mean"))


def series_gate(panel: DataFrame, target: str = "prix_median_m2",
                min_train: int = K.MIN_TRAIN_MONTHS) -> DataFrame:
    """One row per zone seen in train with its status.

    ``status`` is 'ok', or 'skipped' with a reason when the train series is
    shorter than ``min_train`` months or the zone has no test month (the
    anti-join side of the train/test alignment).
    """
    st = series_stats(panel, target)
    tr = st.where(F.col("split") == "train").select(
        "zone", F.col("n").alias("nb_train"), F.col("y_min").alias("train_min"),
        F.col("y_max").alias("train_max"), F.col("y_mean").alias("train_mean"))
    te = st.where(F.col("split") == "test").select("zone", F.col("n").alias("nb_test"))
    g = tr.join(te, "zone", "left").withColumn("nb_test", F.coalesce("nb_test", F.lit(0)))
    status = (F.when(F.col("nb_train") < min_train, F.lit("skipped"))
              .when(F.col("nb_test") == 0, F.lit("skipped")).otherwise(F.lit("ok")))
    reason = (F.when(F.col("nb_train") < min_train, F.lit("train series shorter than minimum"))
              .when(F.col("nb_test") == 0, F.lit("no test month")))
    return g.withColumn("status", status).withColumn("reason", reason)


def panel_features(panel: DataFrame, target: str = "prix_median_m2", leak_free: bool = False,
                   lags: Sequence[int] = K.FEATURE_LAGS, means: Sequence[int] = K.FEATURE_MEANS,
                   stds: Sequence[int] = K.FEATURE_STDS) -> DataFrame:
    """Lag / rolling / trend / calendar features per zone series.

    Windows count rows, not calendar months, and rolling statistics are only
    set on a full window (T14).  A feature exists for a zone only when the
    series is longer than its window (the reference adds the column only then),
    so ``complete`` tells whether a row survives a NULL drop over the existing
    features (P8).  With ``leak_free=True`` rolling statistics and the trend
    use rows strictly before the current one, so no feature contains the target.
    """
    w = Window.partitionBy("zone").orderBy("annee_mois")
    n = F.count(F.lit(1)).over(Window.partitionBy("zone"))
    y = F.col(target)
    out = panel.select("zone", "annee_mois", target).withColumns({
        "_n": n, "mois": F.month("annee_mois"), "annee": F.year("annee_mois"),
        "mois_depuis_debut": (F.row_number().over(w) - 1).cast("int")})
    end = -1 if leak_free else 0
    exprs, exists = {}, {}
    for k in lags:
        exprs[f"lag_{k}"] = F.lag(y, k).over(w)
        exists[f"lag_{k}"] = k
    for k in means:
        fr = w.rowsBetween(end - k + 1, end)
        exprs[f"ma_{k}"] = F.when(F.count(y).over(fr) == k, F.avg(y).over(fr))
        exists[f"ma_{k}"] = k
    for k in stds:
        fr = w.rowsBetween(end - k + 1, end)
        exprs[f"std_{k}"] = F.when(F.count(y).over(fr) == k, F.stddev_samp(y).over(fr))
        exists[f"std_{k}"] = k
    exprs["tendance"] = (F.lag(y, 1).over(w) - F.lag(y, 2).over(w)) if leak_free else (y - F.lag(y, 1).over(w))
    exists["tendance"] = 1
    out = out.withColumns(exprs)
    complete = F.lit(True)
    for c, k in exists.items():
        complete = complete & (F.col(c).isNotNull() | (F.col("_n") <= k))
    return out.withColumn("complete", complete).drop("_n")


def chrono_split(features: DataFrame, share: float = K.VALIDATION_SHARE) -> DataFrame:
    """Flag the last (1 - share) of each zone's complete rows as validation.

    Fit rows are the first ``int(n * share)`` rows in month order.
    """
    w = Window.partitionBy("zone").orderBy("annee_mois")
    n = F.count(F.lit(1)).over(Window.partitionBy("zone"))
    rn = F.row_number().over(w)
    return features.withColumn("is_validation", rn > F.floor(n * F.lit(share)))


def fallback_forecast(panel: DataFrame, target: str, window: int = K.FALLBACK_WINDOW) -> DataFrame:
    """Mean of the last ``window`` train values, repeated over each test month.

    Output: zone, step (1-based, in test month order), annee_mois, yhat.  The
    trailing mean is NULL when the train series is shorter than the window.
    """
    tr = panel.where(F.col("split") == "train")
    wdesc = Window.partitionBy("zone").orderBy(F.col("annee_mois").desc())
    last = (tr.withColumn("_rk", F.row_number().over(wdesc)).where(F.col("_rk") <= window)
            .groupBy("zone").agg(F.avg(target).alias("_m"), F.count(F.lit(1)).alias("_c"))
            .select("zone", F.when(F.col("_c") == window, F.col("_m")).alias("yhat")))
    steps = test_steps(panel)
    return steps.join(last, "zone").select("zone", "step", "annee_mois", "yhat")


def test_steps(panel: DataFrame) -> DataFrame:
    """(zone, step, annee_mois) of the test split, step = month rank within the zone."""
    te = panel.where(F.col("split") == "test")
    w = Window.partitionBy("zone").orderBy("annee_mois")
    return te.select("zone", "annee_mois", F.row_number().over(w).alias("step"))


def split_panel(sales: DataFrame, train_years, test_years, extended: bool = False) -> DataFrame:
    """Monthly panel of the train and test periods, tagged by ``split``.

    The reference aggregates train and test files separately; the two periods
    are disjoint in time so a single group-by over the tagged rows is the same.
    """
    y = F.year("annee_mois")
    tagged = sales.withColumn("split", F.when(y.isin(list(train_years)), F.lit("train"))
                              .when(y.isin(list(test_years)), F.lit("test"))).where(F.col("split").isNotNull())
    p = monthly_panel(tagged, extended=extended)
    return p.withColumn("split", F.when(F.year("annee_mois").isin(list(train_years)), F.lit("train"))
                        .otherwise(F.lit("test")))
