"""Forecast alignment, sanity guard and error metrics.

Metrics are one aggregation over (model, zone) groups: sqrt(mean e^2),
mean |e|, R^2 = 1 - SSE/SST (not the squared correlation), MAPE with an
explicit zero policy.  Everything here runs on forecast-sized tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.numeric import clip, is_finite, round_half_even, safe_div
from realty_spark.operators.panel import test_steps
from realty_spark.operators.quantiles import group_quantiles


def align_forecast(forecast: DataFrame, panel: DataFrame, target: str) -> DataFrame:
    """Pair forecast step i with the i-th test month of its zone and the actual value."""
    actual = (test_steps(panel).join(panel.where(F.col("split") == "test").select("zone", "annee_mois", target),
                                     ["zone", "annee_mois"])
              .withColumnRenamed(target, "y"))
    return actual.join(forecast.select("zone", "step", "yhat"), ["zone", "step"])


def regression_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y", yhat: str = "yhat",
                       mape_zero: str = "skip") -> DataFrame:
    """RMSE, MAE, R^2 and MAPE per group.

    ``mape_zero='skip'`` ignores rows with y = 0 (NULL if none left);
    ``'propagate'`` returns +inf as soon as a y is 0 (numpy's unguarded mean).
    R^2 on a constant y is 1.0 for a perfect prediction else 0.0.  Every term
    is over rows with both an actual and a forecast; ``n`` counts them.
    """
    df = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    e = F.col(y) - F.col(yhat)
    ape = F.abs(safe_div(e, F.col(y)))
    mape = F.avg(F.when(F.col(y) != 0, ape)) * 100.0
    if mape_zero == "propagate":
        mape = F.when(F.count_if(F.col(y) == 0) > 0, F.lit(float("inf"))).otherwise(mape)
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"), mape.alias("mape"))
    r2 = (F.when(F.col("_sst") > 0, 1.0 - F.col("_sse") / F.col("_sst"))
          .when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return agg.withColumn("r2", r2).drop("_sse", "_sst")


def forecast_guard(forecast: DataFrame, gate: DataFrame, fallback: DataFrame, kind: str = "price") -> DataFrame:
    """Sanity guard of a zone forecast horizon.

    ``gate`` carries ``train_min``/``train_max`` per zone and ``fallback``
    the trailing-mean forecast (W6).  Volume: a step is bad when |f| > 3 max
    or not finite; bounds [0, 3 max].  Price: also f < 0.5 min; bounds
    [0.5 min, 1.5 max].  One bad step replaces the whole horizon by the
    fallback, then every step is clipped.
    """
    if kind == "volume":
        hi = F.col("train_max") * K.VOLUME_MAX_FACTOR
        lo = F.lit(0.0)
        bad = ~is_finite("yhat") | (F.abs("yhat") > hi)
    else:
        hi = F.col("train_max") * K.PRICE_MAX_FACTOR
        lo = F.col("train_min") * K.PRICE_MIN_FACTOR
        bad = ~is_finite("yhat") | (F.abs("yhat") > hi) | (F.col("yhat") < lo)
    fb = fallback.select("zone", "step", F.col("yhat").alias("_fb"))
    j = (forecast.join(gate.select("zone", "train_min", "train_max"), "zone").join(fb, ["zone", "step"], "left")
         .withColumn("_bad", F.coalesce(bad, F.lit(True))))
    any_bad = F.max(F.col("_bad").cast("int")).over(Window.partitionBy("zone")) == 1
    j = j.withColumn("fallback", any_bad)
    chosen = F.when(F.col("fallback"), F.col("_fb")).otherwise(F.col("yhat"))
    return j.select("zone", "step", F.col("yhat").alias("yhat_brut"), "fallback",
                    clip(chosen, lo, hi).alias("yhat"))


def metrics_summary(metrics: DataFrame, statuses: DataFrame | None = None) -> DataFrame:
    """Per model: mean and median MAPE, mean R^2, mean MAE, best zone."""
    med = group_quantiles(metrics, ["model"], {"mape_mediane": ("mape", 0.5)})
    s = metrics.groupBy("model").agg(
        F.avg("mape").alias("mape_moyen"), F.avg("r2").alias("r2_moyen"), F.avg("mae").alias("mae_moyen"),
        F.min_by("zone", F.struct(F.col("mape"), F.col("zone"))).alias("meilleure_zone"),
        F.count(F.lit(1)).alias("nb_zones_evaluees"))
    out = s.join(med, "model", "left")
    if statuses is not None:
        ratio = statuses.groupBy("model").agg(
            safe_div(F.count_if(F.col("status") == "ok").cast("double"), F.count(F.lit(1))).alias("taux_succes"))
        out = out.join(ratio, "model", "left")
    return out


def segment_errors(df: DataFrame, segment: str, y: str = "y", yhat: str = "yhat", top_n: int = 10,
                   scale: int = 2) -> DataFrame:
    """Absolute / relative error statistics per segment, worst ``top_n`` by MAE."""
    e = (df.where(F.col(segment).isNotNull())
         .withColumns({"erreur_abs": F.abs(F.col(y) - F.col(yhat)),
                       "erreur_rel": F.abs(safe_div(F.col(y) - F.col(yhat), F.col(y))) * 100.0}))
    st = e.groupBy(segment).agg(F.avg("erreur_abs").alias("MAE"), F.stddev_samp("erreur_abs").alias("Std_erreur"),
                                F.avg("erreur_rel").alias("MAPE"), F.count(segment).alias("Nb_observations"))
    q = group_quantiles(e, [segment], {"Mediane_erreur": ("erreur_abs", 0.5), "Mediane_MAPE": ("erreur_rel", 0.5)})
    r = lambda c: round_half_even(F.col(c), scale).alias(c)
    out = st.join(q, segment, "left").select(segment, r("MAE"), r("Mediane_erreur"), r("Std_erreur"), r("MAPE"),
                                            r("Mediane_MAPE"), "Nb_observations")
    return out.orderBy(F.col("MAE").desc(), F.col(segment)).limit(top_n)


def compare_models(metrics: DataFrame, model_a: str, model_b: str, metric: str = "mape") -> DataFrame:
    """Per-zone metric of two models side by side (full outer on zone) and a - b, ascending."""
    a = metrics.where(F.col("model") == model_a).select("zone", F.col(metric).alias(f"{metric}_a"))
    b = metrics.where(F.col("model") == model_b).select("zone", F.col(metric).alias(f"{metric}_b"))
    j = a.join(b, "zone", "full_outer").withColumn("difference", F.col(f"{metric}_a") - F.col(f"{metric}_b"))
    return j.orderBy(F.col("difference").asc_nulls_last(), F.col("zone"))


def comparison_table(metrics: DataFrame) -> DataFrame:
    """Model x dataset comparison with upper-cased dataset names."""
    extra = ["n"] if "n" in metrics.columns else []
    return metrics.select("model", F.upper("dataset").alias("dataset"), *extra, "rmse", "mae", "r2", "mape")
