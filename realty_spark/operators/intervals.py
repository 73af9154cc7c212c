"""Forecast intervals from rolling-origin back-tests (V8, M9).

Every model forecasts again from earlier origins of each zone's train series:
origin ``cut`` hides the last ``cut`` train months, of which the next
``horizon`` are forecast.  The (zone, origin) pairs are rows of one panel whose
zones are named "zone@cut", so the per-zone models run over all origins in one
job, and none sees a month behind its origin.  The absolute errors of a zone's
step give a split-conformal half width: the ceil((k + 1) * width)-th smallest
of k errors, which covers a further forecast with probability ``width`` where
errors are exchangeable.  A step with too few origins for that rank has no
interval (NULL).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.operators import forecast
from realty_spark.operators.evaluate import align_forecast
from realty_spark.operators.panel import series_gate, test_steps

FOLDS = 9  # origins that have an error for a step
WIDTH = K.SEASONAL_TREND_PARAMS["interval_width"]
MARK = "@"


def back_test_panel(panel: DataFrame, target: str, horizon: int, folds: int = FOLDS, min_train: int = K.MIN_TRAIN_MONTHS) -> DataFrame:
    """The panel of every (zone, origin): its zone is "zone@cut", its test split the ``horizon`` months behind the origin."""
    ok = series_gate(panel, target, min_train).where(F.col("status") == "ok").select("zone")
    zone = Window.partitionBy("zone")
    rows = (panel.where(F.col("split") == "train").join(ok, "zone")
            .withColumns({"_back": F.row_number().over(zone.orderBy(F.col("annee_mois").desc())), "_n": F.count(F.lit(1)).over(zone)}))
    cuts = F.explode(F.sequence(F.lit(1), F.lit(horizon + folds - 1)))
    each = rows.withColumn("cut", cuts).where((F.col("_n") - F.col("cut") >= min_train) & (F.col("_back") > F.col("cut") - horizon))
    return each.withColumns({"split": F.when(F.col("_back") > F.col("cut"), "train").otherwise("test"),
                             "zone": F.concat_ws(MARK, "zone", F.col("cut").cast("string"))}).drop("_back", "_n")


def back_test_errors(forecast_rows: DataFrame, tested: DataFrame, target: str) -> DataFrame:
    """(zone, cut, step, error) of a model's forecasts (zone, step, yhat) over the back-test panel."""
    aligned = align_forecast(forecast_rows.where("step IS NOT NULL AND yhat IS NOT NULL"), tested, target)
    parts = F.split("zone", MARK + "(?=[0-9]+$)")
    return aligned.where(F.col("y").isNotNull()).select(parts[0].alias("zone"), parts[1].cast("int").alias("cut"), "step",
                                                        F.abs(F.col("y") - F.col("yhat")).alias("error"))


def half_widths(errors: DataFrame, folds: int = FOLDS, width: float = WIDTH) -> DataFrame:
    """(model, zone, step, nb_essais, demi_largeur): the conformal quantile of each step's errors over its latest ``folds`` origins."""
    late = Window.partitionBy("model", "zone", "step").orderBy("cut")
    kept = errors.withColumn("_k", F.row_number().over(late)).where(F.col("_k") <= folds)
    per = kept.groupBy("model", "zone", "step").agg(F.sort_array(F.collect_list("error")).alias("e"))  # ``folds`` at most
    rank = F.ceil((F.size("e") + 1) * F.lit(width)).cast("int")
    return per.select("model", "zone", "step", F.size("e").alias("nb_essais"),
                      F.when(rank <= F.size("e"), F.get("e", rank - 1)).alias("demi_largeur"))


def with_intervals(forecasts: DataFrame, widths: DataFrame) -> DataFrame:
    """(model, zone, step, annee_mois, yhat, lo, hi, nb_essais) of (model, zone, step, annee_mois, yhat) rows."""
    j = forecasts.join(widths, ["model", "zone", "step"], "left")
    return j.select("model", "zone", "step", "annee_mois", "yhat", (F.col("yhat") - F.col("demi_largeur")).alias("lo"),
                    (F.col("yhat") + F.col("demi_largeur")).alias("hi"), F.coalesce("nb_essais", F.lit(0)).alias("nb_essais"))


def best_zones(metrics: DataFrame, metric: str = "mape") -> DataFrame:
    """(model, zone) of each model's zone of least ``metric``; ties to the first name."""
    return metrics.where(F.col(metric).isNotNull()).groupBy("model").agg(
        F.min_by("zone", F.struct(F.col(metric), F.col("zone"))).alias("zone")).withColumn("meilleure_zone", F.lit(True))


def horizon_of(panel: DataFrame) -> int:
    return test_steps(panel).agg(F.max("step")).first()[0] or 1


def per_zone_back_tests(tested: DataFrame, models: Mapping[str, object], target: str) -> DataFrame:
    """(model, zone, cut, step, error) of models that map (panel, target) to (zone, step, yhat)."""
    out = None
    for name, model in models.items():
        rows = back_test_errors(model(tested, target), tested, target).withColumn("model", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


def sarima_back_test(tested: DataFrame, target: str, kind: str = "price") -> DataFrame:
    """Seasonal ARIMA over the origins: orders are searched at a zone's earliest origin and refitted at each, so no order knows a later month."""
    cut = F.split("zone", MARK + "(?=[0-9]+$)")
    named = tested.withColumns({"_base": cut[0], "_cut": cut[1].cast("int")})
    zones = named.select("zone", "_base", "_cut").distinct()
    first = zones.groupBy("_base").agg(F.max("_cut").alias("_cut"))
    earliest = named.join(first, ["_base", "_cut"], "left_semi").drop("_base", "_cut")
    found = forecast.best_orders(forecast.sarima_grid(earliest, target)).withColumn("_base", cut[0]).drop("zone")
    orders = zones.select("zone", "_base").join(found, "_base").drop("_base").checkpoint()
    return forecast.sarima_forecast(tested, target, kind=kind, orders=orders)


def trees_back_test(tested: DataFrame, target: str, max_iter: int = K.GBT_PARAMS["n_estimators"], seed: int = K.GBT_PARAMS["seed"]) -> DataFrame:
    """Pooled trees over the origins: fitted on the months before every zone's earliest origin, rolled from each origin."""
    cut = F.split("zone", MARK + "(?=[0-9]+$)")
    named = tested.withColumns({"_base": cut[0], "_cut": cut[1].cast("int")})
    first = named.where(F.col("split") == "train").groupBy("_base").agg(F.max("_cut").alias("_cut"))
    history = named.where(F.col("split") == "train").join(first, ["_base", "_cut"], "left_semi").select(F.col("_base").alias("zone"), "annee_mois", target)
    trees = forecast.PooledTrees(history, history.select("zone").distinct(), target, max_iter, seed)
    states = forecast.forecast_states(tested, series_gate(tested, target).where(F.col("status") == "ok"), target)
    states = states.withColumn("essai", F.col("zone")).withColumn("zone", cut[0]).join(trees.eligible, "zone")
    return trees.roll(states).select(F.col("essai").alias("zone"), "step", "yhat")
