"""Rolling-origin back-tests: what an origin may know, ranks of the conformal quantile, coverage."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from realty_spark.operators import intervals, panel


def series(spark, zones, n, test=3, seed=0):
    rng, rows = np.random.default_rng(seed), []
    for z in zones:
        for i in range(n + test):
            rows.append((z, dt.date(2000 + i // 12, i % 12 + 1, 1), "train" if i < n else "test", float(100 + rng.normal())))
    return spark.createDataFrame(rows, "zone string, annee_mois date, split string, prix_median_m2 double")


def test_origins_hide_their_future(spark):
    p = series(spark, ["a", "b@c"], 40).unionByName(series(spark, ["short"], 20))
    tested = intervals.back_test_panel(p, "prix_median_m2", horizon=3, folds=4)
    got = tested.groupBy("zone").agg(F.sum((F.col("split") == "train").cast("int")).alias("train"), F.sum((F.col("split") == "test").cast("int")).alias("test"),
                                     F.max(F.when(F.col("split") == "train", F.col("annee_mois"))).alias("last"),
                                     F.min(F.when(F.col("split") == "test", F.col("annee_mois"))).alias("first")).collect()
    assert {r.zone: (r.train, r.test) for r in got} == {f"{z}@{k}": (40 - k, min(k, 3)) for z in ("a", "b@c") for k in range(1, 7)}
    assert all(r.last < r.first for r in got)
    fc = panel.fallback_forecast(tested, "prix_median_m2")
    errors = intervals.back_test_errors(fc, tested, "prix_median_m2").collect()
    assert {(r.zone, r.cut, r.step) for r in errors} == {(z, k, s) for z in ("a", "b@c") for k in range(1, 7) for s in range(1, min(k, 3) + 1)}


def test_half_width_is_the_conformal_rank_or_null(spark):
    rows = [("m", "z", k, 1, float(k)) for k in range(1, 15)] + [("m", "z", k, 2, 1.0) for k in range(1, 4)]
    got = {r.step: (r.nb_essais, r.demi_largeur) for r in intervals.half_widths(
        spark.createDataFrame(rows, "model string, zone string, cut int, step int, error double")).collect()}
    assert got == {1: (9, 8.0), 2: (3, None)}  # the latest nine origins; four of three errors would be needed
    assert math.ceil((9 + 1) * intervals.WIDTH) == 8


def test_intervals_cover_at_least_their_width(spark):
    """Exchangeable errors: a further one falls within the half width with a probability of at least ``WIDTH``."""
    rng, rows, fresh = np.random.default_rng(2), [], {}
    for z in range(1500):
        e = np.abs(rng.standard_t(3, intervals.FOLDS + 1))
        rows += [("m", str(z), k + 1, 1, float(v)) for k, v in enumerate(e[:-1])]
        fresh[str(z)] = e[-1]
    got = intervals.half_widths(spark.createDataFrame(rows, "model string, zone string, cut int, step int, error double")).collect()
    covered = np.mean([fresh[r.zone] <= r.demi_largeur for r in got])
    assert intervals.WIDTH - 0.03 <= covered <= intervals.WIDTH + 0.05


def test_sarima_and_trees_back_tests_give_every_origin(spark):
    p = series(spark, ["a", "b"], 62, test=2, seed=5)
    tested = intervals.back_test_panel(p, "prix_median_m2", horizon=2, folds=2).checkpoint()
    for rows in (intervals.sarima_back_test(tested, "prix_median_m2"), intervals.trees_back_test(tested, "prix_median_m2", max_iter=3)):
        errors = intervals.back_test_errors(rows, tested, "prix_median_m2").collect()
        assert {(r.zone, r.cut, r.step) for r in errors} == {(z, k, s) for z in "ab" for k in (1, 2, 3) for s in range(1, min(k, 2) + 1)}
        assert all(r.error < 20 for r in errors)
