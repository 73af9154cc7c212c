"""Operator golden rows: district medians, imputation, profiling, windows, evaluation, guard."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from realty_spark.operators import association, district, evaluate, panel, profile


def _d(y, m, d=1):
    return dt.date(y, m, d)


def test_having_5_and_impute(spark):
    rows = ([("A", "2020-T1", _d(2020, 1, 5), float(p)) for p in (10, 20, 30, 40)]          # 4 sales: no median
            + [("A", "2020-T2", _d(2020, 4, 5), float(p)) for p in (1, 2, 3, 4, 5)]         # 5 sales: median 3
            + [("B", "2020-T1", _d(2020, 1, 9), 7.0)])                                      # never a median
    df = spark.createDataFrame(rows, "quartier_detaille string, annee_trimestre string, date_mutation date, prix_m2 double")
    med = district.district_quarter_median(df).collect()
    assert [(r.annee_trimestre, r.prix_median_m2, r.nb_transactions) for r in med] == [("2020-T2", 3.0, 5)]
    built = district.attach_median(df, district.district_quarter_median(df))
    imp = {(r.quartier_detaille, r.date_mutation, r.prix_m2): r.prix_median_m2
           for r in district.impute_median(built).collect()}
    assert imp[("A", _d(2020, 1, 5), 10.0)] == 3.0    # earliest dated non-null median of district A
    assert imp[("B", _d(2020, 1, 9), 7.0)] == 7.0     # no median at all: own price


def test_single_row_group_std_null_and_empty_level(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (2, 22.0)], "mois int, prix_m2 double")
    out = {r.level: r for r in profile.target_by_category(df, ["mois"], domains={"mois": range(1, 13)}).collect()}
    assert len(out) == 12
    assert out["1"].std is None and out["1"]["count"] == 1
    assert out["2"].median == 21.0
    assert out["5"]["count"] == 0 and out["5"].mean is None


def test_rolling_partial_and_gap_month(spark):
    rows = [("z", _d(2020, m), float(v)) for m, v in ((1, 1), (3, 2), (4, 3), (5, 4))]   # February missing
    p = spark.createDataFrame(rows, "zone string, annee_mois date, prix_median_m2 double")
    f = panel.panel_features(p, means=(3,), stds=(), lags=(1,)).orderBy("annee_mois").collect()
    assert [r.ma_3 for r in f] == [None, None, 2.0, 3.0]
    assert f[1].lag_1 == 1.0            # March's lag is January: row based, not calendar


def test_one_group_anova_and_kruskal(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 3.0)], "c string, prix_m2 double")
    a = association.anova(df, ["c"]).first()
    assert (a.f_stat, a.p_value, a.significatif) == (0.0, 1.0, "Non")
    k = association.kruskal(df, ["c"]).first()
    assert (k.h_stat, k.p_value, k.significatif) == (0.0, 1.0, "Non")


def test_anova_kruskal_known_values(spark):
    # hand-computed: groups [1,2,3] and [4,5,6]: F = 13.5 / 1 = 13.5 ; H (no ties) = 27/7
    rows = [("a", v) for v in (1.0, 2.0, 3.0)] + [("b", v) for v in (4.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "c string, prix_m2 double")
    a = association.anova(df, ["c"]).first()
    assert math.isclose(a.f_stat, 13.5) and math.isclose(a.p_value, 0.021311641128756, rel_tol=1e-9)
    k = association.kruskal(df, ["c"]).first()
    assert math.isclose(k.h_stat, 27 / 7) and math.isclose(k.p_value, 0.049534613435626, rel_tol=1e-9)


def test_spearman_monotone_invariance(spark):
    rows = [(float(i), float(i) ** 3 + (i % 3), float(i % 4)) for i in range(50)]
    df = spark.createDataFrame(rows, "x double, prix_m2 double, w double")
    s1 = {r.variable: r.spearman for r in association.spearman(df, ["x", "w"]).collect()}
    df2 = df.withColumn("x", F.exp(F.col("x") / 10))
    s2 = {r.variable: r.spearman for r in association.spearman(df2, ["x", "w"]).collect()}
    assert math.isclose(s1["x"], s2["x"], rel_tol=1e-12)
    assert -1 <= s1["w"] <= 1


def test_r2_constant_and_mape_zero(spark):
    perfect = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "y double, yhat double")
    imperfect = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, yhat double")
    assert evaluate.regression_metrics(perfect).first().r2 == 1.0
    assert evaluate.regression_metrics(imperfect).first().r2 == 0.0
    z = spark.createDataFrame([(0.0, 1.0), (10.0, 11.0)], "y double, yhat double")
    assert math.isclose(evaluate.regression_metrics(z).first().mape, 10.0)
    assert evaluate.regression_metrics(z, mape_zero="propagate").first().mape == float("inf")


def test_rmse_ge_mae(spark):
    df = spark.createDataFrame([(float(i), float(i) + (i % 5) - 2) for i in range(1, 40)], "y double, yhat double")
    m = evaluate.regression_metrics(df).first()
    assert m.rmse >= m.mae


@pytest.mark.parametrize("kind,fc,expect_fallback", [("volume", 4.0, True), ("price", 0.4, True), ("price", 1.2, False)])
def test_clamp_and_fallback(spark, kind, fc, expect_fallback):
    gate = spark.createDataFrame([("z", 1.0, 1.0)], "zone string, train_min double, train_max double")
    fcast = spark.createDataFrame([("z", 1, 1.0), ("z", 2, fc)], "zone string, step int, yhat double")
    fb = spark.createDataFrame([("z", 1, 0.9), ("z", 2, 0.9)], "zone string, step int, yhat double")
    out = evaluate.forecast_guard(fcast, gate, fb, kind=kind).orderBy("step").collect()
    assert all(r.fallback == expect_fallback for r in out)
    if expect_fallback:
        assert [r.yhat for r in out] == [0.9, 0.9]          # whole horizon replaced, inside the bounds
    else:
        assert [r.yhat for r in out] == [1.0, 1.2]


def test_short_series_skipped(spark):
    rows = ([("z1", _d(2000 + i // 12, i % 12 + 1), "train", 1.0) for i in range(23)]
            + [("z2", _d(2000 + i // 12, i % 12 + 1), "train", 1.0) for i in range(30)]
            + [("z1", _d(2003, 1), "test", 1.0)])
    p = spark.createDataFrame(rows, "zone string, annee_mois date, split string, prix_median_m2 double")
    g = {r.zone: (r.status, r.reason) for r in panel.series_gate(p).collect()}
    assert g["z1"] == ("skipped", "train series shorter than minimum")
    assert g["z2"] == ("skipped", "no test month")


def test_category_profile_top_and_share(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbc"] + [(None,)], "c string")
    out = profile.category_profile(df, ["c"], top=2).orderBy("rang").collect()
    assert [(r.value, r.effectif) for r in out] == [("a", 3), ("b", 2)]
    assert math.isclose(out[0].pourcentage, 50.0) and out[0].nb_valeurs_manquantes == 1
    assert out[0].nb_categories == 3


def test_shared_target_ranks_follow_each_columns_nulls(spark):
    """Kruskal and Spearman of columns with different null patterns equal those of each column alone; one range sort ranks the target."""
    import numpy as np
    import pandas as pd

    from realty_spark.operators import association
    rng = np.random.default_rng(8)
    n = 400
    pdf = pd.DataFrame({"prix_m2": np.round(rng.normal(3000, 900, n), -2), "a": rng.integers(0, 3, n).astype(float), "b": np.round(rng.normal(size=n), 1) + 0.0,
                        "c": [None] * n, "d": [7.0] * n})
    pdf.loc[::3, "a"] = np.nan
    pdf.loc[5:90, "b"] = np.nan
    pdf.loc[200:210, "prix_m2"] = np.nan
    rows = [tuple(None if v is None or v != v else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "prix_m2 double, a double, b double, c double, d double").repartition(5)
    rho = {r.variable: (r.n, r.spearman) for r in association.spearman(df, ["a", "b", "c", "d"], with_p=False).collect()}
    for c in "ab":
        both = pdf[["prix_m2", c]].dropna()
        exp = np.corrcoef(both["prix_m2"].rank(), both[c].astype(float).rank())[0, 1]
        assert rho[c][0] == len(both) and abs(rho[c][1] - exp) < 1e-12
    assert "c" not in rho and rho["d"][1] is None
    h = {r.variable: r for r in association.kruskal(df, ["a", "b"], with_p=False).collect()}
    for c in "ab":
        both = pdf[["prix_m2", c]].dropna()
        ranks, t = both["prix_m2"].rank(), both["prix_m2"].value_counts()
        m = len(both)
        s = (ranks.groupby(both[c]).sum() ** 2 / both.groupby(c).size()).sum()
        exp = (12 / (m * (m + 1)) * s - 3 * (m + 1)) / (1 - ((t ** 3 - t).sum()) / (m ** 3 - m))
        assert h[c].N == m and abs(h[c].h_stat - exp) < 1e-9
