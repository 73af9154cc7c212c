"""Forecasting behaviour: coefficient recovery, determinism, failure isolation, p-values, Shapiro."""

import datetime as dt
import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from realty_spark.functions import distributions
from realty_spark.operators import association, forecast


def _values(spark, function, *rows):
    """A distribution function over rows of arguments."""
    names = [f"a{i}" for i in range(len(rows[0]))]
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in rows], ", ".join(f"{n} double" for n in names)).coalesce(1)
    return [r.p for r in df.select(function(*map(F.col, names)).alias("p")).collect()]


def test_published_pvalues(spark):
    assert math.isclose(_values(spark, distributions.f_sf, (3.0, 2, 10))[0], 0.0954, abs_tol=5e-5)
    assert math.isclose(_values(spark, distributions.chi2_sf, (7.81, 3))[0], 0.0501, abs_tol=5e-5)
    assert math.isclose(_values(spark, distributions.corr_pvalue, (0.5, 20))[0], 0.0247, abs_tol=5e-4)


def test_pvalues_need_no_python_worker(spark):
    df = spark.range(3).selectExpr("CAST(id AS DOUBLE) AS x")
    out = df.select(distributions.f_sf(F.col("x"), F.lit(3.0), F.lit(9.0)), distributions.chi2_sf(F.col("x"), F.lit(3.0)),
                    distributions.corr_pvalue(F.col("x") / 4, F.lit(9)), distributions.norm_ppf(F.col("x") / 4), distributions.normal_above(F.col("x")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and len(out.collect()) == 3


def test_invalid_arguments_give_null(spark):
    nan, inf = math.nan, math.inf
    assert _values(spark, distributions.f_sf, (nan, 2, 2), (-1, 2, 2), (1, 0, 2), (1, 2, None), (inf, 2, 2), (0, 2, 2)) == [None] * 4 + [0.0, 1.0]
    assert _values(spark, distributions.chi2_sf, (nan, 2), (-1, 2), (1, 0), (None, 2), (inf, 2), (0, 2)) == [None] * 4 + [0.0, 1.0]
    assert _values(spark, distributions.corr_pvalue, (nan, 9), (None, 9), (0.5, 2), (1, 9), (-1, 9), (0, 9)) == [None] * 3 + [0.0, 0.0, 1.0]
    assert _values(spark, distributions.norm_ppf, (0,), (1,), (None,), (0.5,)) == [None] * 3 + [0.0]


def test_f_and_t_match_sums_for_integer_halves(spark):
    """Closed forms: F with even d1 or even d2 is a finite sum, t with odd or even df a finite cosine series."""
    def f_even_d1(f, d1, d2):
        x, a = d2 / (d2 + d1 * f), d2 / 2
        return x ** a * sum(math.gamma(a + i) / math.gamma(a) / math.factorial(i) * (1 - x) ** i for i in range(int(d1) // 2))

    def t_two_sided(t, df):
        angle, c = math.atan(t / math.sqrt(df)), math.cos(math.atan(t / math.sqrt(df)))
        if df % 2:
            term, total = c, 0.0
            for j in range(1, (df - 1) // 2 + 1):
                total += term
                term *= c * c * (2 * j) / (2 * j + 1)
            return 1 - 2 / math.pi * (angle + math.sin(angle) * total)
        term, total = 1.0, 0.0
        for j in range(df // 2):
            total += term
            term *= c * c * (2 * j + 1) / (2 * j + 2)
        return 1 - math.sin(angle) * total
    rows = [(f, d1, d2) for f in (0.2, 1.0, 4.5) for d1 in (2, 4, 10) for d2 in (1, 3, 8, 51)]
    for got, row in zip(_values(spark, distributions.f_sf, *rows), rows):
        assert math.isclose(got, f_even_d1(*row), rel_tol=1e-11)
    rows = [(r, n) for r in (-0.7, 0.05, 0.4) for n in (3, 4, 9, 30, 101)]
    for got, (r, n) in zip(_values(spark, distributions.corr_pvalue, *rows), rows):
        assert math.isclose(got, t_two_sided(abs(r) * math.sqrt((n - 2) / (1 - r * r)), n - 2), rel_tol=1e-9, abs_tol=1e-14)


def test_normal_quantiles_match_the_standard_library(spark):
    from statistics import NormalDist
    probs = [1e-300, 1e-20, 1e-8, 0.001, 0.07, 0.075, 0.3, 0.5, 0.77, 0.925, 0.99, 1 - 1e-9]
    for got, p in zip(_values(spark, distributions.norm_ppf, *[(p,) for p in probs]), probs):
        assert math.isclose(got, NormalDist().inv_cdf(p), rel_tol=1e-14, abs_tol=1e-15)
    for got, z in zip(_values(spark, distributions.normal_above, (-3,), (0,), (0.5,), (9,), (30,)), (-3, 0, 0.5, 9, 30)):
        assert math.isclose(got, 0.5 * math.erfc(z / math.sqrt(2)), rel_tol=1e-11)


def test_sarima_recovers_ar1():
    rng = np.random.default_rng(0)
    y = np.zeros(400)
    for t in range(1, 400):
        y[t] = 0.7 * y[t - 1] + rng.normal()
    fit = forecast.fit_sarima(y + 50, (1, 0, 0), (0, 0, 0))
    assert abs(fit["beta"][0] - 0.7) < 0.08
    assert forecast.sarima_checks(fit) == (True, True)
    f = forecast.forecast_sarima(fit, 5)
    assert len(f) == 5 and np.all(np.isfinite(f))


def test_sarima_grid_size():
    assert len(forecast.sarima_candidates()) == 144


def test_seasonal_trend_positive_and_deterministic():
    days = np.arange(0, 36 * 30.4, 30.4)
    y = 1000 * np.exp(0.01 * np.arange(36)) * (1 + 0.05 * np.sin(2 * np.pi * days / 365.25))
    empty = np.zeros((36, 0))
    a = forecast.fit_seasonal_trend(days, y, empty, days[-6:] + 200, np.zeros((6, 0)))
    b = forecast.fit_seasonal_trend(days, y, empty, days[-6:] + 200, np.zeros((6, 0)))
    assert np.all(a[0] > 0) and np.allclose(a[0], b[0]) and np.all(a[1] <= a[0]) and np.all(a[0] <= a[2])
    with pytest.raises(ValueError):
        forecast.fit_seasonal_trend(days, -y, empty, days[-6:], np.zeros((6, 0)))


def test_failing_zone_is_isolated(spark):
    rows = []
    for z, sign in (("ok", 1.0), ("bad", -1.0)):
        for i in range(30):
            rows.append((z, dt.date(2000 + i // 12, i % 12 + 1, 1), "train", sign * (100.0 + i), 10, 50.0, 3.0))
        rows.append((z, dt.date(2003, 1, 1), "test", sign * 130.0, 10, 50.0, 3.0))
    p = spark.createDataFrame(rows, "zone string, annee_mois date, split string, prix_median_m2 double, "
                                    "nb_transactions long, surface_moy double, nb_pieces_moy double")
    out = {r.zone: r.status for r in forecast.seasonal_trend_forecast(p).collect()}
    assert out == {"ok": "ok", "bad": "error"}


def test_shapiro_normal_vs_skewed():
    rng = np.random.default_rng(1)
    w, p = association.shapiro_wilk_np(rng.normal(size=500))
    assert 0.98 < w <= 1.0 and p > 0.01
    w2, p2 = association.shapiro_wilk_np(rng.exponential(size=500))
    assert p2 < 1e-6


def test_row_sample_is_bounded_seeded_and_takes_ties_one_by_one(spark):
    df = spark.range(60000).selectExpr("CASE WHEN id % 3 = 0 THEN 'unique' WHEN id % 3 = 1 THEN 'seven' ELSE 'small' END AS variable",
                                       "CAST(CASE WHEN id % 3 = 0 THEN id WHEN id % 3 = 1 THEN id % 7 ELSE id END AS DOUBLE) AS x", "id"
                                       ).where("variable <> 'small' OR x < 200")
    a = association.row_sample(df, ["variable"], ["id"], size=500, seed=3).collect()
    by = {}
    for r in a:
        by.setdefault(r.variable, []).append(r.x)
    assert {k: len(v) for k, v in by.items()} == {"unique": 500, "seven": 500, "small": 66}
    assert len(set(by["seven"])) == 7 and max(by["seven"].count(v) for v in range(7)) < 150
    b = association.row_sample(df.repartition(7), ["variable"], ["id"], size=500, seed=3).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_sample_plan_joins_by_broadcast(spark):
    df = spark.range(100_000).selectExpr("CAST(id % 2 AS STRING) AS variable", "CAST(id AS DOUBLE) AS x", "id")
    plan = association.row_sample(df, ["variable"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ExistingRDD" not in plan  # no checkpoint


def test_large_degrees_of_freedom(spark):
    def f_sf(*row):
        return _values(spark, distributions.f_sf, row)[0]

    def chi2_sf(*row):
        return _values(spark, distributions.chi2_sf, row)[0]
    assert math.isclose(chi2_sf(1e6, 1e6), 0.49981, abs_tol=1e-5) and math.isclose(chi2_sf(1e5, 1e5), 0.49941, abs_tol=1e-5)
    for d2 in (10, 1e4, 9e5, 2e6, 1e12):  # closed form for two numerator degrees of freedom
        assert math.isclose(f_sf(3.0, 2, d2), math.exp(-d2 / 2 * math.log1p(6.0 / d2)), rel_tol=1e-7)
    for k in (2, 4, 10):  # closed form for even degrees of freedom
        x = 7.3
        exact = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))
        assert math.isclose(chi2_sf(x, k), exact, rel_tol=1e-12)
    assert math.isclose(_values(spark, distributions.corr_pvalue, (2e-6, 1e12 + 2))[0], math.erfc(2 / math.sqrt(2)), rel_tol=1e-6)


def _chosen(y):
    scored = forecast.common_sample(len(y))
    best = None
    for c in forecast.sarima_candidates():
        try:
            fit = forecast.fit_sarima(y, c[:3], c[3:], scored=scored)
        except ValueError:
            continue
        assert fit["neff"] == scored
        if best is None or fit["aic"] < best[0]:
            best = fit["aic"], c, fit
    return best


def test_order_search_prefers_few_terms_for_noise_and_finds_seasonal_lags():
    terms = [sum(_chosen(100 + np.random.default_rng(s).normal(size=180))[1]) for s in range(6)]
    assert np.mean(terms) <= 3
    rng = np.random.default_rng(9)
    y = np.zeros(240)
    for t in range(12, 240):
        y[t] = 0.85 * y[t - 12] + rng.normal()
    _, c, _ = _chosen(y + 100)
    assert c[3] or c[4] or c[5]


def test_patience_counts_trees():
    assert forecast.best_count([5, 4, 3, 3.5, 3.4, 2.9, 6], 2) == 3
    assert forecast.best_count([5, 4, 3, 3.5, 2.9, 6], 2) == 5
    assert forecast.best_count([1.0, 1.0], 20) == 1


def test_boosted_trees_learn_and_report_skipped_zones(spark):
    rng, rows = np.random.default_rng(4), []
    for z, k in (("north", 3.0), ("south", -3.0), ("east", 0.0)):
        level = 1000.0
        for i in range(126):
            level += k + 15 * np.sin(i * np.pi / 6) + 8 * np.sin(level / 20) + rng.normal()
            rows.append((z, dt.date(2000 + i // 12, i % 12 + 1, 1), "train" if i < 120 else "test", float(level)))
    rows += [("short", dt.date(2000, m, 1), "train", 10.0) for m in range(1, 6)] + [("short", dt.date(2001, 1, 1), "test", 10.0)]
    p = spark.createDataFrame(rows, "zone string, annee_mois date, split string, prix_median_m2 double")
    fc, imp = forecast.gbt_forecast(p, max_iter=40)
    out = fc.collect()
    truth = {(r[0], r[1]): r[3] for r in rows}
    ok = [r for r in out if r.status == "ok"]
    assert len(ok) == 18 and ok[0].nb_arbres > 1
    errors = [abs(r.yhat - truth[r.zone, r.annee_mois]) for r in ok]
    last = {z: truth[z, dt.date(2009, 12, 1)] for z in ("north", "south", "east")}
    assert np.mean(errors) < 0.6 * np.mean([abs(last[r.zone] - truth[r.zone, r.annee_mois]) for r in ok])
    assert [r.zone for r in out if r.status != "ok"] == ["short"] and imp.count() == len(forecast.GBT_FEATURES)


def _products(y, d, sd, s=12):
    """The lag products of one differenced series in numpy."""
    y = np.asarray(y, float)
    w = np.convolve(y - (math.floor(y.mean()) if not d + sd else 0), forecast._diff_poly(d, sd, s), mode="valid")
    n, last = len(w), forecast._last_lag()
    m, scored = forecast._long_ar(n), forecast.common_sample(len(y))
    x = np.full((n, last + 2), np.nan)
    for k in range(last + 1):
        x[k:, k] = w[:max(0, n - k)]
    x[:, -1] = 1.0
    return n, m, scored, x[m:].T @ x[m:], x[n - scored:].T @ x[n - scored:]


@pytest.mark.parametrize(("n", "level"), [(60, 3000.0), (84, 40.0), (50, 10.0), (30, 5.0), (240, 0.0)])
def test_orders_solved_from_lag_products_match_regressions(n, level):
    rng = np.random.default_rng(n)
    y = level + np.cumsum(rng.normal(size=n)) + 3 * np.sin(np.arange(n) * np.pi / 6)
    scored = forecast.common_sample(n)
    for d in (0, 1):
        for sd in (0, 1):
            n_w, m, got_scored, long_sums, scored_sums = _products(y, d, sd)
            for p, q, sp, sq, aic, admissible, error in forecast.solve_orders(d, sd, n_w, m, got_scored, long_sums, scored_sums):
                try:
                    fit = forecast.fit_sarima(y, (p, d, q), (sp, sd, sq), scored=scored)
                except ValueError:
                    assert error
                    continue
                if fit["neff"] >= len(fit["beta"]) + 4 and fit["sigma2"] > 1e-6:
                    assert error is None and abs(aic - fit["aic"]) < 1e-4 * max(1, abs(fit["aic"])), (d, sd, p, q, sp, sq)


def test_common_sample_follows_its_closed_form():
    for n in range(12, 300):
        least = n - 13 - min(14, (n - 13) // 3) - 14
        assert forecast.common_sample(n) == (least if least >= 12 else 12)


def test_order_search_has_one_python_node_and_flags_one_best(spark):
    rng = np.random.default_rng(5)
    rows = [(z, dt.date(2000 + i // 12, i % 12 + 1, 1), "train" if i < 72 else "test", float(100 + 10 * np.sin(i * np.pi / 6) + rng.normal()))
            for z in ("a", "b") for i in range(78)]
    p = spark.createDataFrame(rows, "zone string, annee_mois date, split string, prix_median_m2 double")
    grid = forecast.flag_best(forecast.sarima_grid(p, "prix_median_m2"))
    assert grid._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    out = grid.collect()
    assert len(out) == 288 and sorted(r.zone for r in out if r.meilleur) == ["a", "b"]
    best = {r.zone: r.cid for r in forecast.best_orders(forecast.sarima_grid(p, "prix_median_m2")).collect()}
    assert best == {r.zone: r.cid for r in out if r.meilleur}
    y = np.array([r[3] for r in rows if r[0] == "a" and r[2] == "train"])
    for r in out:
        if r.zone == "a" and r.aic is not None:
            fit = forecast.fit_sarima(y, (r.p, r.d, r.q), (r.sp, r.sd, r.sq), scored=forecast.common_sample(72))
            assert abs(fit["aic"] - r.aic) < 1e-4 * abs(fit["aic"])


def test_state_features_equal_the_panels(spark):
    from realty_spark.operators.panel import panel_features
    rng, rows = np.random.default_rng(6), []
    for z, n in (("long", 40), ("short", 9)):
        rows += [(z, dt.date(2000 + i // 12, i % 12 + 1, 1), None if (z, i) == ("long", 35) else float(rng.normal(100, 9))) for i in range(n)]
    history = spark.createDataFrame(rows, "zone string, annee_mois date, prix_median_m2 double")
    nxt = spark.createDataFrame([("long", dt.date(2003, 5, 1), None), ("short", dt.date(2000, 10, 1), None)], history.schema)
    want = {r.zone: r for r in panel_features(history.unionByName(nxt), leak_free=True).join(nxt.select("zone", "annee_mois"), ["zone", "annee_mois"]).collect()}
    got = forecast.state_features(forecast.last_values(history, "prix_median_m2").join(nxt.select("zone", "annee_mois"), "zone")).collect()
    for r in got:
        for c in forecast.GBT_FEATURES[1:] + ("complete",):
            a, b = r[c], want[r.zone][c]
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9)), (r.zone, c, a, b)


def _counted(df):
    """The rows of ``df`` and an accumulator of how many were computed."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema), seen


def test_boosted_trees_compute_their_panel_once(spark):
    rows = [(z, dt.date(2000 + i // 12, i % 12 + 1, 1), "train" if i < 48 else "test", 100.0 + 7 * i % 31 + len(z))
            for z in ("a", "bb") for i in range(50)]
    p, seen = _counted(spark.createDataFrame(rows, "zone string, annee_mois date, split string, prix_median_m2 double"))
    fc, imp = forecast.gbt_forecast(p, max_iter=2)
    assert fc.where("status = 'ok'").count() == 4 and imp.count() == len(forecast.GBT_FEATURES)
    assert seen.value <= 2 * len(rows)  # a checkpoint may compute its rows twice


@pytest.mark.parametrize("row_key", [["id"], None])
def test_correlation_report_computes_its_rows_once(spark, row_key):
    rows = [(i, float(i % 17), None if i % 5 == 0 else float(i * i % 23), float(i % 29 + 3 * (i % 17))) for i in range(400)]
    df, seen = _counted(spark.createDataFrame(rows, "id long, u double, w double, prix_m2 double"))
    out = {r.variable: r for r in association.correlation_report(df, ["u", "w"], row_key=row_key).collect()}
    assert seen.value == len(rows)
    for c, k in (("u", 1), ("w", 2)):
        whole = [(r[k], r[3]) for r in rows if r[k] is not None]
        assert out[c].n == len(whole) and out[c].normal is not None
        assert out[c].pearson == pytest.approx(np.corrcoef(*zip(*whole))[0, 1], abs=1e-12)
        ranks = [[np.mean([i + 1 for i, y in enumerate(sorted(v)) if y == x]) for x in v] for v in zip(*whole)]
        assert out[c].spearman == pytest.approx(np.corrcoef(*ranks)[0, 1], abs=1e-12)
