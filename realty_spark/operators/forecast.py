"""Per-zone forecasting as distributed grouped jobs.

The reference fits one library model per department in a Python loop.
Here every zone (and, for the order search, every zone x candidate) is an
independent task: the monthly series travels as one sorted array per zone
(bounded by the number of months), numpy does the small linear algebra
inside the task, and failures are caught per zone and returned as
``status='error'`` rows instead of stopping the job.

Estimators are named for what they are; no numeric equality with the
reference's libraries is claimed:

* ``sarima_*`` - seasonal ARIMA orders scored by two-stage Hannan-Rissanen
  least squares on the differenced series (long-AR residuals, then OLS on the
  expanded seasonal AR/MA lag set), Gaussian AIC on one sample for all orders.
  The sums of products of a differenced series' lags come from one Spark
  aggregate; residual lags are linear in them, so that every order is solved
  from a block of one small matrix.  The winner is refitted on all months;
  forecasts by recursion with zero future shocks, then undifferencing.  Stationarity and invertibility
  are checked from the polynomial roots; a failing zone uses the fallback.
* ``seasonal_trend_forecast`` - log-scale penalised least squares: piecewise
  linear trend with hinge changepoints in the first 80 % of the history,
  yearly Fourier terms and standardised regressors (multiplicative effects on
  the price scale), interval from the residual scale.
* ``gbt_forecast`` - Spark ML gradient-boosted trees on the pooled panel.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.distributions import norm_ppf_np
from realty_spark.operators.evaluate import forecast_guard
from realty_spark.operators.panel import fallback_forecast, series_gate, test_steps
from realty_spark.session import ensure_checkpoint_dir


# ----------------------------------------------------------- series carrier --
def zone_series(panel: DataFrame, target: str, extra=()) -> DataFrame:
    """One row per eligible zone: train months/values (sorted) and test months.

    A zone's series is bounded by its number of months, so collecting it into
    one array per zone is safe at any data size.
    """
    gate = series_gate(panel, target).where(F.col("status") == "ok").select("zone")
    fields = [F.col("annee_mois"), F.col(target).alias("y")] + [F.col(c) for c in extra]
    tr = (panel.where(F.col("split") == "train").groupBy("zone")
          .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("train")))
    te = (panel.where(F.col("split") == "test").groupBy("zone")
          .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("test")))
    return gate.join(tr, "zone").join(te, "zone")


# ------------------------------------------------------------ SARIMA kernel --
def sarima_candidates() -> list[tuple[int, int, int, int, int, int]]:
    """The 144 (p, d, q, P, D, Q) candidates in the reference's loop order."""
    return list(product(K.SARIMA_P, K.SARIMA_D, K.SARIMA_Q, K.SARIMA_SP, K.SARIMA_SD, K.SARIMA_SQ))


def _diff_poly(d: int, sd: int, s: int) -> np.ndarray:
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(sd):
        sp = np.zeros(s + 1)
        sp[0], sp[-1] = 1.0, -1.0
        poly = np.convolve(poly, sp)
    return poly


def _lags(p: int, sp: int, s: int) -> list[int]:
    return sorted({i + s * j for i in range(p + 1) for j in range(sp + 1)} - {0})


def _long_ar(n: int, s: int = K.SEASONAL_PERIOD) -> int:
    """Order of the long autoregression of a differenced series of n values: alike for all candidates of one (d, D)."""
    return min(s + 2, n // 3)


def common_sample(n: int, s: int = K.SEASONAL_PERIOD) -> int:
    """Scored observations of every candidate of a series of n months: what the greediest candidate leaves.

    A candidate that cannot be scored on so few is compared on the last year
    instead; 0 if not even that is left.
    """
    left = []
    for p, d, q, sp, sd, sq in sarima_candidates():
        m = n - d - s * sd
        ar, ma = _lags(p, sp, s), _lags(q, sq, s)
        left.append(m - (_long_ar(m) if ma else 0) - max(ar + ma, default=0))
    least = min(left)
    return least if least >= s else s if max(left) >= s else 0


def fit_sarima(y: np.ndarray, order, sorder, s: int = K.SEASONAL_PERIOD, scored: int | None = None) -> dict:
    """Two-stage Hannan-Rissanen fit; raises ValueError when the series is too short.

    With ``scored`` the coefficients and the AIC come from the last so many
    observations alone, so that AICs of different orders speak of one sample.
    """
    p, d, q = order
    sp, sd, sq = sorder
    y = np.asarray(y, dtype=float)
    poly = _diff_poly(d, sd, s)
    w = np.convolve(y, poly, mode="valid")
    ar, ma = _lags(p, sp, s), _lags(q, sq, s)
    const = d + sd == 0
    n = len(w)
    e = np.zeros(n)
    start = 0
    if ma:
        m = _long_ar(n)
        if m < 1 or n - m < m + 5:
            raise ValueError("series too short for the long autoregression")
        xl = np.column_stack([w[m - k:n - k] for k in range(1, m + 1)] + [np.ones(n - m)])
        b1, *_ = np.linalg.lstsq(xl, w[m:], rcond=None)
        e[m:] = w[m:] - xl @ b1
        start = m
    t0 = start + max(ar + ma, default=0)
    if scored is not None:
        if n - scored < t0 or not scored:
            raise ValueError("series too short for this order")
        t0 = n - scored
    neff = n - t0
    k = len(ar) + len(ma) + int(const)
    if neff < k + 3:
        raise ValueError("series too short for this order")
    cols = [w[t0 - l:n - l] for l in ar] + [e[t0 - l:n - l] for l in ma] + ([np.ones(neff)] if const else [])
    x = np.column_stack(cols) if cols else np.zeros((neff, 0))
    beta = np.linalg.lstsq(x, w[t0:], rcond=None)[0] if k else np.zeros(0)
    resid = w[t0:] - x @ beta
    sigma2 = max(float(np.mean(resid ** 2)), 1e-300)
    loglik = -0.5 * neff * (math.log(2 * math.pi * sigma2) + 1.0)
    e_fit = e.copy()
    e_fit[t0:] = resid
    return {"beta": beta, "ar": ar, "ma": ma, "const": const, "aic": 2.0 * (k + 1) - 2.0 * loglik, "neff": neff,
            "sigma2": sigma2, "w": w, "e": e_fit, "poly": poly, "y": y}


def _roots_ok(lags, coefs, sign: float) -> bool:
    if not lags:
        return True
    c = np.zeros(max(lags) + 1)
    c[0] = 1.0
    for lag, b in zip(lags, coefs):
        c[lag] = sign * b
    roots = np.roots(c[::-1])
    return bool(np.all(np.abs(roots) > 1.0 + 1e-8))


def sarima_checks(fit: dict) -> tuple[bool, bool]:
    """(stationary, invertible) of the fitted AR and MA polynomials."""
    na, nm = len(fit["ar"]), len(fit["ma"])
    b = fit["beta"]
    return _roots_ok(fit["ar"], b[:na], -1.0), _roots_ok(fit["ma"], b[na:na + nm], 1.0)


def forecast_sarima(fit: dict, steps: int) -> np.ndarray:
    """Recursive forecast of the differenced series with zero future shocks, then undifferencing."""
    b, ar, ma = fit["beta"], fit["ar"], fit["ma"]
    phi, theta = b[:len(ar)], b[len(ar):len(ar) + len(ma)]
    c = b[-1] if fit["const"] else 0.0
    w, e = list(fit["w"]), list(fit["e"])
    y, poly = list(fit["y"]), fit["poly"]
    out = []
    for _ in range(steps):
        t = len(w)
        val = c + sum(ph * w[t - l] for ph, l in zip(phi, ar)) + sum(th * e[t - l] for th, l in zip(theta, ma))
        w.append(val)
        e.append(0.0)
        ty = len(y)
        yv = val - sum(poly[j] * y[ty - j] for j in range(1, len(poly)))
        y.append(yv / poly[0])
        out.append(y[-1])
    return np.array(out)


GRID_SCHEMA = ("zone string, cid int, p int, d int, q int, sp int, sd int, sq int, aic double, "
               "admissible boolean, error string")


def _last_lag(s: int = K.SEASONAL_PERIOD) -> int:
    """The furthest lag that a candidate's residual lags reach: the long autoregression's behind the seasonal ones."""
    return 2 * (s + max(K.SARIMA_P + K.SARIMA_Q))


def lag_products(panel: DataFrame, target: str, s: int = K.SEASONAL_PERIOD) -> DataFrame:
    """Sums of products of the lags of every eligible zone's differenced series, the shared design of the order search (M2).

    One row per (zone, d, sd, i, j), i <= j: lags 0 to ``_last_lag`` and a
    constant behind them.  ``long_sum`` runs over the months of the long
    autoregression, ``scored_sum`` over the common scored months; a sum is NULL
    where a lag is missing in one of its months.  The undifferenced series is
    taken from its mean's whole part, which a constant absorbs.  ``n`` months,
    ``n_w`` differenced ones, ``m`` the long autoregression's order, ``scored``
    the months of ``common_sample``.
    """
    last = _last_lag(s)
    gate = series_gate(panel, target).where(F.col("status") == "ok").select("zone", F.floor("train_mean").alias("shift"))
    zone = Window.partitionBy("zone").orderBy("annee_mois")
    y = F.col(target).cast("double")
    months = (panel.where(F.col("split") == "train").join(gate, "zone")
              .select("zone", "annee_mois", "shift", y.alias("y"), *[F.lag(y, k).over(zone).alias(f"y{k}") for k in (1, s, s + 1)],
                      F.count(F.lit(1)).over(Window.partitionBy("zone")).alias("n")))
    forms = [(0, 0, F.col("y") - F.col("shift")), (1, 0, F.col("y") - F.col("y1")), (0, 1, F.col("y") - F.col(f"y{s}")),
             (1, 1, F.col("y") - F.col("y1") - F.col(f"y{s}") + F.col(f"y{s + 1}"))]
    w = months.select("zone", "annee_mois", "n", F.explode(F.array(*[
        F.struct(F.lit(d).alias("d"), F.lit(sd).alias("sd"), value.alias("w")) for d, sd, value in forms])).alias("f"))
    w = w.select("zone", "annee_mois", "n", "f.*").where(F.col("w").isNotNull())
    series = Window.partitionBy("zone", "d", "sd")
    lags = F.reverse(F.collect_list("w").over(series.orderBy("annee_mois").rowsBetween(-last, 0)))
    rows = w.select("zone", "d", "sd", "n", F.count(F.lit(1)).over(series).alias("n_w"),
                    (F.row_number().over(series.orderBy("annee_mois")) - 1).alias("t"), lags.alias("x"))
    least = F.col("n") - s - 1 - F.least(F.lit(s + 2), F.floor((F.col("n") - s - 1) / 3)) - (s + 2)
    rows = rows.withColumns({"m": F.least(F.lit(s + 2), F.floor(F.col("n_w") / 3)).cast("int"),
                             "scored": F.when(least >= s, least).when(F.col("n") >= s, F.lit(s)).otherwise(F.lit(0)).cast("int")})
    value = f"CASE WHEN {{0}} > {last} THEN 1.0 ELSE get(x, {{0}}) END"
    pairs = F.expr(f"flatten(transform(sequence(0, {last + 1}), i -> transform(sequence(i, {last + 1}), "
                   f"j -> named_struct('i', i, 'j', j, 'p', ({value.format('i')}) * ({value.format('j')})))))")
    each = rows.select("zone", "d", "sd", "n", "n_w", "m", "scored", "t", F.explode(pairs).alias("e")).select("*", "e.*").drop("e")
    in_long, in_scored = F.col("t") >= F.col("m"), F.col("t") >= F.col("n_w") - F.col("scored")

    def whole(inside):
        return F.when(F.count_if(inside & F.col("p").isNull()) == 0, F.sum(F.when(inside, F.col("p"))))
    return each.groupBy("zone", "d", "sd", "n", "n_w", "m", "scored", "i", "j").agg(
        whole(in_long).alias("long_sum"), whole(in_scored).alias("scored_sum"))


def solve_orders(d: int, sd: int, n_w: int, m: int, scored: int, long_sums: np.ndarray, scored_sums: np.ndarray,
                 s: int = K.SEASONAL_PERIOD) -> list[tuple]:
    """(p, q, sp, sq, aic, admissible, error) of the orders of one differencing, each from its block of the lag products."""
    last, const = _last_lag(s), d + sd == 0
    one = last + 1
    change = {}  # residual lags in terms of the series' lags
    if m >= 1 and n_w - m >= m + 5:
        own = [*range(1, m + 1), one]
        b = np.linalg.lstsq(long_sums[np.ix_(own, own)], long_sums[own, 0], rcond=None)[0]
        for lag in range(1, s + 3):
            column = np.zeros(last + 2)
            column[lag], column[one] = 1.0, -b[-1]
            column[lag + 1:lag + m + 1] = -b[:-1]
            change[lag] = column
    out = []
    for p, q, sp, sq in product(K.SARIMA_P, K.SARIMA_Q, K.SARIMA_SP, K.SARIMA_SQ):
        ar, ma = _lags(p, sp, s), _lags(q, sq, s)
        k = len(ar) + len(ma) + int(const)
        try:
            if ma and not change:
                raise ValueError("series too short for the long autoregression")
            first = (m if ma else 0) + max(ar + ma, default=0)
            if not scored or n_w - scored < first or scored < k + 3:
                raise ValueError("series too short for this order")
            units = np.eye(last + 2)
            design = np.column_stack([units[:, 0]] + [units[:, l] for l in ar] + [change[l] for l in ma] + ([units[:, one]] if const else []))
            used = np.flatnonzero(design.any(axis=1))
            sums = scored_sums[np.ix_(used, used)]
            if np.isnan(sums).any():
                raise ValueError("series too short for this order")
            block = design[used].T @ sums @ design[used]
            scale = np.sqrt(np.maximum(np.diag(block), 1e-300))
            block = block / np.outer(scale, scale)
            beta = np.linalg.lstsq(block[1:, 1:], block[1:, 0], rcond=1e-13)[0] if k else np.zeros(0)
            rss = (block[0, 0] - 2 * beta @ block[1:, 0] + beta @ block[1:, 1:] @ beta) * scale[0] ** 2 if k else block[0, 0] * scale[0] ** 2
            sigma2 = max(float(rss) / scored, 1e-300)
            aic = 2.0 * (k + 1) + scored * (math.log(2 * math.pi * sigma2) + 1.0)
            beta = beta * scale[0] / scale[1:] if k else beta
            fit = {"ar": ar, "ma": ma, "beta": beta}
            out.append((p, q, sp, sq, aic, all(sarima_checks(fit)), None if np.isfinite(aic) else "non-finite AIC"))
        except (ValueError, np.linalg.LinAlgError) as ex:
            out.append((p, q, sp, sq, math.nan, False, str(ex)))
    return out


def _solve_batches(it):
    number = {c: i for i, c in enumerate(sarima_candidates())}
    size = _last_lag() + 2
    for pdf in it:
        rows = []
        for r in pdf.itertuples(index=False):
            long_sums, scored_sums = np.full((size, size), np.nan), np.full((size, size), np.nan)
            for e in r.entries:
                long_sums[e["i"], e["j"]] = long_sums[e["j"], e["i"]] = math.nan if e["long_sum"] is None else e["long_sum"]
                scored_sums[e["i"], e["j"]] = scored_sums[e["j"], e["i"]] = math.nan if e["scored_sum"] is None else e["scored_sum"]
            for p, q, sp, sq, *told in solve_orders(r.d, r.sd, r.n_w, r.m, r.scored, long_sums, scored_sums):
                rows.append((r.zone, number[p, r.d, q, sp, r.sd, sq], p, r.d, q, sp, r.sd, sq, *told))
        yield pd.DataFrame(rows, columns=["zone", "cid", "p", "d", "q", "sp", "sd", "sq", "aic", "admissible", "error"])


def sarima_grid(panel: DataFrame, target: str) -> DataFrame:
    """Score the 144 candidate orders of every eligible zone (M2).

    All candidates of a zone are scored on the same last months
    (``common_sample``), so that their AICs compare fits and not lost rows.
    Each (zone, d, D) is one row of a few hundred sums (``lag_products``), of
    which its 36 orders are solved.  Returns every candidate with its AIC
    (NULL + error text when the fit is impossible: the reference skips those).
    """
    sums = lag_products(panel, target).groupBy("zone", "d", "sd", "n_w", "m", "scored").agg(
        F.collect_list(F.struct("i", "j", "long_sum", "scored_sum")).alias("entries"))
    scored = sums.mapInPandas(_solve_batches, GRID_SCHEMA)
    return scored.withColumn("aic", F.when(~F.isnan("aic"), F.col("aic")))


def _rank(constrained: bool) -> Column:
    return F.struct((~F.col("admissible")).cast("int") if constrained else F.lit(0), F.col("aic"), F.col("cid"))


def flag_best(grid: DataFrame, constrained: bool = True) -> DataFrame:
    """The grid with ``meilleur``: whether a candidate is its zone's best (``best_orders``); the grid is scored once."""
    best = F.min(F.when(F.col("aic").isNotNull(), _rank(constrained))).over(Window.partitionBy("zone"))
    return grid.withColumn("meilleur", F.coalesce(F.col("aic").isNotNull() & (best["cid"] == F.col("cid")), F.lit(False)))


def best_orders(grid: DataFrame, constrained: bool = True) -> DataFrame:
    """Lowest AIC per zone; the first candidate in loop order wins ties (M2).

    With ``constrained`` the order is chosen among candidates whose fit is
    stationary and invertible (the reference's final fit enforces both); a
    zone without such a candidate keeps its unconstrained best, whose final
    forecast is then replaced by the fallback.
    """
    ok = grid.where(F.col("aic").isNotNull())
    best = ok.groupBy("zone").agg(F.min_by(F.struct("cid", "p", "d", "q", "sp", "sd", "sq", "aic"), _rank(constrained)).alias("b"))
    return best.select("zone", "b.*")


FC_SCHEMA = ("zone string, step int, yhat double, stationary boolean, invertible boolean, "
             "status string, message string")


def sarima_forecast(panel: DataFrame, target: str = "prix_median_m2", kind: str = "price", orders: DataFrame | None = None) -> DataFrame:
    """Order search, final fit per zone, forecast of every test month, sanity guard.

    ``orders`` (the columns of ``best_orders``) replaces the search.

    Output: zone, step, annee_mois, yhat (guarded), yhat_brut, fallback, order
    text, aic, status ('ok' / 'error' / 'skipped'), message.
    """
    best = best_orders(sarima_grid(panel, target)) if orders is None else orders
    series = zone_series(panel, target)
    j = series.join(best, "zone", "left")

    def fit_zone(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        h = len(r["test"])
        try:
            if pd.isna(r["cid"]):
                raise ValueError("no SARIMA candidate could be fitted")
            y = np.array([s["y"] for s in r["train"]], dtype=float)
            fit = fit_sarima(y, (int(r["p"]), int(r["d"]), int(r["q"])), (int(r["sp"]), int(r["sd"]), int(r["sq"])))
            st, inv = sarima_checks(fit)
            f = forecast_sarima(fit, h)
            status, msg = "ok", None if (st and inv) else "constraints violated: fallback forced"
            if not (st and inv):
                f = np.full(h, np.nan)   # the guard replaces a NaN horizon by the fallback
            return pd.DataFrame({"zone": r["zone"], "step": np.arange(1, h + 1, dtype="int32"), "yhat": f,
                                 "stationary": st, "invertible": inv, "status": status, "message": msg})
        except Exception as ex:  # noqa: BLE001 - one failing zone must not fail the job (M10)
            return pd.DataFrame({"zone": [r["zone"]], "step": [None], "yhat": [None], "stationary": [None],
                                 "invertible": [None], "status": ["error"], "message": [str(ex)[:200]]})

    raw = j.groupBy("zone").applyInPandas(fit_zone, FC_SCHEMA)
    gate = series_gate(panel, target)
    fb = fallback_forecast(panel, target)
    ok = raw.where(F.col("status") == "ok").select("zone", "step", "yhat")
    guarded = forecast_guard(ok, gate, fb, kind=kind)
    steps = test_steps(panel)
    texts = best.select("zone", F.format_string("(%d,%d,%d)(%d,%d,%d,12)", "p", "d", "q", "sp", "sd", "sq")
                         .alias("ordre"), "aic")
    res = (raw.join(guarded, ["zone", "step"], "left").join(steps, ["zone", "step"], "left")
           .join(texts, "zone", "left")
           .select("zone", "step", "annee_mois", F.coalesce(guarded["yhat"], F.lit(None)).alias("yhat"),
                   "yhat_brut", "fallback", "ordre", "aic", "status", "message"))
    skipped = (gate.where(F.col("status") != "ok")
               .select("zone", F.lit(None).cast("int").alias("step"), F.lit(None).cast("date").alias("annee_mois"),
                       F.lit(None).cast("double").alias("yhat"), F.lit(None).cast("double").alias("yhat_brut"),
                       F.lit(None).cast("boolean").alias("fallback"), F.lit(None).cast("string").alias("ordre"),
                       F.lit(None).cast("double").alias("aic"), "status", F.col("reason").alias("message")))
    return res.unionByName(skipped)


# ---------------------------------------------------- seasonal trend kernel --
def _design(days: np.ndarray, t: np.ndarray, cps: np.ndarray, regs: np.ndarray, order: int) -> np.ndarray:
    cols = [np.ones_like(t), t] + [np.maximum(t - c, 0.0) for c in cps]
    yr = days / 365.25
    for k in range(1, order + 1):
        cols += [np.sin(2 * np.pi * k * yr), np.cos(2 * np.pi * k * yr)]
    mat = np.column_stack(cols)
    return np.column_stack([mat, regs]) if regs.size else mat


def fit_seasonal_trend(days, y, regs, days_f, regs_f, params=K.SEASONAL_TREND_PARAMS):
    """Penalised least squares on log(y); returns (yhat, lower, upper) for the future rows."""
    y = np.asarray(y, dtype=float)
    if np.any(~np.isfinite(y)) or np.any(y <= 0):
        raise ValueError("multiplicative model needs a positive target")
    n = len(y)
    d0, span = days[0], max(days[-1] - days[0], 1.0)
    t, tf = (days - d0) / span, (days_f - d0) / span
    ncp = int(min(params["n_changepoints"], max(0, math.floor(params["changepoint_range"] * n) - 1)))
    cps = np.quantile(t[: max(1, int(math.floor(params["changepoint_range"] * n)))], np.linspace(0, 1, ncp + 2)[1:-1]) \
        if ncp else np.zeros(0)
    regs, regs_f = np.asarray(regs, float), np.asarray(regs_f, float)
    if regs.size:
        mu_r, sd_r = regs.mean(axis=0), regs.std(axis=0)
        sd_r[sd_r == 0] = 1.0
        regs, regs_f = (regs - mu_r) / sd_r, (regs_f - mu_r) / sd_r
    ly = np.log(y)
    mu, sd = ly.mean(), ly.std() or 1.0
    z = (ly - mu) / sd
    order = params["yearly_fourier_order"]
    a = _design(days, t, cps, regs, order)
    af = _design(days_f, tf, cps, regs_f, order)
    pilot = np.linalg.lstsq(a[:, :2], z, rcond=None)[0]
    s2 = max(float(np.var(z - a[:, :2] @ pilot)), 1e-6)
    pen = np.zeros(a.shape[1])
    pen[2:2 + len(cps)] = s2 / params["changepoint_prior_scale"] ** 2
    pen[2 + len(cps):] = s2 / params["seasonality_prior_scale"] ** 2
    normal = a.T @ a + np.diag(pen) + 1e-9 * np.eye(a.shape[1])
    beta = np.linalg.solve(normal, a.T @ z)
    resid = z - a @ beta
    used = float(np.trace(np.linalg.solve(normal, a.T @ a)))  # effective parameters: trace of the hat matrix
    sig = float(np.sqrt(np.sum(resid ** 2) / max(n - used, 1.0))) * sd
    zq = float(norm_ppf_np([(1 + params["interval_width"]) / 2])[0])
    lf = mu + sd * (af @ beta)
    return np.exp(lf), np.exp(lf - zq * sig), np.exp(lf + zq * sig)


ST_SCHEMA = ("zone string, step int, annee_mois date, yhat double, yhat_lower double, yhat_upper double, "
             "nb_train int, nb_test int, status string, message string")
REGRESSORS = ("nb_transactions", "surface_moy", "nb_pieces_moy")


def seasonal_trend_forecast(panel: DataFrame, target: str = "prix_median_m2", regressors=REGRESSORS,
                            use_regressors: bool = True) -> DataFrame:
    """Trend + yearly seasonality (multiplicative) + standardised regressors per zone.

    The future frame uses the test months with their observed regressors, as
    the reference does.  Zones failing the gate are reported as skipped.
    """
    regs = list(regressors) if use_regressors else []
    series = zone_series(panel, target, extra=regs)

    def fit_zone(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        tr, te = list(r["train"]), list(r["test"])
        months = [s["annee_mois"] for s in te]
        try:
            days = np.array([(pd.Timestamp(s["annee_mois"]) - pd.Timestamp("1970-01-01")).days for s in tr], float)
            days_f = np.array([(pd.Timestamp(m) - pd.Timestamp("1970-01-01")).days for m in months], float)
            y = np.array([s["y"] for s in tr], float)
            x = np.array([[s[c] for c in regs] for s in tr], float).reshape(len(tr), len(regs))
            xf = np.array([[s[c] for c in regs] for s in te], float).reshape(len(te), len(regs))
            yh, lo, hi = fit_seasonal_trend(days, y, x, days_f, xf)
            return pd.DataFrame({"zone": r["zone"], "step": np.arange(1, len(te) + 1, dtype="int32"),
                                 "annee_mois": months, "yhat": yh, "yhat_lower": lo, "yhat_upper": hi,
                                 "nb_train": len(tr), "nb_test": len(te), "status": "ok", "message": None})
        except Exception as ex:  # noqa: BLE001 (M10)
            return pd.DataFrame({"zone": [r["zone"]], "step": [None], "annee_mois": [None], "yhat": [None],
                                 "yhat_lower": [None], "yhat_upper": [None], "nb_train": [len(tr)],
                                 "nb_test": [len(te)], "status": ["error"], "message": [str(ex)[:200]]})

    out = series.groupBy("zone").applyInPandas(fit_zone, ST_SCHEMA)
    gate = series_gate(panel, target).where(F.col("status") != "ok")
    skipped = gate.select("zone", F.lit(None).cast("int").alias("step"), F.lit(None).cast("date").alias("annee_mois"),
                          *[F.lit(None).cast("double").alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")],
                          F.col("nb_train").cast("int"), F.col("nb_test").cast("int"), "status",
                          F.col("reason").alias("message"))
    return out.unionByName(skipped)


# ------------------------------------------------------------ boosted trees --
GBT_FEATURES = ("zone_idx", "mois", "annee", "mois_depuis_debut", "lag_1", "lag_2", "lag_3", "lag_6", "lag_12",
                "ma_3", "ma_6", "ma_12", "std_3", "std_6", "tendance")


def best_count(errors: list[float], patience: int) -> int:
    """Trees up to the least validation error before ``patience`` trees bring no lower one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_trees(rows: DataFrame, max_iter: int, patience: int, seed: int):
    """Fit on the rows that are not validation, with as many trees as patience on the validation rows allows.

    Fits double their trees until the least error is ``patience`` trees old
    (a seeded fit begins with the trees of a shorter one), then the model is
    refitted with the best count.
    """
    from pyspark.ml.regression import GBTRegressor
    fit_rows, valid = rows.where(~F.col("is_validation")), rows.where("is_validation")
    names = rows.schema["features"].metadata["ml_attr"]["attrs"].get("nominal", [])
    bins = max([32] + [len(a["vals"]) + 1 for a in names])

    def fit(n: int):
        return GBTRegressor(featuresCol="features", labelCol="label", maxIter=n, maxDepth=K.GBT_PARAMS["max_depth"],
                            stepSize=K.GBT_PARAMS["learning_rate"], subsamplingRate=K.GBT_PARAMS["subsample"],
                            featureSubsetStrategy=str(K.GBT_PARAMS["colsample_bytree"]), maxBins=bins,
                            minInstancesPerNode=K.GBT_PARAMS["min_child_weight"], seed=seed).fit(fit_rows)
    n = min(max_iter, 2 * patience)
    while True:
        model = fit(n)
        errors = model.evaluateEachIteration(valid, "squared") if valid.limit(1).count() else [0.0] * n
        best = best_count(errors, patience)
        if best + patience <= n or n >= max_iter:
            return model if best == n else fit(best)
        n = min(max_iter, 2 * n)


STATE_MONTHS = max(*K.FEATURE_LAGS, *K.FEATURE_MEANS, *K.FEATURE_STDS)


def last_values(history: DataFrame, target: str) -> DataFrame:
    """(zone, state, known): a zone's last ``STATE_MONTHS`` values in month order and how many months it has; a zone's months are few."""
    months = F.sort_array(F.collect_list(F.struct("annee_mois", F.col(target).cast("double").alias("y"))))
    return history.groupBy("zone").agg(F.slice(F.transform(months, lambda s: s["y"]), -F.least(F.count(F.lit(1)), F.lit(STATE_MONTHS)).cast("int"),
                                               STATE_MONTHS).alias("state"), F.count(F.lit(1)).alias("known"))


def state_features(rows: DataFrame) -> DataFrame:
    """The leak-free features of ``panel_features`` for the month that follows a state, from (state, known, annee_mois)."""
    state, size = F.col("state"), F.size("state")
    lag = lambda k: F.get(state, size - k)
    features = {"mois": F.month("annee_mois"), "annee": F.year("annee_mois"), "mois_depuis_debut": F.col("known").cast("int")}
    exists = {}
    for k in K.FEATURE_LAGS:
        features[f"lag_{k}"], exists[f"lag_{k}"] = F.when(size >= k, lag(k)), k

    def window(k, value):
        part = F.slice(state, size - k + 1, k)
        return F.when(size >= k, F.when(F.forall(part, lambda v: v.isNotNull()), value(part)))
    mean = lambda part: F.aggregate(part, F.lit(0.0), lambda acc, v: acc + v) / F.size(part)
    for k in K.FEATURE_MEANS:
        features[f"ma_{k}"], exists[f"ma_{k}"] = window(k, mean), k
    for k in K.FEATURE_STDS:
        features[f"std_{k}"], exists[f"std_{k}"] = window(k, lambda part: F.sqrt(F.aggregate(
            F.transform(part, lambda v: (v - mean(part)) * (v - mean(part))), F.lit(0.0), lambda acc, v: acc + v) / (F.size(part) - 1))), k
    features["tendance"], exists["tendance"] = F.when(size >= 2, lag(1) - lag(2)), 1
    out = rows.withColumns(features)
    complete = F.lit(True)
    for c, k in exists.items():
        complete = complete & (F.col(c).isNotNull() | (F.col("known") + 1 <= k))
    return out.withColumn("complete", complete)


class PooledTrees:
    """One boosted-tree model for all zones of a history: (zone, annee_mois, target) rows up to some month.

    The zone is a nominal feature; the label is the change from the previous
    month, which trees can extrapolate where a level cannot; the last 15 % of
    each zone's complete rows is the validation set (W7) for the number of
    trees.  ``eligible`` zones have enough complete rows; ``model`` is None without one.
    """

    def __init__(self, history: DataFrame, zones: DataFrame, target: str, max_iter: int, seed: int):
        from pyspark.ml.feature import StringIndexer, VectorAssembler

        from realty_spark.operators.panel import chrono_split, panel_features
        ensure_checkpoint_dir(history.sparkSession)
        self.indexer = StringIndexer(inputCol="zone", outputCol="zone_idx", stringOrderType="alphabetAsc", handleInvalid="keep").fit(zones.select("zone"))
        self.assembler = VectorAssembler(inputCols=list(GBT_FEATURES), outputCol="features")
        feats = self.indexer.transform(panel_features(history, target, leak_free=True)).where(F.col("complete"))
        self.eligible = (feats.groupBy("zone").agg(F.count(F.lit(1)).alias("_rows"))
                         .where(F.col("_rows") >= K.MIN_FEATURE_ROWS).select("zone").checkpoint())
        train = chrono_split(feats.join(self.eligible, "zone"), K.VALIDATION_SHARE).withColumn("label", F.col(target) - F.col("lag_1"))
        rows = self.assembler.transform(train).select("features", "label", "is_validation").checkpoint()
        self.model = None if self.eligible.limit(1).count() == 0 else fit_trees(rows, max_iter, K.GBT_PARAMS["early_stopping_rounds"], seed)

    def roll(self, states: DataFrame) -> DataFrame:
        """(other columns.., step, annee_mois, yhat) for every month of (zone, state, known, months, train_min, train_max, train_mean, ..) rows.

        A row is a zone with its last values; each step predicts its next
        month, clips it to [0.7 min, 1.3 max] of the train series and shifts
        it into the state.  Only narrow expressions work on the rows, whose
        size stays the same; a reliable checkpoint a step cuts the plan.
        """
        kept = [c for c in states.columns if c not in ("state", "known", "months", "train_min", "train_max", "train_mean")]
        now = states.withColumn("path", F.array().cast("array<double>")).checkpoint()
        horizon = now.agg(F.max(F.size("months"))).first()[0] or 0
        columns = now.columns
        lo, hi = F.col("train_min") * K.GBT_MIN_FACTOR, F.col("train_max") * K.GBT_MAX_FACTOR
        for i in range(horizon if self.model else 0):
            at = self.indexer.transform(state_features(now.withColumn("annee_mois", F.get("months", F.lit(i))))).withColumn("_last", F.col("lag_1"))
            scored = self.model.transform(self.assembler.transform(at.fillna(0.0, subset=list(GBT_FEATURES))))
            yhat = F.when(F.col("complete"), F.greatest(lo, F.least(hi, F.col("_last") + F.col("prediction")))).otherwise(F.col("train_mean"))
            shifted = F.concat(F.when(F.size("state") >= STATE_MONTHS, F.slice("state", 2, STATE_MONTHS)).otherwise(F.col("state")), F.array("yhat"))
            moved = scored.withColumn("yhat", yhat).withColumns({
                "path": F.when(F.size("months") > i, F.concat("path", F.array("yhat"))).otherwise(F.col("path")), "state": shifted, "known": F.col("known") + 1})
            now = moved.select(columns).checkpoint()
        told = now.select(*kept, F.explode(F.arrays_zip(F.col("months").alias("m"), F.col("path").alias("p"), F.sequence(F.lit(1), F.greatest(
            F.size("months"), F.lit(1))).alias("s"))).alias("e")) if self.model else now.select(*kept, F.explode(F.array(
                F.struct(F.lit(None).cast("date").alias("m"), F.lit(None).cast("double").alias("p"), F.lit(0).alias("s")))).alias("e")).limit(0)
        return told.select(*kept, F.col("e.s").alias("step"), F.col("e.m").alias("annee_mois"), F.col("e.p").alias("yhat")).where("annee_mois IS NOT NULL")


def forecast_states(panel: DataFrame, gate: DataFrame, target: str) -> DataFrame:
    """(zone, state, known, months, train_min, train_max, train_mean) of the gated zones: what ``PooledTrees.roll`` starts from."""
    months = test_steps(panel).groupBy("zone").agg(F.sort_array(F.collect_list("annee_mois")).alias("months"))
    history = panel.where(F.col("split") == "train").select("zone", "annee_mois", target)
    return (last_values(history, target).join(gate.select("zone", "train_min", "train_max", "train_mean"), "zone").join(months, "zone"))


def gbt_forecast(panel: DataFrame, target: str = "prix_median_m2", max_iter: int = K.GBT_PARAMS["n_estimators"],
                 seed: int = K.GBT_PARAMS["seed"]):
    """Pooled gradient-boosted trees with recursive multi-step forecasts.

    One Spark ML model for all zones (``PooledTrees``) instead of a per-zone
    loop.  Features are leak-free (statistics over strictly earlier months).
    Zones that fail the gate or have too few complete rows get one row that
    says so.  The panel, a row per zone and month, is landed first, for every
    step reads it and would otherwise aggregate the sales again.  Returns
    ``(forecast, importances)`` DataFrames.
    """
    spark = panel.sparkSession
    ensure_checkpoint_dir(spark)
    panel = panel.select("split", "zone", "annee_mois", target).checkpoint()
    all_zones = series_gate(panel, target)
    gate = all_zones.where(F.col("status") == "ok")
    history = panel.where(F.col("split") == "train").select("zone", "annee_mois", target).join(gate.select("zone"), "zone")
    trees = PooledTrees(history, all_zones, target, max_iter, seed)
    preds = trees.roll(forecast_states(panel, gate, target).join(trees.eligible, "zone"))
    names, model = list(GBT_FEATURES), trees.model
    imp = [(names[j], float(v)) for j, v in enumerate(model.featureImportances.toArray())] if model else []
    importances = spark.createDataFrame(imp, "feature string, importance double")
    told = preds.select("zone", "annee_mois", "step", "yhat", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("message"))
    few = (gate.join(trees.eligible, "zone", "left_anti").select("zone", F.lit("skipped").alias("status"),
                                                                 F.lit("too few complete feature rows").alias("message")))
    left_out = all_zones.where(F.col("status") != "ok").select("zone", "status", F.col("reason").alias("message")).unionByName(few)
    forecast_df = told.unionByName(left_out, allowMissingColumns=True).withColumn(
        "nb_arbres", F.lit(model.getNumTrees if model else None).cast("int"))
    return forecast_df, importances


def top_importances(importances: DataFrame, k: int = 5) -> DataFrame:
    """Top-k feature importances."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)

