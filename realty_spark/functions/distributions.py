"""Distribution functions for p-values, as native column expressions.

Spark SQL has no F, chi-square, Student t or normal distribution.  The
incomplete beta and gamma functions are summed by their continued fractions
(and the gamma series left of its mean) with ``aggregate`` over a sequence of
terms, so p-values need no Python worker.  The number of terms follows the
parameters; an expansion that has not converged within it gives NULL.

Up to ``LARGE`` degrees of freedom the expansions' relative error is below
1e-9.  Beyond, they would need too many terms, and the limiting distributions
take over, for chi-square by the Wilson-Hilferty cube root (error below 1e-6),
for F by the chi-square of the smaller side with the first correction in the
larger degrees d (relative error of the order of (d1 / d2)^2), or the cube roots
of both sides, for t by the F of (1, df).  The expressions are meant for tables
with one row per tested variable.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE = 1e6  # degrees of freedom from which the limits are used
_CLOSE = 1e-15
_TINY = 1e-300


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of the values, which are evaluated once."""
    return F.transform(F.array(F.struct(*[v.cast("double").alias(k) for k, v in values.items()])), body)[0]


def _or_tiny(c: Column) -> Column:
    return F.when(c == 0, F.lit(_TINY)).otherwise(c)


def _terms(size: Column) -> Column:
    """1, 2, ...: terms within which the expansions converge for parameters of this size, with room to spare."""
    return F.sequence(F.lit(1), (F.lit(300) + F.floor(30 * F.sqrt(size))).cast("int"))


def _fraction(terms: Column, b0: Column, term: Callable[[Column], tuple[Column, Column]]) -> Column:
    """b0 + a1 / (b1 + a2 / (b2 + ...)), term(n) = (a_n, b_n), by products of the convergents' ratios; NULL if it did not converge."""
    def step(acc: Column, n: Column) -> Column:
        a, b = term(n.cast("double"))
        below = F.lit(1.0) / _or_tiny(b + a * acc["below"])
        above = _or_tiny(b + a / acc["above"])
        moved = F.transform(F.array(F.struct(above.alias("above"), below.alias("below"))), lambda s: F.struct(
            (acc["value"] * s["above"] * s["below"]).alias("value"), s["above"].alias("above"), s["below"].alias("below"),
            (F.abs(s["above"] * s["below"] - 1.0) < _CLOSE).alias("done")))[0]
        return F.when(acc["done"], acc).otherwise(moved)
    start = F.struct(_or_tiny(b0).alias("value"), _or_tiny(b0).alias("above"), F.lit(0.0).alias("below"), F.lit(False).alias("done"))
    return F.aggregate(terms, start, step, lambda acc: F.when(acc["done"], acc["value"]))


def log_gamma(z: Column) -> Column:
    """log of the gamma function for z > 0: Stirling's series eight places further on."""
    w = z + 8.0
    product = z
    for i in range(1, 8):
        product = product * (z + float(i))
    series = F.lit(0.0)
    for power, divisor in ((1, 12.0), (3, -360.0), (5, 1260.0), (7, -1680.0), (9, 1188.0)):
        series = series + F.lit(1.0) / (divisor * F.pow(w, F.lit(float(power))))
    return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def beta_reg(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta I_x(a, b); NULL outside a, b > 0 and 0 <= x <= 1."""
    def core(v: Column) -> Column:
        def term(n: Column) -> tuple[Column, Column]:
            m = F.floor(n / 2.0).cast("double")
            odd = -(v["a"] + m) * (v["a"] + v["b"] + m) * v["x"] / ((v["a"] + 2.0 * m) * (v["a"] + 2.0 * m + 1.0))
            even = m * (v["b"] - m) * v["x"] / ((v["a"] + 2.0 * m - 1.0) * (v["a"] + 2.0 * m))
            return F.when(n % 2 == 1, odd).otherwise(even), F.lit(1.0)
        scale = (log_gamma(v["a"] + v["b"]) - log_gamma(v["a"]) - log_gamma(v["b"])
                 + v["a"] * F.log(v["x"]) + v["b"] * F.log1p(-v["x"]))
        value = F.exp(scale) / v["a"] / _fraction(_terms(F.greatest(v["a"], v["b"])), F.lit(1.0), term)
        value = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
        return F.when(value.isNotNull(), F.when(v["swap"] == 1, 1.0 - value).otherwise(value))

    def sides(v: Column) -> Column:
        swap = v["x"] > (v["a"] + 1.0) / (v["a"] + v["b"] + 2.0)  # the fraction converges fast left of the mean
        return (F.when((v["x"] == 0) | (v["x"] == 1), v["x"])
                .otherwise(let(core, a=F.when(swap, v["b"]).otherwise(v["a"]), b=F.when(swap, v["a"]).otherwise(v["b"]),
                               x=F.when(swap, 1.0 - v["x"]).otherwise(v["x"]), swap=swap.cast("int"))))
    valid = lambda v: (v["a"] > 0) & (v["b"] > 0) & (v["x"] >= 0) & (v["x"] <= 1) & (v["a"] < math.inf) & (v["b"] < math.inf)
    return let(lambda v: F.when(valid(v), sides(v)), a=a, b=b, x=x)


def gamma_upper(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x); NULL outside a > 0 and x >= 0."""
    def core(v: Column) -> Column:
        scale = F.exp(v["a"] * F.log(v["x"]) - v["x"] - log_gamma(v["a"]))
        right = scale / _fraction(_terms(v["a"]), v["x"] + 1.0 - v["a"],
                                  lambda n: (-n * (n - v["a"]), v["x"] + 2.0 * n + 1.0 - v["a"]))
        start = F.struct((F.lit(1.0) / v["a"]).alias("total"), (F.lit(1.0) / v["a"]).alias("part"))

        def step(acc: Column, n: Column) -> Column:
            part = acc["part"] * v["x"] / (v["a"] + n.cast("double"))
            return F.struct((acc["total"] + part).alias("total"), part.alias("part"))
        left = F.aggregate(_terms(v["a"]), start, step, lambda acc: F.when(acc["part"] <= acc["total"] * _CLOSE, acc["total"]))
        value = F.when(v["x"] >= v["a"] + 1.0, right).otherwise(1.0 - scale * left)
        return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))
    return let(lambda v: F.when((v["a"] > 0) & (v["a"] < math.inf) & (v["x"] >= 0),
                                F.when(v["x"] == 0, 1.0).when(v["x"] == math.inf, 0.0).otherwise(core(v))), a=a, x=x)


def _gamma_or_normal(use_gamma: Column, a: Column, x: Column, z: Column) -> Column:
    """Q(a, x), or the normal distribution above z, which is Q(1/2, z^2 / 2) / 2."""
    def chosen(v: Column) -> Column:
        plain = v["plain"] == 1
        q = gamma_upper(F.when(plain, v["a"]).otherwise(0.5), F.when(plain, v["x"]).otherwise(v["z"] * v["z"] / 2.0))
        return let(lambda r: F.when(plain, r["q"]).when(v["z"] >= 0, r["q"] / 2.0).otherwise(1.0 - r["q"] / 2.0), q=q)
    return let(chosen, plain=use_gamma.cast("int"), a=a, x=x, z=z)


def normal_above(z: Column) -> Column:
    """Survival function of the standard normal distribution."""
    return _gamma_or_normal(F.lit(False), F.lit(1.0), F.lit(1.0), z)


def _chi2(v: Column) -> Column:
    spread = F.lit(2.0) / (9.0 * v["k"])
    z = (F.cbrt(v["x"] / v["k"]) - (1.0 - spread)) / F.sqrt(spread)
    return F.when((v["x"] >= 0) & (v["k"] > 0) & (v["k"] < math.inf),
                  F.when(v["x"] == math.inf, 0.0).otherwise(_gamma_or_normal(v["k"] <= LARGE, v["k"] / 2.0, v["x"] / 2.0, z)))


def chi2_sf(x: Column, k: Column) -> Column:
    """Survival function of the chi-square distribution; NULL for invalid arguments."""
    return let(_chi2, x=x, k=k)


def _f(v: Column) -> Column:
    f, d1, d2 = v["f"], v["d1"], v["d2"]
    small = (d1 <= LARGE) & (d2 <= LARGE)
    u, w = F.lit(2.0) / (9.0 * d1), F.lit(2.0) / (9.0 * d2)
    root = F.cbrt(f)
    both = (d1 > LARGE) & (d2 > LARGE)
    z = ((1.0 - w) * root - (1.0 - u)) / F.sqrt(u + w * root * root)
    # the larger side is its mean, to first order in its degrees of freedom
    turned = d1 > d2
    k, far = F.when(turned, d2).otherwise(d1), F.when(turned, d1).otherwise(d2)
    ratio = k * F.when(turned, F.lit(1.0) / f).otherwise(f)
    x = ratio / (1.0 + (ratio - k + 2.0) / (2.0 * far))
    limit = let(lambda r: F.when(turned & ~both, 1.0 - r["q"]).otherwise(r["q"]), q=_gamma_or_normal(~both, k / 2.0, x / 2.0, z))
    valid = (f >= 0) & (d1 > 0) & (d2 > 0) & (d1 < math.inf) & (d2 < math.inf)
    return F.when(valid, F.when(f == 0, 1.0).when(f == math.inf, 0.0)
                  .when(small, beta_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))).otherwise(limit))


def f_sf(f: Column, d1: Column, d2: Column) -> Column:
    """Survival function of the F distribution; NULL for invalid arguments."""
    return let(_f, f=f, d1=d1, d2=d2)


def corr_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p-value of a Pearson/Spearman coefficient over n pairs: t^2 = (n - 2) r^2 / (1 - r^2) is F of (1, n - 2)."""
    def p(v: Column) -> Column:
        square = (1.0 - v["r"]) * (1.0 + v["r"])
        return (F.when((v["n"] <= 2) | F.isnan(v["r"]) | v["r"].isNull(), F.lit(None).cast("double"))
                .when(F.abs(v["r"]) >= 1.0, 0.0).otherwise(f_sf((v["n"] - 2.0) * v["r"] * v["r"] / square, F.lit(1.0), v["n"] - 2.0)))
    return let(p, r=r, n=n)


# Coefficients of Wichura's algorithm AS 241 for the normal quantile,
# numerator and denominator from the constant term up, for the middle, the tails and the far tails.
NORMAL_QUANTILE = {
    "middle": (
        (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
         4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
        (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
         2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)),
    "tail": (
        (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
         1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
         1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)),
    "far": (
        (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)),
}


def _polynomial(coefficients: Sequence[float], r: Column) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * r + c
    return value


def _ratio(part: str, r: Column) -> Column:
    above, below = NORMAL_QUANTILE[part]
    return _polynomial(above, r) / _polynomial(below, r)


def norm_ppf(p: Column) -> Column:
    """Standard normal quantile; NULL outside 0 < p < 1."""
    def value(v: Column) -> Column:
        q = v["p"] - 0.5
        r = F.sqrt(-F.log(F.least(v["p"], 1.0 - v["p"])))
        tail = F.when(r <= 5.0, _ratio("tail", r - 1.6)).otherwise(_ratio("far", r - 5.0))
        return F.when((v["p"] > 0) & (v["p"] < 1), F.when(F.abs(q) <= 0.425, q * _ratio("middle", 0.180625 - q * q))
                      .otherwise(F.signum(q) * tail))
    return let(value, p=p)


_STD = NormalDist()


def norm_ppf_np(p) -> np.ndarray:
    """Standard normal quantiles of an array inside a task; NaN outside 0 < p < 1."""
    return np.array([_STD.inv_cdf(x) if 0.0 < x < 1.0 else math.nan for x in np.ravel(p)]).reshape(np.shape(p))


def norm_cdf_np(z: float) -> float:
    """Standard normal distribution function inside a task."""
    return _STD.cdf(z) if math.isfinite(z) else (1.0 if z > 0 else 0.0)
