"""Safe arithmetic and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from realty_spark.constants import NO, SIGNIFICANCE, YES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b with NULL instead of an ANSI division-by-zero error."""
    return F.try_divide(_col(a), _col(b))


def clip(c, lo, hi) -> Column:
    """greatest(lo, least(hi, c)); NULL bounds leave that side open, a NULL value stays NULL."""
    c = _col(c)
    lo = _col(lo) if not isinstance(lo, (int, float)) else F.lit(float(lo))
    hi = _col(hi) if not isinstance(hi, (int, float)) else F.lit(float(hi))
    return F.when(c.isNotNull(), F.greatest(lo, F.least(hi, c)))


def round_half_even(c, scale: int = 2) -> Column:
    """Banker's rounding like pandas ``round`` (0.125 -> 0.12)."""
    return F.bround(_col(c), scale)


def is_finite(c) -> Column:
    c = _col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def significance_flag(p, alpha: float = SIGNIFICANCE, below: bool = True) -> Column:
    """'Oui' when p < alpha (or p > alpha with ``below=False``), else 'Non'."""
    p = _col(p)
    cond = (p < alpha) if below else (p > alpha)
    return F.when(cond, F.lit(YES)).otherwise(F.lit(NO))


def safe_corr(x, y) -> Column:
    """Pearson correlation over pairwise non-null rows; NULL for a constant column.

    Uses Spark's numerically stable central-moment aggregates; each variance is
    restricted to the rows where the other variable is present as well.
    """
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    vx = F.var_pop(F.when(both, x))
    vy = F.var_pop(F.when(both, y))
    denom = F.sqrt(vx * vy)
    return F.when(denom > 0, F.try_divide(F.covar_pop(x, y), denom))
