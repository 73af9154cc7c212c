"""Parsing of registry text: locale numbers and fixed-format dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL, so that later comparisons follow NULL logic (NaN > x is true in Spark)."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def parse_locale_number(c, strict: bool = False) -> Column:
    """Text with a decimal comma ('250000,50') -> double.

    ``strict=True`` raises on junk like a plain cast (pandas ``astype(float)``);
    otherwise junk becomes NULL (pandas ``to_numeric(errors='coerce')``).
    NaN never survives: it is mapped to NULL.
    """
    text = F.regexp_replace(F.trim(_col(c).cast("string")), ",", ".")
    parsed = text.cast("double") if strict else _try_double(text)
    return nan_to_null(parsed)


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def parse_date(c, fmt: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Fixed-format text -> DATE; malformed text -> NULL unless ``strict``."""
    c = _col(c).cast("string")
    return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)
