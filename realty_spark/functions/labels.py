"""Codes and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from realty_spark.constants import CAPITAL_DEPARTMENT, CAPITAL_LABEL, ZONE_PREFIX


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c, width: int = 5) -> Column:
    """Left-pad with zeros like ``str.zfill``: never truncates longer text."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_postcode(c) -> Column:
    """null -> 0 -> integer text -> zero-padded to 5 -> '00000' becomes NULL.

    Accepts text ('75001', '75001.0') or numbers; junk that is not a number
    becomes NULL as well.
    """
    as_int = ((_col(c).cast("string")).try_cast("double")).try_cast("bigint")
    text = F.coalesce(as_int, F.lit(0).cast("bigint")).cast("string")
    padded = zfill(text, 5)
    return F.nullif(padded, F.lit("00000"))


def district(commune, postcode) -> Column:
    """'commune (postcode)' with a missing commune rendered as '' (C8)."""
    return F.concat(F.coalesce(_col(commune), F.lit("")), F.lit(" ("),
                    F.coalesce(zfill(_col(postcode).cast("string")), F.lit("")), F.lit(")"))


def arrondissement(department, postcode, capital: str = CAPITAL_DEPARTMENT) -> Column:
    """Last two postcode characters inside the capital department, else NULL."""
    cp = _col(postcode).cast("string")
    return F.when(_col(department) == F.lit(capital), F.substring(cp, -2, 2))


def detailed_district(arr, district_label, capital_label: str = CAPITAL_LABEL) -> Column:
    """'Paris 05e' when an arrondissement is known, otherwise the district label."""
    arr = _col(arr)
    return F.when(arr.isNotNull(), F.concat(F.lit(capital_label + " "), arr, F.lit("e"))) \
        .otherwise(_col(district_label))


def zone_label(department) -> Column:
    """'Dept <code>' (C16)."""
    return F.concat(F.lit(ZONE_PREFIX), _col(department).cast("string"))
