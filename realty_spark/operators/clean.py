"""Filters, projections and typing of the sales table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.labels import normalize_postcode
from realty_spark.functions.numeric import safe_div


def filter_departments(df: DataFrame, departments: Iterable[str] = K.IDF_DEPARTMENTS,
                       col: str = "code_departement") -> DataFrame:
    """Keep rows whose department code is in the list (P1); pushed to the scan when possible."""
    return df.where(F.col(col).isin(list(departments)))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def quality_filter(df: DataFrame, value: str = "valeur_fonciere", surface: str = "surface_reelle_bati",
                   rooms: str = "nombre_pieces_principales") -> DataFrame:
    """value > 1000, 9 < surface < 1000, 1 <= rooms <= 15 (P3).  NULL fails every test."""
    v, s, r = F.col(value), F.col(surface), F.col(rooms)
    return df.where((v > K.MIN_VALUE) & (s > K.MIN_SURFACE) & (s < K.MAX_SURFACE)
                    & (r >= K.MIN_ROOMS) & (r <= K.MAX_ROOMS))


def with_price_m2(df: DataFrame, value: str = "valeur_fonciere", surface: str = "surface_reelle_bati",
                  out: str = "prix_m2") -> DataFrame:
    """Price per square metre; a zero surface gives NULL instead of an error."""
    return df.withColumn(out, safe_div(F.col(value), F.col(surface)))


def price_filter(df: DataFrame, price: str = "prix_m2") -> DataFrame:
    """500 < price/m2 < 20000, strict."""
    p = F.col(price)
    return df.where((p > K.MIN_PRICE_M2) & (p < K.MAX_PRICE_M2))


def clean_sales(df: DataFrame, departments: Iterable[str] | None = K.IDF_DEPARTMENTS) -> DataFrame:
    """Department filter, quality filter, price per m2, outlier filter."""
    if departments is not None:
        df = filter_departments(df, departments)
    return price_filter(with_price_m2(quality_filter(df)))


def split_by_year(df: DataFrame, train_years: Sequence[int] = K.TRAIN_YEARS,
                  test_years: Sequence[int] = K.TEST_YEARS, year: str = "annee") -> DataFrame:
    """Tag rows 'train'/'test' by year membership; rows in neither list are dropped (P5).

    One tagged DataFrame instead of two copies: downstream jobs group or
    filter on ``split`` and Parquet output can be partitioned by it.
    """
    y = F.col(year)
    tagged = df.withColumn("split", F.when(y.isin(list(train_years)), F.lit("train"))
                           .when(y.isin(list(test_years)), F.lit("test")))
    return tagged.where(F.col("split").isNotNull())



def features_target(df: DataFrame, target: str = "prix_m2", drop: Sequence[str] = ()) -> tuple[list[str], str]:
    """Feature column list and target name (P6); the target stays in the same row."""
    feats = [c for c in df.columns if c != target and c not in drop and c != "split"]
    return feats, target




def domain_value(c: str, lo: int, hi: int):
    """Value inside an ordered integer domain, else NULL (C14)."""
    col = F.col(c).cast("int")
    return F.when(col.between(lo, hi), col)


def convert_types(df: DataFrame, analysis: bool = False) -> DataFrame:
    """Type battery of the cleaning step.

    * ``date_mutation`` -> DATE (strict under ANSI: malformed text raises);
    * ``code_postal`` normalised (null/0 -> NULL, zero-padded to 5);
    * ``code_type_local`` -> nullable BIGINT; department/commune codes -> text;
    * ``mois`` in 1..12 and ``trimestre`` in 1..4, anything else NULL;
    * with ``analysis=True`` also ``annee_date`` = 1 January of ``annee``.
    Categorical columns stay strings; their domains live in ``profile``.
    """
    cols = set(df.columns)
    out = {}
    if "date_mutation" in cols:
        out["date_mutation"] = F.to_date(F.col("date_mutation"))
    if "code_postal" in cols:
        out["code_postal"] = normalize_postcode("code_postal")
    if "code_type_local" in cols:
        out["code_type_local"] = ((F.col("code_type_local").cast("string")).try_cast("double")).try_cast("bigint")
    for c in ("code_departement", "code_commune"):
        if c in cols:
            out[c] = F.col(c).cast("string")
    if "mois" in cols:
        out["mois"] = domain_value("mois", 1, 12)
    if "trimestre" in cols:
        out["trimestre"] = domain_value("trimestre", 1, 4)
    if analysis and "annee" in cols:
        out["annee_date"] = F.make_date(F.col("annee").cast("int"), F.lit(1), F.lit(1))
    return df.withColumns(out) if out else df


def classify_columns(df: DataFrame, categorical: Iterable[str] = ("mois", "trimestre", "code_type_local")) -> dict:
    """Numeric / categorical / date column lists from the schema (P10).

    Month, quarter and type code are declared categorical like the reference's
    category dtypes even though they are stored as integers.
    """
    from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType
    cat_declared = set(categorical)
    num, cat, dates = [], [], []
    for f in df.schema.fields:
        if f.name in cat_declared or isinstance(f.dataType, (StringType, BooleanType)):
            cat.append(f.name)
        elif isinstance(f.dataType, NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            dates.append(f.name)
    return {"numeriques": num, "categoriques": cat, "dates": dates}


def keep_mask(df: DataFrame, departments: Iterable[str] | None = K.IDF_DEPARTMENTS,
              value: str = "valeur_fonciere", surface: str = "surface_reelle_bati",
              rooms: str = "nombre_pieces_principales"):
    """Boolean Column: the row survives ``clean_sales`` (for one-pass retention counts, A18)."""
    v, s, r = F.col(value), F.col(surface), F.col(rooms)
    price = safe_div(v, s)
    m = ((v > K.MIN_VALUE) & (s > K.MIN_SURFACE) & (s < K.MAX_SURFACE) & (r >= K.MIN_ROOMS)
         & (r <= K.MAX_ROOMS) & (price > K.MIN_PRICE_M2) & (price < K.MAX_PRICE_M2))
    if departments is not None:
        m = m & F.col("code_departement").isin(list(departments))
    return F.coalesce(m, F.lit(False))
