"""Calendar derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from realty_spark.constants import QUARTER_SEP


def month_start(c) -> Column:
    """First day of the month as DATE (a pandas monthly period)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(c.cast("date"), "MM")


def quarter_label(year: Column, quarter: Column) -> Column:
    """'YYYY-Tq'; NULL when the date is NULL."""
    return F.concat(year.cast("string"), F.lit(QUARTER_SEP), quarter.cast("string"))


def add_calendar(df: DataFrame, date_col: str = "date_mutation", with_month_start: bool = False,
                 with_quarter_label: bool = True) -> DataFrame:
    """Add annee, mois, trimestre (ints), annee_trimestre and optionally annee_mois."""
    d = F.col(date_col)
    cols = {"annee": F.year(d), "mois": F.month(d), "trimestre": F.quarter(d)}
    df = df.withColumns(cols)
    if with_quarter_label:
        df = df.withColumn("annee_trimestre", quarter_label(F.col("annee"), F.col("trimestre")))
    if with_month_start:
        df = df.withColumn("annee_mois", month_start(d))
    return df
