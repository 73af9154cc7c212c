"""District labels, district x quarter medians, join-back and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realty_spark import constants as K
from realty_spark.functions.labels import arrondissement, detailed_district, district
from realty_spark.functions.numeric import safe_div
from realty_spark.operators.quantiles import group_stats

MEDIAN_KEYS = ("quartier_detaille", "annee_trimestre")


def label_districts(df: DataFrame, capital: str = K.CAPITAL_DEPARTMENT,
                    capital_label: str = K.CAPITAL_LABEL) -> DataFrame:
    """quartier = 'commune (postcode)', arrondissement inside the capital, detailed label."""
    return (df.withColumns({"quartier": district("nom_commune", "code_postal"),
                            "arrondissement": arrondissement("code_departement", "code_postal", capital)})
            .withColumn("quartier_detaille", detailed_district("arrondissement", "quartier", capital_label)))


def district_quarter_median(sales: DataFrame, min_sales: int = K.MIN_SALES_PER_MEDIAN,
                            price: str = "prix_m2", keys=MEDIAN_KEYS) -> DataFrame:
    """Median, count and mean of price per (district, quarter), groups with >= min_sales (A1, A2)."""
    keys = list(keys)
    base = sales
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    st = group_stats(base, keys, {"prix_median_m2": (price, 0.5)},
                     {"nb_transactions": (price, "count"), "prix_moyen_m2": (price, "avg")})
    return (st.where(F.col("nb_transactions") >= min_sales)
            .select(*keys, "prix_median_m2", "nb_transactions", "prix_moyen_m2"))


def with_median_gap(df: DataFrame, price: str = "prix_m2", median: str = "prix_median_m2") -> DataFrame:
    """ecart_prix_median_pct = (price - median) / median * 100; NULL when the median is NULL or 0 (C11)."""
    return df.withColumn("ecart_prix_median_pct",
                         safe_div(F.col(price) - F.col(median), F.col(median)) * F.lit(100.0))


def attach_median(sales: DataFrame, medians: DataFrame, keys=MEDIAN_KEYS) -> DataFrame:
    """Left-join the group median back onto every sale, then the % gap.

    The median table has one row per (district, quarter); AQE broadcasts it
    when its measured size is under the broadcast threshold, otherwise the
    join is a sort-merge join whose skewed partitions AQE splits.
    """
    m = medians.select(*keys, "prix_median_m2")
    return with_median_gap(sales.join(m, list(keys), "left"))


def district_first_median(dataset: DataFrame, district_col: str = "quartier_detaille",
                          order_col: str = "date_mutation") -> DataFrame:
    """Per district, the median of its earliest dated row that has one (A3).

    Medians are constant within (district, quarter), so ties on the date carry
    the same value and ``min_by`` is deterministic.
    """
    return (dataset.where(F.col("prix_median_m2").isNotNull() & F.col(district_col).isNotNull())
            .groupBy(district_col)
            .agg(F.min_by("prix_median_m2", order_col).alias("_district_median")))


def impute_median(dataset: DataFrame, district_col: str = "quartier_detaille") -> DataFrame:
    """Fill a missing median with the district's first median, else the row's own price (J2),
    then recompute the gap (C11)."""
    first = district_first_median(dataset, district_col)
    out = (dataset.join(first, district_col, "left")
           .withColumn("prix_median_m2", F.coalesce("prix_median_m2", "_district_median", "prix_m2"))
           .drop("_district_median"))
    return with_median_gap(out)
