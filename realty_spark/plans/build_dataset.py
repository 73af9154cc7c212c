"""Dataset build (cleaned price-per-m2 sales with district medians), section 3.1 of the survey.

scan -> department filter / column prune -> typed dates and numbers ->
quality + outlier filters -> district labels -> district x quarter medians
(one shuffle) -> join back -> gap %.  ``write_dataset`` lands it as Parquet
partitioned by year, sorted by date within files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from realty_spark import constants as K
from realty_spark.functions.dates import add_calendar
from realty_spark.functions.parse import nan_to_null, parse_date, parse_locale_number
from realty_spark.operators import clean, district
from realty_spark.operators.quantiles import BROADCAST_ROWS
from realty_spark.session import ensure_checkpoint_dir, scratch_path


def parse_numbers(df: DataFrame, columns: Iterable[str] = K.GEO_NUMERIC, strict: bool = False) -> DataFrame:
    """Text numbers with decimal commas -> double; numeric columns -> double with NaN -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in columns:
        if c not in types:
            continue
        if isinstance(types[c], StringType):
            out[c] = parse_locale_number(c, strict=strict)
        elif isinstance(types[c], NumericType):
            out[c] = nan_to_null(F.col(c).cast("double"))
        else:
            out[c] = (F.col(c).cast("string")).try_cast("double")
    return df.withColumns(out) if out else df


def prepare_sales(raw: DataFrame, departments: Iterable[str] | None = K.IDF_DEPARTMENTS,
                  date_format: str = "yyyy-MM-dd", strict_numbers: bool = False) -> DataFrame:
    """Everything of the build up to the outlier filter (narrow stages only, no shuffle)."""
    df = raw
    if departments is not None:
        df = clean.filter_departments(df, departments)
    df = clean.drop_columns(df, K.BUILD_DROP_COLUMNS)
    types = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(types.get("date_mutation"), StringType):
        df = df.withColumn("date_mutation", parse_date("date_mutation", date_format))
    df = add_calendar(df, "date_mutation")
    df = parse_numbers(df, K.GEO_NUMERIC, strict=strict_numbers)
    return clean.price_filter(clean.with_price_m2(clean.quality_filter(df)))


def land_sales(sales: DataFrame, by: str = "quartier_detaille", buckets: int | None = None) -> DataFrame:
    """``sales`` written once into the checkpoint folder as a table bucketed by district, and read back.

    Medians, first medians and joins on the district find the rows of a
    district together, so they shuffle no sale again.
    """
    spark = sales.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"sales_{uuid.uuid4().hex}"
    sales.write.option("path", scratch_path(spark, "sales")).bucketBy(buckets, by).saveAsTable(name)
    return spark.table(name)


def build_dataset(raw: DataFrame, departments: Iterable[str] | None = K.IDF_DEPARTMENTS,
                  capital: str = K.CAPITAL_DEPARTMENT, capital_label: str = K.CAPITAL_LABEL,
                  date_format: str = "yyyy-MM-dd", landed: bool = False) -> DataFrame:
    """Cleaned sales with district labels, the (district, quarter) median and the % gap; ``landed``: by way of ``land_sales``."""
    sales = district.label_districts(prepare_sales(raw, departments, date_format), capital, capital_label)
    sales = land_sales(sales) if landed else sales
    medians = district.district_quarter_median(sales)
    if landed:  # a row per district and quarter, counted before it may be broadcast
        ensure_checkpoint_dir(sales.sparkSession)
        medians = medians.checkpoint()
        medians = F.broadcast(medians) if medians.count() <= BROADCAST_ROWS else medians
    return district.attach_median(sales, medians)


def clean_dataset(dataset: DataFrame, analysis: bool = False) -> DataFrame:
    """Cleaning step on a built dataset: drop columns, impute medians, gap, types (section 3.2)."""
    df = clean.drop_columns(dataset, K.CLEAN_DROP_COLUMNS)
    df = district.impute_median(df)
    return clean.convert_types(df, analysis=analysis)


def write_dataset(df: DataFrame, path: str, partition_by: str = "annee", fmt: str = "parquet",
                  partitions: int | None = None) -> None:
    """Persist as Parquet partitioned by year, rows sorted by date inside each file.

    Range partitioning on (year, date) spreads a large year over many tasks; a
    hash of the whole row at the key's end lets one busy date spread as well.
    """
    keys = [partition_by, "date_mutation"]
    tailed = df.withColumn("_tail", F.xxhash64(*df.columns))
    dealt = tailed.repartitionByRange(partitions, *keys, "_tail") if partitions else tailed.repartitionByRange(*keys, "_tail")
    (dealt.sortWithinPartitions(*keys, "_tail").drop("_tail")
     .write.mode("overwrite").partitionBy(partition_by).format(fmt).save(path))
