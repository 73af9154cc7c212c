"""Readers and writers for the registry extracts and result tables.

Text extracts are read with every column as a string (no inference; locale
numbers and codes are typed by the named parsing functions).  Multi-path
reads are a single scan over all files; frames with drifting columns are
stacked by name.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from realty_spark import constants as K
from realty_spark.functions.parse import parse_date

# Header names of the raw pipe-delimited extract and their canonical names.
RAW_TO_CANONICAL = {
    "Date mutation": "date_mutation",
    "Code departement": "code_departement",
    "Valeur fonciere": "valeur_fonciere",
    "Surface reelle bati": "surface_reelle_bati",
    "Surface terrain": "surface_terrain",
    "Nombre pieces principales": "nombre_pieces_principales",
    "Nombre de lots": "nombre_lots",
}

METRICS_SCHEMA = ("model string, dataset string, zone string, n long, rmse double, mae double, "
                  "r2 double, mape double, params map<string,string>")


def header_catalogue(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line of every file of the paths, from one distributed job.

    The files' lines are read as raw text; those of a file's first block come
    in order to one task, which streams them and hands on the first alone.  No
    line is sorted or held, as an aggregate of strings would, so a task's
    memory does not follow the size of its files.
    """
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_block_start").alias("_block"))

    def first_lines(batches):
        seen = set()
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            new = [(code, path) for code, path in enumerate(codes.dictionary.to_pylist()) if path not in seen]
            seen.update(path for _, path in new)
            if new:
                yield batch.take(pa.array([pc.index(codes.indices, code).as_py() for code, _ in new], pa.int64()))
    first = lines.where(F.col("_block") == 0).select("path", "value").mapInArrow(first_lines, "path string, value string")
    return first.groupBy("path").agg(F.min("value").alias("header"))  # a path that was given twice has the same line twice


def _fields(header: str, sep: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([header.lstrip("\ufeff")], delimiter=sep), ()))


def _read_by_name(spark: SparkSession, paths: Sequence[str], sep: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of all files, each file matched by its own header; a column that a file lacks is NULL there.

    Files are grouped by their headers (``header_catalogue``: a row per file
    comes to the driver); a group is one scan with its header as explicit
    string schema, so the number of jobs doesn't follow the number of files.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in header_catalogue(spark, paths).orderBy("path").collect():
        groups.setdefault(_fields(row["header"], sep), []).append(unquote(row["path"]))
    frames = []
    for header, files in groups.items():
        schema = StructType([StructField(c, StringType()) for c in header])
        frame = spark.read.schema(schema).option("header", True).option("sep", sep).csv(files)
        frames.append(frame.select([F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns]))
    if not frames:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    return reduce(DataFrame.union, frames)


def read_geo_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Comma CSV extracts (one per year) stacked by column name, all columns text."""
    return _read_by_name(spark, paths, ",", columns)


def read_raw_txt(spark: SparkSession, paths: Sequence[str], split: str | None = None,
                 columns: Sequence[str] = tuple(RAW_TO_CANONICAL)) -> DataFrame:
    """Pipe-delimited raw extracts stacked by column name, all columns text, optionally tagged with a split."""
    df = _read_by_name(spark, paths, "|", columns)
    return df.withColumn("split", F.lit(split)) if split else df


def canonical_raw(df: DataFrame, date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Rename raw headers to the canonical names and parse the French date."""
    for raw, canon in RAW_TO_CANONICAL.items():
        if raw in df.columns:
            df = df.withColumnRenamed(raw, canon)
    return df.withColumn("date_mutation", parse_date("date_mutation", date_format))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A dataset written by ``write_dataset`` (typed Parquet hand-off instead of CSV)."""
    return spark.read.parquet(path)


def union_periods(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing from a period becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metric table partitioned by model; only the written models' results are replaced."""
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path)


def read_metrics(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Metrics of one model; an empty table with the metric schema when nothing was written."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001 - missing path
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], METRICS_SCHEMA)
    return df.where(F.col("model") == model) if model else df


def write_splits(df: DataFrame, path: str) -> None:
    """Cleaned rows with their split, one Parquet folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


__all__ = ["header_catalogue", "read_geo_csv", "read_raw_txt", "canonical_raw", "read_dataset", "union_periods", "write_metrics",
           "read_metrics", "write_splits"]
