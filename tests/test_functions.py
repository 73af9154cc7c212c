"""Golden edge cases of the column functions (FIXTURES.md section 4)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from realty_spark.functions.labels import arrondissement, detailed_district, district, normalize_postcode
from realty_spark.functions.numeric import round_half_even, safe_corr, safe_div
from realty_spark.functions.parse import parse_date, parse_locale_number
from realty_spark.operators import clean


def test_nan_filter(spark):
    df = spark.createDataFrame([(float("nan"), 20.0, 3.0), (1001.0, 20.0, 3.0), (1000.0, 20.0, 3.0)],
                               "v double, s double, r double")
    df = df.withColumn("v", parse_locale_number("v"))
    out = clean.quality_filter(df, "v", "s", "r").collect()
    assert [r.v for r in out] == [1001.0]


def test_zero_surface(spark):
    df = spark.createDataFrame([(100.0, 0.0), (0.0, 0.0)], "v double, s double")
    assert [r.p for r in df.select(safe_div("v", "s").alias("p")).collect()] == [None, None]


def test_decimal_comma(spark):
    df = spark.createDataFrame([("250000,50",), ("abc",), (None,)], "t string")
    assert [r.x for r in df.select(parse_locale_number("t").alias("x")).collect()] == [250000.5, None, None]
    strict = df.where(F.col("t") == "250000,50").select(parse_locale_number("t", strict=True).alias("x"))
    assert strict.first().x == 250000.5


def test_bad_date(spark):
    df = spark.createDataFrame([("31/12/2024",), ("2024-12-31",), ("xx",)], "t string")
    got = [r.d for r in df.select(parse_date("t", "dd/MM/yyyy").alias("d")).collect()]
    assert got == [dt.date(2024, 12, 31), None, None]


def test_postcode(spark):
    df = spark.createDataFrame([("75001",), (None,), ("1234",), ("0",), ("123456",), ("75001.0",)], "c string")
    got = [r.c for r in df.select(normalize_postcode("c").alias("c")).collect()]
    assert got == ["75001", None, "01234", None, "123456", "75001"]


def test_paris_label(spark):
    df = spark.createDataFrame([("75", "75001", "Paris"), ("92", "92100", "Boulogne")], "d string, cp string, c string")
    out = (df.withColumns({"q": district("c", "cp"), "a": arrondissement("d", "cp")})
           .withColumn("qd", detailed_district("a", "q")).collect())
    assert [r.qd for r in out] == ["Paris 01e", "Boulogne (92100)"]


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,)], "x double")
    assert [r.x for r in df.select(round_half_even("x", 2).alias("x")).collect()] == [0.12, 0.14]


def test_constant_column_corr_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert df.agg(safe_corr("x", "y").alias("r")).first().r is None


def test_pairwise_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (None, 1.0), (4.0, 8.3)], "x double, y double")
    r = df.agg(safe_corr("x", "y").alias("r")).first().r
    import numpy as np
    assert math.isclose(r, np.corrcoef([1, 2, 4], [2, 4.1, 8.3])[0, 1], rel_tol=1e-12)
