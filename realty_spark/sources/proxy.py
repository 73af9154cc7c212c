"""Proxy sales view over the driver's TPC-H-like tables.

The driver data holds no property sales; this view plays that role
(see FIXTURES.md section 2):

=========================  ==========================================
sale concept               driver expression
=========================  ==========================================
date_mutation              CAST(o_orderdate AS DATE)
code_departement (zone)    r_name (or n_name with ``zone_level='nation'``)
nom_commune                n_name
code_postal                lpad(c_nationkey, 5, '0')
valeur_fonciere            l_extendedprice
surface_reelle_bati        l_quantity
nombre_pieces_principales  CAST(p_size AS DOUBLE)
=========================  ==========================================

Extra driver columns are kept for profiling (categories ``l_returnflag,
o_orderstatus, c_mktsegment, o_orderpriority, p_type, p_brand``; numbers
``l_discount, l_tax, p_retailprice``).  ``inject_nulls`` blanks the sale value
on line 7 of every order, a deterministic way to exercise null handling.

At scale this is three equi-joins on large keys (order, customer, part)
plus two tiny dimensions; Catalyst prunes every unused column before the
shuffles, and AQE turns the dimension joins into broadcasts from measured
sizes.  In a real deployment the registry extract is one flat table and
these joins disappear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Proxy departments / periods (the proxy's equivalents of the fixed values).
PROXY_DEPARTMENTS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
PROXY_CAPITAL = "EUROPE"
PROXY_TRAIN_YEARS = (1995, 1996, 1997, 1998, 1999, 2000)
PROXY_TEST_YEARS = (2001,)
PROXY_CATEGORICAL = ("l_returnflag", "o_orderstatus", "c_mktsegment", "o_orderpriority", "p_type")
PROXY_MID_CATEGORICAL = ("p_brand", "nom_commune")
PROXY_NUMERIC = ("surface_reelle_bati", "valeur_fonciere", "l_discount", "l_tax",
                 "nombre_pieces_principales", "p_retailprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def proxy_sales(spark: SparkSession, sf_dir: str, zone_level: str = "region",
                inject_nulls: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey)
         .join(p, li.l_partkey == p.p_partkey))
    value = F.col("l_extendedprice")
    if inject_nulls:
        value = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(value)
    dept = F.col("r_name") if zone_level == "region" else F.col("n_name")
    return j.select(
        F.col("o_orderdate").cast("date").alias("date_mutation"),
        dept.alias("code_departement"),
        F.col("n_name").alias("nom_commune"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("code_postal"),
        value.alias("valeur_fonciere"),
        F.col("l_quantity").alias("surface_reelle_bati"),
        F.col("p_size").cast("double").alias("nombre_pieces_principales"),
        "l_returnflag", "o_orderstatus", "c_mktsegment", "o_orderpriority", "p_type", "p_brand",
        "l_discount", "l_tax", "p_retailprice", "l_orderkey", "l_linenumber",
    )


def proxy_sales_sql(zone_level: str = "region", inject_nulls: bool = False) -> str:
    """The same view as a DuckDB/ANSI SQL SELECT (for oracle queries)."""
    value = ("CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_extendedprice END"
             if inject_nulls else "l.l_extendedprice")
    dept = "r.r_name" if zone_level == "region" else "n.n_name"
    return f"""
SELECT CAST(o.o_orderdate AS DATE) AS date_mutation,
       {dept} AS code_departement,
       n.n_name AS nom_commune,
       lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS code_postal,
       {value} AS valeur_fonciere,
       l.l_quantity AS surface_reelle_bati,
       CAST(p.p_size AS DOUBLE) AS nombre_pieces_principales,
       l.l_returnflag, o.o_orderstatus, c.c_mktsegment, o.o_orderpriority, p.p_type, p.p_brand,
       l.l_discount, l.l_tax, p.p_retailprice, l.l_orderkey, l.l_linenumber
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey"""
