"""Query catalogue: every operator family as a (Spark query, DuckDB oracle SQL) pair.

Each Spark query takes ``(spark, sf_dir)`` and runs the library operators on
the proxy sales view built from the driver tables; the oracle computes the
same result in plain SQL.  Doubles are rounded to 6 decimals on both sides
(summation order differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from realty_spark.sources.proxy import (
    PROXY_DEPARTMENTS, PROXY_TEST_YEARS, PROXY_TRAIN_YEARS, proxy_sales, proxy_sales_sql,
)
from realty_spark import constants as K
from realty_spark.functions.distributions import NORMAL_QUANTILE
from realty_spark.operators import clean, forecast, panel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ROUND = 6


def _round_expr(c, scale: int = ROUND):
    """floor(x * 10^s + 0.5) / 10^s: plain IEEE arithmetic, bit-identical in Spark and DuckDB
    (Spark's ``round`` rounds the decimal text, DuckDB the binary value)."""
    m = float(10 ** scale)
    return F.when(F.abs(c) < 1e12, F.floor(c * m + 0.5).cast("double") / m).otherwise(c)


def rounded(df: DataFrame, scale: int = ROUND) -> DataFrame:
    """Round every floating column (final projection only)."""
    return df.select(*[_round_expr(F.col(f.name), scale).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def register(name: str, sql: str | None = None):
    def deco(fn):
        # only what is compared with SQL is rounded
        QUERIES[name] = (lambda spark, sf_dir, _fn=fn: rounded(_fn(spark, sf_dir))) if sql is not None else fn
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


DEPTS_SQL = ", ".join(f"'{d}'" for d in PROXY_DEPARTMENTS)
TRAIN_SQL = ", ".join(str(y) for y in PROXY_TRAIN_YEARS)
TEST_SQL = ", ".join(str(y) for y in PROXY_TEST_YEARS)


def _clean_cte(zone_level: str = "region", inject_nulls: bool = False, departments: bool = True) -> str:
    where = f"WHERE code_departement IN ({DEPTS_SQL})" if departments else ""
    return f"""
raw AS ({proxy_sales_sql(zone_level, inject_nulls)}),
q AS (SELECT * FROM raw {where}),
f AS (SELECT * FROM q WHERE valeur_fonciere > 1000 AND surface_reelle_bati > 9 AND surface_reelle_bati < 1000
      AND nombre_pieces_principales >= 1 AND nombre_pieces_principales <= 15),
sales AS (SELECT *, valeur_fonciere / NULLIF(surface_reelle_bati, 0) AS prix_m2 FROM f
          WHERE valeur_fonciere / NULLIF(surface_reelle_bati, 0) > 500
            AND valeur_fonciere / NULLIF(surface_reelle_bati, 0) < 20000)"""


def r6(expr: str) -> str:
    m = f"{float(10 ** ROUND)}"
    return f"(CASE WHEN abs({expr}) < 1e12 THEN floor(({expr}) * {m} + 0.5) / {m} ELSE ({expr}) END)"


def clean_proxy(spark: SparkSession, sf_dir: str, zone_level: str = "region",
                inject_nulls: bool = False, departments=PROXY_DEPARTMENTS) -> DataFrame:
    return clean.clean_sales(proxy_sales(spark, sf_dir, zone_level, inject_nulls), departments)


def zoned(spark: SparkSession, sf_dir: str, zone_level: str = "region") -> DataFrame:
    return panel.with_zone(clean_proxy(spark, sf_dir, zone_level))


# ---------------------------------------------------------------- panel ----
@register("monthly_panel", sql=f"""
WITH {_clean_cte()},
z AS (SELECT 'Dept ' || code_departement AS zone, CAST(date_trunc('month', date_mutation) AS DATE) AS annee_mois,
             prix_m2, valeur_fonciere FROM sales)
SELECT zone, annee_mois, {r6('median(prix_m2)')} AS prix_median_m2, {r6('avg(prix_m2)')} AS prix_moyen_m2,
       count(prix_m2) AS nb_transactions, {r6('median(valeur_fonciere)')} AS valeur_mediane
FROM z GROUP BY zone, annee_mois""")
def q_monthly_panel(spark, sf_dir):
    """Monthly panel by zone: median/mean price per m2, count, median value (A7) [P1,P3,C7,P4,C16,C5]."""
    return panel.monthly_panel(zoned(spark, sf_dir))


# ------------------------------------------------------ dataset build ------
from realty_spark.functions.dates import add_calendar  # noqa: E402
from realty_spark.functions.parse import parse_date, parse_locale_number  # noqa: E402
from realty_spark.operators import association, district, profile  # noqa: E402
from realty_spark.plans import build_dataset as B  # noqa: E402
from realty_spark.sources.proxy import (  # noqa: E402
    PROXY_CAPITAL, PROXY_CATEGORICAL, PROXY_MID_CATEGORICAL, PROXY_NUMERIC, table,
)


def built(spark, sf_dir, zone_level="region"):
    raw = proxy_sales(spark, sf_dir, zone_level)
    return B.build_dataset(raw, PROXY_DEPARTMENTS, capital=PROXY_CAPITAL, landed=True)


def labelled(spark, sf_dir):
    sales = B.prepare_sales(proxy_sales(spark, sf_dir), PROXY_DEPARTMENTS)
    return district.label_districts(sales, PROXY_CAPITAL)


def train_rows(spark, sf_dir):
    """Cleaned analysis rows, train split (the reference's X_train / y_train rows), without the district medians.

    The reports on these rows read no median, and adding or imputing medians
    keeps every row, so the median job is left out of their plans.
    """
    return typed_rows(spark, sf_dir).where(F.col("split") == "train")


def typed_rows(spark, sf_dir):
    """Cleaned, typed rows of both splits, without the district medians."""
    ds = clean.convert_types(clean.drop_columns(labelled(spark, sf_dir), K.CLEAN_DROP_COLUMNS), analysis=True)
    return clean.split_by_year(ds, PROXY_TRAIN_YEARS, PROXY_TEST_YEARS).where(F.col("split").isNotNull())


_LABELS_SQL = f"""
cal AS (SELECT *, CAST(year(date_mutation) AS INTEGER) AS annee, CAST(month(date_mutation) AS INTEGER) AS mois,
               CAST(quarter(date_mutation) AS INTEGER) AS trimestre,
               CAST(year(date_mutation) AS VARCHAR) || '-T' || CAST(quarter(date_mutation) AS VARCHAR) AS annee_trimestre
        FROM sales),
lab AS (SELECT *, coalesce(nom_commune, '') || ' (' ||
               coalesce(CASE WHEN length(code_postal) < 5 THEN lpad(code_postal, 5, '0') ELSE code_postal END, '')
               || ')' AS quartier,
               CASE WHEN code_departement = '{PROXY_CAPITAL}' THEN right(code_postal, 2) END AS arrondissement
        FROM cal),
lab2 AS (SELECT *, CASE WHEN arrondissement IS NOT NULL THEN 'Paris ' || arrondissement || 'e' ELSE quartier END
                AS quartier_detaille FROM lab),
med AS (SELECT quartier_detaille, annee_trimestre, median(prix_m2) AS prix_median_m2,
               count(prix_m2) AS nb_transactions, avg(prix_m2) AS prix_moyen_m2
        FROM lab2 WHERE quartier_detaille IS NOT NULL AND annee_trimestre IS NOT NULL
        GROUP BY 1, 2 HAVING count(prix_m2) >= 5),
ds AS (SELECT l.*, m.prix_median_m2,
              (l.prix_m2 - m.prix_median_m2) / NULLIF(m.prix_median_m2, 0) * 100 AS ecart_prix_median_pct
       FROM lab2 l LEFT JOIN med m USING (quartier_detaille, annee_trimestre)),
first_med AS (SELECT quartier_detaille, arg_min(prix_median_m2, date_mutation) AS dm FROM ds
              WHERE prix_median_m2 IS NOT NULL GROUP BY 1),
imp AS (SELECT ds.* REPLACE (coalesce(ds.prix_median_m2, f.dm, ds.prix_m2) AS prix_median_m2) FROM ds
        LEFT JOIN first_med f USING (quartier_detaille)),
imp2 AS (SELECT * REPLACE ((prix_m2 - prix_median_m2) / NULLIF(prix_median_m2, 0) * 100 AS ecart_prix_median_pct)
         FROM imp),
typed AS (SELECT * REPLACE (
              nullif(CASE WHEN length(CAST(coalesce(TRY_CAST(TRY_CAST(code_postal AS DOUBLE) AS BIGINT), 0) AS VARCHAR)) < 5
                          THEN lpad(CAST(coalesce(TRY_CAST(TRY_CAST(code_postal AS DOUBLE) AS BIGINT), 0) AS VARCHAR), 5, '0')
                          ELSE CAST(coalesce(TRY_CAST(TRY_CAST(code_postal AS DOUBLE) AS BIGINT), 0) AS VARCHAR) END,
                     '00000') AS code_postal),
              make_date(annee, 1, 1) AS annee_date
          FROM imp2),
tr AS (SELECT *, CASE WHEN annee IN ({TRAIN_SQL}) THEN 'train' WHEN annee IN ({TEST_SQL}) THEN 'test' END AS split
       FROM typed)"""


@register("clean_sales", sql=f"""
WITH {_clean_cte()}
SELECT date_mutation, code_departement, valeur_fonciere, surface_reelle_bati, nombre_pieces_principales,
       {r6('prix_m2')} AS prix_m2 FROM sales""")
def q_clean_sales(spark, sf_dir):
    """Department, quality and outlier filters with price per m2."""
    return clean_proxy(spark, sf_dir).select("date_mutation", "code_departement", "valeur_fonciere",
                                             "surface_reelle_bati", "nombre_pieces_principales", "prix_m2")


@register("district_label", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT DISTINCT code_departement, nom_commune, code_postal, quartier, arrondissement, quartier_detaille FROM lab2""")
def q_district_label(spark, sf_dir):
    """District label, capital arrondissement and detailed label."""
    return labelled(spark, sf_dir).select("code_departement", "nom_commune", "code_postal", "quartier",
                                          "arrondissement", "quartier_detaille").distinct()


@register("district_quarter_median", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT quartier_detaille, annee_trimestre, {r6('prix_median_m2')} AS prix_median_m2, nb_transactions,
       {r6('prix_moyen_m2')} AS prix_moyen_m2 FROM med""")
def q_district_quarter_median(spark, sf_dir):
    """Median/count/mean price per (district, quarter), HAVING >= 5 sales."""
    return district.district_quarter_median(labelled(spark, sf_dir))


@register("median_gap", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT date_mutation, quartier_detaille, annee_trimestre, {r6('prix_m2')} AS prix_m2,
       {r6('prix_median_m2')} AS prix_median_m2, {r6('ecart_prix_median_pct')} AS ecart_prix_median_pct FROM ds""")
def q_median_gap(spark, sf_dir):
    """Group median joined back onto every sale and % gap (J1, C11): the built dataset."""
    return built(spark, sf_dir).select("date_mutation", "quartier_detaille", "annee_trimestre", "prix_m2",
                                       "prix_median_m2", "ecart_prix_median_pct")


@register("impute_median", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT date_mutation, quartier_detaille, {r6('prix_m2')} AS prix_m2, {r6('prix_median_m2')} AS prix_median_m2,
       {r6('ecart_prix_median_pct')} AS ecart_prix_median_pct FROM imp2""")
def q_impute_median(spark, sf_dir):
    """Missing medians filled with the district's first median, else own price; gap recomputed."""
    ds = clean.drop_columns(built(spark, sf_dir), ["annee_trimestre"])
    return district.impute_median(ds).select("date_mutation", "quartier_detaille", "prix_m2", "prix_median_m2",
                                            "ecart_prix_median_pct")


@register("drop_and_cast", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT date_mutation, code_postal, code_departement, mois, trimestre, annee_date, quartier_detaille,
       {r6('prix_median_m2')} AS prix_median_m2 FROM typed""")
def q_drop_and_cast(spark, sf_dir):
    """Column drop, imputation and the type battery: postcode, domains, year date."""
    ds = B.clean_dataset(built(spark, sf_dir), analysis=True)
    assert "annee_trimestre" not in ds.columns and "arrondissement" not in ds.columns
    return ds.select("date_mutation", "code_postal", "code_departement", "mois", "trimestre", "annee_date",
                     "quartier_detaille", "prix_median_m2")


@register("parse_locale_number", sql="""
SELECT l_orderkey, l_linenumber,
       TRY_CAST(replace(trim(CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN 'abc'
                                  ELSE replace(CAST(l_extendedprice AS VARCHAR), '.', ',') END), ',', '.') AS DOUBLE)
       AS valeur_fonciere
FROM lineitem""")
def q_parse_locale_number(spark, sf_dir):
    """Decimal-comma text -> double, junk -> NULL (C6, T8) over every lineitem price."""
    li = table(spark, sf_dir, "lineitem")
    text = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 3), F.lit("abc")) \
        .otherwise(F.regexp_replace(F.col("l_extendedprice").cast("string"), r"\.", ","))
    return li.select("l_orderkey", "l_linenumber", parse_locale_number(text).alias("valeur_fonciere"))


@register("parse_dates", sql="""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'xx'
                                   WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d')
                                   ELSE strftime(o_orderdate, '%d/%m/%Y') END AS txt FROM orders),
d AS (SELECT o_orderkey, CAST(try_strptime(txt, '%d/%m/%Y') AS DATE) AS date_mutation FROM t)
SELECT o_orderkey, date_mutation, CAST(year(date_mutation) AS INTEGER) AS annee,
       CAST(month(date_mutation) AS INTEGER) AS mois, CAST(quarter(date_mutation) AS INTEGER) AS trimestre,
       CAST(year(date_mutation) AS VARCHAR) || '-T' || CAST(quarter(date_mutation) AS VARCHAR) AS annee_trimestre,
       CAST(date_trunc('month', date_mutation) AS DATE) AS annee_mois
FROM d""")
def q_parse_dates(spark, sf_dir):
    """dd/MM/yyyy text -> DATE with malformed text -> NULL; year, month, quarter, labels."""
    o = table(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("xx"))
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd"))
           .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    d = o.select("o_orderkey", parse_date(txt, "dd/MM/yyyy").alias("date_mutation"))
    return add_calendar(d, "date_mutation", with_month_start=True)


@register("train_test_split", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT split, date_mutation, quartier_detaille, {r6('prix_m2')} AS prix_m2 FROM tr WHERE split IS NOT NULL""")
def q_train_test_split(spark, sf_dir):
    """Year-membership split of the cleaned dataset; target kept in-row."""
    ds = clean.split_by_year(B.clean_dataset(built(spark, sf_dir)), PROXY_TRAIN_YEARS, PROXY_TEST_YEARS)
    feats, target = clean.features_target(ds, "prix_m2", drop=["annee"])
    assert target not in feats
    return ds.select("split", "date_mutation", "quartier_detaille", target)


@register("split_summary", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL},
t AS (SELECT * FROM tr WHERE split IS NOT NULL),
py AS (SELECT split, annee, count(*) AS nb_annee FROM t GROUP BY 1, 2),
ps AS (SELECT split, count(*) AS nb_lignes, avg(prix_m2) AS cible_moyenne, min(prix_m2) AS cible_min,
              max(prix_m2) AS cible_max FROM t GROUP BY 1),
ps2 AS (SELECT *, nb_lignes * 100.0 / sum(nb_lignes) OVER () AS part_pct FROM ps)
SELECT py.split, py.annee, py.nb_annee, ps2.nb_lignes, {r6('ps2.cible_moyenne')} AS cible_moyenne,
       {r6('ps2.cible_min')} AS cible_min, {r6('ps2.cible_max')} AS cible_max, {r6('ps2.part_pct')} AS part_pct
FROM py JOIN ps2 USING (split)""")
def q_split_summary(spark, sf_dir):
    """Rows per split and year, split share, target mean/min/max."""
    return profile.split_summary(typed_rows(spark, sf_dir))


_NULL_COLS = ("date_mutation", "code_departement", "nom_commune", "code_postal", "valeur_fonciere",
              "surface_reelle_bati", "nombre_pieces_principales", "l_returnflag", "p_type")


@register("null_profile", sql="WITH raw AS (" + proxy_sales_sql(inject_nulls=True) + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS nb_null FROM raw" for c in _NULL_COLS))
def q_null_profile(spark, sf_dir):
    """Null count per column in one pass, on the proxy with injected NULL values (A5)."""
    return profile.null_profile(proxy_sales(spark, sf_dir, inject_nulls=True), _NULL_COLS)


def _long_sql(cols, value_type="DOUBLE", src="t", keep=""):
    keep = f"{keep}, " if keep else ""
    return "\nUNION ALL\n".join(
        f"SELECT {keep}'{c}' AS variable, CAST({c} AS {value_type}) AS value FROM {src}" for c in cols)


_TRAIN_SQL = f"WITH {_clean_cte()}, {_LABELS_SQL}, t AS (SELECT * FROM tr WHERE split = 'train')"


@register("numeric_profile", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(PROXY_NUMERIC)})
SELECT variable, count(value) AS nb, {r6('min(value)')} AS min, {r6('quantile_cont(value, 0.25)')} AS q1,
       {r6('median(value)')} AS mediane, {r6('avg(value)')} AS moyenne, {r6('quantile_cont(value, 0.75)')} AS q3,
       {r6('max(value)')} AS max, {r6('stddev_samp(value)')} AS ecart_type,
       count(*) FILTER (WHERE value IS NULL) AS nb_nan
FROM long GROUP BY variable""")
def q_numeric_profile(spark, sf_dir):
    """Descriptive statistics of every numeric column of the train split."""
    return profile.numeric_profile(train_rows(spark, sf_dir), PROXY_NUMERIC)


_CATS = PROXY_CATEGORICAL + PROXY_MID_CATEGORICAL


@register("category_profile", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(_CATS, 'VARCHAR')}),
c AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
pv AS (SELECT variable, count(*) AS nb_categories, sum(n) AS nn FROM c GROUP BY 1),
nu AS (SELECT variable, count(*) FILTER (WHERE value IS NULL) AS nb_valeurs_manquantes FROM long GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value ASC) AS rang FROM c)
SELECT r.variable, CAST(r.rang AS INTEGER) AS rang, r.value, r.n AS effectif,
       {r6('r.n * 100.0 / pv.nn')} AS pourcentage, pv.nb_categories, nu.nb_valeurs_manquantes
FROM r JOIN pv USING (variable) JOIN nu USING (variable) WHERE r.rang <= 10""")
def q_category_profile(spark, sf_dir):
    """Levels, nulls, top-10 counts and shares per categorical column."""
    return profile.category_profile(train_rows(spark, sf_dir), _CATS)


@register("level_gate", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(_CATS, 'VARCHAR')}),
pv AS (SELECT variable, count(DISTINCT value) AS nb_categories FROM long GROUP BY 1)
SELECT variable, nb_categories, nb_categories <= 20 AS graphique, nb_categories < 100 AS test FROM pv""")
def q_level_gate(spark, sf_dir):
    """Distinct levels per categorical column with the chart (<= 20) and test (< 100) gates."""
    return profile.level_gate(train_rows(spark, sf_dir), _CATS)


_TBC = PROXY_CATEGORICAL + ("mois", "trimestre")


@register("target_by_category", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(_TBC, 'VARCHAR', keep='prix_m2')}),
l AS (SELECT variable, value AS level, prix_m2 FROM long WHERE value IS NOT NULL)
SELECT variable, level, count(prix_m2) AS count, round_even(avg(prix_m2), 2) AS mean,
       round_even(median(prix_m2), 2) AS median, round_even(stddev_samp(prix_m2), 2) AS std,
       round_even(min(prix_m2), 2) AS min, round_even(max(prix_m2), 2) AS max
FROM l GROUP BY 1, 2""")
def q_target_by_category(spark, sf_dir):
    """Price statistics per level of each categorical column, half-even rounded; month/quarter domains."""
    doms = {"mois": range(1, 13), "trimestre": range(1, 5)}
    return profile.target_by_category(train_rows(spark, sf_dir), _TBC, domains=doms)


# -------------------------------------------------------- association ------
def _assoc_long_sql(cols, typ):
    return f"""long AS ({_long_sql(cols, typ, keep='prix_m2')})"""


_CAT_L = f"""{_TRAIN_SQL}, {_assoc_long_sql(PROXY_CATEGORICAL, 'VARCHAR')},
l AS (SELECT variable, value AS level, prix_m2 AS y FROM long WHERE value IS NOT NULL AND prix_m2 IS NOT NULL)"""
_NUM_L = f"""{_TRAIN_SQL}, {_assoc_long_sql(PROXY_NUMERIC, 'DOUBLE')},
l AS (SELECT variable, value AS x, prix_m2 AS y FROM long WHERE value IS NOT NULL AND NOT isnan(value)
      AND prix_m2 IS NOT NULL)"""


@register("anova_f", sql=f"""{_CAT_L},
g AS (SELECT variable, level, count(y) AS n, avg(y) AS m, var_pop(y) AS v FROM l GROUP BY 1, 2),
v AS (SELECT variable, count(*) AS k, CAST(sum(n) AS BIGINT) AS N, sum(n * m) / sum(n) AS gm, sum(n * v) AS ssw
      FROM g GROUP BY 1),
b AS (SELECT g.variable, sum(g.n * (g.m - v.gm) * (g.m - v.gm)) AS ssb FROM g JOIN v USING (variable) GROUP BY 1)
SELECT variable, k, N, {r6("CASE WHEN k > 1 THEN (ssb / (k - 1)) / NULLIF(ssw / NULLIF(N - k, 0), 0) ELSE 0.0 END")}
       AS f_stat FROM v JOIN b USING (variable)""")
def q_anova_f(spark, sf_dir):
    """One-way ANOVA F of price across the levels of every categorical column (H1)."""
    return association.anova(train_rows(spark, sf_dir), PROXY_CATEGORICAL, with_p=False)


@register("kruskal_h", sql=f"""{_CAT_L},
r AS (SELECT variable, level, y, rank() OVER (PARTITION BY variable ORDER BY y)
             + (count(*) OVER (PARTITION BY variable, y) - 1) / 2.0 AS rk FROM l),
rs AS (SELECT variable, level, count(*) AS n, sum(rk) AS R FROM r GROUP BY 1, 2),
per AS (SELECT variable, count(*) AS k, CAST(sum(n) AS BIGINT) AS N, sum(R * R / n) AS s FROM rs GROUP BY 1),
tv AS (SELECT variable, y, CAST(count(*) AS DOUBLE) AS t FROM l GROUP BY 1, 2),
ties AS (SELECT variable, sum(t * t * t - t) AS tt FROM tv GROUP BY 1)
SELECT variable, k, N, {r6("CASE WHEN k > 1 THEN (12.0 / (CAST(N AS DOUBLE) * (N + 1)) * s - 3.0 * (N + 1)) / NULLIF(1 - tt / (CAST(N AS DOUBLE) * N * N - N), 0) ELSE 0.0 END")}
       AS h_stat FROM per JOIN ties USING (variable)""")
def q_kruskal_h(spark, sf_dir):
    """Kruskal-Wallis H with tie correction per categorical column, distributed average ranks (H2)."""
    return association.kruskal(train_rows(spark, sf_dir), PROXY_CATEGORICAL, with_p=False)


@register("pearson_target", sql=f"""{_NUM_L}
SELECT variable, count(*) AS n,
       {r6("CASE WHEN var_pop(x) * var_pop(y) > 0 THEN covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y)) END")}
       AS pearson FROM l GROUP BY 1""")
def q_pearson_target(spark, sf_dir):
    """Pearson r of each numeric column with price over pairwise complete rows, |r| order."""
    return association.order_by_abs(association.pearson(train_rows(spark, sf_dir), PROXY_NUMERIC, with_p=False))


@register("spearman_target", sql=f"""{_NUM_L},
r AS (SELECT variable,
             rank() OVER (PARTITION BY variable ORDER BY x) + (count(*) OVER (PARTITION BY variable, x) - 1) / 2.0 AS rx,
             rank() OVER (PARTITION BY variable ORDER BY y) + (count(*) OVER (PARTITION BY variable, y) - 1) / 2.0 AS ry
      FROM l)
SELECT variable, count(*) AS n,
       {r6("CASE WHEN var_pop(rx) * var_pop(ry) > 0 THEN covar_pop(rx, ry) / sqrt(var_pop(rx) * var_pop(ry)) END")}
       AS spearman FROM r GROUP BY 1""")
def q_spearman_target(spark, sf_dir):
    """Spearman rho of each numeric column with price from distributed average ranks (H4)."""
    return association.spearman(train_rows(spark, sf_dir), PROXY_NUMERIC, with_p=False)


def _corr_sql(a, b):
    if a == b:
        return f"CASE WHEN var_pop({a}) > 0 THEN 1.0 END"
    va = f"var_pop(CASE WHEN {b} IS NOT NULL THEN {a} END)"
    vb = f"var_pop(CASE WHEN {a} IS NOT NULL THEN {b} END)"
    return f"CASE WHEN {va} * {vb} > 0 THEN covar_pop({a}, {b}) / sqrt({va} * {vb}) END"


_CM_COLS = PROXY_NUMERIC + ("prix_m2",)
_CM_SQL = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, {r6(_corr_sql(a, b))} AS r FROM t"
    for i, a in enumerate(_CM_COLS) for b in _CM_COLS[i:])
_CM_SQL_MIRROR = "\nUNION ALL\n".join(
    f"SELECT '{b}' AS var1, '{a}' AS var2, {r6(_corr_sql(a, b))} AS r FROM t"
    for i, a in enumerate(_CM_COLS) for b in _CM_COLS[i + 1:])


@register("corr_matrix", sql=f"""{_TRAIN_SQL}
{_CM_SQL}
UNION ALL
{_CM_SQL_MIRROR}""")
def q_corr_matrix(spark, sf_dir):
    """Pairwise Pearson matrix of the numeric columns and price in one aggregation (H6)."""
    return association.corr_matrix(train_rows(spark, sf_dir), PROXY_NUMERIC, "prix_m2")


@register("jarque_bera", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(PROXY_NUMERIC)}),
l AS (SELECT * FROM long WHERE value IS NOT NULL AND NOT isnan(value)),
m AS (SELECT variable, avg(value) AS mu FROM l GROUP BY 1),
c AS (SELECT l.variable, l.value - m.mu AS d FROM l JOIN m USING (variable)),
s AS (SELECT variable, count(*) AS n, avg(d * d) AS m2, avg(d * d * d) AS m3, avg(d * d * d * d) AS m4 FROM c GROUP BY 1),
k AS (SELECT variable, n, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) - 3 AS kurt FROM s),
j AS (SELECT *, n / 6.0 * (skew * skew + kurt * kurt / 4.0) AS jb FROM k)
SELECT variable, n, {r6('skew')} AS skew, {r6('kurt')} AS kurt, {r6('jb')} AS jb, {r6('exp(-jb / 2.0)')} AS jb_p,
       CASE WHEN exp(-jb / 2.0) > 0.05 THEN 'Oui' ELSE 'Non' END AS normal FROM j""")
def q_jarque_bera(spark, sf_dir):
    """Jarque-Bera normality test of every numeric column on the full data (H5, scalable companion)."""
    return association.jarque_bera(train_rows(spark, sf_dir), PROXY_NUMERIC)


ROW_KEY = ("l_orderkey", "l_linenumber")


@register("shapiro")
def q_shapiro(spark, sf_dir):
    """Shapiro-Wilk W and p (Royston) on a seeded bounded sample per numeric column."""
    return association.shapiro(train_rows(spark, sf_dir), PROXY_NUMERIC, row_key=ROW_KEY)


@register("shapiro_sample", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(PROXY_NUMERIC, keep='prix_m2, l_orderkey, l_linenumber')}),
r AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY md5(l_orderkey || '|' || l_linenumber || '|42'), l_orderkey, l_linenumber) AS rk
      FROM long WHERE value IS NOT NULL AND NOT isnan(value) AND prix_m2 IS NOT NULL)
SELECT variable, l_orderkey, l_linenumber, {r6('value')} AS x FROM r WHERE rk <= {K.SHAPIRO_MAX_SAMPLE}""")
def q_shapiro_sample(spark, sf_dir):
    """The rows that the Shapiro-Wilk test draws per numeric column: at most 5,000 of least seeded hash."""
    return association.shapiro_sample(train_rows(spark, sf_dir), PROXY_NUMERIC, row_key=ROW_KEY)


def f_sf_sql(f: str, d1: str, d2: str) -> str:
    """F's survival function in SQL, by Simpson's rule over the angle whose squared sine is d2 / (d2 + d1 f)."""
    top, n = f"asin(sqrt({d2} / ({d2} + {d1} * {f})))", 20_000
    at = f"(({top}) * i / {n})"
    weight = f"(CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    log_b = f"(lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0))"
    part = f"CASE WHEN i = 0 THEN 0.0 ELSE 2 * exp({log_b} + ({d2} - 1) * ln(sin({at})) + ({d1} - 1) * ln(cos({at}))) END"
    return f"(list_sum(list_transform(range(0, {n + 1}), lambda i: {weight} * ({part}))) * ({top}) / {n} / 3)"


def chi2_sf_sql(x: str, k: str) -> str:
    """Chi-square's survival function in SQL, by Simpson's rule over the square root, as far as the density is felt."""
    n = 20_000
    at = f"(sqrt({x}) + (40 + sqrt({k})) * i / {n})"
    weight = f"(CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    part = f"exp(ln(2.0) * (1 - {k} / 2.0) + ({k} - 1) * ln({at}) - {at} * {at} / 2 - lgamma({k} / 2.0))"
    return f"(list_sum(list_transform(range(0, {n + 1}), lambda i: {weight} * ({part}))) * (40 + sqrt({k})) / {n} / 3)"


_RHO_SQL = "CASE WHEN var_pop({x}) * var_pop({y}) > 0 THEN covar_pop({x}, {y}) / sqrt(var_pop({x}) * var_pop({y})) END"


def _corr_p_sql(r: str) -> str:
    square = f"((n - 2) * {r} * {r} / ((1.0 - {r}) * (1.0 + {r})))"
    return f"CASE WHEN n > 2 AND abs({r}) < 1 THEN {f_sf_sql(square, '1.0', '(n - 2.0)')} WHEN n > 2 AND abs({r}) >= 1 THEN 0.0 END"


@register("correlation_tests", sql=f"""{_NUM_L},
r AS (SELECT *,
             rank() OVER (PARTITION BY variable ORDER BY x) + (count(*) OVER (PARTITION BY variable, x) - 1) / 2.0 AS rx,
             rank() OVER (PARTITION BY variable ORDER BY y) + (count(*) OVER (PARTITION BY variable, y) - 1) / 2.0 AS ry
      FROM l),
c AS (SELECT variable, count(*) AS n, {_RHO_SQL.format(x='x', y='y')} AS pearson, {_RHO_SQL.format(x='rx', y='ry')} AS spearman
      FROM r GROUP BY 1)
SELECT variable, n, {r6('pearson')} AS pearson, {r6(_corr_p_sql('pearson'))} AS pearson_p, {r6('spearman')} AS spearman,
       {r6(_corr_p_sql('spearman'))} AS spearman_p FROM c""")
def q_correlation_tests(spark, sf_dir):
    """Pearson and Spearman coefficients of each numeric column with price and their two-sided p-values."""
    return association.correlation_report(train_rows(spark, sf_dir), PROXY_NUMERIC, normality=False)


_REPORT_L = f"""{_TRAIN_SQL}, {_assoc_long_sql(_CATS, 'VARCHAR')},
gate AS (SELECT variable, count(DISTINCT value) AS nb_categories FROM long GROUP BY 1 HAVING count(DISTINCT value) < {K.TEST_MAX_LEVELS}),
l AS (SELECT variable, value AS level, prix_m2 AS y FROM long JOIN gate USING (variable) WHERE value IS NOT NULL AND prix_m2 IS NOT NULL)"""


@register("assoc_report", sql=f"""{_REPORT_L},
gl AS (SELECT variable, level, count(y) AS n, avg(y) AS m, var_pop(y) AS v FROM l GROUP BY 1, 2),
v AS (SELECT variable, CAST(count(*) AS DOUBLE) AS k, CAST(sum(n) AS DOUBLE) AS N, sum(n * m) / sum(n) AS gm, sum(n * v) AS ssw FROM gl GROUP BY 1),
b AS (SELECT gl.variable, sum(gl.n * (gl.m - v.gm) * (gl.m - v.gm)) AS ssb FROM gl JOIN v USING (variable) GROUP BY 1),
ft AS (SELECT variable, k, N, CASE WHEN k > 1 THEN (ssb / (k - 1)) / NULLIF(ssw / NULLIF(N - k, 0), 0) ELSE 0.0 END AS f_stat
      FROM v JOIN b USING (variable)),
r AS (SELECT variable, level, y, rank() OVER (PARTITION BY variable ORDER BY y)
             + (count(*) OVER (PARTITION BY variable, y) - 1) / 2.0 AS rk FROM l),
rs AS (SELECT variable, level, count(*) AS n, sum(rk) AS R FROM r GROUP BY 1, 2),
per AS (SELECT variable, sum(R * R / n) AS s FROM rs GROUP BY 1),
tv AS (SELECT variable, y, CAST(count(*) AS DOUBLE) AS t FROM l GROUP BY 1, 2),
ties AS (SELECT variable, sum(t * t * t - t) AS tt FROM tv GROUP BY 1),
h AS (SELECT variable, k, N, f_stat, CASE WHEN k > 1 THEN (12.0 / (N * (N + 1)) * s - 3.0 * (N + 1)) / NULLIF(1 - tt / (N * N * N - N), 0)
             ELSE 0.0 END AS h_stat FROM ft JOIN per USING (variable) JOIN ties USING (variable)),
p AS (SELECT variable, f_stat, h_stat, CASE WHEN k > 1 THEN {f_sf_sql('f_stat', '(k - 1)', '(N - k)')} ELSE 1.0 END AS p_anova,
             CASE WHEN k > 1 THEN {chi2_sf_sql('h_stat', '(k - 1)')} ELSE 1.0 END AS p_kruskal FROM h)
SELECT variable, nb_categories, {r6('f_stat')} AS f_stat, {r6('p_anova')} AS p_anova,
       CASE WHEN p_anova < {K.SIGNIFICANCE} THEN '{K.YES}' ELSE '{K.NO}' END AS sig_anova, {r6('h_stat')} AS h_stat,
       {r6('p_kruskal')} AS p_kruskal, CASE WHEN p_kruskal < {K.SIGNIFICANCE} THEN '{K.YES}' ELSE '{K.NO}' END AS sig_kruskal
FROM gate JOIN p USING (variable)""")
def q_assoc_report(spark, sf_dir):
    """ANOVA + Kruskal-Wallis with p-values and significance for gated categorical columns (H7)."""
    return association.association_report(train_rows(spark, sf_dir), _CATS)


@register("correlation_report")
def q_correlation_report(spark, sf_dir):
    """Pearson, Spearman with two-sided p-values and the Shapiro normal flag per numeric column (H3-H5)."""
    return association.correlation_report(train_rows(spark, sf_dir), PROXY_NUMERIC, row_key=ROW_KEY)


# --------------------------------------------------------- panels ----------
def _split_sql(expr):
    return f"CASE WHEN year({expr}) IN ({TRAIN_SQL}) THEN 'train' WHEN year({expr}) IN ({TEST_SQL}) THEN 'test' END"


@register("retention_rate", sql=f"""
WITH raw AS ({proxy_sales_sql()}),
t AS (SELECT *, {_split_sql('date_mutation')} AS split,
             coalesce(code_departement IN ({DEPTS_SQL}) AND valeur_fonciere > 1000 AND surface_reelle_bati > 9
                      AND surface_reelle_bati < 1000 AND nombre_pieces_principales >= 1
                      AND nombre_pieces_principales <= 15
                      AND valeur_fonciere / NULLIF(surface_reelle_bati, 0) > 500
                      AND valeur_fonciere / NULLIF(surface_reelle_bati, 0) < 20000, false) AS keep FROM raw)
SELECT split, count(*) AS nb_brut, count(*) FILTER (WHERE keep) AS nb_propre,
       {r6('count(*) FILTER (WHERE keep) * 100.0 / count(*)')} AS taux_conservation_pct
FROM t WHERE split IS NOT NULL GROUP BY split""")
def q_retention_rate(spark, sf_dir):
    """Share of raw rows kept by the cleaning filters, per split, in one pass."""
    raw = proxy_sales(spark, sf_dir)
    y = F.year("date_mutation")
    raw = raw.withColumn("split", F.when(y.isin(list(PROXY_TRAIN_YEARS)), "train")
                         .when(y.isin(list(PROXY_TEST_YEARS)), "test")).where(F.col("split").isNotNull())
    return profile.retention_rate(raw, clean.keep_mask(raw, PROXY_DEPARTMENTS))


def split_panel_proxy(spark, sf_dir, extended=False, zone_level="region"):
    """The panel of both periods, landed: a row per zone and month, which gates, series and forecasts read several times."""
    sales = zoned(spark, sf_dir, zone_level) if zone_level == "region" else \
        panel.with_zone(clean_proxy(spark, sf_dir, zone_level, departments=None))
    return panel.split_panel(sales, PROXY_TRAIN_YEARS, PROXY_TEST_YEARS, extended=extended).checkpoint()


def _zone_cte(zone_level="region"):
    return f"""{_clean_cte(zone_level, departments=zone_level == 'region')},
z AS (SELECT 'Dept ' || code_departement AS zone, CAST(date_trunc('month', date_mutation) AS DATE) AS annee_mois, *
      FROM sales WHERE year(date_mutation) IN ({TRAIN_SQL}, {TEST_SQL}))"""


def _panel_cte(zone_level="region"):
    return f"""{_zone_cte(zone_level)},
p AS (SELECT zone, annee_mois, median(prix_m2) AS prix_median_m2, avg(prix_m2) AS prix_moyen_m2,
             stddev_samp(prix_m2) AS prix_std_m2, median(valeur_fonciere) AS valeur_mediane,
             avg(nombre_pieces_principales) AS nb_pieces_moy, avg(surface_reelle_bati) AS surface_moy,
             count(*) AS nb_transactions,
             CASE WHEN year(annee_mois) IN ({TRAIN_SQL}) THEN 'train' ELSE 'test' END AS split
      FROM z GROUP BY zone, annee_mois)"""


@register("monthly_panel_ext", sql=f"""
WITH {_panel_cte()}
SELECT zone, annee_mois, split, {r6('prix_median_m2')} AS prix_median_m2, {r6('prix_moyen_m2')} AS prix_moyen_m2,
       {r6('prix_std_m2')} AS prix_std_m2, {r6('valeur_mediane')} AS valeur_mediane,
       {r6('nb_pieces_moy')} AS nb_pieces_moy, {r6('surface_moy')} AS surface_moy, nb_transactions FROM p""")
def q_monthly_panel_ext(spark, sf_dir):
    """Extended monthly panel (std, mean rooms, mean surface) tagged train/test."""
    return split_panel_proxy(spark, sf_dir, extended=True)


@register("panel_span", sql=f"""
WITH {_panel_cte()}
SELECT split, min(annee_mois) AS mois_min, max(annee_mois) AS mois_max, count(DISTINCT zone) AS nb_zones
FROM p GROUP BY split""")
def q_panel_span(spark, sf_dir):
    """First/last month and distinct zones per split."""
    return panel.panel_span(split_panel_proxy(spark, sf_dir))


@register("series_gate", sql=f"""
WITH {_panel_cte('nation')},
st AS (SELECT split, zone, count(*) AS n, min(prix_median_m2) AS y_min, max(prix_median_m2) AS y_max,
              avg(prix_median_m2) AS y_mean FROM p GROUP BY 1, 2),
tr AS (SELECT * FROM st WHERE split = 'train'), te AS (SELECT * FROM st WHERE split = 'test')
SELECT tr.zone, tr.n AS nb_train, {r6('tr.y_min')} AS train_min, {r6('tr.y_max')} AS train_max,
       {r6('tr.y_mean')} AS train_mean, coalesce(te.n, 0) AS nb_test,
       CASE WHEN tr.n < 24 THEN 'skipped' WHEN coalesce(te.n, 0) = 0 THEN 'skipped' ELSE 'ok' END AS status,
       CASE WHEN tr.n < 24 THEN 'train series shorter than minimum' WHEN coalesce(te.n, 0) = 0 THEN 'no test month' END
       AS reason
FROM tr LEFT JOIN te USING (zone)""")
def q_series_gate(spark, sf_dir):
    """Per-zone eligibility (>= 24 train months, >= 1 test month) with train min/max/mean."""
    return panel.series_gate(split_panel_proxy(spark, sf_dir, zone_level="nation"))


_FEAT_W = "PARTITION BY zone ORDER BY annee_mois"


def _feat_sql(target="prix_median_m2"):
    y = target
    parts = [f"lag({y}, {k}) OVER w AS lag_{k}" for k in (1, 2, 3, 6, 12)]
    for k in (3, 6, 12):
        fr = f"({_FEAT_W} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"CASE WHEN count({y}) OVER {fr} = {k} THEN avg({y}) OVER {fr} END AS ma_{k}")
    for k in (3, 6):
        fr = f"({_FEAT_W} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"CASE WHEN count({y}) OVER {fr} = {k} THEN stddev_samp({y}) OVER {fr} END AS std_{k}")
    parts.append(f"{y} - lag({y}, 1) OVER w AS tendance")
    return ",\n       ".join(parts)


@register("panel_features", sql=f"""
WITH {_panel_cte()},
tr AS (SELECT zone, annee_mois, prix_median_m2 FROM p WHERE split = 'train'),
ft AS (SELECT zone, annee_mois, prix_median_m2, CAST(month(annee_mois) AS INTEGER) AS mois,
             CAST(year(annee_mois) AS INTEGER) AS annee, CAST(row_number() OVER w - 1 AS INTEGER) AS mois_depuis_debut,
             count(*) OVER (PARTITION BY zone) AS n_,
             {_feat_sql()}
      FROM tr WINDOW w AS ({_FEAT_W}))
SELECT zone, annee_mois, {r6('prix_median_m2')} AS prix_median_m2, mois, annee, mois_depuis_debut,
       {', '.join(r6(c) + ' AS ' + c for c in ['lag_1', 'lag_2', 'lag_3', 'lag_6', 'lag_12', 'ma_3', 'ma_6', 'ma_12', 'std_3', 'std_6', 'tendance'])},
       (lag_1 IS NOT NULL OR n_ <= 1) AND (lag_2 IS NOT NULL OR n_ <= 2) AND (lag_3 IS NOT NULL OR n_ <= 3)
       AND (lag_6 IS NOT NULL OR n_ <= 6) AND (lag_12 IS NOT NULL OR n_ <= 12) AND (ma_3 IS NOT NULL OR n_ <= 3)
       AND (ma_6 IS NOT NULL OR n_ <= 6) AND (ma_12 IS NOT NULL OR n_ <= 12) AND (std_3 IS NOT NULL OR n_ <= 3)
       AND (std_6 IS NOT NULL OR n_ <= 6) AND (tendance IS NOT NULL OR n_ <= 1) AS complete
FROM ft""")
def q_panel_features(spark, sf_dir):
    """Lags 1-12, full-window rolling means/stds, trend, calendar features per zone."""
    p = split_panel_proxy(spark, sf_dir).where(F.col("split") == "train")
    return panel.panel_features(p)


@register("chrono_split", sql=f"""
WITH {_panel_cte()},
tr AS (SELECT zone, annee_mois, prix_median_m2 FROM p WHERE split = 'train'),
ft AS (SELECT zone, annee_mois, count(*) OVER (PARTITION BY zone) AS n_,
              lag(prix_median_m2, 12) OVER w AS l12
       FROM tr WINDOW w AS ({_FEAT_W})),
c AS (SELECT zone, annee_mois FROM ft WHERE l12 IS NOT NULL OR n_ <= 12)
SELECT zone, annee_mois,
       row_number() OVER ({_FEAT_W}) > floor(count(*) OVER (PARTITION BY zone) * 0.85) AS is_validation FROM c""")
def q_chrono_split(spark, sf_dir):
    """Chronological 85/15 fit/validation split of each zone's complete feature rows."""
    p = split_panel_proxy(spark, sf_dir).where(F.col("split") == "train")
    feats = panel.panel_features(p).where(F.col("complete"))
    return panel.chrono_split(feats).select("zone", "annee_mois", "is_validation")


@register("fallback_forecast", sql=f"""
WITH {_panel_cte()},
tr AS (SELECT zone, prix_median_m2, row_number() OVER (PARTITION BY zone ORDER BY annee_mois DESC) AS rk
       FROM p WHERE split = 'train'),
m AS (SELECT zone, CASE WHEN count(*) = 6 THEN avg(prix_median_m2) END AS yhat FROM tr WHERE rk <= 6 GROUP BY zone),
te AS (SELECT zone, annee_mois, CAST(row_number() OVER ({_FEAT_W}) AS INTEGER) AS step FROM p WHERE split = 'test')
SELECT te.zone, te.step, te.annee_mois, {r6('m.yhat')} AS yhat FROM te JOIN m USING (zone)""")
def q_fallback_forecast(spark, sf_dir):
    """Trailing-6 mean of each zone's train series repeated over its test months."""
    return panel.fallback_forecast(split_panel_proxy(spark, sf_dir), "prix_median_m2")


# ------------------------------------------------------- evaluation --------
from realty_spark.operators import evaluate  # noqa: E402


def _eval_base(spark, sf_dir):
    p = split_panel_proxy(spark, sf_dir)
    gate = panel.series_gate(p, "prix_median_m2")
    fb = panel.fallback_forecast(p, "prix_median_m2")
    return p, gate, fb


def drift_forecast(p: DataFrame, target: str) -> DataFrame:
    """Drift input for the guard/compare queries: last + step * (last - first) / (n - 1)."""
    tr = p.where(F.col("split") == "train")
    s = tr.groupBy("zone").agg(F.max_by(target, "annee_mois").alias("_last"),
                               F.min_by(target, "annee_mois").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return (panel.test_steps(p).join(s, "zone")
            .select("zone", "step", "annee_mois",
                    (F.col("_last") + F.col("step") * safe_div(F.col("_last") - F.col("_first"), F.col("_n") - 1))
                    .alias("yhat")))


from realty_spark.functions.numeric import safe_div  # noqa: E402

_EVAL_CTE = f"""{_panel_cte()},
tr AS (SELECT zone, annee_mois, prix_median_m2, row_number() OVER (PARTITION BY zone ORDER BY annee_mois DESC) AS rk
       FROM p WHERE split = 'train'),
fbm AS (SELECT zone, CASE WHEN count(*) = 6 THEN avg(prix_median_m2) END AS yhat FROM tr WHERE rk <= 6 GROUP BY zone),
te AS (SELECT zone, annee_mois, prix_median_m2 AS y, row_number() OVER ({_FEAT_W}) AS step FROM p WHERE split = 'test'),
st AS (SELECT zone, min(prix_median_m2) AS train_min, max(prix_median_m2) AS train_max, count(*) AS n,
              arg_max(prix_median_m2, annee_mois) AS last_, arg_min(prix_median_m2, annee_mois) AS first_
       FROM p WHERE split = 'train' GROUP BY zone),
fb AS (SELECT te.zone, te.step, te.y, fbm.yhat FROM te JOIN fbm USING (zone)),
dr AS (SELECT te.zone, te.step, te.y, st.last_ + te.step * (st.last_ - st.first_) / NULLIF(st.n - 1, 0) AS yhat
       FROM te JOIN st USING (zone)),
both_ AS (SELECT 'fallback' AS model, * FROM fb UNION ALL SELECT 'drift' AS model, * FROM dr),
zm AS (SELECT model, zone, count(*) AS n, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
              avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100 AS mape,
              CASE WHEN var_pop(y) * count(y) > 0 THEN 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y))
                   WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END AS r2
       FROM both_ GROUP BY model, zone)"""


def _zone_metrics(spark, sf_dir):
    p, gate, fb = _eval_base(spark, sf_dir)
    al = [evaluate.align_forecast(fb, p, "prix_median_m2").withColumn("model", F.lit("fallback")),
          evaluate.align_forecast(drift_forecast(p, "prix_median_m2"), p, "prix_median_m2")
          .withColumn("model", F.lit("drift"))]
    return evaluate.regression_metrics(al[0].unionByName(al[1]), ["model", "zone"])


@register("forecast_guard", sql=f"""WITH {_EVAL_CTE},
g AS (SELECT dr.zone, dr.step, dr.yhat, fb.yhat AS fb, st.train_min, st.train_max,
             coalesce(NOT isfinite(dr.yhat) OR abs(dr.yhat) > st.train_max * 1.5 OR dr.yhat < st.train_min * 0.5, true)
             AS bad FROM dr JOIN st USING (zone) LEFT JOIN fb USING (zone, step)),
h AS (SELECT *, max(CAST(bad AS INTEGER)) OVER (PARTITION BY zone) = 1 AS fallback FROM g)
SELECT zone, CAST(step AS INTEGER) AS step, {r6('yhat')} AS yhat_brut, fallback,
       CASE WHEN (CASE WHEN fallback THEN fb ELSE yhat END) IS NOT NULL THEN {r6('greatest(train_min * 0.5, least(train_max * 1.5, CASE WHEN fallback THEN fb ELSE yhat END))')} END AS yhat
FROM h""")
def q_forecast_guard(spark, sf_dir):
    """Price sanity guard on a drift forecast: whole-horizon fallback on any bad step, then clip."""
    p, gate, fb = _eval_base(spark, sf_dir)
    return evaluate.forecast_guard(drift_forecast(p, "prix_median_m2"), gate, fb, kind="price")


@register("volume_guard", sql=f"""WITH {_EVAL_CTE},
vs AS (SELECT zone, min(nb_transactions) AS lo, max(nb_transactions) AS hi, count(*) AS n, arg_max(nb_transactions, annee_mois) AS l,
              arg_min(nb_transactions, annee_mois) AS f FROM p WHERE split = 'train' GROUP BY 1),
vr AS (SELECT zone, nb_transactions AS v, row_number() OVER (PARTITION BY zone ORDER BY annee_mois DESC) AS rk FROM p WHERE split = 'train'),
vf AS (SELECT zone, CASE WHEN count(*) = 6 THEN avg(v) END AS fb FROM vr WHERE rk <= 6 GROUP BY 1),
g AS (SELECT te.zone, te.step, 8 * (vs.l + te.step * (vs.l - vs.f) / CAST(NULLIF(vs.n - 1, 0) AS DOUBLE)) * (te.step % 2 - 0.4::DOUBLE) AS yhat, vf.fb, vs.hi
      FROM te JOIN vs USING (zone) LEFT JOIN vf USING (zone) WHERE te.zone <> 'Dept ASIA'
      UNION ALL SELECT te.zone, te.step, vs.l + te.step * (vs.l - vs.f) / CAST(NULLIF(vs.n - 1, 0) AS DOUBLE), vf.fb, vs.hi
      FROM te JOIN vs USING (zone) LEFT JOIN vf USING (zone) WHERE te.zone = 'Dept ASIA'),
h AS (SELECT *, max(CAST(coalesce(NOT isfinite(yhat) OR abs(yhat) > hi * 3.0, true) AS INTEGER)) OVER (PARTITION BY zone) = 1 AS fallback FROM g)
SELECT zone, CAST(step AS INTEGER) AS step, {r6('yhat')} AS yhat_brut, fallback,
       CASE WHEN (CASE WHEN fallback THEN fb ELSE yhat END) IS NOT NULL THEN {r6('greatest(0.0, least(hi * 3.0, CASE WHEN fallback THEN fb ELSE yhat END))')} END AS yhat
FROM h""")
def q_volume_guard(spark, sf_dir):
    """Volume sanity guard on a drift forecast that is made to swing in all zones but one: whole-horizon fallback beyond three times the maximum."""
    target, p = "nb_transactions", split_panel_proxy(spark, sf_dir)
    swing = F.when(F.col("zone") == "Dept ASIA", F.lit(1.0)).otherwise(8 * (F.col("step") % 2 - F.lit(0.4)))
    fc = drift_forecast(p, target).withColumn("yhat", F.col("yhat") * swing)
    return evaluate.forecast_guard(fc, panel.series_gate(p, target), panel.fallback_forecast(p, target), kind="volume")


@register("unguarded_metrics", sql=f"""WITH {_EVAL_CTE},
zz AS (SELECT model, zone, CASE WHEN step = 1 AND zone = 'Dept ASIA' THEN 0.0 ELSE y END AS y, yhat FROM both_)
SELECT model, zone, count(*) AS n, {r6('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, {r6('avg(abs(y - yhat))')} AS mae,
       CASE WHEN count(*) FILTER (WHERE y = 0) > 0 THEN CAST('inf' AS DOUBLE) ELSE {r6('avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100')} END AS mape,
       {r6('CASE WHEN var_pop(y) * count(y) > 0 THEN 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)) WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END')} AS r2
FROM zz GROUP BY 1, 2""")
def q_unguarded_metrics(spark, sf_dir):
    """Zone metrics with the unguarded MAPE, which a zero actual (put into one zone's first month) makes infinite."""
    p, _, fb = _eval_base(spark, sf_dir)
    rows = [evaluate.align_forecast(fc, p, "prix_median_m2").withColumn("model", F.lit(name))
            for name, fc in (("fallback", fb), ("drift", drift_forecast(p, "prix_median_m2")))]
    zero = (F.col("step") == 1) & (F.col("zone") == "Dept ASIA")
    both = rows[0].unionByName(rows[1]).withColumn("y", F.when(zero, F.lit(0.0)).otherwise(F.col("y")))
    return evaluate.regression_metrics(both, ["model", "zone"], mape_zero="propagate")


@register("regression_metrics", sql=f"""WITH {_EVAL_CTE}
SELECT 'fallback' AS model, 'TEST' AS dataset, count(*) AS n, {r6('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse,
       {r6('avg(abs(y - yhat))')} AS mae,
       {r6('CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)) WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END')} AS r2,
       {r6('avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100')} AS mape
FROM fb""")
def q_regression_metrics(spark, sf_dir):
    """Pooled RMSE / MAE / R^2 / zero-guarded MAPE of the fallback forecast on the test months."""
    p, gate, fb = _eval_base(spark, sf_dir)
    m = evaluate.regression_metrics(evaluate.align_forecast(fb, p, "prix_median_m2"))
    return evaluate.comparison_table(m.withColumns({"model": F.lit("fallback"), "dataset": F.lit("test")}))


@register("zone_metrics", sql=f"""WITH {_EVAL_CTE}
SELECT model, zone, n, {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('mape')} AS mape, {r6('r2')} AS r2 FROM zm""")
def q_zone_metrics(spark, sf_dir):
    """Per (model, zone) metrics of the fallback and drift forecasts, by ascending MAPE."""
    return _zone_metrics(spark, sf_dir).orderBy("model", "mape", "zone")


@register("metrics_summary", sql=f"""WITH {_EVAL_CTE},
gate AS (SELECT st.zone, CASE WHEN st.n < 24 THEN 'skipped'
                              WHEN NOT EXISTS (SELECT 1 FROM te WHERE te.zone = st.zone) THEN 'skipped'
                              ELSE 'ok' END AS status FROM st)
SELECT model, {r6('avg(mape)')} AS mape_moyen, {r6('avg(r2)')} AS r2_moyen, {r6('avg(mae)')} AS mae_moyen,
       arg_min(zone, (mape, zone)) AS meilleure_zone, count(*) AS nb_zones_evaluees,
       {r6('median(mape)')} AS mape_mediane,
       (SELECT count(*) FILTER (WHERE status = 'ok') * 1.0 / count(*) FROM gate) AS taux_succes
FROM zm GROUP BY model""")
def q_metrics_summary(spark, sf_dir):
    """Mean/median MAPE, mean R^2 and MAE, best zone and success ratio per model."""
    p, gate, fb = _eval_base(spark, sf_dir)
    zm = _zone_metrics(spark, sf_dir)
    st = gate.select("status")
    statuses = st.withColumn("model", F.lit("fallback")).unionByName(st.withColumn("model", F.lit("drift")))
    return evaluate.metrics_summary(zm, statuses)


@register("segment_errors", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL},
e AS (SELECT quartier_detaille, abs(prix_m2 - prix_median_m2) AS ea,
             abs((prix_m2 - prix_median_m2) / NULLIF(prix_m2, 0)) * 100 AS er FROM imp2
      WHERE quartier_detaille IS NOT NULL),
g AS (SELECT quartier_detaille, round_even(avg(ea), 2) AS MAE, round_even(median(ea), 2) AS Mediane_erreur,
             round_even(stddev_samp(ea), 2) AS Std_erreur, round_even(avg(er), 2) AS MAPE,
             round_even(median(er), 2) AS Mediane_MAPE, count(*) AS Nb_observations FROM e GROUP BY 1)
SELECT * FROM g ORDER BY MAE DESC, quartier_detaille LIMIT 10""")
def q_segment_errors(spark, sf_dir):
    """Error of the district-median predictor per district, worst 10 by MAE."""
    ds = district.impute_median(clean.drop_columns(built(spark, sf_dir), ["annee_trimestre"]))
    e = ds.select("quartier_detaille", F.col("prix_m2").alias("y"), F.col("prix_median_m2").alias("yhat"))
    return evaluate.segment_errors(e, "quartier_detaille", top_n=10)


@register("compare_models", sql=f"""WITH {_EVAL_CTE},
a AS (SELECT zone, mape AS mape_a FROM zm WHERE model = 'fallback'),
b AS (SELECT zone, mape AS mape_b FROM zm WHERE model = 'drift')
SELECT coalesce(a.zone, b.zone) AS zone, {r6('mape_a')} AS mape_a, {r6('mape_b')} AS mape_b,
       {r6('mape_a - mape_b')} AS difference FROM a FULL OUTER JOIN b ON a.zone = b.zone""")
def q_compare_models(spark, sf_dir):
    """Per-zone MAPE of two models side by side with the difference, ascending."""
    return evaluate.compare_models(_zone_metrics(spark, sf_dir), "fallback", "drift")


@register("union_periods", sql=f"""
WITH raw AS ({proxy_sales_sql()}),
u AS (SELECT CAST(year(date_mutation) AS INTEGER) AS annee, p_brand FROM raw WHERE year(date_mutation) <= 1997
      UNION ALL
      SELECT CAST(year(date_mutation) AS INTEGER) AS annee, NULL AS p_brand FROM raw WHERE year(date_mutation) > 1997)
SELECT annee, count(*) AS n, count(*) FILTER (WHERE p_brand IS NULL) AS nb_sans_marque FROM u GROUP BY annee""")
def q_union_periods(spark, sf_dir):
    """Period extracts with a drifting column stacked by name, missing column NULL."""
    from realty_spark.sources.readers import union_periods
    raw = proxy_sales(spark, sf_dir).withColumn("annee", F.year("date_mutation"))
    early = raw.where(F.col("annee") <= 1997)
    late = raw.where(F.col("annee") > 1997).drop("p_brand")
    u = union_periods([early, late])
    return u.groupBy("annee").agg(F.count(F.lit(1)).alias("n"),
                                  F.count_if(F.col("p_brand").isNull()).alias("nb_sans_marque"))


# ---------------------------------------------------------- round trips ----
from realty_spark.session import scratch_path  # noqa: E402
from realty_spark.sources import readers  # noqa: E402

_INGEST = ("date_mutation", "code_departement", "valeur_fonciere", "surface_reelle_bati", "p_brand")


def _extracts(spark, sf_dir, sep: str, names: dict[str, str]) -> str:
    """The proxy sales as text extracts of two periods whose headers differ in order and in one column."""
    raw = proxy_sales(spark, sf_dir).select(*_INGEST)
    path, year = scratch_path(spark, "extracts"), F.year("date_mutation")
    writer = {"header": True, "sep": sep}
    raw.where(year <= 1995).withColumnsRenamed(names).write.options(**writer).csv(f"{path}/early")
    (raw.where(year > 1995).select(*_INGEST[:1], *_INGEST[3:0:-1]).withColumnsRenamed(names)
     .write.options(**writer).csv(f"{path}/late"))
    return path


_INGEST_SQL = f"""
WITH raw AS ({proxy_sales_sql()})
SELECT CAST(year(date_mutation) AS INTEGER) AS annee, count(*) AS n, {r6('sum(valeur_fonciere)')} AS valeur,
       {r6('sum(surface_reelle_bati)')} AS surface, count(*) FILTER (WHERE year(date_mutation) <= 1995) AS avec_marque
FROM raw GROUP BY 1"""


def _ingest_summary(df):
    return df.groupBy(F.year("date_mutation").alias("annee")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("valeur_fonciere").alias("valeur"), F.sum("surface_reelle_bati").alias("surface"),
        F.count("p_brand").alias("avec_marque"))


@register("ingest_geo_csv", sql=_INGEST_SQL)
def q_ingest_geo_csv(spark, sf_dir):
    """Comma extracts with drifting headers written, read back by column name, typed and summed."""
    path = _extracts(spark, sf_dir, ",", {})
    text = readers.read_geo_csv(spark, [f"{path}/early", f"{path}/late"], _INGEST)
    typed = B.parse_numbers(text, ["valeur_fonciere", "surface_reelle_bati"])
    return _ingest_summary(typed.withColumn("date_mutation", parse_date("date_mutation", "yyyy-MM-dd")))


@register("ingest_raw_txt", sql=_INGEST_SQL)
def q_ingest_raw_txt(spark, sf_dir):
    """Pipe extracts with raw headers written, read back by column name, renamed, typed and summed."""
    raw_names = {v: k for k, v in readers.RAW_TO_CANONICAL.items()}
    path = _extracts(spark, sf_dir, "|", raw_names)
    text = readers.read_raw_txt(spark, [f"{path}/early", f"{path}/late"], columns=[raw_names.get(c, c) for c in _INGEST])
    return _ingest_summary(B.parse_numbers(readers.canonical_raw(text, "yyyy-MM-dd"), ["valeur_fonciere", "surface_reelle_bati"]))


@register("dataset_round_trip", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT annee, quartier_detaille, count(*) AS n, {r6('sum(prix_m2)')} AS prix, {r6('sum(prix_median_m2)')} AS mediane
FROM ds GROUP BY 1, 2""")
def q_dataset_round_trip(spark, sf_dir):
    """The built dataset written by year and read back."""
    path = scratch_path(spark, "dataset")
    B.write_dataset(built(spark, sf_dir), path)
    return readers.read_dataset(spark, path).groupBy(F.col("annee").cast("int").alias("annee"), "quartier_detaille").agg(
        F.count(F.lit(1)).alias("n"), F.sum("prix_m2").alias("prix"), F.sum("prix_median_m2").alias("mediane"))


@register("split_round_trip", sql=f"""
WITH {_clean_cte()}, {_LABELS_SQL}
SELECT split, annee, count(*) AS n, {r6('sum(prix_m2)')} AS prix FROM tr WHERE split IS NOT NULL GROUP BY 1, 2""")
def q_split_round_trip(spark, sf_dir):
    """Cleaned rows written with their split, one folder per split, and read back."""
    path = scratch_path(spark, "splits")
    readers.write_splits(typed_rows(spark, sf_dir), path)
    return readers.read_dataset(spark, path).groupBy("split", "annee").agg(F.count(F.lit(1)).alias("n"), F.sum("prix_m2").alias("prix"))


@register("schema_null_profile", sql=f"""{_TRAIN_SQL}
""" + "\nUNION ALL\n".join(f"SELECT '{kind}' AS nature, '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS nb_null FROM t"
                            for kind, cs in (("numeriques", ("valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales", "l_discount", "l_tax",
                                                             "p_retailprice", "l_orderkey", "l_linenumber", "annee", "prix_m2")),
                                             ("dates", ("date_mutation", "annee_date"))) for c in cs))
def q_schema_null_profile(spark, sf_dir):
    """Null counts of the columns that the schema classifies as numbers and dates (P10, A5)."""
    rows = train_rows(spark, sf_dir)
    kinds = clean.classify_columns(rows)
    nature = {c: kind for kind in ("numeriques", "dates") for c in kinds[kind]}
    counts = profile.null_profile(rows, list(nature))
    return counts.withColumn("nature", F.element_at(F.create_map(*[F.lit(x) for c, k in nature.items() for x in (c, k)]), F.col("variable")))


@register("metrics_round_trip", sql=f"""WITH {_EVAL_CTE},
a AS (SELECT zone, rmse AS rmse_a FROM zm WHERE model = 'fallback'),
b AS (SELECT zone, rmse AS rmse_b FROM zm WHERE model = 'drift')
SELECT coalesce(a.zone, b.zone) AS zone, {r6('rmse_a')} AS rmse_a, {r6('rmse_b')} AS rmse_b,
       {r6('rmse_a - rmse_b')} AS difference FROM a FULL OUTER JOIN b ON a.zone = b.zone""")
def q_metrics_round_trip(spark, sf_dir):
    """Metrics of two models written one after the other, read back one by one and compared."""
    path, zm = scratch_path(spark, "metrics"), _zone_metrics(spark, sf_dir).checkpoint()
    for model in ("fallback", "drift"):
        readers.write_metrics(zm.where(F.col("model") == model), path)
    both = readers.read_metrics(spark, path, "fallback").unionByName(readers.read_metrics(spark, path, "drift"))
    return evaluate.compare_models(both, "fallback", "drift", "rmse")


# ------------------------------------------------------- chart data --------
from realty_spark.operators import chartdata, intervals  # noqa: E402

_NUM_LONG = f"""{_TRAIN_SQL}, long AS ({_long_sql(PROXY_NUMERIC)}),
l AS (SELECT * FROM long WHERE value IS NOT NULL AND NOT isnan(value))"""


@register("histogram", sql=f"""{_NUM_LONG},
r AS (SELECT variable, min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM l GROUP BY 1),
b AS (SELECT l.variable, CASE WHEN w > 0 THEN least(floor((value - lo) / w), 49) ELSE 0 END AS bin, lo, w
      FROM l JOIN r USING (variable))
SELECT variable, CAST(bin AS INTEGER) AS bin, {r6('lo + bin * w')} AS "left", {r6('lo + (bin + 1) * w')} AS "right",
       count(*) AS count FROM b GROUP BY variable, bin, lo, w""")
def q_histogram(spark, sf_dir):
    """50-bin histograms of every numeric column, last bin closed (V1, V9)."""
    return chartdata.histogram(train_rows(spark, sf_dir), PROXY_NUMERIC)


@register("boxplot", sql=f"""{_NUM_LONG},
qq AS (SELECT variable, quantile_cont(value, 0.25) AS q1, median(value) AS mediane, quantile_cont(value, 0.75) AS q3
      FROM l GROUP BY 1),
j AS (SELECT l.*, qq.q1, qq.mediane, qq.q3, value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside
      FROM l JOIN qq USING (variable))
SELECT variable, {r6('any_value(q1)')} AS q1, {r6('any_value(mediane)')} AS mediane, {r6('any_value(q3)')} AS q3,
       {r6('min(value) FILTER (WHERE inside)')} AS moustache_basse,
       {r6('max(value) FILTER (WHERE inside)')} AS moustache_haute,
       count(*) FILTER (WHERE NOT inside) AS nb_aberrants, count(*) AS n FROM j GROUP BY variable""")
def q_boxplot(spark, sf_dir):
    """Box-plot data (quartiles, whiskers, outlier counts) of every numeric column (V2)."""
    return chartdata.boxplot_columns(train_rows(spark, sf_dir), PROXY_NUMERIC)


@register("boxplot_by_category", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(PROXY_CATEGORICAL, 'VARCHAR', keep='prix_m2')}),
l AS (SELECT variable, value AS level, prix_m2 FROM long WHERE value IS NOT NULL AND prix_m2 IS NOT NULL),
qq AS (SELECT variable, level, quantile_cont(prix_m2, 0.25) AS q1, median(prix_m2) AS mediane,
             quantile_cont(prix_m2, 0.75) AS q3 FROM l GROUP BY 1, 2),
j AS (SELECT l.*, q1, mediane, q3, prix_m2 >= q1 - 1.5 * (q3 - q1) AND prix_m2 <= q3 + 1.5 * (q3 - q1) AS inside
      FROM l JOIN qq USING (variable, level))
SELECT variable, level, {r6('any_value(q1)')} AS q1, {r6('any_value(mediane)')} AS mediane, {r6('any_value(q3)')} AS q3,
       {r6('min(prix_m2) FILTER (WHERE inside)')} AS moustache_basse,
       {r6('max(prix_m2) FILTER (WHERE inside)')} AS moustache_haute,
       count(*) FILTER (WHERE NOT inside) AS nb_aberrants, count(*) AS n FROM j GROUP BY variable, level""")
def q_boxplot_by_category(spark, sf_dir):
    """Box-plot data of price per level of each categorical column (V2)."""
    return chartdata.boxplot_by_category(train_rows(spark, sf_dir), PROXY_CATEGORICAL)


@register("scatter_bins", sql=f"""{_TRAIN_SQL}, long AS ({_long_sql(PROXY_NUMERIC, keep='prix_m2')}),
l AS (SELECT variable, value AS x, prix_m2 AS y FROM long WHERE value IS NOT NULL AND NOT isnan(value)
      AND prix_m2 IS NOT NULL),
r AS (SELECT variable, min(x) AS lx, (max(x) - min(x)) / 50 AS wx, min(y) AS ly, (max(y) - min(y)) / 50 AS wy
      FROM l GROUP BY 1)
SELECT variable,
       CAST(CASE WHEN wx > 0 THEN least(floor((x - lx) / wx), 49) ELSE 0 END AS INTEGER) AS bin_x,
       CAST(CASE WHEN wy > 0 THEN least(floor((y - ly) / wy), 49) ELSE 0 END AS INTEGER) AS bin_y,
       count(*) AS count FROM l JOIN r USING (variable) GROUP BY 1, 2, 3""")
def q_scatter_bins(spark, sf_dir):
    """2-D binned counts of each numeric column against price (V3)."""
    return chartdata.scatter_bins(train_rows(spark, sf_dir), PROXY_NUMERIC)


@register("top_levels_chart", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(_CATS, 'VARCHAR')}),
c AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value ASC) AS rang FROM c),
t20 AS (SELECT * FROM r WHERE rang <= 20)
SELECT variable, value, n, CAST(rang AS INTEGER) AS rang,
       {r6("CASE WHEN rang <= 10 THEN n * 100.0 / sum(CASE WHEN rang <= 10 THEN n END) OVER (PARTITION BY variable) END")}
       AS part_camembert_pct FROM t20""")
def q_top_levels_chart(spark, sf_dir):
    """Top-20 bar and top-10 pie data (share of the top-10 total) per categorical column (V4)."""
    return chartdata.top_levels_chart(profile.level_counts(train_rows(spark, sf_dir), _CATS))


@register("mean_bar", sql=f"""{_TRAIN_SQL},
long AS ({_long_sql(_CATS, 'VARCHAR', keep='prix_m2')}),
s AS (SELECT variable, value AS level, round_even(avg(prix_m2), 2) AS mean FROM long WHERE value IS NOT NULL
      GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY level) AS ordre FROM s)
SELECT variable, CAST(ordre AS INTEGER) AS ordre, level, mean FROM o WHERE ordre <= 20""")
def q_mean_bar(spark, sf_dir):
    """Mean price of the first 20 levels of each categorical column (V5)."""
    return chartdata.mean_bar(profile.target_by_category(train_rows(spark, sf_dir), _CATS))


@register("corr_chart", sql=f"""{_NUM_L},
c AS (SELECT variable,
             CASE WHEN var_pop(x) * var_pop(y) > 0 THEN covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y)) END AS pearson
      FROM l GROUP BY 1)
SELECT variable, {r6('pearson')} AS pearson,
       CAST(row_number() OVER (ORDER BY abs(pearson) DESC NULLS LAST, variable) AS INTEGER) AS ordre FROM c""")
def q_corr_chart(spark, sf_dir):
    """Pearson bar-chart data ordered by |r| (V6)."""
    return chartdata.corr_chart(association.pearson(train_rows(spark, sf_dir), PROXY_NUMERIC, with_p=False))


_RESIDUALS = f"""
WITH {_clean_cte()}, {_LABELS_SQL},
e AS (SELECT prix_m2 AS reel, prix_median_m2 AS prevu, prix_m2 - prix_median_m2 AS residu FROM imp2
      WHERE prix_m2 IS NOT NULL AND prix_median_m2 IS NOT NULL)"""


def _residuals(spark, sf_dir):
    ds = district.impute_median(clean.drop_columns(built(spark, sf_dir), ["annee_trimestre"]))
    return ds.select(F.col("prix_m2").alias("reel"), F.col("prix_median_m2").alias("prevu"),
                     (F.col("prix_m2") - F.col("prix_median_m2")).alias("residu")).where("residu IS NOT NULL")


@register("residual_histogram", sql=f"""{_RESIDUALS},
r AS (SELECT min(residu) AS lo, (max(residu) - min(residu)) / 50 AS w FROM e),
b AS (SELECT CASE WHEN w > 0 THEN least(floor((residu - lo) / w), 49) ELSE 0 END AS bin, lo, w FROM e, r)
SELECT 'residu' AS variable, CAST(bin AS INTEGER) AS bin, {r6('any_value(lo) + bin * any_value(w)')} AS "left",
       {r6('any_value(lo) + (bin + 1) * any_value(w)')} AS "right", count(*) AS count FROM b GROUP BY bin""")
def q_residual_histogram(spark, sf_dir):
    """50-bin histogram of the residuals of the district-median predictor (V3, V1)."""
    return chartdata.histogram(_residuals(spark, sf_dir), ["residu"])


def _grid_sql(name: str, x: str, y: str, same_range: bool = False) -> str:
    ends = f"least(min({x}), min({y})) AS lx, greatest(max({x}), max({y})) AS hx, least(min({x}), min({y})) AS ly, greatest(max({x}), max({y})) AS hy" \
        if same_range else f"min({x}) AS lx, max({x}) AS hx, min({y}) AS ly, max({y}) AS hy"
    return f"""{_RESIDUALS},
r AS (SELECT {ends} FROM e),
b AS (SELECT CASE WHEN hx > lx THEN least(floor(({x} - lx) / ((hx - lx) / 50)), 49) ELSE 0 END AS bx,
             CASE WHEN hy > ly THEN least(floor(({y} - ly) / ((hy - ly) / 50)), 49) ELSE 0 END AS byy FROM e, r)
SELECT '{name}' AS graphique, CAST(bx AS INTEGER) AS bin_x, CAST(byy AS INTEGER) AS bin_y, count(*) AS count FROM b GROUP BY 2, 3"""


@register("predicted_vs_actual", sql=_grid_sql("predit_reel", "reel", "prevu", same_range=True))
def q_predicted_vs_actual(spark, sf_dir):
    """Counts of predicted against actual price on one range for both axes, the square around y = x (V3)."""
    return chartdata.prediction_grids(_residuals(spark, sf_dir), "reel", "prevu").where("graphique = 'predit_reel'")


@register("residual_vs_predicted", sql=_grid_sql("residu_predit", "prevu", "residu"))
def q_residual_vs_predicted(spark, sf_dir):
    """Counts of residual against predicted price (V3)."""
    return chartdata.prediction_grids(_residuals(spark, sf_dir), "reel", "prevu").where("graphique = 'residu_predit'")


def _norm_ppf_sql(p: str) -> str:
    """Wichura's rational functions in SQL, for probabilities that are not in the far tails."""
    def ratio(part, r):
        above, below = NORMAL_QUANTILE[part]
        poly = lambda cs: " + ".join(f"{c!r}::DOUBLE * pow({r}, {k})" for k, c in enumerate(cs))
        return f"(({poly(above)}) / ({poly(below)}))"
    q, r = f"({p} - 0.5)", f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio('middle', f'(0.180625 - {q} * {q})')} ELSE sign({q}) * {ratio('tail', r)} END"


@register("qq_points", sql=f"""{_RESIDUALS},
pr AS (SELECT (i + 0.5::DOUBLE) / 200 AS prob, i FROM range(0, 200) r(i)),
sq AS (SELECT quantile_cont(residu, list_transform(range(0, 200), lambda i: (i + 0.5::DOUBLE) / 200)) AS v FROM e),
qp AS (SELECT pr.prob, sq.v[i + 1] AS sample_q, {_norm_ppf_sql('pr.prob')} AS theoretical_q FROM pr, sq)
SELECT {r6('prob')} AS prob, {r6('sample_q')} AS sample_q, {r6('theoretical_q')} AS theoretical_q,
       {r6('(SELECT regr_slope(sample_q, theoretical_q) FROM qp)')} AS pente, {r6('(SELECT regr_intercept(sample_q, theoretical_q) FROM qp)')} AS ordonnee FROM qp""")
def q_qq_points(spark, sf_dir):
    """Normal Q-Q data of the district-median predictor residuals on a 200-point grid (V7)."""
    ds = district.impute_median(clean.drop_columns(built(spark, sf_dir), ["annee_trimestre"]))
    res = ds.select((F.col("prix_m2") - F.col("prix_median_m2")).alias("residu"))
    return chartdata.qq_points(res, "residu")


_INTERVAL_SQL = f"""okz AS (SELECT st.zone, st.n FROM st WHERE st.n >= {K.MIN_TRAIN_MONTHS} AND EXISTS (SELECT 1 FROM te WHERE te.zone = st.zone)),
hz AS (SELECT max(step) AS h FROM te),
cu AS (SELECT zone, n, unnest(range(1, h + {intervals.FOLDS})) AS cut, h FROM okz, hz),
es AS (SELECT zone, n, cut, unnest(range(1, least(cut, h) + 1)) AS step FROM cu WHERE n - cut >= {K.MIN_TRAIN_MONTHS}),
ey AS (SELECT es.*, tr.prix_median_m2 AS y FROM es JOIN tr ON tr.zone = es.zone AND tr.rk = es.cut - es.step + 1),
bm AS (SELECT cu.zone, cu.cut, avg(tr.prix_median_m2) AS m FROM cu JOIN tr ON tr.zone = cu.zone AND tr.rk BETWEEN cu.cut + 1 AND cu.cut + 6 GROUP BY 1, 2),
er AS (SELECT 'fallback' AS model, ey.zone, ey.cut, ey.step, abs(ey.y - bm.m) AS e FROM ey JOIN bm USING (zone, cut)
       UNION ALL SELECT 'drift', ey.zone, ey.cut, ey.step,
              abs(ey.y - (l.prix_median_m2 + ey.step * (l.prix_median_m2 - st.first_) / NULLIF(ey.n - ey.cut - 1, 0)))
       FROM ey JOIN tr l ON l.zone = ey.zone AND l.rk = ey.cut + 1 JOIN st ON st.zone = ey.zone),
ek AS (SELECT *, row_number() OVER (PARTITION BY model, zone, step ORDER BY cut) AS k FROM er WHERE e IS NOT NULL),
hw AS (SELECT model, zone, step, count(*) AS nb_essais, list(e ORDER BY e)[CAST(ceil((count(*) + 1) * CAST({intervals.WIDTH} AS DOUBLE)) AS BIGINT)] AS demi
       FROM ek WHERE k <= {intervals.FOLDS} GROUP BY 1, 2, 3),
tm AS (SELECT zone, annee_mois, row_number() OVER ({_FEAT_W}) AS step FROM p WHERE split = 'test'),
fi AS (SELECT b.model, b.zone, b.step, tm.annee_mois, b.yhat, b.yhat - demi AS lo, b.yhat + demi AS hi, coalesce(nb_essais, 0) AS nb_essais
       FROM both_ b JOIN tm ON tm.zone = b.zone AND tm.step = b.step LEFT JOIN hw ON hw.model = b.model AND hw.zone = b.zone AND hw.step = b.step)"""


def _two_models(spark, sf_dir):
    """Panel, forecasts of the fallback and drift models with intervals, and their test metrics."""
    target = "prix_median_m2"
    p = split_panel_proxy(spark, sf_dir)  # a row per zone and month, read by every model and origin
    models = {"fallback": panel.fallback_forecast, "drift": drift_forecast}
    made, scores = [], []
    for name, model in models.items():
        fc = model(p, target).withColumn("model", F.lit(name))
        made.append(fc.select("model", "zone", "step", "annee_mois", "yhat"))
        scores.append(evaluate.align_forecast(fc, p, target).withColumn("model", F.lit(name)))
    tested = intervals.back_test_panel(p, target, intervals.horizon_of(p))
    widths = intervals.half_widths(intervals.per_zone_back_tests(tested, models, target))
    metrics = evaluate.regression_metrics(scores[0].unionByName(scores[1]), ["model", "zone"])
    return p, intervals.with_intervals(made[0].unionByName(made[1]), widths), metrics


@register("forecast_intervals", sql=f"""WITH {_EVAL_CTE}, {_INTERVAL_SQL}
SELECT model, zone, CAST(step AS INTEGER) AS step, annee_mois, {r6('yhat')} AS yhat, {r6('lo')} AS lo, {r6('hi')} AS hi,
       CAST(nb_essais AS INTEGER) AS nb_essais FROM fi""")
def q_forecast_intervals(spark, sf_dir):
    """Fallback and drift forecasts with 80 % intervals from rolling-origin back-tests (V8, M9)."""
    return _two_models(spark, sf_dir)[1]


@register("forecast_overview", sql=f"""WITH {_EVAL_CTE}, {_INTERVAL_SQL},
bz AS (SELECT model, arg_min(zone, (mape, zone)) AS zone FROM zm WHERE mape IS NOT NULL GROUP BY 1)
SELECT NULL AS model, zone, annee_mois, CASE WHEN split = 'train' THEN 'historique' ELSE 'reel' END AS kind, {r6('prix_median_m2')} AS value,
       CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, CAST(NULL AS BOOLEAN) AS meilleure_zone FROM p
UNION ALL SELECT fi.model, fi.zone, annee_mois, 'prevision', {r6('yhat')}, {r6('lo')}, {r6('hi')}, bz.zone IS NOT NULL
FROM fi LEFT JOIN bz ON bz.model = fi.model AND bz.zone = fi.zone""")
def q_forecast_overview(spark, sf_dir):
    """Per-zone history, actual and forecasts of the simple models with intervals and the best zone, for the overview figure (V8)."""
    p, forecasts, metrics = _two_models(spark, sf_dir)
    return chartdata.forecast_overview(p, forecasts, intervals.best_zones(metrics), "prix_median_m2")


@register("forecast_overview_models")
def q_forecast_overview_models(spark, sf_dir):
    """The overview with the seasonal ARIMA, seasonal-trend and boosted-tree forecasts, each with back-tested intervals (V8, M9)."""
    target = "prix_median_m2"
    p = split_panel_proxy(spark, sf_dir, extended=True)
    tested = intervals.back_test_panel(p, target, intervals.horizon_of(p)).checkpoint()
    made = {"sarima": (forecast.sarima_forecast(p, target), intervals.sarima_back_test(tested, target)),
            "tendance_saison": (forecast.seasonal_trend_forecast(p, target), forecast.seasonal_trend_forecast(tested, target)),
            "arbres": (forecast.gbt_forecast(p, target)[0], intervals.trees_back_test(tested, target))}
    rows, errors, scores = [], [], []
    for name, (fc, back) in made.items():
        fc = fc.where("step IS NOT NULL").select("zone", "step", "annee_mois", "yhat").checkpoint()
        rows.append(fc.withColumn("model", F.lit(name)))
        errors.append(intervals.back_test_errors(back, tested, target).withColumn("model", F.lit(name)))
        scores.append(evaluate.align_forecast(fc, p, target).withColumn("model", F.lit(name)))
    forecasts = intervals.with_intervals(readers.union_periods(rows), intervals.half_widths(readers.union_periods(errors)))
    metrics = evaluate.regression_metrics(readers.union_periods(scores), ["model", "zone"])
    return chartdata.forecast_overview(p, forecasts, intervals.best_zones(metrics), target)


# ---------------------------------------------------------- models ---------



@register("sarima_grid")
def q_sarima_grid(spark, sf_dir):
    """AIC of the 144 seasonal ARIMA candidates of every eligible zone, best per zone flagged (M2)."""
    return forecast.flag_best(forecast.sarima_grid(split_panel_proxy(spark, sf_dir), "nb_transactions"))


_LAST = forecast._last_lag()


@register("lag_products", sql=f"""WITH {_panel_cte()},
st AS (SELECT zone, count(*) FILTER (WHERE split = 'train') AS n, count(*) FILTER (WHERE split = 'test') AS nt,
              floor(avg(nb_transactions) FILTER (WHERE split = 'train')) AS shift FROM p GROUP BY 1),
yy AS (SELECT zone, annee_mois, n, shift, CAST(nb_transactions AS DOUBLE) AS y, lag(nb_transactions, 1) OVER o AS y1,
             lag(nb_transactions, 12) OVER o AS y12, lag(nb_transactions, 13) OVER o AS y13
      FROM p JOIN st USING (zone) WHERE split = 'train' AND n >= {K.MIN_TRAIN_MONTHS} AND nt > 0 WINDOW o AS (PARTITION BY zone ORDER BY annee_mois)),
w AS (SELECT zone, annee_mois, n, 0 AS d, 0 AS sd, y - shift AS w FROM yy UNION ALL SELECT zone, annee_mois, n, 1, 0, y - y1 FROM yy
      UNION ALL SELECT zone, annee_mois, n, 0, 1, y - y12 FROM yy UNION ALL SELECT zone, annee_mois, n, 1, 1, y - y1 - y12 + y13 FROM yy),
r AS (SELECT *, count(*) OVER (PARTITION BY zone, d, sd) AS n_w, row_number() OVER (PARTITION BY zone, d, sd ORDER BY annee_mois) - 1 AS t
      FROM w WHERE w IS NOT NULL),
m AS (SELECT *, least(14, n_w // 3) AS m, CASE WHEN n - 13 - least(14, (n - 13) // 3) - 14 >= 12 THEN n - 13 - least(14, (n - 13) // 3) - 14
             WHEN n >= 12 THEN 12 ELSE 0 END AS scored FROM r),
x AS (SELECT m.zone, m.d, m.sd, m.n, m.n_w, m.m, m.scored, m.t, k.k AS lag, CASE WHEN k.k = {_LAST + 1} THEN 1.0 ELSE b.w END AS v
      FROM m CROSS JOIN range(0, {_LAST + 2}) k(k) LEFT JOIN m b ON b.zone = m.zone AND b.d = m.d AND b.sd = m.sd AND b.t = m.t - k.k AND k.k <= {_LAST}),
qq AS (SELECT a.zone, a.d, a.sd, a.n, a.n_w, a.m, a.scored, a.t, a.lag AS i, c.lag AS j, a.v * c.v AS p
      FROM x a JOIN x c ON c.zone = a.zone AND c.d = a.d AND c.sd = a.sd AND c.t = a.t AND a.lag <= c.lag)
SELECT zone, d, sd, n, n_w, CAST(m AS INTEGER) AS m, CAST(scored AS INTEGER) AS scored, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       CASE WHEN count(*) FILTER (WHERE t >= m AND p IS NULL) = 0 THEN sum(p) FILTER (WHERE t >= m) END AS long_sum,
       CASE WHEN count(*) FILTER (WHERE t >= n_w - scored AND p IS NULL) = 0 THEN sum(p) FILTER (WHERE t >= n_w - scored) END AS scored_sum
FROM qq GROUP BY ALL""")
def q_lag_products(spark, sf_dir):
    """Sums of lag products of every zone's differenced volume series: the design shared by the 144 orders (M2)."""
    return forecast.lag_products(split_panel_proxy(spark, sf_dir), "nb_transactions")


@register("sarima_forecast")
def q_sarima_forecast(spark, sf_dir):
    """Seasonal ARIMA volume forecast per zone with the volume guard and per-zone failure isolation."""
    return forecast.sarima_forecast(split_panel_proxy(spark, sf_dir), "nb_transactions", kind="volume")


@register("sarima_price_forecast")
def q_sarima_price_forecast(spark, sf_dir):
    """Seasonal ARIMA median-price forecast per zone with the price guard."""
    return forecast.sarima_forecast(split_panel_proxy(spark, sf_dir), "prix_median_m2", kind="price")


@register("seasonal_trend_forecast")
def q_seasonal_trend_forecast(spark, sf_dir):
    """Multiplicative trend + yearly seasonality + regressors per zone, 80 % interval."""
    return forecast.seasonal_trend_forecast(split_panel_proxy(spark, sf_dir, extended=True))


@register("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    """Pooled boosted-tree price model with a recursive forecast of every test month (M5, M6)."""
    fc, _ = forecast.gbt_forecast(split_panel_proxy(spark, sf_dir), "prix_median_m2")
    return fc


@register("gbt_importance")
def q_gbt_importance(spark, sf_dir):
    """Top-5 feature importances of the pooled boosted-tree price model."""
    _, imp = forecast.gbt_forecast(split_panel_proxy(spark, sf_dir), "prix_median_m2")
    return forecast.top_importances(imp, 5)


@register("model_scores")
def q_model_scores(spark, sf_dir):
    """Test-month metrics of every model and zone, with the unguarded MAPE, train / test months and the fitted form."""
    target = "prix_median_m2"
    p = split_panel_proxy(spark, sf_dir, extended=True)
    gate = panel.series_gate(p, target)
    sarima = forecast.sarima_forecast(p, target, kind="price").checkpoint()
    trees = forecast.gbt_forecast(p, target)[0].checkpoint()
    made = {"fallback": (panel.fallback_forecast(p, target), F.lit("moyenne des 6 derniers mois")),
            "sarima": (sarima, F.col("ordre")),
            "tendance_saison": (forecast.seasonal_trend_forecast(p, target), F.lit("tendance et saison")),
            "arbres": (trees, F.concat(F.col("nb_arbres").cast("string"), F.lit(" arbres, "), F.lit(len(forecast.GBT_FEATURES)),
                                       F.lit(" variables")))}
    scores = []
    for model, (fc, form) in made.items():
        shape = fc.where("step IS NOT NULL").groupBy("zone").agg(F.max(form).alias("forme"))
        aligned = evaluate.align_forecast(fc.where("step IS NOT NULL"), p, target)
        guarded = evaluate.regression_metrics(aligned, ["zone"])
        plain = evaluate.regression_metrics(aligned, ["zone"], mape_zero="propagate").select("zone", F.col("mape").alias("mape_brute"))
        scores.append(guarded.join(plain, "zone").join(shape, "zone", "left").withColumn("model", F.lit(model)))
    out = readers.union_periods(scores).join(gate.select("zone", "nb_train", "nb_test"), "zone", "left")
    return out.orderBy("model", "mape", "zone")
