"""Physical-plan checks: filter pushdown and column pruning reach the Parquet scan."""

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_quality_filters_pushed_to_lineitem_scan(spark):
    from realty_spark.plans.catalog import clean_proxy
    plan = _plan(clean_proxy(spark, SF_SMALL).select("prix_m2"))
    assert "GreaterThan(l_extendedprice,1000.0)" in plan
    assert "GreaterThan(l_quantity,9.0)" in plan and "LessThan(l_quantity,1000.0)" in plan
    # pruning: lineitem columns never used by the query are not read
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "l_quantity" in line]
    assert schemas and "l_shipdate" not in schemas[0] and "l_suppkey" not in schemas[0]


def test_landed_sales_are_scanned_and_shuffled_once(spark):
    """Medians, first medians and join-back read the landed sales alone and shuffle none of them."""
    from realty_spark.operators import clean, district
    from realty_spark.plans.catalog import built
    out = district.impute_median(clean.drop_columns(built(spark, SF_SMALL), ["annee_trimestre"]))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "lineitem" not in plan and "sales_" in plan
    assert "Exchange hashpartitioning" not in plan and "RoundRobin" not in plan
