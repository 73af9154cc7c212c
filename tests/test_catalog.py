"""Oracle pairs at sf0.001 (the driver's gate runs the same comparison at sf0.01) and the entry smoke."""

import duckdb
import pytest

import __spark_entry__ as E
from realty_spark.plans import catalog
from tests.conftest import SF_SMALL

PAIRS = sorted(catalog.ORACLE)
TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"zone", "annee_mois", "prix_median_m2", "prix_moyen_m2", "nb_transactions",
                               "valeur_mediane"}


def test_reports_leave_out_unused_medians(spark):
    """The association queries read no district median, so their plans hold no checkpointed median job."""
    from realty_spark.plans.catalog import train_rows
    plan = train_rows(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "prix_median_m2" not in plan and "LogicalRDD" not in plan


def test_every_query_has_docstring():
    for name, fn in E.queries().items():
        assert fn.__doc__, name


@pytest.mark.parametrize("name", PAIRS)
def test_oracle_pair(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _norm(tuple(r[c] for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    oc = [d[0] for d in res.description]
    assert sorted(oc) == cols
    exp = _norm(tuple(r[oc.index(c)] for c in cols) for r in res.fetchall())
    assert got == exp
