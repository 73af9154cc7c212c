"""Skew-proof exact quantiles and average ranks against pandas on a skewed fixture."""

import numpy as np
import pandas as pd
import pytest

from realty_spark.operators.quantiles import group_quantiles, value_ranks


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    # one hot group holding most rows, ties, small groups, a NaN and a NULL
    g = ["hot"] * 3000 + ["a"] * 7 + ["b"] * 1 + ["c"] * 40
    v = np.concatenate([rng.integers(0, 200, 3000).astype(float), rng.normal(size=7), [5.0],
                        np.round(rng.normal(size=40), 1)])
    pdf = pd.DataFrame({"g": g, "v": v})
    pdf.loc[3, "v"] = np.nan
    rows = [(a, None if i == 5 else (float(b) if not np.isnan(b) else float("nan")))
            for i, (a, b) in enumerate(zip(pdf.g, pdf.v))]
    df = spark.createDataFrame(rows, "g string, v double")
    clean = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    return df, clean


@pytest.mark.parametrize(("accuracy", "small"), [(10_000, 10_000), (1000, 1000), (20, 20)])
def test_group_quantiles_match_pandas(spark, skewed, accuracy, small):
    df, pdf = skewed
    out = group_quantiles(df, ["g"], {"q1": ("v", 0.25), "med": ("v", 0.5), "q9": ("v", 0.9)},
                          accuracy, small).toPandas().set_index("g").sort_index()
    exp = pdf.groupby("g")["v"].quantile([0.25, 0.5, 0.9]).unstack().sort_index()
    np.testing.assert_allclose(out["q1"], exp[0.25], rtol=1e-12)
    np.testing.assert_allclose(out["med"], exp[0.5], rtol=1e-12)
    np.testing.assert_allclose(out["q9"], exp[0.9], rtol=1e-12)


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_value_ranks_match_pandas_average_rank(spark, skewed, parts):
    df, pdf = skewed
    out = value_ranks(df, ["g"], "v", partitions=parts).toPandas()
    pdf = pdf.assign(r=pdf.groupby("g")["v"].rank(method="average"))
    exp = pdf.drop_duplicates(["g", "v"]).set_index(["g", "v"])["r"]
    got = out.set_index(["g", "v"])["_rank"]
    pd.testing.assert_series_equal(got.sort_index(), exp.sort_index(), check_names=False)


def test_ties_example(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 2.0), ("x", 4.0)], "g string, v double")
    got = sorted((r.v, r._rank) for r in value_ranks(df, ["g"], "v").collect())
    assert got == [(1.0, 1.0), (2.0, 2.5), (4.0, 4.0)]


def test_hot_group_of_equal_values_is_split_and_exact(spark):
    # 2000 identical values in one group are one cell of the counting pass and one ranked value
    rows = [("hot", 3.0)] * 2000 + [("hot", 1.0), ("hot", 9.0), ("cold", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    q = {r.g: r for r in group_quantiles(df, ["g"], {"med": ("v", 0.5), "q0": ("v", 0.0)}, 200, 200).collect()}
    assert q["hot"].med == 3.0 and q["hot"].q0 == 1.0 and q["cold"].med == 2.0
    r = {(x.g, x.v): (x._rank, x._t) for x in value_ranks(df, ["g"], "v", partitions=8).collect()}
    assert r[("hot", 1.0)] == (1.0, 1) and r[("hot", 3.0)] == (1001.5, 2000) and r[("hot", 9.0)] == (2002.0, 1)


def test_group_stats_moments(spark):
    from realty_spark.operators.quantiles import group_stats
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)], "g string, v double")
    out = {r.g: r for r in group_stats(df, ["g"], {"med": ("v", 0.5)},
                                        {"n": ("v", "count"), "m": ("v", "avg"), "s": ("v", "stddev_samp")}).collect()}
    assert (out["a"].med, out["a"].n, out["a"].m) == (2.0, 2, 2.0) and out["b"].s is None


@pytest.mark.parametrize("shape", ["continuous", "few", "heavy"])
def test_large_groups_are_exact_through_their_brackets(spark, shape):
    rng = np.random.default_rng(3)
    n = 30_000
    v = {"continuous": rng.normal(size=n), "few": rng.integers(0, 4, n).astype(float), "heavy": np.round(rng.pareto(0.7, n), 2)}[shape]
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"g": rng.integers(0, 2, n), "v": v})).repartition(7)
    got = group_quantiles(df, ["g"], {f"q{i}": ("v", p) for i, p in enumerate(probs)}, accuracy=500, small=500).toPandas().set_index("g")
    exp = df.toPandas().groupby("g")["v"].quantile(probs).unstack()
    for i, p in enumerate(probs):
        np.testing.assert_allclose(got[f"q{i}"].sort_index(), exp[p].sort_index(), rtol=1e-12)


def test_quantiles_are_lazy_and_leave_few_cells(spark):
    from realty_spark.operators import quantiles
    df = spark.range(200_000).selectExpr("CAST(id % 3 = 0 AS INT) AS g", "CAST(hash(id) AS DOUBLE) AS v")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = group_quantiles(df, ["g"], {"med": ("v", 0.5)}, accuracy=1000, small=1000)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan  # no checkpoint
    long = quantiles._long_values(df, ["g"], ["v"])
    cells = quantiles._cells(long, ["g", "_var"], quantiles._bracketed(long, ["g", "_var"], [0.5], 1000, 1000))
    assert cells.count() < 0.02 * 200_000


def test_hot_group_of_the_counting_pass_can_be_split(spark):
    """Both sides of the join with the brackets come from plain shuffles, which AQE splits where one is skewed."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v")
        plan = group_quantiles(df, ["g"], {"med": ("v", 0.5)})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    assert "Sort" in lines[at + 1] and "Exchange" in lines[at + 2] and plan.count("_key") >= 2


def test_unused_quantiles_are_not_computed(spark):
    from realty_spark.operators.quantiles import group_stats
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, v double")
    out = group_stats(df, ["g"], {}, {"n": ("v", "count")})
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_group_stats_without_keys_and_of_empty_tables(spark):
    from realty_spark.operators.quantiles import group_stats
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    r = group_stats(df, [], {"med": ("v", 0.5)}, {"n": ("v", "count")}).first()
    assert (r.med, r.n) == (50.0, 101)
    empty = spark.createDataFrame([], "g string, v double")
    assert group_stats(empty, ["g"], {"med": ("v", 0.5)}, {"n": ("v", "count")}).count() == 0
    assert value_ranks(empty, ["g"], "v").count() == 0


@pytest.mark.parametrize("n_probs", [15, 16, 17, 33, 200])
def test_many_quantiles_of_ties_and_small_groups(spark, n_probs):
    """Every quantile is exact wherever a search's blocks begin; no list of all targets is built for a cell."""
    from realty_spark.operators.quantiles import quantile_rows
    rng = np.random.default_rng(n_probs)
    groups = {"tied": np.floor(rng.exponential(size=3000) * 4), "apart": rng.normal(size=2000), "few": np.array([2.0, 1.0, 1.0]), "one": np.array([7.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double").repartition(3)
    probs = [(i + 0.5) / n_probs for i in range(n_probs)]
    probs = [0.0, *probs[1:-1], 1.0]
    for accuracy, small in ((1000, 10), (10_000, 10_000)):
        rows = quantile_rows(df, ["g"], ["v"], probs, accuracy, small)
        assert "flatten" not in rows._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.g, r.q): r._at for r in rows.collect()}
        assert len(got) == len(groups) * n_probs
        for g, vs in groups.items():
            np.testing.assert_allclose([got[g, i] for i in range(n_probs)], np.quantile(vs, probs), rtol=1e-12, atol=1e-12)
