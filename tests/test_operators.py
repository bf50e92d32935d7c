"""Ranks, quantiles and versions against brute force, with hot values and keys."""

import datetime as dtm

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from cargolith.functions import dates as dt
from cargolith.operators import keyed, scd
from cargolith.operators.ranking import average_ranks, percent_rank_columns, quantile_rows, quantiles, row_numbers, running_sums

col = F.col


def skewed(n=6000, seed=3):
    """One value and one key hold more than a third of the rows."""
    rng = np.random.default_rng(seed)
    x = np.where(rng.random(n) < 0.4, 5.0, rng.normal(0, 10, n).round(2))
    key = np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abcde"), n))
    return pd.DataFrame({"id": range(n), "k": key, "x": x})


@pytest.fixture(scope="module")
def pdf():
    return skewed()


@pytest.fixture(scope="module")
def sdf(spark, pdf):
    return spark.createDataFrame(pdf).repartition(7)


@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_row_numbers_for_any_partitioning(spark, pdf, sdf, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = row_numbers(sdf, ["x", "id"], "rn").select("id", "rn").toPandas().sort_values("id")["rn"].tolist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = pdf.sort_values(["x", "id"]).assign(rn=range(1, len(pdf) + 1)).sort_values("id")["rn"].tolist()
    assert got == want


def test_running_sums_per_key(pdf, sdf):
    counts = sdf.groupBy("k", "x").agg(F.count("*").alias("c"))
    got = running_sums(counts, ["x"], ["c"], ["k"]).toPandas().sort_values(["k", "x"]).reset_index(drop=True)
    want = pdf.groupby(["k", "x"]).size().reset_index(name="c").sort_values(["k", "x"])
    assert got["cum_c"].tolist() == want.groupby("k")["c"].cumsum().tolist()
    assert got["total_c"].tolist() == want.groupby("k")["c"].transform("sum").tolist()


def test_average_and_percent_ranks(pdf, sdf):
    ranks = average_ranks(sdf, "x").toPandas().set_index("x")["avg_rank"]
    want = pdf["x"].rank()
    assert np.allclose(ranks.loc[pdf["x"]].to_numpy(), want.to_numpy())
    pct = percent_rank_columns(sdf, {"x": "p"}).toPandas().sort_values("id")["p"]
    assert np.allclose(pct, pdf["x"].rank(pct=True))


@pytest.mark.parametrize("accuracy_hit", [False, True])
def test_quantiles_are_exact(spark, pdf, sdf, accuracy_hit):
    # 40,000 rows go through the bracketed pass, 6,000 are kept whole.
    frame = pdf if not accuracy_hit else skewed(40000, 9)
    data = sdf if not accuracy_hit else spark.createDataFrame(frame)
    probs = {"a": 0.0, "b": 0.13, "c": 0.5, "d": 0.87, "e": 1.0}
    row = quantiles(data, "x", probs).first().asDict()
    assert np.allclose([row[n] for n in probs], frame["x"].quantile(list(probs.values())))
    by_key = quantiles(data, "x", probs, ["k"]).toPandas().set_index("k").sort_index()
    want = frame.groupby("k")["x"].quantile(list(probs.values())).unstack()
    assert np.allclose(by_key[list(probs)].to_numpy(), want.to_numpy())
    grid = [i / 20 for i in range(1, 20)]
    rows = quantile_rows(data, "x", grid).toPandas().sort_values("probability")["quantile"]
    assert np.allclose(rows, frame["x"].quantile(grid))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(hs.lists(hs.integers(-3, 3), min_size=1, max_size=40))
def test_quantiles_of_short_columns(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    row = quantiles(df, "x", {"q1": 0.25, "q2": 0.5}).first()
    assert np.allclose([row.q1, row.q2], pd.Series(xs, dtype=float).quantile([0.25, 0.5]))


def test_first_per_key_and_duplicates(pdf, sdf):
    got = keyed.first_per_key(sdf, ["k"], [col("x").desc(), col("id")]).toPandas().sort_values("k")
    want = pdf.sort_values(["x", "id"], ascending=[False, True]).drop_duplicates("k").sort_values("k")
    assert got["id"].tolist() == want["id"].tolist()
    twice = keyed.duplicate_members(sdf, ["x"]).count()
    assert twice == pdf.duplicated("x", keep=False).sum()


def test_surrogate_keys_continue(spark):
    old = spark.createDataFrame([("b", 1), ("d", 2)], "n string, k long")
    new = spark.createDataFrame([(x,) for x in "abcd"], "n string")
    got = {r.n: r.k for r in scd.assign_keys(new, "n", "k", old).collect()}
    assert got["b"] == 1 and got["d"] == 2 and sorted([got["a"], got["c"]]) == [3, 4]


D = dtm.datetime


def history(spark):
    rows = [
        ("same", "x", D(2020, 1, 1), D(2099, 12, 31), True), ("changed", "x", D(2020, 1, 1), D(2099, 12, 31), True),
        ("gone", "x", D(2020, 1, 1), D(2099, 12, 31), True), ("filled", None, D(2020, 1, 1), D(2099, 12, 31), True),
        ("changed", "w", D(2010, 1, 1), D(2020, 1, 1), False), ("none", None, D(2020, 1, 1), D(2099, 12, 31), True),
    ]
    return spark.createDataFrame(rows, "id string, a string, EffectiveDate timestamp_ntz, ExpiryDate timestamp_ntz, IsCurrent boolean")


def snapshot(spark):
    rows = [(k, v, D(2024, 1, 1)) for k, v in (("same", "x"), ("changed", "y"), ("new", "z"), ("filled", "f"), ("none", None))]
    return spark.createDataFrame(rows, "id string, a string, EffectiveDate timestamp_ntz")


def test_version_merge(spark):
    as_of = dt.instant("2024-02-02")
    out = scd.merge_versions(history(spark), snapshot(spark), "id", ["a"], as_of)
    rows = {(r.id, r.a, r.IsCurrent): r for r in out.collect()}
    assert len(rows) == 9
    assert rows[("changed", "x", False)].ExpiryDate == D(2024, 2, 2)
    assert rows[("changed", "w", False)].ExpiryDate == D(2020, 1, 1)
    assert rows[("filled", None, False)] and rows[("filled", "f", True)]
    assert ("none", None, True) in rows and ("gone", "x", True) in rows and ("new", "z", True) in rows
    current = out.filter("IsCurrent").groupBy("id").count().filter("count > 1").count()
    assert current == 0


def test_version_merge_is_idempotent(spark):
    once = scd.merge_versions(history(spark), snapshot(spark), "id", ["a"], dt.instant("2024-02-02"))
    again = scd.merge_versions(once, snapshot(spark), "id", ["a"], dt.instant("2024-03-03"))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def test_quantiles_of_columns_do_not_deal_rows_by_column(spark, monkeypatch):
    """The rows of a column, a third of all or more, must not meet in one task."""
    from cargolith.operators import ranking
    from cargolith.plans import features

    plans, real = [], ranking.running_sums
    monkeypatch.setattr(ranking, "running_sums", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, *a, **k))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(50).selectExpr("id * 1.0 as a", "-id * 2.0 as b")
        got = features.scaling_marks(df, ["a", "b"]).collect()
        features.winsorise(df, ["a"]).collect(), features.impute(df, ["a"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {(r.column, r.Q1, r.Median, r.Q3) for r in got} == {("a", 12.25, 24.5, 36.75), ("b", -73.5, -49.0, -24.5)}
    assert len(plans) == 3 and all("SortMergeJoin" not in p and "percentile_approx" not in p for p in plans)


def test_quantiles_of_odd_values(spark):
    values = [-1e300, -5.0, -1e-310, 0.0, -0.0, 1e-310, 2.0, 2.0, 2.0000000001, 7e12, float("inf"), None]
    row = quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", {"p0": 0.0, "p1": 0.1, "p5": 0.5, "p9": 0.9}).first()
    assert tuple(row) == (-1e300, -5.0, 1e-310, 7e12)
