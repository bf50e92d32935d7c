"""Tuning of forests and boosted trees against fits by ``pyspark.ml``, one by one."""

import json

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from cargolith.catalog import learn
from cargolith.plans import models as m
from cargolith.plans import tuning

SMALL = {
    "random_forest": {"numTrees": [20, 40], "maxDepth": [2, 4], "minInstancesPerNode": [1, 9]},
    "gradient_boost": {"maxIter": [3, 6], "stepSize": [0.1, 0.3], "maxDepth": [2, 4]},
}


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, (900, 3)).astype(float)
    y = 2.0 * (x[:, 0] > 7) + x[:, 1] * 0.3 - (x[:, 2] > 12) * x[:, 0] * 0.2 + rng.normal(0, 0.3, 900)
    df = spark.createDataFrame([(i, i % 3, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, fold int, a double, b double, c double, y double")
    return m.design(df, "abc", "y", ["id", "fold"]).persist()


def one_by_one(folded, make):
    measure = RegressionEvaluator(metricName="mse")
    errors = [measure.evaluate(make().fit(folded.filter(F.col("fold") != k)).transform(folded.filter(F.col("fold") == k))) for k in range(3)]
    return np.mean(errors), np.std(errors)


def test_all_candidates_of_all_learners_are_tuned(folded, monkeypatch):
    monkeypatch.setattr(m, "REGRESSION_GRIDS", SMALL)
    found = {(r.model, r.params): r for r in m.tuned_regressors(folded, "fold").collect()}
    assert len(found) == 17 + 8 + 8
    for p in m.param_grid(SMALL["gradient_boost"]):
        r = found["gradient_boost", json.dumps(p)]
        assert (r.cv_mean, r.cv_std) == pytest.approx(one_by_one(folded, lambda p=p: GBTRegressor(seed=1, **p)), rel=5e-3)
    for p in m.param_grid(SMALL["random_forest"])[::3]:
        r = found["random_forest", json.dumps(p)]
        assert r.cv_mean == pytest.approx(one_by_one(folded, lambda p=p: RandomForestRegressor(seed=1, **p))[0], rel=0.25)
    monkeypatch.setattr(tuning, "ROWS", 0)
    few = {"random_forest": {"numTrees": [40], "maxDepth": [4], "minInstancesPerNode": [1]}, "gradient_boost": {"maxIter": [6], "stepSize": [0.3], "maxDepth": [2]}}
    monkeypatch.setattr(m, "REGRESSION_GRIDS", few)
    rows = {r.model: r for r in m.tuned_regressors(folded, "fold").collect() if r.model in few}
    p = m.param_grid(few["gradient_boost"])[0]
    assert rows["gradient_boost"].cv_mean == pytest.approx(found["gradient_boost", json.dumps(p)].cv_mean, rel=5e-3) and len(rows) == 2


def test_the_query_tunes_forests_and_boosted_trees(spark, folded, monkeypatch):
    monkeypatch.setattr(learn, "_folded", lambda s, d: folded)
    monkeypatch.setattr(m, "REGRESSION_GRIDS", SMALL)
    got = {r.model: r[1] for r in learn._tuned(spark, "").groupBy("model").count().collect()}
    assert got == {"ridge": 4, "lasso": 4, "elastic_net": 9, "random_forest": 8, "gradient_boost": 8}


def test_a_shallow_tree_is_the_upper_part_of_a_deep_one():
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 32, (400, 5)).astype(np.uint8), rng.normal(size=400)
    y += bins[:, 0] * 0.2
    starts = np.arange(400) * 5
    bag = rng.integers(0, 3, 300).astype(float)

    def grow(depths, least=1.0):
        return tuning._tree(bins.ravel(), 5, 5, y[:300], bag, starts[:300], starts[300:], least, depths, np.random.default_rng(2))

    two, deep = grow([2, 30])
    assert np.array_equal(two, grow([2])[0]) and len(set(two)) == 4 and len(set(deep)) > 50
    # By brute force: the value of a held-out row is the mean of the bagged rows in its quarter.
    first = min(((f, c) for f in range(5) for c in range(31)), key=lambda s: sum(
        (bag[part] * (y[:300][part] - np.average(y[:300][part], weights=bag[part])) ** 2).sum() if bag[part].sum() else 1e9
        for part in (bins[:300, s[0]] <= s[1], bins[:300, s[0]] > s[1])))
    one = grow([1])[0]
    side = bins[:, first[0]] <= first[1]
    want = [np.average(y[:300][s[:300]], weights=bag[s[:300]]) for s in (side, ~side)]
    assert np.allclose(one, np.where(side[300:], *want))
    assert len(set(grow([30], 60.0)[0])) <= 5
