"""Forests and boosted trees from histograms against ``pyspark.ml`` and brute force."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from cargolith.plans import models as m
from cargolith.plans import trees
from cargolith.session import scratch_path


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (600, 3)).astype(float)
    y = 2.0 * (x[:, 0] > 7) + x[:, 1] * 0.3 - (x[:, 2] > 12) * x[:, 0] * 0.2 + rng.normal(0, 0.1, 600)
    df = spark.createDataFrame([(i, *map(float, r), float(t), int(t > 2.5)) for i, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, y double, flag int")
    return m.design(df, "abc", "y", ["id"]).persist(), m.class_weights(m.design(df, "abc", "flag", ["id"])).persist()


def test_boosting_is_that_of_pyspark(data):
    """Features with few values have the same bins there, hence the trees are the same."""
    for frame, e in ((data[0], GBTRegressor(maxIter=13, maxDepth=3, seed=1)), (data[1], GBTClassifier(maxIter=13, maxDepth=3, seed=1))):
        got, want = trees.fit_trees(frame, {"x": e})["x"], e.fit(frame)
        column = "prediction" if isinstance(e, GBTRegressor) else "probability"
        a, b = ([r[0] for r in x.transform(frame).orderBy("id").select(column).collect()] for x in (got, want))
        assert np.allclose(np.array([getattr(v, "values", v) for v in a]), np.array([getattr(v, "values", v) for v in b]), atol=1e-6)
        assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-6)


def test_forest_is_as_good(data):
    own = trees.fit_trees(data[0], {"x": RandomForestRegressor(numTrees=60, seed=1)})["x"]
    other = RandomForestRegressor(numTrees=60, seed=1).fit(data[0])
    a, b = (m.evaluator("regression").evaluate(x.transform(data[0])) for x in (own, other))
    assert a == pytest.approx(b, rel=0.1)
    assert np.allclose(own.featureImportances.toArray(), other.featureImportances.toArray(), atol=0.05)
    own = trees.fit_trees(data[1], {"x": RandomForestClassifier(numTrees=60, seed=1, weightCol="weight")})["x"]
    out = own.transform(data[1])
    assert out.filter("label = prediction").count() > 570 and own.transform(data[1]).schema["probability"].dataType == RandomForestClassifier(seed=1).fit(data[1]).transform(data[1]).schema["probability"].dataType


def test_the_first_split_is_the_best_one(data):
    rows = np.array([[*r.features, r.label] for r in data[0].collect()])
    model = trees.fit_trees(data[0], {"x": GBTRegressor(maxIter=1, maxDepth=1)})["x"]
    errors = {(i, c): sum(((p - p.mean()) ** 2).sum() for p in (rows[rows[:, i] <= c, 3], rows[rows[:, i] > c, 3])) for i in range(3) for c in range(19)}
    i, b = model.trees[0]["split"][0]
    assert (i, b) == min(errors, key=errors.get) and model.cuts[i][b] == b + 0.5


def test_queries_fit_trees_in_few_scans(spark, data, monkeypatch):
    """No fit of the recipes goes through the passes of ``pyspark.ml``, whose number grows with the trees."""
    for kind in (GBTRegressor, RandomForestRegressor, GBTClassifier, RandomForestClassifier):
        monkeypatch.setattr(kind, "fit", lambda *a, **k: pytest.fail("fitted by pyspark.ml"))
    m.fit_all(data[0], {n: m.regressors(**m.FEW_TREES)[n] for n in ("random_forest", "gradient_boost")})
    fitted = m.fit_all(data[1], {n: m.classifiers(**m.FEW_TREES)[n] for n in ("random_forest", "gradient_boost")})
    path = f"{scratch_path(spark, 'models')}/flag/forest"
    m.save(fitted["random_forest"], path, {"features": ["a"]})
    again, held = m.load(spark, path)
    both = m.scored_columns({"x": fitted["random_forest"], "y": again}, data[1])
    assert held == {"features": ["a"]} and both.filter(~F.col("pred_x").eqNullSafe(F.col("pred_y"))).count() == 0


def test_boosting_of_many_classes_is_that_of_pyspark(data):
    """One class against the rest, as OneVsRest fits it, without a fit by ``pyspark.ml``."""
    four = data[0].withColumn("label", F.when(F.col("label") < 0.5, 0.0).when(F.col("label") < 2, 1.0).when(F.col("label") < 4, 2.0).otherwise(3.0))
    e = GBTClassifier(maxIter=11, maxDepth=3, seed=1)
    want = m.multiclass(e, 4).fit(four).transform(four).orderBy("id").select("prediction").collect()
    model = m.fit_each(four, {"x": lambda: e}, 4)["x"]
    assert isinstance(model, trees.TreeModel) and m.importances(model, "abc") == []
    again = trees.TreeModel.from_json(model.to_json())
    for x in (model, again):
        got = x.transform(four).orderBy("id").select("prediction").collect()
        assert got == want


def test_rows_reach_the_nodes_of_their_splits():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 32, (5, 500)).astype(np.uint8)
    split = {0: (1, 12), 1: (0, 3), 2: (4, 20), 4: (2, 9), 6: (3, 30), 14: (1, 25), 30: (0, 1)}
    want = []
    for row in bins.T:
        at = 0
        while at in split:
            at = 2 * at + 1 + int(row[split[at][0]] > split[at][1])
        want.append(at)
    assert trees._places(bins, split).tolist() == want


def test_plans_of_late_rounds_are_no_longer_than_those_of_early_ones(data, monkeypatch):
    """Frames kept of frames kept doubled the text of each plan every ten rounds: gigabytes in the driver and the event log."""
    lengths = []
    kind = type(data[0])
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: (lengths.append(len(df._jdf.queryExecution().toString())), collect(df))[1])
    trees.fit_trees(data[0], {"x": GBTRegressor(maxIter=45, maxDepth=1)})
    assert max(lengths[-5:]) < 3 * max(lengths[12:17])


def test_numbers_are_packed_without_loss():
    from cargolith.plans.packed import _packed, _unpacked

    rng = np.random.default_rng(1)
    cases = [[], [1.0, 0.0, 255.0], [-3.0, 700.0], [1e6, -5.0], [0.5, 0.25], rng.choice([0.1, 1 / 3, 7.7], 5000), rng.normal(size=300), [np.nan, 1.0], [np.inf, 0.1], [1e300, 2.0**53]]
    sizes = []
    for c in cases:
        held = _packed(np.array(c, dtype=float))
        sizes.append(len(held))
        assert np.array_equal(_unpacked(held), np.array(c, dtype=float), equal_nan=True)
    assert sizes[1] == 5 and sizes[5] < 5100
