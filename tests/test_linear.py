"""Linear learners from sums against solutions on the rows themselves."""

import json

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from cargolith.plans import linear
from cargolith.plans import models as m


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 4)) * [1, 50, 0.01, 1] + [0, 1000, 3, 0]
    x[:, 3] = 7.0  # no spread
    y = x @ [2, 0.05, -30, 1] + rng.normal(scale=0.5, size=400)
    rows = spark.createDataFrame([(*map(float, r), float(t), i % 5) for i, (r, t) in enumerate(zip(x, y))], "a double, b double, c double, d double, label double, fold int")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(rows).select("features", "label", "fold").persist(), x, y


def scaled(x):
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    return (x - q2) / np.where(q3 == q1, 1, q3 - q1)


@pytest.mark.parametrize("alpha", [0.1, 100.0])
def test_ridge(data, alpha):
    frame, x, y = data
    z = np.column_stack((scaled(x), np.ones(len(x))))
    want = z @ np.linalg.solve(z.T @ z + alpha * np.diag([1, 1, 1, 1, 0]), z.T @ y)
    got = [r.prediction for r in linear.MomentRegression("ridge", alpha=alpha).fit(frame).transform(frame).collect()]
    assert np.allclose(got, want, atol=1e-6)


@pytest.mark.parametrize("kind,parameters", [("lasso", {"alpha": 0.1}), ("lasso", {"alpha": 100.0}), ("elastic_net", {"alpha": 0.1, "l1_ratio": 0.5})])
def test_optimality(data, kind, parameters):
    """At the optimum the gradient of the error lies in the subgradient of the penalty."""
    frame, x, y = data
    z = scaled(x)
    scale = linear.robust_scale(frame, 4)
    b, w = linear.solve(kind, linear.moments(frame, scale)[0], **parameters)
    r = parameters.get("l1_ratio", 1.0)
    pull = z.T @ (y - b - z @ w) / len(y) - parameters["alpha"] * (1 - r) * w
    limit = parameters["alpha"] * r
    assert np.allclose(pull[w != 0], limit * np.sign(w[w != 0]), atol=1e-7) and (np.abs(pull[w == 0]) <= limit + 1e-7).all()
    assert abs((y - b - z @ w).mean()) < 1e-7


def test_errors_of_held_out_folds(data):
    """Errors from sums are those of refitting on the other folds and scoring the rows."""
    frame, x, y = data
    best, table = linear.tuned(frame, "fold")
    z, fold = np.column_stack((scaled(x), np.ones(len(x)))), np.arange(len(x)) % 5
    rows = {(r.model, r.params): r for r in table.collect()}
    assert len(rows) == 4 + 4 + 9 and set(best) == set(linear.GRIDS)
    for alpha in linear.GRIDS["ridge"]["alpha"]:
        errors = []
        for k in range(5):
            a, t = z[fold != k], y[fold != k]
            w = np.linalg.solve(a.T @ a + alpha * np.diag([1, 1, 1, 1, 0]), a.T @ t)
            errors.append(((y[fold == k] - z[fold == k] @ w) ** 2).mean())
        got = rows["ridge", json.dumps({"alpha": alpha})]
        assert np.isclose(got.cv_mean, np.mean(errors)) and np.isclose(got.cv_std, np.std(errors))


def test_model_can_be_saved(spark, data, tmp_path):
    frame, _, _ = data
    model = linear.MomentRegression("ridge").fit(frame)
    model.save(str(tmp_path / "m"))
    again = linear.LinearRegressionModel.load(str(tmp_path / "m"))
    assert np.allclose(again.coefficients.toArray(), model.coefficients.toArray()) and again.intercept == model.intercept


def test_shared_fits_and_expanding_folds(data):
    """Learners fitted together are those fitted alone; errors of later folds are those of the rows."""
    frame, x, y = data
    learners = {"ridge": linear.MomentRegression("ridge"), "lasso": linear.MomentRegression("lasso", alpha=0.1)}
    for name, model in linear.fit_together(frame, learners).items():
        assert np.allclose(model.coefficients.toArray(), learners[name].fit(frame).coefficients.toArray())
    z, fold = np.column_stack((scaled(x), np.ones(len(x)))), np.arange(len(x)) % 5
    for name, k, rmse in linear.expanding_errors(frame, "fold", {"ridge": learners["ridge"]}):
        a, t = z[fold < k], y[fold < k]
        w = np.linalg.solve(a.T @ a + np.diag([1, 1, 1, 1, 0]), a.T @ t)
        assert name == "ridge" and np.isclose(rmse, np.sqrt(((y[fold == k] - z[fold == k] @ w) ** 2).mean()))


def test_errors_are_plain_numbers(spark, data):
    """Rows for Spark are made of them."""
    rows = linear.expanding_errors(data[0], "fold", {"ridge": linear.MomentRegression("ridge")})
    assert all(type(e) is float for *_, e in rows) and spark.createDataFrame(rows, "m string, k int, e double").count() == 4


def test_quartiles_of_blocks_are_exact(spark):
    """The scaler comes from a few scans of blocks, not from a row per feature and value."""
    rng = np.random.default_rng(4)
    x = np.column_stack((rng.normal(size=501) * 1e-3, rng.integers(-3, 4, 501), np.exp(rng.normal(size=501) * 9), np.full(501, -2.5), rng.choice([0.0, -1e300, 5e-324], 501)))
    df = spark.createDataFrame([(i % 2, *map(float, r), 1.0) for i, r in enumerate(x)], "fold int, a double, b double, c double, d double, e double, y double")
    data = m.design(df.repartition(5), "abcde", "y", ["fold"])
    with linear.held_blocks(data) as held:
        assert np.allclose(linear.quartiles(held, 5), np.quantile(x, [0.25, 0.5, 0.75], axis=0).T, rtol=1e-14, atol=0)
    scale, parts = linear.scaled_moments(data, "fold")
    assert sorted(parts) == [0, 1] and parts[0].n == 251 and scale.width[3] == 1.0
    with linear.held_blocks(data.limit(0)) as held:
        assert linear.quartiles(held, 5) is None
