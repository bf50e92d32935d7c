"""Logistic models by shared scans against ``pyspark.ml`` and one fit per fold."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cargolith.plans import logistic
from cargolith.plans import models as m


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack((rng.normal(1995, 2, 900), rng.normal(0, 30, 900), rng.integers(0, 4, 900), np.full(900, 7.0)))
    pull = 0.6 * (x[:, 0] - 1995) - 0.02 * x[:, 1] + rng.logistic(0, 1, 900)
    kinds = (pull > -1).astype(int) + (pull > 0.5) + (pull > 2)
    df = spark.createDataFrame([(i, *map(float, r), int(a), int(b)) for i, (r, a, b) in enumerate(zip(x, pull > 0.8, kinds))], "id int, a double, b double, c double, d double, flag int, kind int")
    return [m.class_weights(m.design(df, "abcd", y, ["id"])).withColumn("fold", m.fold_of("id", 3)).persist() for y in ("flag", "kind")]


@pytest.mark.parametrize("at", [0, 1])
@pytest.mark.parametrize("penalty, share", [(0.01, 0.0), (0.02, 1.0), (0.05, 0.5), (1e-5, 0.0)])
def test_minimum_is_that_of_pyspark(data, at, penalty, share):
    e = LogisticRegression(regParam=penalty, elasticNetParam=share, maxIter=2000, tol=1e-13, weightCol="weight")
    got, want = logistic.fit_logistic(data[at], {"x": e})["x"], e.fit(data[at])
    assert got.numClasses == want.numClasses and got.coefficientMatrix.toArray().shape == want.coefficientMatrix.toArray().shape
    a, b = (np.array([r.probability.toArray() for r in x.transform(data[at]).orderBy("id").collect()]) for x in (got, want))
    assert np.allclose(a, b, atol=2e-5)
    assert [r[0] for r in got.transform(data[at]).orderBy("id").select("prediction").collect()] == (a.argmax(axis=1) if at else (a[:, 1] > 0.5)).astype(float).tolist()
    if at and share == 1.0:
        return  # Adding a number to a feature's coefficients of all classes may leave the sum of their sizes as it is.
    # The last feature is the same in all rows: its coefficient cannot be told from the intercept.
    assert np.allclose(got.coefficientMatrix.toArray()[:, :3], want.coefficientMatrix.toArray()[:, :3], atol=1e-4)
    assert np.allclose(got.coefficientMatrix.toArray()[:, 3], 0)


def test_tuning_takes_few_scans_and_scores_every_fold(data, monkeypatch):
    wanted = m.tune(data[0], m.CLASSIFIERS["logistic"](), m.CLASSIFICATION_GRIDS["logistic"], "classification", "fold")[1].collect()
    monkeypatch.setattr(LogisticRegression, "fit", lambda *a, **k: pytest.fail("fitted by pyspark.ml"))
    scans, inner = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda *a: scans.append(1) or inner(*a))
    model, table = m.tune_classifier(data[0].drop("weight"), "logistic", "fold")
    got = table.collect()
    assert [r.params for r in got] == [r.params for r in wanted] and len(got) == 6 and len(scans) < 40
    assert np.allclose([(r.cv_mean, r.cv_std) for r in got], [(r.cv_mean, r.cv_std) for r in wanted], atol=0.004)
    assert model.transform(data[0]).filter("label = prediction").count() > 600


def test_one_class_is_left_to_pyspark(data):
    ones = data[0].filter("label = 1").withColumn("weight", F.lit(1.0))
    assert logistic.fit_logistic(ones, {"x": m.CLASSIFIERS["logistic"]()})["x"].transform(ones).filter("prediction = 1").count() == ones.count()


def test_blocks_are_small_and_hold_all_rows(spark):
    """Rows of megabytes ended executors: heap for some at once, and again for each copy."""
    from cargolith.plans.packed import blocks

    df = spark.range(60_000).selectExpr("id", *[f"id % {k + 2} as c{k}" for k in range(12)], "rand(1) as r", "id % 2 as y", "if(id % 2 = 0, 0.7, 1.9) as weight", "id % 5 as fold")
    data = m.design(df.coalesce(1), [*(f"c{k}" for k in range(12)), "r"], "y", ["weight", "fold"])
    rows = blocks(data, "weight", "fold").collect()
    assert max(len(r.x) + len(r.y) + len(r.w) + len(r.k) for r in rows) < 500_000 and len(rows) > 3
    got = sum(len(r.y) - 2 for r in rows)
    assert got == 60_000 and sum(len(r.x) for r in rows) < 60_000 * 40


def test_models_of_all_folds_come_from_shared_scans(data):
    e = LogisticRegression(regParam=0.01, weightCol="weight")
    both = logistic.fit_outside(data[0], {"x": e}, "fold", [0, -1])
    for k, part in ((0, data[0].filter("fold <> 0")), (-1, data[0])):
        want = logistic.fit_logistic(part, {"x": e})["x"]
        assert np.allclose(both[k]["x"].coefficients.toArray(), want.coefficients.toArray(), atol=1e-6)
        assert abs(both[k]["x"].intercept - want.intercept) < 1e-6
