"""Models and scoring against brute force on small frames."""

import datetime as dtm

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cargolith.plans import models as m
from cargolith.plans import scoring as sc
from cargolith.plans import segments as seg
from cargolith.plans import timeseries as ts
from cargolith.session import scratch_path

col = F.col


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [6, 6], [0, 8]])
    return np.vstack([c + rng.normal(0, 0.6, (40, 2)) for c in centres])


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (400, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(0, 0.1, 400)
    pdf = pd.DataFrame({"id": range(400), "a": x[:, 0], "b": x[:, 1], "y": y, "flag": (y > 0).astype(int)})
    return spark.createDataFrame(pdf), pdf


def test_cluster_measures_follow_their_definitions(spark, cloud):
    points = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(cloud)], "id long, x array<double>")
    centres = seg.centres_for_all(points, "id", "x", [2, 3, 4])
    rows = {r.k: r for r in seg.measures(points, "x", centres).collect()}
    own = {r.id: r.own for r in points.select("id", seg.nearest_centre("x", centres[3]).alias("own")).collect()}
    assert len({(own[i], i // 40) for i in own}) == 3
    gaps = ((cloud[:, None] - cloud[None]) ** 2).sum(-1)
    each = []
    for i in range(120):
        a = gaps[i, i // 40 * 40 : i // 40 * 40 + 40].sum() / 39
        b = min(gaps[i, j * 40 : j * 40 + 40].mean() for j in range(3) if j != i // 40)
        each.append((b - a) / max(a, b))
    assert rows[3].silhouette == pytest.approx(np.mean(each))
    assert max(rows.values(), key=lambda r: r.silhouette).k == 3
    labels = np.repeat([0, 1, 2], 40)
    means = np.array([cloud[labels == i].mean(axis=0) for i in range(3)])
    within = ((cloud - means[labels]) ** 2).sum()
    between = sum(40 * ((means[i] - cloud.mean(axis=0)) ** 2).sum() for i in range(3))
    assert rows[3].inertia == pytest.approx(within, rel=1e-6)
    assert rows[3].calinski_harabasz == pytest.approx(between / 2 / (within / 117), rel=1e-6)


def test_weights_and_weighted_mean(spark):
    df = spark.createDataFrame([(1.0, 1.1, 2.0), (2.0, 1.9, 1.0)], "label double, pred_a double, pred_b double")
    w = m.inverse_error_weights(df, ["a", "b"])
    assert w["a"] == pytest.approx(0.99 / 1.0, abs=0.01) and sum(w.values()) == pytest.approx(1)
    got = [r.v for r in df.select(m.weighted_mean(w).alias("v")).collect()]
    assert got[0] == pytest.approx(1.1 * w["a"] + 2.0 * w["b"])


def test_soft_vote_is_the_mean_of_probabilities(spark, linear):
    data = m.class_weights(m.design(linear[0], ["a", "b"], "flag", ["id"]))
    fitted = m.fit_all(data, {n: m.CLASSIFIERS[n] for n in ("logistic", "random_forest")})
    out = m.soft_vote(fitted, data, {"logistic": 0.75, "random_forest": 0.25}).select("id", "probability", "prediction").toPandas().set_index("id")
    single = {n: x.transform(data).select("id", "probability").toPandas().set_index("id")["probability"] for n, x in fitted.items()}
    for i in (0, 17, 399):
        want = 0.75 * single["logistic"][i].toArray() + 0.25 * single["random_forest"][i].toArray()
        assert np.allclose(out.loc[i, "probability"], want)
        assert out.loc[i, "prediction"] == want.argmax()


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0.0,)] * 30 + [(1.0,)] * 10, "label double")
    got = {r.label: r.w for r in m.class_weights(df).groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert got == pytest.approx({0.0: 20.0, 1.0: 20.0})


def test_stacking_and_persistence(spark, linear):
    data = m.design(linear[0], ["a", "b"], "y", ["id"])
    from pyspark.ml.regression import LinearRegression

    base, meta = m.stack(data, "id", {"ridge": lambda: LinearRegression(regParam=0.0), "lasso": m.REGRESSORS["lasso"]}, LinearRegression(), folds=3)
    out = meta.transform(m.stacked_features(m.scored_columns(base, data), ["ridge", "lasso"]))
    assert out.agg(F.avg(F.pow(col("label") - col("prediction"), 2))).first()[0] < 0.02
    path = f"{scratch_path(spark, 'models')}/y/ridge"
    m.save(base["ridge"], path, {"features": ["a", "b"]})
    loaded, meta_data = m.load(spark, path)
    assert meta_data == {"features": ["a", "b"]}
    a = loaded.transform(data).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(base["ridge"].transform(data).agg(F.sum("prediction")).first()[0])


def test_missing_features_count_as_zero(spark, linear):
    data = m.design(linear[0], ["a", "b"], "y", ["id"])
    from pyspark.ml.regression import LinearRegression

    model = LinearRegression().fit(data)
    thin = spark.createDataFrame([(1, 2.0), (2, None)], "id int, a double")
    got = {r.id: r.prediction for r in sc.batch_predict(model, thin, ["a", "b"]).collect()}
    assert got[1] == pytest.approx(model.intercept + 2 * model.coefficients[0])
    assert got[2] == pytest.approx(model.intercept)


def test_delivery_scores_and_intervals(spark, linear):
    data = m.design(linear[0], ["a", "b"], "y", ["id"])
    flags = m.class_weights(m.design(linear[0], ["a", "b"], "flag", ["id"]))
    reg, clf = m.REGRESSORS["ridge"]().fit(data), m.CLASSIFIERS["logistic"]().fit(flags)
    frame = linear[0].withColumn("PlannedArrivalDate", F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = sc.delivery(frame, clf, reg, ["a", "b"]).collect()
    assert len(rows) == 400
    for r in rows[:20]:
        assert (r.OnTimeProbability > 0.5) == (r.PredictedOnTimeFlag == 1.0)
        days = (r.PredictedArrivalDate - dtm.datetime(2024, 1, 1)).total_seconds() / 86400
        assert days == pytest.approx(r.PredictedDeliveryVariance, abs=1e-6)
    wide = sc.interval(frame.withColumn("p", F.lit(10.0)), "p", 2.0).first()
    assert (wide.lower_bound, wide.upper_bound) == pytest.approx((10 - 3.919928, 10 + 3.919928))


def test_contributions_are_ranked(spark):
    df = spark.createDataFrame([(1.0, -5.0, 2.0)], "a double, b double, c double")
    got = sc.contributions(df, {"a": 0.5, "b": 0.3, "c": 0.6}, 2).first().contributions
    assert [(x.feature, x.contribution) for x in got] == [("b", -1.5), ("c", 1.2)]


def test_time_folds_expand(spark):
    rows = [(dtm.datetime(2024, 1, 1) + dtm.timedelta(days=i), float(i)) for i in range(60)]
    df = m.time_folds(spark.createDataFrame(rows, "d timestamp_ntz, y double"), "d", 5)
    sizes = {r.fold: (r.n, r.a, r.b) for r in df.groupBy("fold").agg(F.count("*").alias("n"), F.min("d").alias("a"), F.max("d").alias("b")).collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4, 5] and all(n == 10 for n, _, _ in sizes.values())
    assert all(sizes[i][2] < sizes[i + 1][1] for i in range(5))


def test_forecast_methods_compose(spark):
    rows = [(k, dtm.date(2024, 1, 1) + dtm.timedelta(days=i), float(20 + i % 7 + (3 if k == "b" else 0) * i)) for k in "ab" for i in range(40)]
    series = spark.createDataFrame(rows, "series_id string, ds date, y double")
    one = {(r.series_id, r.ds): r.yhat for r in ts.smoothing_forecast(series, 5).collect()}
    two = {(r.series_id, r.ds): r.yhat for r in ts.autoregressive_forecast(series, 5).collect()}
    both = {(r.series_id, r.ds): r.yhat for r in ts.ensemble_forecast(series, 5).collect()}
    assert all(both[k] == pytest.approx((one[k] + two[k]) / 2) for k in both) and len(both) == 10
    everything = ts.comprehensive_forecast(series, 5).groupBy("method").count().collect()
    assert {r.method: r["count"] for r in everything} == {"history": 80, "exponential_smoothing": 10, "autoregressive": 10, "ensemble": 10}
    errors = ts.backtest(series).toPandas()
    best = ts.best_methods(ts.backtest(series)).toPandas().set_index("series_id")["best_method"]
    for k, g in errors.groupby("series_id"):
        assert best[k] == g.sort_values("mape")["method"].iloc[0]


@pytest.mark.parametrize("n", [0, 9, 30_000])
def test_stratified_split_has_exact_quotas(spark, n):
    rows = spark.range(n).select("id", F.when(col("id") % 10 == 0, 1.0).when(col("id") < 7, None).otherwise(0.0).alias("y"), F.lit("x").alias("__k"))
    train, test = m.stratified_split(rows.withColumnRenamed("__k", "extra"), "id", "y")
    sizes = {r.y: r[1] for r in rows.groupBy("y").count().collect() if r.y is not None}
    got = {r.y: r[1] for r in test.groupBy("y").count().collect()}
    assert {y: got.get(y, 0) for y in sizes} == {y: int(size * 0.2 + 0.5) for y, size in sizes.items()}
    assert train.count() + test.count() == sum(sizes.values()) and train.join(test, "id").count() == 0
    share = m.split_share(col("id"))
    most = {r.y: r[1] for r in test.groupBy("y").agg(F.max(share)).collect()}
    least = {r.y: r[1] for r in train.groupBy("y").agg(F.min(share)).collect()}
    assert all(most[y] <= least[y] for y in most)


def test_tuning_takes_the_best_candidate(spark, linear):
    data = m.design(linear[0], ["a", "b"], "flag", ["id"]).withColumn("fold", m.fold_of("id", 3))
    model, table = m.tune_classifier(data, "logistic", "fold", sample=3)
    rows = table.collect()
    assert len(rows) == 3 and max(r.cv_mean for r in rows) > 0.95
    assert model.transform(data).filter("label <> prediction").count() < 20
