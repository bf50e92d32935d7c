"""Models R01-R13, clustering C01-C02, persistence S15, scoring V01-V06."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from cargolith.catalog import binding as b
from cargolith.catalog import sqlmodels as sm
from cargolith.catalog.registry import register, tidy
from cargolith.catalog.scalars import band
from cargolith.catalog.sqlbase import INV, RFM, SCORES, SHIP, VARIANCE, sql
from cargolith.operators.density import density_clusters
from cargolith.plans import customers as cust
from cargolith.plans import evaluation as ev
from cargolith.plans import features as f
from cargolith.plans import linear as lin
from cargolith.plans import models as m
from cargolith.plans import registry as reg
from cargolith.plans import scoring as sc
from cargolith.plans import segments as seg
from cargolith.plans import selection as sel
from cargolith.session import drop_stash, scratch_path, stash
from cargolith.sources.marts import invoices, shipments
from cargolith.sources.tables import parquet

col, lit = F.col, F.lit
# Rows of the test part with a known variance.
TESTED = f"('0x' || left(md5('{m.SEED}:' || ShipmentID), 8))::BIGINT / 4294967296.0 < 0.2 AND {VARIANCE} IS NOT NULL"

# Neither the targets nor anything derived from the actual arrival is a feature.
DELIVERY = ["TotalWeight", "TotalVolume", "TotalPackages", "ShipmentValue", "Month", "Quarter", "DayOfWeek", "Year", "OriginLocationKey",
            "DestinationLocationKey", "EquipmentKey", "FreightTypeKey", "WeightVolumeDensity", "ValuePerWeight"]
PAYMENT = ["TotalAmount", "TaxAmount", "Month", "Quarter", "DayOfWeek", "Year", "PaymentTermKey", "TaxRate"]


def shipment_frame(s, d):
    return f.shipment_features(shipments(s, d), labels=False)


def invoice_frame(s, d):
    return f.invoice_features(invoices(s, d), b.as_of())


def written(df, name="design"):
    """``stash``, after which the driver drops what it no longer needs, shuffle files of the joins among it."""
    out = stash(df, name)
    df.sparkSession._jvm.System.gc()
    return out


def regression_data(s, d):
    """Delivery variance from what is known at departure; written once, as every fit and score reads it."""
    return _regression_data(shipment_frame(s, d), DELIVERY), DELIVERY


def _regression_data(frame, features):
    marks = {"test": m.split_share(col("ShipmentID")) < 0.2, "fold": m.fold_of("ShipmentID", 5)}
    rows = m.design_rows(frame, features, "DeliveryVariance", ["ShipmentID"]).withColumns(marks)
    return m.assembled(written(rows), features)


def parts(data):
    """Training and test rows of ``m.train_test``, marked when they were written."""
    return data.filter("NOT test").drop("test"), data.filter("test").drop("test", "fold")


def class_rows(s, d):
    return m.design_rows(shipment_frame(s, d), DELIVERY, "OnTimeDeliveryFlag", ["ShipmentID"])


def payment_rows(frame):
    """Payment status 1 to 4 of sales and purchases as classes 0 to 3."""
    data = m.design_rows(frame, PAYMENT, "PaymentStatus", ["InvoiceID", "InvoiceType"]).withColumn("label", col("label") - 1)
    return data.withColumn("Invoice", F.concat_ws(":", "InvoiceType", "InvoiceID"))


def stratified_parts(rows, key, features):
    """Training rows with class weights, and test rows; each class has its share of both."""
    rows = written(rows)
    train, test = m.stratified_split(rows, key, "label")
    train, test = written(train.withColumn("fold", m.fold_of(key, 5)), "train"), written(test, "test")
    drop_stash(rows)
    return m.class_weights(m.assembled(train, features)), m.assembled(test, features)


def scored_once(fitted, test):
    """Labels and predictions of all models side by side, written: measures read them several times."""
    return written(m.scored_columns(fitted, test).select("label", *[f"pred_{n}" for n in fitted]), "scored")


def measured(rows):
    """(y, p) rows, written."""
    return written(rows, "scored")


def long_scores(scored, columns):
    """(model, y, p) rows; ``columns`` has the prediction of each model."""
    return scored.select(col("label").alias("y"), F.inline(F.array(*[F.struct(lit(n).alias("model"), c.alias("p")) for n, c in columns.items()])))


def subset(factories, *names):
    return {n: factories[n] for n in names}


_held = {}


def _once(name, s, d, make):
    """What ``make`` returns, fitted once per session and folder: several queries read the same models."""
    key = (name, s.sparkContext.applicationId, d)
    if key not in _held:
        _held[key] = make(s, d)
    return _held[key]


def _fit_regressors(s, d):
    train, test = parts(regression_data(s, d)[0])
    return m.fit_all(train, m.REGRESSORS), train, test


def fitted_regressors(s, d):
    """All five regressors at full size, their training rows and their test rows."""
    return _once("regressors", s, d, _fit_regressors)


def _regressors(s, d):
    fitted, _, test = fitted_regressors(s, d)
    return tidy(ev.regression_metrics(long_scores(scored_once(fitted, test), {n: col(f"pred_{n}") for n in fitted}), ["model"]))


register("R01_regressors", _regressors)


def _ridge(s, d):
    train, test = parts(regression_data(s, d)[0])
    return m.REGRESSORS["ridge"]().fit(train), test


_RIDGE = "WITH RECURSIVE " + sm.ridge(m.SEED, 5)
register("R01b_ridge_predictions", lambda s, d: tidy((lambda model, test: model.transform(test).select("ShipmentID", "prediction"))(*_ridge(s, d))),
    f"{_RIDGE} SELECT ShipmentID, round({sm.PREDICTED}, 4) AS prediction FROM z, coef WHERE test AND coef.fold = -1 AND alpha = 1")


def _folded(s, d):
    return parts(regression_data(s, d)[0])[0]


def _tuned(s, d):
    """Every candidate of all five regressors over five folds."""
    return tidy(m.tuned_regressors(_folded(s, d), "fold"))


register("R03_tuning", _tuned)
_HELD = " + ".join(f"w[{i + 1}] * x{i}" for i in range(sm.P))
register("R03b_ridge_candidates", lambda s, d: tidy(lin.tuned(_folded(s, d), "fold", ["ridge"])[1].select(
        F.get_json_object("params", "$.alpha").cast("double").alias("alpha"), "cv_mean", "cv_std")),
    f"""{_RIDGE}, e AS (SELECT alpha, z.fold, avg(pow(y - ({sm.PREDICTED}), 2)) AS mse FROM z JOIN coef ON z.fold = coef.fold WHERE NOT test GROUP BY 1, 2)
SELECT alpha, round(avg(mse), 4) AS cv_mean, round(stddev_pop(mse), 4) AS cv_std FROM e GROUP BY 1""")


def _tuned_classifier(s, d):
    """All six candidates of the logistic model over five folds of the stratified training part."""
    train, _ = m.stratified_split(written(class_rows(s, d)), "ShipmentID", "label")
    train = m.assembled(train, DELIVERY)
    return tidy(m.tune_classifier(train.withColumn("fold", m.fold_of("ShipmentID", 5)), "logistic", "fold")[1])


register("R03c_classifier_tuning", _tuned_classifier)
register("R04_hash_split", lambda s, d: m.train_test(shipments(s, d, "ShipmentID", "ShipmentValue"), "ShipmentID")[1],
    sql(SHIP, f"""SELECT ShipmentID, ShipmentValue FROM shipments
WHERE ('0x' || left(md5('{m.SEED}:' || ShipmentID), 8))::BIGINT / 4294967296.0 < 0.2"""))
register("R04b_fold_sizes", lambda s, d: shipments(s, d, "ShipmentID").groupBy(
    m.fold_of("ShipmentID", 5).alias("fold"), (m.split_share(F.col("ShipmentID")) < 0.2).alias("test")).agg(F.count("*").alias("n")),
    sql(SHIP, f"""SELECT floor(('0x' || left(md5('{m.SEED + 1}:' || ShipmentID), 8))::BIGINT / 4294967296.0 * 5)::INT AS fold,
  ('0x' || left(md5('{m.SEED}:' || ShipmentID), 8))::BIGINT / 4294967296.0 < 0.2 AS test, count(*) AS n FROM shipments GROUP BY ALL"""))


def _time_folds(s, d):
    base = m.time_folds(shipment_frame(s, d), "ShipmentDate", 5)
    data = m.assembled(written(m.design_rows(base, DELIVERY, "DeliveryVariance", ["fold"])), DELIVERY)
    made = {n: make() for n, make in m.regressors(**m.FEW_TREES).items()}
    linear = {n: e for n, e in made.items() if isinstance(e, lin.MomentRegression)}
    rows = lin.expanding_errors(data, "fold", linear)
    rows += [(n, i + 1, float(x)) for n, e in made.items() if n not in linear for i, x in enumerate(m.expanding_scores(data, e, "regression", 5))]
    return tidy(s.createDataFrame(rows, "model string, fold int, rmse double"))


register("R05_time_ordered_folds", _time_folds)
register("R05b_fold_sizes", lambda s, d: m.time_folds(shipments(s, d, "ShipmentDate"), "ShipmentDate", 5).groupBy("fold").agg(F.count(lit(1)).alias("n")),
    sql(f"{SHIP}, e AS (SELECT quantile_cont(CAST(date_diff('day', DATE '1970-01-01', ShipmentDate) AS DOUBLE), [1/6, 2/6, 3/6, 4/6, 5/6]) AS q FROM shipments)",
    "SELECT CAST(len(list_filter(q, lambda x: x < date_diff('day', DATE '1970-01-01', ShipmentDate))) AS INTEGER) AS fold, count(*) AS n FROM shipments, e GROUP BY 1"))


def _stratified(s, d):
    """Share and size of each class in the test part; the test rows by id."""
    frame = shipment_frame(s, d).select("ShipmentID", col("OnTimeDeliveryFlag").alias("label"))
    return m.stratified_split(frame, "ShipmentID", "label")[1]


register("R04c_stratified_split", _stratified, sql(SHIP, f"""
SELECT ShipmentID, label FROM (SELECT *, rank() OVER (PARTITION BY label ORDER BY {sm.digest(m.SEED)}, ShipmentID) AS r, count(*) OVER (PARTITION BY label) AS n
  FROM (SELECT ShipmentID, CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END AS label FROM shipments))
WHERE r <= floor(n * 0.2 + 0.5)"""))


def class_parts(s, d):
    return stratified_parts(class_rows(s, d), "ShipmentID", DELIVERY)


def payment_parts(frame):
    return stratified_parts(payment_rows(frame), "Invoice", PAYMENT)


def _fit_classifiers(s, d):
    train, test = class_parts(s, d)
    return m.fit_all(train, m.CLASSIFIERS), train, test


def fitted_classifiers(s, d):
    """All four classifiers at full size, their training rows and their test rows."""
    return _once("classifiers", s, d, _fit_classifiers)


def _by_model(fitted, test, measure):
    out, scored = None, scored_once(fitted, test)
    for n in fitted:
        part = measure(scored.select(col("label").alias("y"), col(f"pred_{n}").alias("p"))).withColumn("model", lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def _classifiers(s, d):
    fitted, _, test = fitted_classifiers(s, d)
    return tidy(_by_model(fitted, test, ev.classification_metrics))


register("R06_classifiers", _classifiers)


def _payment_models(s, d):
    train, test = payment_parts(invoice_frame(s, d))
    return tidy(_by_model(m.fit_all(train, m.classifiers(**m.FEW_TREES), classes=4), test, ev.class_report))


register("R06b_multiclass", _payment_models)


def _importance(s, d):
    return tidy(m.importance_table(s, fitted_regressors(s, d)[0], DELIVERY))


register("R07_feature_importance", _importance)


def _proba(s, d):
    train, test = class_parts(s, d)
    model = m.fit_all(train, subset(m.CLASSIFIERS, "logistic"))["logistic"]
    return model.transform(test).select("ShipmentID", "label", "prediction", vector_to_array("probability").alias("p"))


def _proba_check(s, d):
    """Test rows, and those whose probabilities are not in [0, 1], do not sum to 1, or disagree with the class."""
    p = col("p")
    sound = (F.array_min(p) >= 0) & (F.abs(p[0] + p[1] - 1) < 1e-9) & (p[col("prediction").cast("int")] == F.array_max(p))
    return _proba(s, d).agg(F.count(lit(1)).alias("n"), F.count_if(~F.coalesce(sound, lit(False))).alias("unsound"))


register("R08_probability", lambda s, d: tidy(_proba(s, d).select("ShipmentID", "label", col("p")[1].alias("probability"))))
register("R08b_probability_check", _proba_check, sql(SHIP, f"""
SELECT count(*) AS n, 0::BIGINT AS unsound FROM (SELECT rank() OVER (PARTITION BY label ORDER BY {sm.digest(m.SEED)}, ShipmentID) AS r, count(*) OVER (PARTITION BY label) AS n
  FROM (SELECT ShipmentID, CASE WHEN {VARIANCE} <= 0 THEN 1 ELSE 0 END AS label FROM shipments)) WHERE r <= floor(n * 0.2 + 0.5)"""))


def _voting(s, d):
    fitted, train, test = fitted_regressors(s, d)
    weights = m.inverse_error_weights(m.scored_columns(fitted, train), list(fitted))
    scored = m.scored_columns(fitted, test)
    return tidy(ev.regression_metrics(measured(scored.select(col("label").alias("y"), m.weighted_mean(weights).alias("p")))))


register("R09_weighted_voting", _voting)


def _soft(s, d):
    """Weighted mean of the probabilities of the classifiers that have them (the linear machine has none)."""
    fitted, train, test = fitted_classifiers(s, d)
    fitted = subset(fitted, "logistic", "random_forest", "gradient_boost")
    weights = m.accuracy_weights(m.scored_columns(fitted, train), list(fitted))
    soft = m.soft_vote(fitted, test, weights).select("ShipmentID", col("label").alias("y"), col("prediction").alias("p"))
    return tidy(ev.classification_metrics(measured(soft.select("y", "p"))))


register("R09b_soft_voting", _soft)


def _hard(s, d):
    fitted, train, test = fitted_classifiers(s, d)
    weights = m.accuracy_weights(m.scored_columns(fitted, train), list(fitted))
    return tidy(ev.classification_metrics(measured(m.scored_columns(fitted, test).select(col("label").alias("y"), m.weighted_vote(weights).alias("p")))))


register("R13_trained_ensemble", _hard)


def _stacking(s, d):
    """All five regressors under a linear meta-learner."""
    train, test = parts(regression_data(s, d)[0])
    base, meta = m.stack(train, "ShipmentID", m.regressors(**m.FEW_TREES), LinearRegression(), folds=5)
    out = meta.transform(m.stacked_features(m.scored_columns(base, test), list(base)))
    return tidy(ev.regression_metrics(measured(out.select(col("label").alias("y"), col("prediction").alias("p")))))


register("R10_stacking", _stacking)


def _class_stacking(s, d):
    """The classifiers with probabilities under a logistic meta-learner, which sees their probability of class 1."""
    train, test = class_parts(s, d)
    factories = subset(m.classifiers(**m.FEW_TREES), "logistic", "random_forest", "gradient_boost")
    base, meta = m.stack(train, "ShipmentID", factories, LogisticRegression(), folds=5, score=m.probability_columns)
    out = meta.transform(m.stacked_features(m.probability_columns(base, test), list(base)))
    return tidy(ev.classification_metrics(measured(out.select(col("label").alias("y"), col("prediction").alias("p")))))


register("R10b_class_stacking", _class_stacking)


def _regression_flow(s, d):
    """Features, selection of 15 at most, split, linear learners tuned over their whole grid, forest and boosted
    trees, evaluation, the ensemble weighted by inverse error, ranks."""
    frame = written(shipment_frame(s, d).select("ShipmentID", "DeliveryVariance", *DELIVERY), "frame")
    ranked = sel.ranked(sel.f_regression(frame, DELIVERY, "DeliveryVariance"), "f_regression", 15)
    chosen = [r.feature for r in ranked.filter("selected").orderBy("rank").collect()]
    data = _regression_data(frame, chosen)
    drop_stash(frame)
    train, test = parts(data)
    fitted = lin.tuned(train, "fold")[0] | m.fit_all(train, subset(m.REGRESSORS, "random_forest", "gradient_boost"))
    scored = m.scored_columns(fitted, train)
    weights = m.inverse_error_weights(scored, list(fitted))
    # One scan of the test part scores all models; a row per model and the ensemble follows from it.
    columns = {n: col(f"pred_{n}") for n in fitted} | {"ensemble": m.weighted_mean(weights)}
    rows = long_scores(scored_once(fitted, test), columns)
    return tidy(ev.compare_models(ev.regression_metrics(rows, ["model"])))


register("R11_regression_flow", _regression_flow)


def _classification_flow(s, d):
    """Features, selection of 15 at most, stratified split, the three classifiers of the flow, evaluation, best model."""
    frame = written(shipment_frame(s, d).select("ShipmentID", "OnTimeDeliveryFlag", *DELIVERY), "frame")
    ranked = sel.ranked(sel.f_classification(frame, DELIVERY, "OnTimeDeliveryFlag"), "f_classification", 15)
    chosen = [r.feature for r in ranked.filter("selected").orderBy("rank").collect()]
    train, test = stratified_parts(m.design_rows(frame, chosen, "OnTimeDeliveryFlag", ["ShipmentID"]), "ShipmentID", chosen)
    drop_stash(frame)
    return _class_table(train, test, 2)


def _class_table(train, test, classes, factories=m.CLASSIFIERS):
    fitted = m.fit_all(train, subset(factories, "random_forest", "gradient_boost", "logistic"), classes)
    table = ev.accuracy_bands(_by_model(fitted, test, ev.classification_metrics))
    best = Window.partitionBy().orderBy(col("accuracy").desc(), "model")  # one row per model
    return tidy(table.withColumn("best", F.row_number().over(best) == 1))


register("R12_classification_flow", _classification_flow)


def _payment_flow(s, d):
    """The same flow for the payment status, four classes."""
    frame = invoice_frame(s, d)
    train, test = payment_parts(frame)
    return _class_table(train, test, 4, m.classifiers(**m.FEW_TREES))


register("R12b_payment_flow", _payment_flow)


def _rfm(s, d):
    return cust.rfm_scores(cust.rfm_base(invoices(s, d), b.as_of()))


def _points(s, d):
    """Customers with their scaled features, written once."""
    return stash(cust.standard_vector(_rfm(s, d), m.RFM_FEATURES).select("CustomerKey", "vector"), "points")


def _kmeans(s, d):
    """Customers with their cluster; the number of clusters is the one with the best silhouette."""
    points = _points(s, d)
    centres = seg.centres_for_all(points, "CustomerKey", "vector", range(2, 11))
    best = seg.measures(points, "vector", centres).orderBy(col("silhouette").desc(), "k").first()  # one row per k
    return points.select("CustomerKey", seg.nearest_centre("vector", centres[best.k]).alias("Segment_KMeans"))


def _choice(s, d):
    points = _points(s, d)
    return tidy(seg.measures(points, "vector", seg.centres_for_all(points, "CustomerKey", "vector", range(2, 11))), inertia=3, calinski_harabasz=3)


_Z = ", ".join(f"(coalesce({c}, 0) - avg(coalesce({c}, 0)::DOUBLE) OVER ()) / coalesce(nullif(stddev_pop(coalesce({c}, 0)::DOUBLE) OVER (), 0), 1) AS f{i}"
               for i, c in enumerate(m.RFM_FEATURES))
_N = len(m.RFM_FEATURES)
_FAR = " + ".join(f"(z.f{i} - c.c{i}) * (z.f{i} - c.c{i})" for i in range(_N))
_AXES = ", ".join(f"c{i}" for i in range(_N))
# Lloyd's rounds in SQL: centres of all counts per round, then the last round's clusters.
_LLOYD = f"""WITH RECURSIVE {INV},
{SCORES},
z0 AS (SELECT CustomerKey, {_Z} FROM scores),
z AS (SELECT *, row_number() OVER (ORDER BY {" + ".join(f"f{i}" for i in range(_N))}, CustomerKey) - 1 AS r, count(*) OVER () AS n FROM z0),
ks AS (SELECT k, unnest(range(k)) AS i FROM (SELECT unnest(range(2, 11)) AS k)),
centre(t, k, i, {_AXES}) AS (SELECT 0, k, i, {", ".join(f"f{i}" for i in range(_N))} FROM ks JOIN z ON z.r = ((2 * i + 1) * n) // (2 * k)
  UNION ALL SELECT t + 1, k, i, {", ".join(f"CASE WHEN rows_ > 0 THEN m{i} ELSE c{i} END" for i in range(_N))} FROM (
    SELECT t, k, i, {_AXES}, count(*) FILTER (mine) AS rows_, {", ".join(f"avg(f{i}) FILTER (mine) AS m{i}" for i in range(_N))}
    FROM (SELECT c.*, z.*, row_number() OVER (PARTITION BY c.k, z.CustomerKey ORDER BY {_FAR}, c.i) = 1 AS mine FROM centre c, z WHERE c.t < 20) GROUP BY ALL_KEYS)),
own AS (SELECT k, i, CustomerKey, far, {", ".join(f"f{i}" for i in range(_N))} FROM (
  SELECT c.k, c.i, z.*, {_FAR} AS far, row_number() OVER (PARTITION BY c.k, z.CustomerKey ORDER BY {_FAR}, c.i) = 1 AS mine FROM centre c, z WHERE c.t = 20) WHERE mine),
total AS (SELECT k, i, count(*) AS n, sum(far) AS spread, sum({" + ".join(f"f{i} * f{i}" for i in range(_N))}) AS norm, {", ".join(f"sum(f{i}) AS s{i}" for i in range(_N))} FROM own GROUP BY k, i),
dist AS (SELECT o.k, o.CustomerKey, o.i = t.i AS mine, {" + ".join(f"o.f{i} * o.f{i}" for i in range(_N))} + t.norm / t.n - 2 * ({" + ".join(f"o.f{i} * t.s{i}" for i in range(_N))}) / t.n AS d, t.n
  FROM own o JOIN total t ON o.k = t.k),
ab AS (SELECT k, CustomerKey, min(d) FILTER (NOT mine) AS b, max(d * n / greatest(n - 1, 1)) FILTER (mine) AS a, max(n) FILTER (mine) AS n FROM dist GROUP BY 1, 2),
sil AS (SELECT k, sum(CASE WHEN n > 1 AND b IS NOT NULL AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) / count(*) AS silhouette FROM ab GROUP BY k),
ch AS (SELECT k, sum(spread) AS inertia, sum(n) AS n, sum(norm) - ({" + ".join(f"sum(s{i}) * sum(s{i})" for i in range(_N))}) / sum(n) AS all_ FROM total GROUP BY k),
chosen AS (SELECT k, silhouette, (all_ - inertia) / (k - 1) / (inertia / (n - k)) AS calinski_harabasz, inertia FROM sil JOIN ch USING (k))""".replace(
    "ALL_KEYS", f"t, k, i, {_AXES}")
register("C01_kmeans_segments", _kmeans, f"""{_LLOYD}
SELECT CustomerKey, i::INTEGER AS Segment_KMeans FROM own WHERE k = (SELECT k FROM chosen ORDER BY silhouette DESC, k LIMIT 1)""")
register("C02_choice_of_k", _choice, f"""{_LLOYD}
SELECT k::INTEGER AS k, round(silhouette, 4) AS silhouette, round(calinski_harabasz, 3) AS calinski_harabasz, round(inertia, 3) AS inertia FROM chosen""")


def _misplaced(s, d):
    """Customers, and those of them that another centre is nearer to than the mean of their own cluster."""
    points = _points(s, d)
    centres = seg.centres_for_all(points, "CustomerKey", "vector", [4])[4]
    placed = points.withColumn("own", seg.nearest_centre("vector", centres))
    means = {r.own: r.mean for r in placed.groupBy("own").agg(F.array(*[F.avg(col("vector")[i]) for i in range(_N)]).alias("mean")).collect()}
    again = seg.nearest_centre("vector", np.array([means[i] for i in sorted(means)]))
    return placed.agg(F.count(lit(1)).alias("customers"), F.count_if(again != col("own")).alias("misplaced"))


register("C01b_nearest_centre", _misplaced, sql(f"{INV}, {RFM}", "SELECT count(*) AS customers, 0::BIGINT AS misplaced FROM rfm"))


def _density(s, d):
    """Density clusters of the customers: eps 0.5, five points, over the scaled features of the k-means segments."""
    points = cust.standard_vector(_rfm(s, d), m.RFM_FEATURES).select("CustomerKey", "vector")
    return density_clusters(points, "CustomerKey", "vector", len(m.RFM_FEATURES)).withColumnRenamed("cluster", "Segment_DBSCAN")


_DBSCAN = f"""WITH RECURSIVE {INV},
{SCORES},
z AS (SELECT CustomerKey, {_Z} FROM scores),
e AS (SELECT a.CustomerKey AS a, b.CustomerKey AS b FROM z a, z b WHERE {" + ".join(f"(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})" for i in range(len(m.RFM_FEATURES)))} <= 0.25),
core AS (SELECT a AS k FROM e GROUP BY a HAVING count(*) >= 5),
l AS (SELECT a, b FROM e SEMI JOIN core x ON x.k = e.a SEMI JOIN core y ON y.k = e.b WHERE a <> b),
reach(node, root) AS (SELECT k, k FROM core UNION SELECT l.b, r.root FROM reach r JOIN l ON l.a = r.node WHERE r.root < l.b),
label AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
number AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS c FROM (SELECT DISTINCT root FROM label))
SELECT z.CustomerKey, coalesce(min(c), -1)::BIGINT AS Segment_DBSCAN
FROM z LEFT JOIN e ON e.a = z.CustomerKey AND (z.CustomerKey NOT IN (SELECT k FROM core) OR e.b = e.a) LEFT JOIN label ON label.node = e.b LEFT JOIN number USING (root) GROUP BY 1"""
register("C03_dbscan_segments", _density, _DBSCAN)


def _saved(s, d):
    data, feats = regression_data(s, d)
    train, test = parts(data)
    path = f"{scratch_path(s, 'models')}/DeliveryVariance/ridge"
    m.save(m.fit_all(train, subset(m.REGRESSORS, "ridge"))["ridge"], path, {"model": "ridge", "features": feats})
    model, meta = m.load(s, path)
    out = model.transform(test).withColumn("features_used", lit(len(meta["features"])))
    return tidy(out.select("ShipmentID", "prediction", "features_used"))


register("S15_model_persistence", _saved, f"{_RIDGE} SELECT ShipmentID, round({sm.PREDICTED}, 4) AS prediction, {len(DELIVERY)} AS features_used FROM z, coef WHERE test AND coef.fold = -1 AND alpha = 1")


def _reloaded(s, d):
    """Test rows, and those that a saved and loaded model predicts otherwise than the model itself."""
    data, feats = regression_data(s, d)
    train, test = parts(data)
    fresh = m.fit_all(train, subset(m.REGRESSORS, "ridge"))["ridge"]
    path = f"{scratch_path(s, 'models')}/DeliveryVariance/ridge"
    m.save(fresh, path, {"model": "ridge", "features": feats})
    out = m.scored_columns({"fresh": fresh, "loaded": m.load(s, path)[0]}, test)
    return out.agg(F.count(lit(1)).alias("n"), F.count_if(~col("pred_fresh").eqNullSafe(col("pred_loaded"))).alias("differing"))


register("S15b_reload_check", _reloaded, sql(SHIP, f"SELECT count(*) AS n, 0::BIGINT AS differing FROM shipments WHERE {TESTED}"))


def _registry(s, d):
    """Three models in a folder, one of them damaged: what is loaded, and how many rows each of the others scores."""
    frame = shipment_frame(s, d)
    root, few = f"{scratch_path(s, 'registry')}", DELIVERY[:6]
    variance = stash(m.design(frame, few, "DeliveryVariance", ["ShipmentID"]), "design")
    flag = stash(m.design(frame, few, "OnTimeDeliveryFlag", ["ShipmentID"]), "design")
    reg.publish(m.REGRESSORS["ridge"]().fit(variance), root, "DeliveryVariance", "ridge", few)
    reg.publish(m.REGRESSORS["lasso"]().fit(variance), root, "DeliveryVariance", "lasso", few)
    reg.publish(LogisticRegression(maxIter=20).fit(flag), root, "OnTimeDeliveryFlag", "logistic", few)
    broken = s._jvm.org.apache.hadoop.fs.Path(f"{root}/DeliveryVariance/lasso/1/model/stages")
    broken.getFileSystem(s.sparkContext._jsc.hadoopConfiguration()).delete(broken, True)
    models, report = reg.load_all(s, root, frame.columns)
    scored = reg.score_all(models, frame, ["ShipmentID"])
    counts = scored.agg(*[F.count(f"{t}__{a}").alias(f"{t}__{a}") for t, a in models])
    rows = counts.select(F.inline(F.array(*[F.struct(lit(t).alias("target"), lit(a).alias("algorithm"), col(f"{t}__{a}").alias("scored")) for t, a in models])))
    return report.join(rows, ["target", "algorithm"], "left").select("target", "algorithm", "version", "status", F.coalesce("scored", lit(0)).alias("scored"))


register("S15c_model_folder", _registry, sql(SHIP, """
SELECT target, algorithm, 1 AS version, status, CASE WHEN status = 'ok' THEN n ELSE 0 END AS scored
FROM (VALUES ('DeliveryVariance', 'ridge', 'ok'), ('DeliveryVariance', 'lasso', 'unreadable'), ('OnTimeDeliveryFlag', 'logistic', 'ok')) v(target, algorithm, status), (SELECT count(*) AS n FROM shipments)"""))


def delivery_frame(s, d):
    """What the delivery models are fitted on and score, written once."""
    frame = shipment_frame(s, d).select("ShipmentID", "PlannedArrivalDate", "OnTimeDeliveryFlag", "DeliveryVariance", *DELIVERY)
    return written(frame.withColumn("test", m.split_share(col("ShipmentID")) < 0.2), "frame")


def _delivery_models(frame):
    train = frame.filter("NOT test")
    clf = m.fit_all(m.class_weights(m.design(train, DELIVERY, "OnTimeDeliveryFlag")), subset(m.CLASSIFIERS, "logistic"))["logistic"]
    return clf, m.fit_all(m.design(train, DELIVERY, "DeliveryVariance"), subset(m.REGRESSORS, "ridge"))["ridge"]


def _linear_check(s, d):
    """Shipments with a known variance, and those whose prediction is not intercept + coefficients . features."""
    frame = delivery_frame(s, d)
    _, reg = _delivery_models(frame)
    terms = F.zip_with(vector_to_array("features"), F.array(*[lit(float(v)) for v in reg.coefficients]), lambda x, c: x * c)
    expected = F.aggregate(terms, lit(float(reg.intercept)), lambda a, x: a + x)
    out = reg.transform(m.design(frame, DELIVERY, "DeliveryVariance"))
    wrong = ~(F.abs(col("prediction") - expected) <= 1e-6 * (1 + F.abs(expected)))
    return out.agg(F.count(lit(1)).alias("n"), F.count_if(wrong).alias("differing"))


def _scored_delivery(s, d):
    frame = delivery_frame(s, d)
    clf, reg = _delivery_models(frame)
    return sc.delivery(frame.drop("test"), clf, reg, DELIVERY)


def _batch(s, d):
    frame = delivery_frame(s, d)
    _, reg = _delivery_models(frame)
    thin = shipments(s, d, "ShipmentID", "ShipmentDate", "TotalWeight", "ShipmentValue")
    return tidy(sc.batch_predict(reg, thin, DELIVERY).select("ShipmentID", "prediction"), 1)


_KNOWN = {"TotalWeight": "coalesce(TotalWeight, 0)", "ShipmentValue": "coalesce(ShipmentValue, 0)"}
_THIN = " + ".join(f"w[{i + 1}] * ({_KNOWN.get(c, '0')} - q{i}[2]) / CASE WHEN q{i}[3] = q{i}[1] THEN 1 ELSE q{i}[3] - q{i}[1] END" for i, c in enumerate(DELIVERY))
register("V01_batch_predict", _batch, f"{_RIDGE} SELECT ShipmentID, round(b + {_THIN}, 1) AS prediction FROM shipments, q, coef WHERE coef.fold = -1 AND alpha = 1")
register("V01b_linear_check", _linear_check, sql(SHIP, f"SELECT count(*) AS n, 0::BIGINT AS differing FROM shipments WHERE {VARIANCE} IS NOT NULL"))
register("V02_delivery_scoring", lambda s, d: tidy(_scored_delivery(s, d).select(
    "ShipmentID", "PredictedOnTimeFlag", "OnTimeProbability", "PredictedDeliveryVariance", "PredictedArrivalDate")))


def _payment_scoring(s, d):
    frame = invoice_frame(s, d)
    train, _ = payment_parts(frame)
    clf = m.fit_all(train, subset(m.CLASSIFIERS, "logistic"))["logistic"]
    status = (col("PredictedPaymentStatus") + 1).alias("PredictedPaymentStatus")
    return tidy(sc.payment(frame, clf, PAYMENT).select("InvoiceID", "InvoiceType", status, "PaymentProbability"))


register("V03_payment_scoring", _payment_scoring)
register("V04_interval", lambda s, d: tidy(sc.interval(
        shipments(s, d, "ShipmentID", "TotalWeight").select("ShipmentID", (col("TotalWeight") * 1050.0).alias("prediction")), "prediction", 12.5), 6),
    sql(SHIP, """SELECT ShipmentID, TotalWeight * 1050 AS prediction, round(TotalWeight * 1050 - 1.959963984540054 * 12.5, 6) AS lower_bound,
  round(TotalWeight * 1050 + 1.959963984540054 * 12.5, 6) AS upper_bound FROM shipments"""))
_RISKCOLS = ["ShipmentID", "TotalWeight", "TotalVolume", "ShipmentValue", "OriginLocationKey", "DestinationLocationKey"]


def _pct(c: str) -> str:
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / count(*) OVER ()"


register("V05_shipment_risk", lambda s, d: tidy(sc.shipment_risk(shipments(s, d, *_RISKCOLS)).select(
        "ShipmentID", "ShipmentValue", "WeightRisk", "VolumeRisk", "ValueRisk", "RouteRisk", "OverallRisk", "RiskCategory"), 8),
    sql(f"""{SHIP}, r0 AS (SELECT *, abs(OriginLocationKey - DestinationLocationKey) AS route FROM shipments),
r AS (SELECT ShipmentID, ShipmentValue, {_pct('TotalWeight')} AS w, {_pct('TotalVolume')} AS v, {_pct('ShipmentValue')} AS u, {_pct('route')} AS t FROM r0),
o AS (SELECT *, (0.0::DOUBLE + 0.5 + w + v + u + t) / 5 AS x FROM r)""", f"""
SELECT ShipmentID, ShipmentValue, round(w, 8) AS WeightRisk, round(v, 8) AS VolumeRisk, round(u, 8) AS ValueRisk, round(t, 8) AS RouteRisk,
  round(x, 8) AS OverallRisk, {band('x', 0.3, 0.7)} AS RiskCategory FROM o"""))


def _model_risk(s, d):
    scored = _scored_delivery(s, d)
    out = sc.shipment_risk(scored, 1 - col("OnTimeProbability"))
    return tidy(out.select("ShipmentID", "DelayRisk", "OverallRisk", "RiskCategory"))


register("V05b_modelled_risk", _model_risk)
_IMP = ["TotalWeight", "TotalPackages", "ShipmentValue"]


def _contributions(s, d):
    df = shipments(s, d, "ShipmentID", *_IMP)
    row = sel.target_correlation(df, _IMP, "ShipmentValue").collect()  # one row per feature
    out = sc.contributions(df, {r.feature: round(r.score, 6) for r in row}, 10)
    return tidy(out.select("ShipmentID", F.posexplode("contributions").alias("place", "c")).select("ShipmentID", "place", "c.feature", "c.contribution"), 4)


register("V06_contributions", _contributions,
    sql(f"""{SHIP}, w AS (SELECT round(abs(corr(TotalWeight, ShipmentValue)), 6) AS a, round(abs(corr(TotalPackages, ShipmentValue)), 6) AS b FROM shipments),
l AS (SELECT row_number() OVER () AS i, ShipmentID, TotalWeight * a AS x, TotalPackages * b AS y, ShipmentValue AS z FROM shipments, w),
u AS (SELECT i, ShipmentID, 'TotalWeight' AS feature, x AS c FROM l UNION ALL SELECT i, ShipmentID, 'TotalPackages', y FROM l UNION ALL SELECT i, ShipmentID, 'ShipmentValue', z FROM l)""", """
SELECT ShipmentID, CAST(row_number() OVER (PARTITION BY i ORDER BY abs(c) DESC, feature) - 1 AS INTEGER) AS place, feature, round(c, 4) AS contribution FROM u"""))
