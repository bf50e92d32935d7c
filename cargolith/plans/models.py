"""Supervised models, ensembles and clustering on ``pyspark.ml``."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from random import Random
from statistics import pstdev

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.operators.ranking import quantile_rows, row_numbers
from cargolith.operators.stats import attach
from cargolith.plans import logistic
from cargolith.plans.linear import MomentRegression, fit_together, tuned, width_of
from cargolith.plans.trees import TreeModel, fit_trees, fits, thresholds
from cargolith.plans.tuning import tuned_trees
from cargolith.session import drop_stash, stash, tiny

col, lit, when = F.col, F.lit, F.when
SEED = 42


def split_share(key: Column, seed: int = SEED) -> Column:
    """Number in [0, 1) from a digest of the seed and the row's id: the same whatever the partitioning, and
    unrelated for different seeds, so that folds do not follow the train/test split."""
    digest = F.md5(F.concat_ws(":", lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / lit(float(2**32))


def train_test(df: DataFrame, key: str, test: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Hash split; classes keep their shares, for the hash does not see the label."""
    share = split_share(col(key), seed)
    return df.filter(share >= test), df.filter(share < test)


def stratified_split(df: DataFrame, key: str, label: str, test: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test part with an exact quota per class: of n rows of a class, the floor(n * test + 1/2) with the
    smallest digest are test rows, ties by ``key``; rows of one class that share a key go to the same part, past the
    quota if need be. Rows without a label are in neither part.

    One pass brackets each class's cutoff between two approximate percentiles, a second one counts the rows
    below the bracket; only the rows inside, some thousandths, are ordered. There is one row per class in all
    that is broadcast.
    """
    accuracy, margin = 10_000, 4.0 / 10_000
    known = df.filter(col(label).isNotNull())
    rows = known.select(col(label).alias("__c"), col(key).alias("__k"), split_share(col(key), seed).alias("__s"))
    sizes = rows.groupBy("__c").agg(
        F.floor(F.count(lit(1)) * test + 0.5).alias("__quota"), (F.count(lit(1)) <= accuracy).alias("__whole"),
        F.percentile_approx("__s", [max(0.0, test - margin), min(1.0, test + margin)], accuracy).alias("__ends"))
    marked = rows.join(tiny(sizes), "__c")
    # Small classes are ordered whole: there the bracket can be narrower than the quota's rounding.
    low, high = ~col("__whole") & (col("__s") < col("__ends")[0]), col("__whole") | (col("__s") <= col("__ends")[1])
    below = marked.groupBy("__c").agg(F.count_if(low).alias("__below"))
    inside = row_numbers(marked.filter(~low & high).select("__c", "__s", "__k"), ["__c", "__s", "__k"], "__r")
    first = inside.groupBy("__c").agg(F.min("__r").alias("__first"))
    bounds = sizes.join(below, "__c").join(first, "__c", "left")
    at = inside.join(tiny(bounds), "__c").filter(col("__below") + col("__r") - col("__first") + 1 == col("__quota"))
    cuts = bounds.select("__c", "__quota").join(at.select("__c", F.struct("__s", "__k").alias("__cut")), "__c", "left")
    missed = F.raise_error(lit("the cutoff lies outside its bracket")).cast("boolean")
    placed = known.join(tiny(cuts), col(label) == col("__c"))
    is_test = (when(col("__quota") == 0, False).when(col("__cut").isNull(), missed)
               .otherwise(F.struct(split_share(col(key), seed).alias("__s"), col(key).alias("__k")) <= col("__cut")))
    tagged = placed.withColumn("__test", is_test).drop("__c", "__quota", "__cut")
    return tagged.filter(~col("__test")).drop("__test"), tagged.filter("__test").drop("__test")


def fold_of(key: str, folds: int, seed: int = SEED + 1) -> Column:
    return F.floor(split_share(col(key), seed) * folds).cast("int")


def design_rows(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Label and features as columns, which take a fraction of the vectors' bytes in files; missing feature values count as 0."""
    return df.filter(col(label).isNotNull()).select(
        *keep, col(label).cast("double").alias("label"), *[F.coalesce(col(c).cast("double"), lit(0.0)).alias(c) for c in features]
    )


def assembled(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """The feature columns of ``design_rows`` as a vector."""
    kept = [c for c in rows.columns if c not in features]
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(rows).select(*kept, "features")


def design(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and label; missing feature values count as 0."""
    return assembled(design_rows(df, features, label, keep), features)


#: Depth of a forest's trees without tuning; the original sets no limit, which costs a pass per level.
FOREST_DEPTH = 5


def regressors(trees: int = 100, rounds: int = 100) -> dict[str, Callable]:
    """Factories of the regressors."""
    return {
        "random_forest": lambda: RandomForestRegressor(numTrees=trees, maxDepth=FOREST_DEPTH, seed=SEED),
        "gradient_boost": lambda: GBTRegressor(maxIter=rounds, maxDepth=3, stepSize=0.1, seed=SEED),
        "ridge": lambda: MomentRegression("ridge"),
        "lasso": lambda: MomentRegression("lasso"),
        "elastic_net": lambda: MomentRegression("elastic_net"),
    }


def classifiers(trees: int = 100, rounds: int = 100) -> dict[str, Callable]:
    """Factories of the classifiers; all but boosting take class weights."""
    return {
        "random_forest": lambda: RandomForestClassifier(numTrees=trees, maxDepth=FOREST_DEPTH, seed=SEED, weightCol="weight"),
        "gradient_boost": lambda: GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.1, seed=SEED),
        "logistic": lambda: LogisticRegression(regParam=0.01, maxIter=100, weightCol="weight"),
        "linear_svm": lambda: LinearSVC(regParam=0.01, maxIter=50, weightCol="weight"),
    }


REGRESSORS, CLASSIFIERS = regressors(), classifiers()
#: For recipes that refit every learner per fold or class.
FEW_TREES = {"trees": 20, "rounds": 10}
# Tuning ranges by model and parameter. Linear regressors have theirs in ``plans.linear``.
REGRESSION_GRIDS = {
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4]},
    "gradient_boost": {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 6, 9]},
}
# Fixed values; for the linear models ``C`` is the inverse of the penalty per row.
CLASSIFICATION_GRIDS = {
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [10, 20, 30], "balanced": [True, False]},
    "gradient_boost": {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 6, 9]},
    "logistic": {"C": [0.1, 1.0, 10.0], "elasticNetParam": [0.0, 1.0]},
    "linear_svm": {"C": [0.1, 1.0, 10.0]},
}


def class_weights(df: DataFrame) -> DataFrame:
    """Adds n / (k * n_c). The weights have one row per class and are broadcast: a shuffle
    on a label would put each class into one task."""
    counts = df.groupBy("label").agg(F.count(lit(1)).alias("__nc"))
    totals = counts.agg(F.sum("__nc").alias("__n"), F.count(lit(1)).alias("__k"))
    w = attach(counts, totals).select("label", (col("__n") / (col("__k") * col("__nc"))).alias("weight"))
    return df.join(tiny(w), "label")


def multiclass(estimator, classes: int):
    """Binary-only learners are wrapped one against the rest."""
    if classes > 2 and isinstance(estimator, (GBTClassifier, LinearSVC)):
        wrapped = OneVsRest(classifier=estimator, parallelism=2)
        return wrapped.setWeightCol("weight") if isinstance(estimator, LinearSVC) else wrapped
    return estimator


def param_grid(ranges: dict[str, list], sample: int | None = None, seed: int = SEED) -> list[dict]:
    """Full grid, or a seeded sample of it for random search."""
    grid = [dict(zip(ranges, values, strict=True)) for values in product(*ranges.values())]
    return Random(seed).sample(grid, sample) if sample is not None and sample < len(grid) else grid


def with_params(estimator, parameters: dict, rows: int):
    """A copy with the parameters set. ``C`` is the inverse penalty on the sum over ``rows`` rows; ``balanced`` says
    whether class weights count."""
    out = estimator.copy()
    for name, value in parameters.items():
        if name == "C":
            out = out.setRegParam(1.0 / (value * max(rows, 1)))
        elif name == "balanced":
            if not value:
                out.clear(out.weightCol)
        else:
            out = out.copy({getattr(out, name): value})
    return out


def evaluator(task: str):
    return RegressionEvaluator(metricName="rmse") if task == "regression" else MulticlassClassificationEvaluator(metricName="accuracy")


def tune(train: DataFrame, estimator, ranges: dict[str, list], task: str, fold: str, sample: int | None = 20, measure=None):
    """Cross-validated choice over the grid; returns (best model, table of mean metrics), by ``measure`` in place of the task's own.

    ``train`` is read once into storage; every candidate is fitted on the folds other than the held-out one,
    four at a time. The best candidate (least rmse, or highest accuracy; the earlier one wins a tie) is fitted
    on all rows.
    """
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r[0]: r[1] for r in train.groupBy(fold).count().collect()}  # one row per fold
        grid = param_grid(ranges, sample)
        total = sum(sizes.values())
        jobs = [(g, k) for g in range(len(grid)) for k in sorted(sizes)]

        def score(job: tuple[int, int]) -> float:
            g, k = job
            model = with_params(estimator, grid[g], total - sizes[k]).fit(train.filter(col(fold) != k))
            return (measure or evaluator(task)).evaluate(model.transform(train.filter(col(fold) == k)))

        with ThreadPool(4) as pool:
            scores = pool.map(inheritable_thread_target(train.sparkSession)(score), jobs)
        by = [[x for (g, _), x in zip(jobs, scores, strict=True) if g == i] for i in range(len(grid))]
        means = [sum(x) / len(x) for x in by]
        best = min(range(len(grid)), key=lambda i: means[i] if task == "regression" else -means[i])
        rows = [(json.dumps(p), m, pstdev(x)) for p, m, x in zip(grid, means, by, strict=True)]
        model = with_params(estimator, grid[best], total).fit(train)
    finally:
        train.unpersist()
    return model, train.sparkSession.createDataFrame(rows, "params string, cv_mean double, cv_std double")


def tune_classifier(train: DataFrame, name: str, fold: str, sample: int | None = 20):
    """``tune`` for one of the classifiers, with class weights; the logistic model's candidates and folds share their scans."""
    train, estimator = class_weights(train), CLASSIFIERS[name]()
    got = tune_logistic(train, estimator, CLASSIFICATION_GRIDS[name], fold, sample) if logistic.fits(estimator) else None
    return got or tune(train, estimator, CLASSIFICATION_GRIDS[name], "classification", fold, sample)


def tune_logistic(train: DataFrame, estimator, ranges: dict[str, list], fold: str, sample: int | None = 20):
    """What ``tune`` returns, with all candidates and folds fitted and scored in the same scans; None where a training part lacks a class."""
    held = logistic.blocks(train, estimator.getWeightCol(), fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        all_ = logistic.Fits(held, width_of(train))
        folds, total = sorted(all_.sizes), sum(all_.sizes.values())
        if not all_.sound([-1, *folds]):
            return None
        grid = param_grid(ranges, sample)
        jobs = [(with_params(estimator, p, total - all_.sizes[k]), k) for p in grid for k in folds]
        without = [k for _, k in jobs]
        hits = all_.hits(all_.solve([e for e, _ in jobs], without), without)
        scores = (hits / np.array([all_.sizes[k] for k in without])).reshape(len(grid), -1).tolist()
        means = [sum(x) / len(x) for x in scores]
        best = with_params(estimator, grid[max(range(len(grid)), key=means.__getitem__)], total)
        model = all_.model(best, all_.solve([best], [-1])[0])
    finally:
        held.unpersist()
    rows = [(json.dumps(p), m, pstdev(x)) for p, m, x in zip(grid, means, scores, strict=True)]
    return model, train.sparkSession.createDataFrame(rows, "params string, cv_mean double, cv_std double")


def tune_regressor(train: DataFrame, name: str, fold: str, sample: int | None = 20):
    """``tune`` for the forest or the boosted trees; the linear learners have ``linear.tuned``."""
    return tune(train, REGRESSORS[name](), REGRESSION_GRIDS[name], "regression", fold, sample)


def tuned_regressors(train: DataFrame, fold: str) -> DataFrame:
    """(model, params, cv_mean, cv_std) of the mean squared error for every candidate of the five regressors. Forests and
    boosted trees are grown in tasks; where the rows are too many for one, every candidate is a fit of its own."""
    table = tuned(train, fold)[1]
    grids = {name: param_grid(ranges) for name, ranges in REGRESSION_GRIDS.items()}
    rows = tuned_trees(train, fold, grids, SEED)
    if rows is not None:
        return table.unionByName(train.sparkSession.createDataFrame(rows, table.schema))
    for name, ranges in REGRESSION_GRIDS.items():
        own = tune(train, REGRESSORS[name](), ranges, "regression", fold, None, RegressionEvaluator(metricName="mse"))[1]
        table = table.unionByName(own.withColumn("model", lit(name)))
    return table


def time_folds(df: DataFrame, date: str, folds: int) -> DataFrame:
    """Adds ``fold`` 0..folds by date quantile (equal shares of rows in time order)."""
    day = F.datediff(col(date), lit("1970-01-01"))
    edges = quantile_rows(df.select(day.alias("day")), "day", [i / (folds + 1) for i in range(1, folds + 1)])
    one = edges.agg(F.collect_list("quantile").alias("__edges"))  # one number per fold
    return attach(df, one).withColumn("fold", F.size(F.filter("__edges", lambda e: e < day))).drop("__edges")


def expanding_scores(data: DataFrame, estimator, task: str, folds: int = 5) -> list[float]:
    """Fits on folds before i, scores on fold i: order in time is respected."""
    scores = []
    cuts = thresholds(data, width_of(data)) if fits(estimator) else None
    for i in range(1, folds + 1):
        model = fit_each(data.filter(col("fold") < i), {"one": lambda: estimator}, cuts=cuts)["one"]
        scores.append(evaluator(task).evaluate(model.transform(data.filter(col("fold") == i))))
    return scores


def importances(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """Tree importances, or mean absolute coefficients, by feature."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(model, "coefficients"):
        values = abs(model.coefficients.toArray())
    else:
        return []
    return [(f, float(v)) for f, v in zip(features, values)]


def importance_table(spark: SparkSession, fitted: dict, features: Sequence[str]) -> DataFrame:
    rows = [(name, f, v) for name, m in fitted.items() for f, v in importances(m, features)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def fit_each(train: DataFrame, factories: dict[str, Callable], classes: int = 2, cuts: list[list[float]] | None = None) -> dict:
    """Fits each estimator; the linear regressors share one scaler and one scan, forests and boosted trees one set of bins."""
    made = {name: make() for name, make in factories.items()}
    done = fit_together(train, {n: e for n, e in made.items() if isinstance(e, MomentRegression)})
    done |= fit_trees(train, {n: e for n, e in made.items() if fits(e)}, classes, cuts)
    done |= logistic.fit_logistic(train, {n: e for n, e in made.items() if logistic.fits(e)})
    return {n: done[n] if n in done else multiclass(e, classes).fit(train) for n, e in made.items()}


def fit_all(train: DataFrame, factories: dict[str, Callable], classes: int = 2) -> dict:
    """``fit_each`` on all rows. Each learner reads ``train`` some times and keeps its own blocks: callers write it before."""
    return fit_each(train, factories, classes)


def predictions(models: dict, data: DataFrame, key: str) -> DataFrame:
    """(model, key, y, p) of all models in long form: one scan per model, nothing collected."""
    parts = [m.transform(data).select(lit(n).alias("model"), key, col("label").alias("y"), col("prediction").alias("p")) for n, m in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def scored_columns(models: dict, data: DataFrame) -> DataFrame:
    """Predictions of all models side by side, ``pred_<name>``, without a join."""
    out = data
    for name, m in models.items():
        kept = out.columns
        out = m.transform(out).select(*kept, col("prediction").alias(f"pred_{name}"))
    return out


def probability_columns(models: dict, data: DataFrame) -> DataFrame:
    """Probabilities of class 1 side by side, ``pred_<name>``, without a join."""
    out = data
    for name, m in models.items():
        kept = out.columns
        out = m.transform(out).select(*kept, vector_to_array("probability")[1].alias(f"pred_{name}"))
    return out


def inverse_error_weights(scored: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """1 / mean squared error, normalised, from one pass over scored rows."""
    row = scored.agg(*[F.avg(F.pow(col("label") - col(f"pred_{n}"), 2)).alias(n) for n in names]).first()
    raw = {n: 1.0 / max(row[n], 1e-12) for n in names}
    total = sum(raw.values())
    return {n: v / total for n, v in raw.items()}


def accuracy_weights(scored: DataFrame, names: Sequence[str]) -> dict[str, float]:
    row = scored.agg(*[F.avg((col("label") == col(f"pred_{n}")).cast("double")).alias(n) for n in names]).first()
    total = sum(row[n] for n in names) or 1.0
    return {n: row[n] / total for n in names}


def weighted_mean(weights: dict[str, float]) -> Column:
    out = lit(0.0)
    for n, w in weights.items():
        out = out + col(f"pred_{n}") * w
    return out


def weighted_vote(weights: dict[str, float]) -> Column:
    """Class with the largest total weight; the smaller class wins a tie."""
    votes = F.array(*[F.struct(col(f"pred_{n}").alias("c"), lit(float(w)).alias("w")) for n, w in weights.items()])
    classes = F.array_sort(F.array_distinct(F.transform(votes, lambda v: v["c"])))
    totals = F.transform(
        classes, lambda c: F.struct(F.aggregate(F.filter(votes, lambda v: v["c"] == c), lit(0.0), lambda a, v: a + v["w"]).alias("w"), (-c).alias("neg"))
    )
    return -F.array_max(totals)["neg"]


def _times(values: Column, factor: float) -> Column:
    return F.transform(values, lambda x: x * factor)


def soft_vote(models: dict, data: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted mean of class probabilities, then the likeliest class."""
    out, total = data, None
    for name, m in models.items():
        kept = out.columns
        out = m.transform(out).select(*kept, vector_to_array("probability").alias(f"prob_{name}"))
        part = _times(col(f"prob_{name}"), weights[name])
        total = part if total is None else F.zip_with(total, part, lambda a, b: a + b)
    out = out.withColumn("probability", total)
    best = F.array_position("probability", F.array_max("probability")) - 1
    return out.withColumn("prediction", best.cast("double")).drop(*[f"prob_{n}" for n in models])


def stack(train: DataFrame, key: str, factories: dict[str, Callable], meta, folds: int = 5, score: Callable = scored_columns) -> tuple[dict, object]:
    """Meta-learner on out-of-fold predictions (``score`` makes its inputs); the base models are then refitted on
    all training rows. Returns (base models, meta model). A column ``fold`` of ``train``, written with it, is taken as it is."""
    rows = train if "fold" in train.columns else train.withColumn("fold", fold_of(key, folds)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = []
        cuts = thresholds(rows, width_of(rows)) if any(fits(make()) for make in factories.values()) else None
        # Logistic models of all folds and of all rows move in the same scans.
        own = {n: make() for n, make in factories.items()}
        own = {n: e for n, e in own.items() if logistic.fits(e)}
        shared = logistic.fit_outside(rows, own, "fold", [*range(folds), -1]) if own else {}
        others = {n: make for n, make in factories.items() if n not in own}

        def fit(part: DataFrame, k: int) -> dict:
            done = fit_each(part, others, cuts=cuts) | shared.get(k, {})
            return {n: done[n] for n in factories}

        for i in range(folds):
            parts.append(score(fit(rows.filter(col("fold") != i), i), rows.filter(col("fold") == i)))
        held_out = parts[0]
        for p in parts[1:]:
            held_out = held_out.unionByName(p)
        scores = stash(held_out.select("label", *[f"pred_{n}" for n in factories]), "held-out")
        meta_model = meta.fit(stacked_features(scores, list(factories)))
        drop_stash(scores)
        return fit(rows, -1), meta_model
    finally:
        rows.unpersist()


def stacked_features(scored: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=[f"pred_{n}" for n in names], outputCol="features").transform(scored.drop("features"))


def save(model, path: str, metadata: dict) -> None:
    """Model and its metadata under ``path``; callers use ``{target}/{algorithm}``."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, TreeModel):
        spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")
        metadata = metadata | {"trees": True}
    else:
        fitted = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
        fitted.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metadata),)], "metadata string").coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    meta = spark.read.schema("metadata string").json(f"{path}/metadata").first()
    held = json.loads(meta.metadata)
    if held.pop("trees", False):
        return TreeModel.from_json(spark.read.text(f"{path}/model").first().value), held
    return PipelineModel.load(f"{path}/model"), held


# ---- clustering
RFM_FEATURES = ["Recency", "Frequency", "Monetary", "CustomerValue", "AvgOrderValue", "PurchaseVelocity", "PaymentRate"]
