"""A folder of trained models: versions, a checked entry per model, and scoring with all of them.

A model is written first and its entry last, so that an entry names a complete model; readers see nothing of a
model that is being written. Versions are never overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENTRY = "target string, algorithm string, version int, features array<string>, digest string, path string"


def _digest(features: Column) -> Column:
    """Of the feature names in their order: a model must get the columns it was fitted on."""
    return F.sha2(F.concat_ws("\n", features), 256)


def entries(spark: SparkSession, root: str) -> DataFrame:
    """All complete entries below ``root``; no row where there is none."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/*/*/entry")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = [str(s.getPath()) for s in found or []]
    return spark.read.schema(ENTRY).json(paths) if paths else spark.createDataFrame([], ENTRY)


def publish(model, root: str, target: str, algorithm: str, features: Sequence[str]) -> int:
    """Adds the next version of (target, algorithm) and returns its number."""
    spark = SparkSession.getActiveSession()
    own = entries(spark, root).filter((F.col("target") == target) & (F.col("algorithm") == algorithm))
    version = (own.agg(F.max("version")).first()[0] or 0) + 1
    path = f"{root}/{target}/{algorithm}/{version}"
    fitted = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    fitted.write().overwrite().save(f"{path}/model")
    row = spark.createDataFrame([(target, algorithm, version, list(features), path)], "target string, algorithm string, version int, features array<string>, path string")
    row.withColumn("digest", _digest(F.col("features"))).select("target", "algorithm", "version", "features", "digest", "path").coalesce(1).write.json(f"{path}/entry")
    return version


def load_all(spark: SparkSession, root: str, columns: Sequence[str]) -> tuple[dict[tuple[str, str], tuple[PipelineModel, list[str]]], DataFrame]:
    """The latest version of every model, and a report (target, algorithm, version, status) with the reason why one is left out.

    ``columns`` are those of the data to be scored. A model counts if its entry's digest fits its features, and
    its files can be read; features that the data lack are only reported, as scoring counts them as 0.
    """
    latest = Window.partitionBy("target", "algorithm").orderBy(F.col("version").desc())
    rows = entries(spark, root).withColumn("__r", F.row_number().over(latest)).filter("__r = 1").withColumn(
        "sound", (F.size("features") > 0) & (F.col("digest") == _digest(F.col("features")))).orderBy("target", "algorithm").collect()  # one row per model
    models, report = {}, []
    for r in rows:
        status = "ok"
        if not r.sound:
            status = "features do not match the entry"
        else:
            try:
                models[r.target, r.algorithm] = (PipelineModel.load(f"{r.path}/model"), list(r.features))
                missing = [f for f in r.features if f not in columns]
                status = f"missing: {', '.join(missing)}" if missing else "ok"
            except (Py4JJavaError, PySparkException):
                status = "unreadable"
        report.append((r.target, r.algorithm, r.version, status))
    return models, spark.createDataFrame(report, "target string, algorithm string, version int, status string")


def score_all(models: dict[tuple[str, str], tuple[PipelineModel, list[str]]], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and a column ``<target>__<algorithm>`` per model, from one scan; missing features count as 0."""
    needed = {f for _, features in models.values() for f in features}
    values = [(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in df.columns else F.lit(0.0)).alias(f"__f_{f}") for f in sorted(needed)]
    out, names = df.select(*keep, *values), list(keep)
    for (target, algorithm), (model, features) in models.items():
        vector = VectorAssembler(inputCols=[f"__f_{f}" for f in features], outputCol="features").transform(out)
        name = f"{target}__{algorithm}"
        out = model.transform(vector).select(*out.columns, F.col("prediction").alias(name))
        names.append(name)
    return out.select(*names)
