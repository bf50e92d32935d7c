"""Session set-up and the two cluster-facing helpers every job shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "cargolith", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Checkpoint files go when their frame is out of use.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: a
    machine-local folder would lose blocks together with its executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cargolith-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and cut its lineage.

    Used where several passes must see the very same partitioning; a lost
    executor then re-reads the files in place of re-sampling range bounds.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tiny(df: DataFrame) -> DataFrame:
    """Broadcast hint for frames whose row count is bounded by construction.

    Callers pass one-row aggregates, the calendar (at most 36,525 days), or one
    row per shuffle partition. Dimensions carry no hint: Catalyst statistics and
    AQE compare their measured size with the broadcast threshold.
    """
    return F.broadcast(df)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, inside the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to a fresh path in the shared folder and reads it back: the lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def drop_stash(*frames: DataFrame) -> None:
    """Removes the files of stashed frames that nothing reads any more."""
    for df in frames:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stash_path)
        target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
