"""Writers: typed append, full refresh, partitioned and bucketed facts, CSV and JSON reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order and type; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    (conform(df, schema) if schema else df).write.mode("overwrite").parquet(path)


def append_fact(df: DataFrame, path: str, schema: T.StructType, rows_per_file: int = 5_000_000) -> None:
    """Facts partitioned by year, so that date filters prune folders. ``REBALANCE``
    lets AQE even out file sizes and split a hot year."""
    out = conform(df, schema).withColumn("PartYear", F.floor(F.col("DateKey") / 10000).cast("int"))
    out.hint("rebalance", "PartYear").write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy(
        "PartYear"
    ).parquet(path)


def write_chunks(df: DataFrame, path: str, chunk_rows: int = 5000) -> None:
    """Files of at most ``chunk_rows`` rows."""
    df.write.mode("append").option("maxRecordsPerFile", chunk_rows).parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Saved table bucketed on the join keys: later joins on them need no shuffle."""
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, chunk_rows: int = 5000, **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", chunk_rows).options(
        **options
    ).mode("append").save()


def csv_report(df: DataFrame, path: str, null_text: str = "") -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", null_text).csv(path)


def json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_rejects(rejects: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per reject rule; a missing key is written as ``nan``, for a blank
    line would be skipped on reading."""
    for name, df in rejects.items():
        csv_report(df, f"{folder}/{name}", "nan")
