"""Readers: Parquet tables, JDBC queries, CSV exports, limited and cached scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc(
    spark: SparkSession, url: str, query: str, *, partition_column: str | None = None, lower=None, upper=None,
    partitions: int = 1, **options: str,
) -> DataFrame:
    """A query scan of an operational database; the partition column splits it into
    parallel range reads. Credentials come from the caller's options only."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def current_keys(dim: DataFrame, *columns: str) -> DataFrame:
    """Key scan of a dimension: current versions only, columns pruned."""
    rows = dim.filter("IsCurrent") if "IsCurrent" in dim.columns else dim
    return rows.select(*columns)


def limited(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)


class TableCache:
    """Scans kept per (table, limit) for jobs that reuse them."""

    def __init__(self, loader):
        self._loader, self._held = loader, {}

    def get(self, name: str, limit: int | None = None) -> DataFrame:
        key = (name, limit)
        if key not in self._held:
            self._held[key] = self._loader(name, limit).persist(StorageLevel.MEMORY_AND_DISK)
        return self._held[key]

    def release(self) -> None:
        for df in self._held.values():
            df.unpersist()
        self._held.clear()


def csv_exports(spark: SparkSession, folder: str, wanted: dict[str, T.StructType | str]) -> dict[str, DataFrame]:
    """Earlier exports that exist in ``folder``; absent ones are left out."""
    found = {}
    for name, schema in wanted.items():
        try:
            found[name] = spark.read.schema(schema).option("header", True).csv(f"{folder}/{name}")
        except AnalysisException:
            continue
    return found


def summary(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and range of the first date column, in one aggregate."""
    dates = [c for c in df.columns if "date" in c.lower() and c != "DateKey"]
    first = F.min(dates[0]) if dates else F.lit(None)
    last = F.max(dates[0]) if dates else F.lit(None)
    return df.agg(
        F.lit(name).alias("TableName"),
        F.count(F.lit(1)).alias("RowCount"),
        F.lit(len(df.columns)).alias("ColumnCount"),
        first.alias("FirstDate"),
        last.alias("LastDate"),
    )
