"""Query registry: a name, a callable on (spark, folder), and the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODULES = ["kpis", "warehouse", "scans", "scalars", "features", "evaluate", "series", "learn"]
QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def register(name: str, run: Callable, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = sql.strip()


def tidy(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Rounds the double columns for comparison across engines."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "double":
            c = F.round(c, special.get(field.name, digits)).alias(field.name)
        out.append(c)
    return df.select(*out)
