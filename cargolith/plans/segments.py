"""K-means for several cluster counts at once.

All counts share their scans: one pass over the rows assigns each row for every count and returns sums per
cluster, which is all that new centres, inertia, Calinski-Harabasz and silhouette need. A table takes as many
scans as rounds plus two, whatever the number of counts. What reaches the driver has one row per cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.operators.ranking import row_numbers
from cargolith.operators.stats import attach

ROUNDS = 20


def first_centres(data: DataFrame, key: str, vector: str, counts: Sequence[int]) -> dict[int, np.ndarray]:
    """For k centres the rows in the middle of k equal shares, in the order of the vector's sum, then ``key``."""
    total = F.aggregate(vector, F.lit(0.0), lambda a, v: a + v)
    placed = row_numbers(data.select(key, vector, total.alias("__sum")), ["__sum", key], "__r", start=0)
    n = F.col("__n")
    marks = {k: [F.floor((2 * i + 1) * n / (2 * k)) for i in range(k)] for k in counts}
    wanted = F.array(*[m for own in marks.values() for m in own])
    rows = attach(placed, data.agg(F.count(F.lit(1)).alias("__n"))).filter(F.array_contains(wanted, F.col("__r"))).select(vector, "__r", "__n").collect()
    at = {r["__r"]: r[vector] for r in rows}
    size = rows[0]["__n"] if rows else 0
    return {k: np.array([at[(2 * i + 1) * size // (2 * k)] for i in range(k)]) for k in counts if size}


def _matrix(batch: pa.RecordBatch, vector: str, size: int) -> np.ndarray:
    return batch.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centres)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - centres[None, :, i]) ** 2
    return out


def _sums(data: DataFrame, vector: str, centres: dict[int, np.ndarray]) -> dict[int, dict[str, np.ndarray]]:
    """Per count: rows, vector sums, sums of squared norms and of squared distances of each cluster."""
    size = next(iter(centres.values())).shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: np.zeros((k, size + 3)) for k in centres}
        for batch in batches:
            x = _matrix(batch, vector, size)
            for k, c in centres.items():
                far = _distances(x, c)
                own = far.argmin(axis=1)
                np.add.at(held[k], own, np.column_stack((np.ones(len(x)), x, (x * x).sum(axis=1), far[np.arange(len(x)), own])))
        rows = [(k, i, *v) for k, t in held.items() for i, v in enumerate(t.tolist())]
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i < 2 else pa.float64()) for i, c in enumerate(columns)], names)

    names = ["k", "cluster", *[f"s{i}" for i in range(size + 3)]]
    schema = "k int, cluster int, " + ", ".join(f"s{i} double" for i in range(size + 3))
    got = data.select(vector).mapInArrow(run, schema).groupBy("k", "cluster").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(size + 3)])
    table = {k: np.zeros((k, size + 3)) for k in centres}
    for r in got.collect():  # one row per cluster of each count
        table[r.k][r.cluster] = r[2:]
    return {k: {"n": t[:, 0], "x": t[:, 1 : size + 1], "norm": t[:, size + 1], "spread": t[:, size + 2]} for k, t in table.items()}


def centres_for_all(data: DataFrame, key: str, vector: str, counts: Sequence[int], rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """Lloyd's rounds for all counts together; a count whose centres stand still leaves, an empty cluster keeps its centre."""
    centres = first_centres(data, key, vector, counts)
    moving = dict(centres)
    for _ in range(rounds):
        if not moving:
            break
        sums = _sums(data, vector, moving)
        for k, s in sums.items():
            after = np.where(s["n"][:, None] > 0, s["x"] / np.maximum(s["n"], 1)[:, None], centres[k])
            if np.abs(after - centres[k]).max() <= 1e-13:
                del moving[k]
            else:
                moving[k] = after
            centres[k] = after
    return centres


def measures(data: DataFrame, vector: str, centres: dict[int, np.ndarray]) -> DataFrame:
    """k, silhouette (squared Euclidean), calinski_harabasz, inertia: two scans for all counts."""
    spark = data.sparkSession
    if not centres:
        return spark.createDataFrame([], "k int, silhouette double, calinski_harabasz double, inertia double")
    sums, size = _sums(data, vector, centres), next(iter(centres.values())).shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: 0.0 for k in centres}
        for batch in batches:
            x = _matrix(batch, vector, size)
            norm = (x * x).sum(axis=1)[:, None]
            for k, c in centres.items():
                s = sums[k]
                n = s["n"]
                own = _distances(x, c).argmin(axis=1)
                all_rows = np.arange(len(x))
                # Mean squared distance to the rows of each cluster, from its sums.
                far = norm + (s["norm"] / np.maximum(n, 1))[None] - 2 * x @ (s["x"] / np.maximum(n, 1)[:, None]).T
                mine = far[all_rows, own] * n[own] / np.maximum(n[own] - 1, 1)
                far[:, n == 0] = np.inf
                far[all_rows, own] = np.inf
                other = far.min(axis=1)
                top = np.maximum(mine, other)
                fine = (n[own] > 1) & np.isfinite(other) & (top > 0)
                total[k] += float(((other - mine)[fine] / top[fine]).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()))], ["k", "total"])

    shares = {r.k: r.total for r in data.select(vector).mapInArrow(run, "k int, total double").groupBy("k").agg(F.sum("total").alias("total")).collect()}
    rows = []
    for k, s in sums.items():
        n, inertia = s["n"].sum(), float(s["spread"].sum())
        spread = float(s["norm"].sum() - (s["x"].sum(axis=0) ** 2).sum() / n)
        score = (spread - inertia) / (k - 1) / (inertia / (n - k)) if inertia and n > k else float("inf")
        rows.append((k, float(shares[k] / n), float(score), inertia))
    return spark.createDataFrame(rows, "k int, silhouette double, calinski_harabasz double, inertia double")


def nearest_centre(vector: str, centres: np.ndarray) -> Column:
    """Number of the nearest centre; the first one wins a tie."""

    def far(c: np.ndarray) -> Column:
        out = F.lit(0.0)
        for i, v in enumerate(c):
            out = out + (F.col(vector)[i] - F.lit(float(v))) * (F.col(vector)[i] - F.lit(float(v)))
        return out

    distances = F.array(*[far(c) for c in centres])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
