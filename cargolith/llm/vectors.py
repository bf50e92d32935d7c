"""What the two vector operators share: which vectors count, bounded samples, k-means, bounded groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import like

#: Rows of one side of a comparison at about most.
BLOCK = 2048


def unique_vectors(table: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles), usable: one row per vec_id other than NULL; of repeated ids the smallest vector counts.

    Usable is a vector without NULL or non-finite components, not empty and not all zero. Vectors of different
    lengths are never near each other: the operators take one length after the other (see ``lengths``).
    """
    rows = like(table, "vec_id", "embedding").filter("vec_id is not null").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.col("embedding").cast("array<double>")).alias("embedding"))
    fine = F.expr("embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)")
    return rows.withColumn("usable", fine)


def lengths(rows: DataFrame) -> list[int]:
    """Lengths of the usable vectors, the most frequent first; a table has one as a rule."""
    found = rows.filter("usable").groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").collect()  # one row per length
    return [r.n for r in found]


def sample(vectors: DataFrame, rows: int, salt: int = 0) -> np.ndarray:
    """The vectors with the smallest hash of their id, at most ``rows`` of them, as an array."""
    got = vectors.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id", F.lit(salt)), "vec_id").limit(rows).toPandas()
    return np.stack(got["embedding"].to_numpy()) if len(got) else np.zeros((0, 0))


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def nearest(x: np.ndarray, centres: np.ndarray, block: int = 4096) -> np.ndarray:
    return np.concatenate([squared(x[i : i + block], centres).argmin(1) for i in range(0, len(x), block)] or [np.zeros(0, np.int64)])


def k_means(x: np.ndarray, k: int, rounds: int = 8, balance: bool = False) -> np.ndarray:
    """Centres by Lloyd's rounds from a fixed start. With ``balance`` the smallest clusters go to split the largest."""
    rng = np.random.default_rng(17)
    k = max(1, min(k, len(x)))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for turn in range(rounds):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        if balance and turn < rounds - 2:
            order = np.argsort(counts)
            large = [c for c in order[::-1] if counts[c] > 2 * len(x) / k][: k // 8]
            for small, big in zip(order, large, strict=False):
                if counts[small] * 4 < counts[big]:
                    centres[small] = x[rng.choice(np.flatnonzero(own == big))]
    return centres


def grouped(base: DataFrame, probes: DataFrame, key: str) -> DataFrame:
    """Rows of both sides (same columns, ``kind`` 0 and 1) in groups of about BLOCK rows a side: key, bb, pb.

    A key's rows are dealt by hash to as many blocks as its count asks for, on each side; every block of one
    side meets every block of the other once. Keys without a row on either side go.
    """
    have = base.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    want = probes.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("np"))
    blocks = have.join(want, key)
    left = base.join(blocks, key).withColumn("bb", F.pmod(F.xxhash64("vec_id"), F.col("nb")).cast("int")).withColumn("pb", F.explode(F.sequence(F.lit(0), F.col("np") - 1)))
    right = probes.join(blocks, key).withColumn("pb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("np")).cast("int")).withColumn("bb", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return left.drop("nb", "np").withColumn("kind", F.lit(0)).unionByName(right.drop("nb", "np").withColumn("kind", F.lit(1))).groupBy(key, "bb", "pb")
