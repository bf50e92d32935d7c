"""Embedding near-duplicates by an inverted multi-index (operator 8).

Unit vectors are cut in halves with a codebook each, fitted on a bounded sample; pairs of codewords are the
cells of a product grid. A vector is stored in its nearest cell and looks into the ``visits`` cells that the
multi-sequence traversal (ascending sum of both halves' distances) gives first. How many that is follows from
sample vectors whose links are found by comparison with all rows: the fewest, as a power of two, that reach the
target recall. Where too few of them have links, pairs made at the threshold are taken as well. All meetings are verified in double precision.

Equal vectors count once, with their number. A hot cell is cut into blocks on both sides; blocks give sums per
vector and local components, never pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import components, stash
from cargolith.llm.vectors import grouped, k_means, lengths, nearest, sample, squared, unique_vectors

COSINE, TARGET = 0.9, 0.995
SAMPLE, PROBES, CELL, CODEWORDS = 20_000, 256, 64, 1024
#: Probes of the second try, linked probes that a measured recall needs, made pairs.
MORE, LINKED, PARTNERS = 2048, 200, 2000
LEAST_VISITS = 8


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


class Grid:
    def __init__(self, points: np.ndarray, rows: int):
        self.cut = max(1, points.shape[1] // 2)
        k = int(min(CODEWORDS, max(2, np.sqrt(rows / CELL))))
        self.first = k_means(points[:, : self.cut], k)
        self.second = k_means(points[:, self.cut :], k) if points.shape[1] > self.cut else np.zeros((1, 0))

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(x[:, : self.cut], self.first), squared(x[:, self.cut :], self.second)

    def home(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, : self.cut], self.first) * len(self.second) + nearest(x[:, self.cut :], self.second)

    def traverse(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The first cells of the multi-sequence order, nearest first.

        The r-th cell has at most r codeword pairs before it, so that only pairs of ranks (i, j), from 0, with
        (i + 1) * (j + 1) <= visits need to be looked at.
        """
        a, b = self.halves(x)
        n = min(visits, a.shape[1] * b.shape[1])
        ia, ib = np.argsort(a, 1, kind="stable")[:, :n], np.argsort(b, 1, kind="stable")[:, :n]
        i, j = np.array([(i, j) for i in range(ia.shape[1]) for j in range(ib.shape[1]) if (i + 1) * (j + 1) <= n]).T
        total = np.take_along_axis(a, ia, 1)[:, i] + np.take_along_axis(b, ib, 1)[:, j]
        order = np.argsort(total, 1, kind="stable")[:, :n]
        cells = ia[:, i] * b.shape[1] + ib[:, j]
        return np.take_along_axis(cells, order, 1)

    def rank(self, a: np.ndarray, b: np.ndarray, cell: int) -> int:
        """How many cells come before ``cell`` for a point with those half distances."""
        own = a[cell // len(b)] + b[cell % len(b)]
        return int(np.searchsorted(np.sort(b), own - a, "left").sum())


def _partner_visits(points: DataFrame, grid: Grid) -> int:
    """Cells to visit for the target recall on made pairs: sample vectors, each with one at the cosine COSINE in a random direction."""
    x = sample(points, PARTNERS, salt=2)
    if not len(x) or x.shape[1] < 2:
        return LEAST_VISITS
    x = _unit(x)
    noise = np.random.default_rng(29).normal(size=x.shape)
    y = COSINE * x + np.sqrt(1 - COSINE**2) * _unit(noise - (noise * x).sum(1)[:, None] * x)
    (xa, xb), (ya, yb), hx, hy = grid.halves(x), grid.halves(y), grid.home(x), grid.home(y)
    # A pair is found if either of the two visits the other's cell.
    ranks = [min(grid.rank(xa[k], xb[k], hy[k]), grid.rank(ya[k], yb[k], hx[k])) for k in range(len(x))]
    return max(LEAST_VISITS, 2 ** int(np.quantile(ranks, TARGET, method="higher")).bit_length())


def _visits(points: DataFrame, grid: Grid) -> int:
    """Cells to visit for the target recall, from sample vectors that have links; MORE of them where PROBES hold few.

    Where those hold under LINKED too, as links are rare, made pairs at the threshold decide as well.
    """
    for probes in (PROBES, MORE):
        visits, linked = _linked_visits(points, grid, probes)
        if linked >= LINKED:
            return visits
    return max(visits, _partner_visits(points, grid))


def _linked_visits(points: DataFrame, grid: Grid, count: int) -> tuple[int, int]:
    """Cells to visit for the target recall, averaged over those of ``count`` sample vectors that have links, and their number."""
    probes = sample(points, count, salt=1)
    if not len(probes):
        return LEAST_VISITS, 0
    shared = points.sparkSession.sparkContext.broadcast((_unit(probes), grid))  # ``count`` rows and two codebooks

    def run(frames):
        probes, grid = shared.value
        a, b = grid.halves(probes)
        for pdf in frames:
            for lo in range(0, len(pdf), 4096):
                x = _unit(np.stack(pdf["embedding"].to_numpy()[lo : lo + 4096]))
                homes = grid.home(x)
                found: dict[tuple[int, int], int] = {}
                for q, k in zip(*np.nonzero(probes @ x.T >= COSINE), strict=True):
                    key = (int(q), int(homes[k]))
                    found[key] = found.get(key, 0) + 1
                rows = [(q, int(grid.rank(a[q], b[q], cell)).bit_length(), n) for (q, cell), n in found.items()]
                yield pd.DataFrame(rows, columns=["q", "steps", "n"])

    got = points.select("embedding").mapInPandas(run, "q int, steps int, n long").groupBy("q", "steps").agg(F.sum("n").alias("n")).toPandas()
    # Each probe meets itself in its own cell.
    got.loc[got.steps == 0, "n"] -= 1
    per = got.pivot_table(index="q", columns="steps", values="n", aggfunc="sum", fill_value=0)
    per = per[per.sum(axis=1) > 0]
    if not len(per):
        return LEAST_VISITS, 0
    recall = per.div(per.sum(axis=1), axis=0).cumsum(axis=1).mean(axis=0)
    enough = recall[recall >= TARGET]
    return max(LEAST_VISITS, 2 ** int(enough.index[0] if len(enough) else recall.index[-1])), len(per)


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums and local components of one block of vectors (kind 0) and one block of visitors (kind 1)."""
    base, probe = pdf[pdf.kind == 0], pdf[pdf.kind == 1]
    none = pd.DataFrame({"vec_id": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "leader": np.zeros(0, np.int64)})
    if not len(base) or not len(probe):
        return none
    ids_b, ids_p = base.vec_id.to_numpy(), probe.vec_id.to_numpy()
    x = _unit(np.stack(base.embedding.to_numpy()))
    i, j = np.nonzero(_unit(np.stack(probe.embedding.to_numpy())) @ x.T >= COSINE)
    # A pair that meets from both sides counts where the smaller id visits.
    seen = np.stack(base.visited.to_numpy())
    back = (seen[j] == probe.home.to_numpy()[i][:, None]).any(1)
    keep = (ids_p[i] < ids_b[j]) | ((ids_p[i] > ids_b[j]) & ~back)
    i, j = i[keep], j[keep]
    if not len(i):
        return none
    nodes, flat = np.unique(np.concatenate((ids_p[i], ids_b[j])), return_inverse=True)
    u, v = flat[: len(i)], flat[len(i) :]
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, u, base.copies.to_numpy()[j])
    np.add.at(links, v, probe.copies.to_numpy()[i])
    leader = np.arange(len(nodes))
    while True:
        before = leader.copy()
        np.minimum.at(leader, u, leader[v])
        np.minimum.at(leader, v, leader[u])
        leader = leader[leader]
        if (before == leader).all():
            break
    return pd.DataFrame({"vec_id": nodes, "links": links, "leader": nodes[leader]})


def vector_duplicates(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vec_id of ``table`` (vec_id, embedding, others ignored).

    Linked are vectors of one length found to have a cosine of ``COSINE`` or more. Vectors that are NULL, zero,
    or hold NULL or non-finite components have no link. Rows without vec_id are left out; of repeated ids the
    smallest vector counts. An empty table gives no row.
    """
    rows = stash(unique_vectors(table), "vectors")
    out = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for size in lengths(rows):
        out = out.union(_linked(rows.filter(F.col("usable") & (F.size("embedding") == size))))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _linked(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id of usable vectors of one length; there is one at least."""
    spark = rows.sparkSession
    classes = stash(rows.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "classes")
    n = classes.count()
    points = sample(classes, SAMPLE)
    grid = Grid(_unit(points), n)
    visits = _visits(classes, grid)
    shared = spark.sparkContext.broadcast(grid)  # two codebooks of CODEWORDS rows at most

    def place(frames):
        grid = shared.value
        for pdf in frames:
            step = max(64, 2048 * 64 // max(64, visits))
            for lo in range(0, len(pdf), step):
                part = pdf.iloc[lo : lo + step]
                x = _unit(np.stack(part["embedding"].to_numpy()))
                seen = grid.traverse(x, visits)
                yield part.assign(home=seen[:, 0], visited=list(seen))

    placed = stash(classes.mapInPandas(place, "embedding array<double>, vec_id long, copies long, home long, visited array<long>"), "placed")
    base = placed.withColumn("cell", F.col("home"))
    probes = placed.withColumn("cell", F.explode("visited")).withColumn("visited", F.lit(None).cast("array<long>"))  # only the other side's are read
    met = stash(grouped(base, probes, "cell").applyInPandas(_compare, "vec_id long, links long, leader long"), "met")
    sums = met.groupBy("vec_id").agg(F.sum("links").alias("links"))
    joined = components(met.select(F.col("vec_id").alias("a"), F.col("leader").alias("b")).distinct())
    about = classes.join(sums, "vec_id", "left").join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left").select(
        "embedding", F.col("vec_id").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return rows.join(about, "embedding").select("vec_id", "n_links", "component_id")
