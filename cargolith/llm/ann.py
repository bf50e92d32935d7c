"""Approximate nearest neighbours by balanced posting lists (operator 9).

Largest inner product becomes least distance by one more component, sqrt(M - |x|^2) with M the largest squared
norm. Centroids come from balanced k-means on a bounded sample. Each vector goes to its nearest list, and to
further ones whose distance is within ``SPREAD`` of that (boundary vectors), unless such a list is nearer to one already
taken than to the vector. Queries find lists by best-first search in a neighbour graph of the centroids, held in
memory; lists count up to a distance ratio, the least one at which that very search meets the target recall on
sample queries with known neighbours. Long lists and lists with many queries are cut into blocks.

A list gives a query only what can still be among its best: a first bound comes from a bounded sample of the rows,
a second from the query's ``LEAD`` nearest lists; both hold for all rows, as the k-th best of some of them. The
sample gives that number only: every row of the result comes out of a list.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cargolith.llm.common import stash
from cargolith.llm.vectors import grouped, k_means, lengths, sample, squared, unique_vectors

TARGET, SPREAD, COPIES = 0.97, 0.1, 4
LISTS, LIST_SIZE, DEGREE, PROBES, LEAD = 8192, 200, 24, 128, 4
#: Rows and bytes of the sample that centroids are fitted on, and of the one that gives the first bound.
SAMPLE, SAMPLE_BYTES, GUIDE, GUIDE_BYTES = 65_536, 32 << 20, 8192, 4 << 20


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.column_stack((x, np.sqrt(np.maximum(0, top - (x * x).sum(1)))))


def _query(x: np.ndarray) -> np.ndarray:
    return np.column_stack((x, np.zeros(len(x))))


class Centroids:
    def __init__(self, points: np.ndarray, rows: int):
        self.centres = k_means(points, int(min(LISTS, len(points), max(1, rows // LIST_SIZE))), balance=True)
        k = min(DEGREE + 1, len(self.centres))
        near = [np.argpartition(squared(self.centres[i : i + 1024], self.centres), k - 1, 1)[:, :k] for i in range(0, len(self.centres), 1024)]
        links = [set(r.tolist()) for r in np.concatenate(near)]
        for i, own in enumerate(list(map(set, links))):
            for j in own:
                links[j].add(i)
        self.graph = [np.array(sorted(s - {i}), np.int64) for i, s in enumerate(links)]
        middle = int(squared(self.centres.mean(0)[None], self.centres)[0].argmin())
        step = max(1, len(self.centres) // 16)
        self.entries = np.unique(np.append(np.arange(0, len(self.centres), step), middle))

    def lists(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists of stored vectors."""
        out = []
        for lo in range(0, len(x), 1024):
            d = np.sqrt(squared(x[lo : lo + 1024], self.centres))
            n = min(COPIES * 4, d.shape[1])
            near = np.argpartition(d, n - 1, 1)[:, :n]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), 1, kind="stable"), 1)
            for row, order in zip(d, near, strict=True):
                kept = [order[0]]
                for c in order[1:]:
                    if row[c] > (1 + SPREAD) * row[order[0]] or len(kept) >= COPIES:
                        break
                    if np.sqrt(((self.centres[kept] - self.centres[c]) ** 2).sum(1)).min() > row[c]:
                        kept.append(c)
                out.append(np.array(kept, np.int64))
        return out

    def search(self, q: np.ndarray, ratio: float) -> list[int]:
        """Lists in the graph whose distance is at most ``ratio`` times the least one found, nearest first."""
        def far(nodes):
            return np.sqrt(((self.centres[nodes] - q) ** 2).sum(1)).tolist()

        heap = list(zip(far(self.entries), self.entries.tolist(), strict=True))
        seen = set(self.entries.tolist())
        heapq.heapify(heap)
        best, out, misses = np.inf, [], 0
        while heap:
            d, c = heapq.heappop(heap)
            best = min(best, d)
            if d > ratio * best:
                misses += 1  # goes on a little: a near list may lie behind a far one
                if misses > DEGREE:
                    break
            else:
                out.append((d, c))
            fresh = [int(v) for v in self.graph[c] if v not in seen]
            if fresh:
                seen.update(fresh)
                for item in zip(far(np.array(fresh)), fresh, strict=True):
                    heapq.heappush(heap, item)
        return [c for d, c in sorted(out) if d <= ratio * best]


def _top(q_ids, q, ids, x, k: int, least: np.ndarray | None = None) -> pd.DataFrame:
    """The k best of ``x`` for each query, itself and scores under ``least`` excluded; ties to the smaller id.

    Scores do not depend on the block.
    """
    parts = []
    for lo in range(0, len(q), 256):
        s = q[lo : lo + 256] @ x.T
        s[q_ids[lo : lo + 256, None] == ids] = -np.inf
        n = min(k, s.shape[1])
        edge = np.partition(s, s.shape[1] - n, 1)[:, s.shape[1] - n]
        if least is not None:
            edge = np.maximum(edge, least[lo : lo + 256])
        i, j = np.nonzero((s >= (edge - 1e-9 * (1 + np.abs(edge)))[:, None]) & (s > -np.inf))
        score = (q[lo + i] * x[j]).sum(1)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        if least is not None:
            keep &= score >= least[lo + i]
        parts.append(pd.DataFrame({"query_id": q_ids[lo + i[keep]], "vec_id": ids[j[keep]], "score": score[keep]}))
    return pd.concat(parts)


_FOUND = "query_id long, vec_id long, score double"


def exact(queries: pd.DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k best of all ``rows`` for a bounded set of queries (vec_id, embedding), block by block."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((queries["vec_id"].to_numpy(), np.stack(queries["embedding"].to_numpy())))

    def run(frames):
        ids, q = shared.value
        for pdf in frames:
            for lo in range(0, len(pdf), 4096):
                part = pdf.iloc[lo : lo + 4096]
                yield _top(ids, q, part["vec_id"].to_numpy(), np.stack(part["embedding"].to_numpy()), k)

    return _best(rows.select("vec_id", "embedding").mapInPandas(run, _FOUND), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _bounded(rows: int, limit: int, size: int) -> int:
    """``rows``, or as many vectors of ``size`` doubles as ``limit`` bytes hold."""
    return max(1, min(rows, limit // (8 * size)))


def _fitted_ratio(centroids: Centroids, queries: np.ndarray, wanted: list[list[np.ndarray]]) -> float:
    """The least distance ratio at which the graph search reaches a list of TARGET of the wanted rows.

    ``wanted`` holds, per query, the lists of each of its exact neighbours.
    """
    points = _query(queries)
    steps = []
    for q, rows in zip(points, wanted, strict=True):
        d = np.sqrt(squared(q[None], centroids.centres)[0])
        steps += [float(d[lists].min() / max(d.min(), 1e-12)) for lists in rows]
    if not steps:
        return 1.0
    low = float(np.quantile(steps, TARGET))
    tries = sorted({low, *np.quantile(steps, np.linspace(TARGET, 1, 8)).tolist(), *(max(steps) * f for f in (1.05, 1.1, 1.2, 1.4, 2.0))})
    for ratio in tries:
        ratio *= 1 + 1e-9
        hits = 0
        for q, rows in zip(points, wanted, strict=True):
            found = set(centroids.search(q, ratio))
            hits += sum(not found.isdisjoint(np.asarray(lists).tolist()) for lists in rows)
        if hits >= TARGET * len(steps):
            return ratio
    return float("inf")


def neighbours(table: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product found for each vec_id divisible by ``every``.

    All candidates where there are fewer than k; candidates have the query's length. Vectors that are NULL, zero,
    or hold NULL or non-finite components take no part, nor do rows without vec_id; of repeated ids the smallest
    vector counts. An empty table gives no row.
    """
    spark = table.sparkSession
    kept = stash(unique_vectors(table), "vectors")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for size in lengths(kept):
        rows = kept.filter(F.col("usable") & (F.size("embedding") == size))
        if not rows.filter(F.col("vec_id") % every == 0).isEmpty():
            out = out.union(_of_length(rows, size, every, k).select(*out.columns))
    return out


def _of_length(vectors: DataFrame, size: int, every: int, k: int) -> DataFrame:
    """``neighbours`` for vectors of one length."""
    spark = vectors.sparkSession
    rows = stash(vectors.select("vec_id", "embedding", F.expr("aggregate(embedding, 0d, (s, x) -> s + x * x)").alias("norm")), "vectors")
    total = rows.agg(F.count("*").alias("n"), F.max("norm").alias("top")).first()
    n, top = total.n, total.top
    centroids = Centroids(_lift(sample(rows, _bounded(SAMPLE, SAMPLE_BYTES, size)), top), n)
    shared = spark.sparkContext.broadcast(centroids)  # LISTS centroids and their graph at most

    def store(frames):
        own = shared.value
        for pdf in frames:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "embedding": pdf["embedding"], "lists": own.lists(_lift(np.stack(pdf["embedding"].to_numpy()), top))})

    stored = stash(rows.mapInPandas(store, "vec_id long, embedding array<double>, lists array<long>"), "lists")
    queries = rows.filter(F.col("vec_id") % every == 0)
    probes = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).toPandas()
    true = exact(probes, rows, k).join(stored.select("vec_id", "lists"), "vec_id").select("query_id", "lists").toPandas()
    lists_of = true.groupby("query_id")["lists"].apply(list).to_dict()
    ratio = _fitted_ratio(centroids, np.stack(probes["embedding"].to_numpy()), [lists_of.get(v, []) for v in probes["vec_id"]])

    def search(frames):
        own = shared.value
        for pdf in frames:
            q = _query(np.stack(pdf["embedding"].to_numpy()))
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "embedding": pdf["embedding"], "lists": [own.search(v, ratio) for v in q]})

    asked = stash(queries.select("vec_id", "embedding").mapInPandas(search, "vec_id long, embedding array<double>, lists array<long>"), "queries")
    none = F.lit(float("-inf"))
    one = lambda df: df.select("vec_id", "embedding", F.explode("lists").alias("list"), "least")
    base = one(stored.withColumn("least", none))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own, probe = pdf[pdf.kind == 0], pdf[pdf.kind == 1]
        if not len(own) or not len(probe):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return _top(probe.vec_id.to_numpy(), np.stack(probe.embedding.to_numpy()), own.vec_id.to_numpy(), np.stack(own.embedding.to_numpy()), k, probe.least.to_numpy())

    def from_lists(probes: DataFrame) -> DataFrame:
        return grouped(base, one(probes), "list").applyInPandas(compare, _FOUND)

    def bounded(probes: DataFrame, found: DataFrame) -> DataFrame:
        """``probes`` with the k-th best score so far as ``least``."""
        worst = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
        return probes.join(worst, "vec_id", "left").withColumn("least", F.coalesce("least", none))

    guide = rows.orderBy(F.xxhash64("vec_id", F.lit(2)), "vec_id").limit(_bounded(GUIDE, GUIDE_BYTES, size)).select("vec_id", "embedding").toPandas()
    known = spark.sparkContext.broadcast((guide["vec_id"].to_numpy(), np.stack(guide["embedding"].to_numpy())))  # GUIDE rows

    def against_sample(frames):
        ids, x = known.value
        for pdf in frames:
            yield _top(pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"].to_numpy()), ids, x, k)

    first = bounded(asked, asked.select("vec_id", "embedding").mapInPandas(against_sample, _FOUND))
    lead = stash(_best(from_lists(first.withColumn("lists", F.slice("lists", 1, LEAD))), k).select("query_id", "vec_id", "score"), "found")
    second = bounded(first.filter(F.size("lists") > LEAD).withColumnRenamed("least", "before"), lead).withColumn("least", F.greatest("least", "before")).drop("before")
    rest = from_lists(second.withColumn("lists", F.expr(f"slice(lists, {LEAD + 1}, size(lists))")))
    found = stash(_best(lead.union(rest.select("query_id", "vec_id", "score")), k), "found")
    # Queries for which their lists hold fewer than k rows above the bound: without a bound, then through all lists.
    for every_list in (False, True):
        counted = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("c"))
        short = asked.join(counted, "vec_id", "left").filter(F.coalesce("c", F.lit(0)) < min(k, n - 1)).drop("c")
        short = stash(short.withColumn("least", none), "short")
        if short.isEmpty():
            break
        if every_list:
            short = short.withColumn("lists", F.sequence(F.lit(0), F.lit(len(centroids.centres) - 1)).cast("array<long>"))
        again = _best(from_lists(short), k)
        found = stash(found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*again.columns).union(again), "found")
    return found
