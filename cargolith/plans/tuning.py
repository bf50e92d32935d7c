"""Tuning of forests and boosted trees: all candidates of a grid over all folds, grown in tasks.

Candidates that share a part are grown once. A forest of 50 trees is the beginning of one of 200, a tree of depth 10 the
upper part of one of depth 30, and 50 rounds of boosting are the beginning of 200: one growth per fold, smallest leaf and
stretch of trees, or per fold, step size and depth, gives the errors of all of them. The training rows go to the tasks
as bins (bytes) and labels in one broadcast of ``ROWS`` rows at most, some 100 MB; more rows are left to ``pyspark.ml``,
fit by fit. Bins, gains, bags and step sizes are those of ``plans.trees``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from math import exp, factorial, gcd
from statistics import fmean, pstdev

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.plans.linear import width_of
from cargolith.plans.packed import _here
from cargolith.plans.trees import blocks, thresholds, unfolded

#: Rows that a task may hold as bins and labels.
ROWS = 1 << 22


def _split(table: np.ndarray, flat: np.ndarray, at: np.ndarray, node: np.ndarray, w: np.ndarray, wy: np.ndarray, count: int, least: float):
    """Best split of each of ``count`` nodes over its features ``table`` [node, slot]: (gain, feature, last bin to the left,
    weight and sum of the left child). ``at`` is where a row's bins begin in ``flat``, ``node`` its node."""
    best, feature, cut = np.full(count, -1.0), np.zeros(count, np.int64), np.zeros(count, np.int64)
    heavy, total = np.zeros(count), np.zeros(count)
    rows = np.arange(count)
    base = node * 32
    for slot in range(table.shape[1]):
        key = base + flat[at + table[node, slot]]
        left = np.bincount(key, w, count * 32).reshape(count, 32).cumsum(axis=1)
        sums = np.bincount(key, wy, count * 32).reshape(count, 32).cumsum(axis=1)
        whole, all_ = left[:, -1:], sums[:, -1:]
        right = whole - left
        sound = (left >= least) & (right >= least)
        gain = np.where(sound, sums**2 / np.where(sound, left, 1.0) + (all_ - sums) ** 2 / np.where(sound, right, 1.0) - all_**2 / whole, -1.0)
        b = gain.argmax(axis=1)
        found = gain[rows, b]
        better = found > best
        best[better], feature[better], cut[better] = found[better], table[better, slot], b[better]
        heavy[better], total[better] = left[rows, b][better], sums[rows, b][better]
    return best, feature, cut, heavy, total


def _tree(flat: np.ndarray, size: int, share: int, y: np.ndarray, bag: np.ndarray, train: np.ndarray, held: np.ndarray, least: float, depths: list, rng):
    """A tree on the bagged training rows (starts in ``flat``), level by level: its predictions for the held-out rows at each of ``depths``."""
    own = np.flatnonzero(bag)
    at, w = train[own], bag[own]
    wy = w * y[own]
    node, seen, seen_node = np.zeros(len(at), np.int64), np.arange(len(held)), np.zeros(len(held), np.int64)
    weight, total = np.array([w.sum()]), np.array([wy.sum()])
    p, out = np.full(len(held), total[0] / max(weight[0], 1.0)), []
    for level in range(max(depths)):
        if level in depths:
            out.append(p.copy())
        if not len(weight):
            continue
        table = rng.random((len(weight), size)).argpartition(share - 1, axis=1)[:, :share] if share < size else np.tile(np.arange(size), (len(weight), 1))
        gain, feature, cut, heavy, sums = _split(table, flat, at, node, w, wy, len(weight), least)
        goes = gain > 1e-12 * np.maximum(1.0, total**2 / weight)
        number = np.cumsum(goes) - 1
        child_weight = np.column_stack((heavy, weight - heavy))[goes].ravel()
        child_total = np.column_stack((sums, total - sums))[goes].ravel()
        value = child_total / np.where(child_weight > 0, child_weight, 1.0)
        # Held-out rows move on and take the child's value; those in a node without a split keep theirs.
        stay = goes[seen_node]
        seen, seen_node = seen[stay], seen_node[stay]
        seen_node = 2 * number[seen_node] + (flat[held[seen] + feature[seen_node]] > cut[seen_node])
        p[seen] = value[seen_node]
        stay = goes[node]
        at, node, w, wy = at[stay], node[stay], w[stay], wy[stay]
        node = 2 * number[node] + (flat[at + feature[node]] > cut[node])
        # Children too light for two leaves are closed at once.
        open_ = child_weight >= 2 * least
        number = np.cumsum(open_) - 1
        stay = open_[node]
        at, node, w, wy = at[stay], number[node[stay]], w[stay], wy[stay]
        stay = open_[seen_node]
        seen, seen_node = seen[stay], number[seen_node[stay]]
        weight, total = child_weight[open_], child_total[open_]
    out.append(p)
    return out


def _boost(flat: np.ndarray, size: int, y: np.ndarray, train: np.ndarray, held: np.ndarray, step: float, depth: int, rounds: list):
    """Boosted trees on the training rows: their predictions for the held-out rows after each of ``rounds`` trees."""
    f, p, out = np.zeros(len(train)), np.zeros(len(held)), []
    ones = np.ones(len(train))
    for r in range(max(rounds)):
        if r in rounds:
            out.append(p.copy())
        g = 2 * (y - f) if r else y
        at, node, w, wy, where = train, np.zeros(len(train), np.int64), ones, g, np.arange(len(train))
        seen, seen_node = np.arange(len(held)), np.zeros(len(held), np.int64)
        weight, total = np.array([float(len(train))]), np.array([g.sum()])
        own, other = np.full(len(train), total[0] / weight[0]), np.full(len(held), total[0] / weight[0])
        for _ in range(depth):
            if not len(weight):
                break
            table = np.tile(np.arange(size), (len(weight), 1))
            gain, feature, cut, heavy, sums = _split(table, flat, at, node, w, wy, len(weight), 1e-9)
            goes = gain > 1e-12 * np.maximum(1.0, total**2 / weight)
            number = np.cumsum(goes) - 1
            weight, total = np.column_stack((heavy, weight - heavy))[goes].ravel(), np.column_stack((sums, total - sums))[goes].ravel()
            value = total / weight
            if not goes.all():
                stay, stays = goes[node], goes[seen_node]
                at, node, w, wy, where, seen, seen_node = at[stay], node[stay], w[stay], wy[stay], where[stay], seen[stays], seen_node[stays]
            node = 2 * number[node] + (flat[at + feature[node]] > cut[node])
            seen_node = 2 * number[seen_node] + (flat[held[seen] + feature[seen_node]] > cut[seen_node])
            own[where], other[seen] = value[node], value[seen_node]
        rate = step if r else 1.0
        f += rate * own
        p += rate * other
    out.append(p)
    return out


def _parts(held, k: int):
    """Bins, where the rows of the other folds and of fold ``k`` begin in them, and their labels."""
    bins, y, fold, size = held
    inside = fold == k
    starts = np.arange(len(y)) * size
    return bins, size, starts[~inside], starts[inside], y[~inside], y[inside]


def _table(model: str, grid: list[dict], folds: list[int], errors: dict) -> list[tuple]:
    """(model, params, cv_mean, cv_std) per candidate; ``errors`` has a mean squared error per candidate and fold."""
    rows = []
    for i, p in enumerate(grid):
        each = [errors[i, k] for k in folds]
        rows.append((model, json.dumps(p), fmean(each), pstdev(each)))
    return rows


def tuned_trees(train: DataFrame, fold: str, grids: dict[str, list[dict]], seed: int) -> list[tuple] | None:
    """(model, params, cv_mean, cv_std) of the mean squared error for every candidate of ``random_forest`` and ``gradient_boost``;
    None where the rows are too many for a task."""
    spark, size = train.sparkSession, width_of(train)
    if train.count() > ROWS:
        return None
    cuts = thresholds(train, size)
    parts = sorted(blocks(train, cuts, fold).collect(), key=lambda r: r.id)  # ROWS rows at most
    parts = [unfolded(r, size) for r in parts]
    bins = np.concatenate([x.T for x, _, _ in parts]).ravel()
    y, of = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    del parts
    held = spark.sparkContext.broadcast((bins, y, of.astype(np.int32), size))
    folds = sorted({int(k) for k in of})
    forest, boost = grids["random_forest"], grids["gradient_boost"]
    split, tree, boosted, parted = _here(_split=_split, _tree=_tree, _boost=_boost, _parts=_parts)
    share = max(1, -(-size // 3))
    odds = np.cumsum([exp(-1) / factorial(k) for k in range(12)])
    copies = np.searchsorted(odds, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(float)
    counts = sorted({p["numTrees"] for p in forest})
    each = reduce(gcd, counts)
    depths = sorted({p["maxDepth"] for p in forest})
    rounds = sorted({p["maxIter"] for p in boost})
    grown = sorted({(p["stepSize"], p["maxDepth"]) for p in boost}, key=lambda c: -c[1])
    jobs = [("gradient_boost", float(s), d, k, 0) for s, d in grown for k in folds]
    jobs += [("random_forest", float(m), 0, k, c) for c in range(max(counts) // each) for m in sorted({p["minInstancesPerNode"] for p in forest}) for k in folds]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                flat, wide, rows, others, own, wanted = parted(held.value, job["fold"])
                if job["model"] == "gradient_boost":
                    got = boosted(flat, wide, own, rows, others, job["a"], job["b"], rounds)
                    values = [float(((p - wanted) ** 2).mean()) for p in got]
                    yield pa.RecordBatch.from_pylist([job | {"errors": values, "sums": b""}], schema)
                    continue
                total = np.zeros((len(depths), len(others)))
                for t in range(job["c"] * each, (job["c"] + 1) * each):
                    rng = np.random.default_rng([seed, t, job["fold"]])
                    bag = copies[rng.integers(0, 1 << 16, len(rows), dtype=np.uint16)]
                    total += tree(flat, wide, share, own, bag, rows, others, job["a"], depths, rng)
                yield pa.RecordBatch.from_pylist([job | {"errors": [], "sums": total.tobytes()}], schema)

    def add(key, chunks):
        _, least, k = (v.as_py() for v in key)
        wanted, total, out = parted(held.value, k)[5], 0.0, []
        for row in sorted(chunks.select(["c", "sums"]).to_pylist(), key=lambda r: r["c"]):
            total = total + np.frombuffer(row["sums"]).reshape(len(depths), -1)
            trees = (row["c"] + 1) * each
            if trees in counts:
                out += [{"model": "random_forest", "a": least, "b": d, "fold": k, "c": trees, "error": float(((s / trees - wanted) ** 2).mean())} for d, s in zip(depths, total)]
        return pa.Table.from_pylist(out, pa.schema([("model", pa.string()), ("a", pa.float64()), ("b", pa.int32()), ("fold", pa.int32()), ("c", pa.int32()), ("error", pa.float64())]))

    kinds = "model string, a double, b int, fold int, c int"
    schema = pa.schema([("model", pa.string()), ("a", pa.float64()), ("b", pa.int32()), ("fold", pa.int32()), ("c", pa.int32()),
                        ("errors", pa.list_(pa.float64())), ("sums", pa.binary())])
    # One job a task, the long ones first.
    rdd = spark.sparkContext.parallelize(jobs, len(jobs))
    done = spark.createDataFrame(rdd, kinds).mapInArrow(grow, kinds + ", errors array<double>, sums binary").persist()
    try:
        errors: dict = {}
        for r in done.filter(F.col("model") == "gradient_boost").select("a", "b", "fold", "errors").collect():  # one row per job
            for n, e in zip(rounds, r.errors, strict=True):
                errors["gradient_boost", n, r.a, r.b, r.fold] = e
        sums = done.filter(F.col("model") == "random_forest").groupBy("model", "a", "fold").applyInArrow(add, kinds + ", error double")
        for r in sums.collect():  # one row per candidate and fold
            errors["random_forest", r.c, r.a, r.b, r.fold] = r.error
    finally:
        done.unpersist()
        held.destroy()
    found = {(i, k): errors["random_forest", p["numTrees"], float(p["minInstancesPerNode"]), p["maxDepth"], k] for i, p in enumerate(forest) for k in folds}
    rows = _table("random_forest", forest, folds, found)
    found = {(i, k): errors["gradient_boost", p["maxIter"], float(p["stepSize"]), p["maxDepth"], k] for i, p in enumerate(boost) for k in folds}
    return rows + _table("gradient_boost", boost, folds, found)
