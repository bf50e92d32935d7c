"""Forests and boosted trees from histograms, for the estimators of ``pyspark.ml`` without tuning.

Features are cut into 32 bins once, over all rows, and kept as bytes. Then a level of trees takes one scan: tasks add up
labels per (tree, node, feature, bin) in numpy, and the sums are all that splits and leaves need. All trees of a forest
share the scans of a level; a boosted tree takes one scan a level. Gains, leaves, step sizes and losses are those of
``pyspark.ml``, whose forests take a pass per some trees and whose rounds take a pass over unpacked vectors each.
What reaches the driver has one row per node of a forest, or one per node and task of a boosted tree.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from math import ceil, exp, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.plans.linear import unpacked, width_of
from cargolith.plans.packed import _packed, _unpacked

BINS, BLOCK, REBASE = 32, 1 << 16, 10
_BLOCKS = "id long, bins binary, y binary, w binary, f binary"


def fits(estimator) -> bool:
    """Whether the estimator is fitted here; deep trees are left to ``pyspark.ml``."""
    return isinstance(estimator, (RandomForestRegressor, RandomForestClassifier, GBTRegressor, GBTClassifier)) and estimator.getMaxDepth() <= 6


def thresholds(data: DataFrame, size: int) -> list[list[float]]:
    """Per feature what parts its bins, from all rows: the middles between its values where they are few, quantiles otherwise."""
    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.array([]) for _ in range(size)]
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for i in range(size):
                if len(held[i]) <= BINS:
                    held[i] = np.unique(np.concatenate((held[i], x[:, i])))[: BINS + 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(size), [len(v) for v in held]), pa.int32()), pa.array(np.concatenate(held), pa.float64())], ["i", "v"])

    values = data.select(vector_to_array("features").alias("x")).mapInArrow(few, "i int, v double").distinct()
    found = {r.i: r.v for r in values.groupBy("i").agg(F.slice(F.sort_array(F.collect_set("v")), 1, BINS + 1).alias("v")).collect()}  # one row per feature
    many = [i for i in range(size) if len(found.get(i, [])) > BINS]
    out = [[(a + b) / 2 for a, b in zip(found.get(i, []), found.get(i, [])[1:])] for i in range(size)]
    if many:
        columns = unpacked(data, size)
        marks = data.agg(*[F.percentile_approx(columns[i], [k / BINS for k in range(1, BINS)], 1000).alias(f"q{i}") for i in many]).first()
        for i in many:
            out[i] = sorted(set(marks[f"q{i}"]))
    return out


def blocks(data: DataFrame, cuts: list[list[float]], weight: str | None) -> DataFrame:
    """Rows in blocks: bins of two features each as one number, labels and weights in as few bytes as hold them exactly,
    and boosting's sums so far (empty)."""
    size = len(cuts)
    edges = [np.array(c, dtype=float) for c in cuts]
    packed, pairs_of = _local(_packed), _local(_pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def block():
            x, y, w = (np.concatenate([h[i] for h in held]) for i in range(3))
            bins = np.stack([np.searchsorted(e, x[:, i], side="left").astype(np.uint8) for i, e in enumerate(edges)])
            cells = [(part << 32) + number, pairs_of(bins).tobytes(), packed(y), packed(w), b""]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(cells)], ["id", "bins", "y", "w", "f"])

        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            held.append((x, *(batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in "yw")))
            rows += len(x)
            if rows >= BLOCK:
                yield block()
                held, rows, number = [], 0, number + 1
        if rows:
            yield block()

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return data.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), w.alias("w")).mapInArrow(run, _BLOCKS)


def _places(bins: np.ndarray, split: dict[int, tuple[int, int]]) -> np.ndarray:
    """Per row the node it reaches; node i has the children 2 i + 1 and 2 i + 2."""
    at = np.zeros(bins.shape[1], dtype=np.uint8)
    for node in sorted(split):
        feature, cut = split[node]
        # Bytes only, without a choice per row: a row of this node moves on by node + 1, to the right by one more.
        move = (bins[feature] > cut).view(np.uint8)
        move += np.uint8(node + 1)
        move &= np.negative((at == node).view(np.uint8))
        at += move
    return at


def _pairs(bins: np.ndarray) -> np.ndarray:
    """Two features as one number: half the sums, from which those of each feature follow."""
    wide = bins.astype(np.int16)
    odd = np.zeros((len(wide) // 2 + len(wide) % 2, wide.shape[1]), np.int16)
    odd[: len(wide) // 2] = wide[1::2]
    return wide[::2] * np.int16(BINS) + odd


def _bins(pairs: np.ndarray, size: int) -> np.ndarray:
    """Bins by feature from those of pairs."""
    out = np.empty((2 * len(pairs), pairs.shape[1]), np.uint8)
    out[::2] = pairs >> 5
    out[1::2] = pairs & np.int16(BINS - 1)
    return out[:size]


def _add(total: np.ndarray, pairs: np.ndarray, rows: np.ndarray | slice | None, node: np.ndarray | None, weights: list[np.ndarray | None]) -> None:
    """Adds to ``total`` [node, feature, bin, sum] what ``rows`` (None: all, of one node) hold; ``weights`` may be None for a count."""
    nodes, features, _, sums = total.shape
    base = None if node is None else node.astype(np.int64) * (BINS * BINS)
    for p in range(len(pairs)):
        key = pairs[p].astype(np.int64) if rows is None else pairs[p][rows] + base
        for i, w in enumerate(weights):
            got = np.bincount(key, w, nodes * BINS * BINS).reshape(nodes, BINS, BINS)
            total[:, 2 * p, :, i] += got.sum(axis=2)
            if 2 * p + 1 < features:
                total[:, 2 * p + 1, :, i] += got.sum(axis=1)


def _add_own(total: np.ndarray, flat: np.ndarray, starts: np.ndarray, node: np.ndarray | None, table: np.ndarray, weights: list[np.ndarray], label: np.ndarray | None) -> None:
    """Adds to ``total`` [node, slot, bin, sum], where slot i of a node is its feature ``table`` [node, i]; a row's bins
    begin at ``starts`` in ``flat``. Two slots are counted as one number. ``label`` says which sum a row counts for."""
    nodes, slots, _, sums = total.shape
    base = 0 if node is None else node * (BINS * BINS)
    own = [flat[starts + (table[0, i] if node is None else table[:, i][node])] for i in range(slots)]
    for i in range(0, slots, 2):
        key = own[i].astype(np.int64)
        key *= BINS
        key += base
        if i + 1 < slots:
            key += own[i + 1]
        if label is not None:
            key *= sums
            key += label
            got = np.bincount(key, weights[0], nodes * BINS * BINS * sums).reshape(nodes, BINS, BINS, sums)
            total[:, i] += got.sum(axis=2)
            if i + 1 < slots:
                total[:, i + 1] += got.sum(axis=1)
            continue
        for k, w in enumerate(weights):
            got = np.bincount(key, w, nodes * BINS * BINS).reshape(nodes, BINS, BINS)
            total[:, i, :, k] += got.sum(axis=2)
            if i + 1 < slots:
                total[:, i + 1, :, k] += got.sum(axis=1)


def _best(total: np.ndarray, allowed: Sequence[int], classes: int) -> tuple[int, int, float, list[float], list[float], list[float]]:
    """(feature, last bin to the left, gain times weight, sums of the node, of its left and of its right child) of a
    node's sums [feature, bin, sum]; feature -1 where no split gains. Sums are weight and label, or weight by class."""
    def score(s: np.ndarray) -> np.ndarray:
        weight = s.sum(axis=-1) if classes else s[..., 0]
        square = (s * s).sum(axis=-1) if classes else s[..., 1] ** 2
        return np.divide(square, weight, out=np.zeros_like(square), where=weight > 0)

    left = total[allowed].cumsum(axis=1)
    whole = left[:1, -1:]
    right = whole - left
    heavy = [s.sum(axis=-1) if classes else s[..., 0] for s in (left, right)]
    gain = np.where((heavy[0] > 1e-9) & (heavy[1] > 1e-9), score(left) + score(right) - score(whole), -1.0)
    i, b = np.unravel_index(gain.argmax(), gain.shape)
    feature = int(allowed[i]) if gain[i, b] > 1e-12 * max(1.0, float(score(whole).max())) else -1
    return feature, int(b), float(gain[i, b]), whole[0, 0].tolist(), left[i, b].tolist(), right[i, b].tolist()


class TreeModel:
    """Trees with their weights; ``transform`` adds the prediction, for classes their probabilities too."""

    def __init__(self, kind: str, cuts: list[list[float]], trees: list[dict], weights: list[float], importances: list[float], classes: int = 1):
        self.kind, self.cuts, self.trees, self.weights, self._importances = kind, cuts, trees, weights, importances
        self.classes = classes  # of ``rest``: each has as many trees, one after another

    @property
    def featureImportances(self) -> DenseVector:
        if self.kind == "rest":
            raise AttributeError("boosted trees of one class against the rest have importances per class only")
        return DenseVector(self._importances)

    def to_json(self) -> str:
        trees = [{"split": {str(k): v for k, v in t["split"].items()}, "value": {str(k): v for k, v in t["value"].items()}} for t in self.trees]
        return json.dumps([self.kind, self.cuts, trees, self.weights, self._importances, self.classes])

    @staticmethod
    def from_json(text: str) -> TreeModel:
        kind, cuts, trees, weights, importances, *classes = json.loads(text)
        trees = [{part: {int(k): v for k, v in t[part].items()} for part in ("split", "value")} for t in trees]
        return TreeModel(kind, cuts, trees, weights, importances, *classes)

    def transform(self, df: DataFrame) -> DataFrame:
        score, share = _scorer(self), vector_to_array("features")
        if self.kind in ("mean", "sum"):
            return df.withColumn("prediction", score(share)[0])
        if self.kind == "rest":
            held = df.withColumn("__p", score(share))
            return held.withColumn("prediction", (F.array_position("__p", F.array_max("__p")) - 1).cast("double")).withColumn("rawPrediction", array_to_vector("__p")).drop("__p")
        held = df.withColumn("__p", score(share))
        best = (F.array_position("__p", F.array_max("__p")) - 1).cast("double")
        return held.withColumn("prediction", best).withColumn("probability", array_to_vector("__p")).drop("__p")


def _scorer(model: TreeModel):
    kind, weights = model.kind, model.weights
    edges = [np.array(c, dtype=float) for c in model.cuts]
    trees = [(t["split"], _values(t["value"])) for t in model.trees]
    places = _local(_places)
    classes = model.classes
    each = len(trees) // classes

    @F.arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(edges))
        bins = np.stack([np.searchsorted(e, x[:, i], side="left").astype(np.uint8) for i, e in enumerate(edges)])
        total = 0.0
        of = 0
        for (split, value), weight in zip(trees, weights, strict=True):
            own = (weight * value)[places(bins, split)]
            if kind == "rest":
                total = np.zeros((len(column), classes)) if of == 0 else total
                total[:, of // each] += own[:, 0]
                of += 1
            else:
                total = total + own
        if kind == "sign":
            one = 1.0 / (1.0 + np.exp(-2.0 * total))
            total = np.column_stack((1.0 - one[:, 0], one[:, 0]))
        elif kind == "vote":
            total = total / total.sum(axis=1, keepdims=True)
        return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(total).ravel()), total.shape[1]).cast(pa.list_(pa.float64()))

    return score


def _values(value: dict[int, list[float]]) -> np.ndarray:
    out = np.zeros((256, len(next(iter(value.values())))))
    for node, v in value.items():
        out[node] = v
    return out


def _local(function):
    """The function itself, sent to tasks by value where the package is not installed there."""
    import types

    scope = {"np": np, "BINS": BINS}
    for f in (_unpacked, _bins):
        scope[f.__name__] = types.FunctionType(f.__code__, scope, f.__name__)
    return types.FunctionType(function.__code__, scope, function.__name__, function.__defaults__)


def _arrays(row: dict, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of bins, bins, labels, and boosting's sums."""
    y = _unpacked(row["y"])
    f = np.frombuffer(row["f"]) if row["f"] else np.zeros(len(y))
    pairs = np.frombuffer(row["bins"], dtype=np.int16).reshape(-1, len(y))
    return pairs, _bins(pairs, size), y, f


def unfolded(row, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins by feature, labels and weights of a block."""
    _, bins, y, _ = _arrays({"bins": row.bins, "y": row.y, "f": b""}, size)
    return bins, y, _unpacked(row.w)


def _normed(values: np.ndarray) -> np.ndarray:
    return values / values.sum() if values.sum() > 0 else values


def forest(held: DataFrame, cuts: list[list[float]], trees: int, depth: int, seed: int, classes: int) -> TreeModel:
    """Trees on Poisson(1) copies of the rows; a node looks at a third of the features, or the root of their number for
    classes. ``classes`` is 0 for numbers."""
    size, sums = len(cuts), classes or 2
    share = min(size, ceil(sqrt(size)) if classes else ceil(size / 3))
    odds = np.cumsum([exp(-1) / factorial(k) for k in range(12)])
    copies = np.searchsorted(odds, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
    splits: list[dict] = [{} for _ in range(trees)]
    values: list[dict] = [{} for _ in range(trees)]
    gains = np.zeros((trees, size))
    open_: dict[tuple[int, int], list[int]] = {}

    def subset(tree: int, node: int) -> list[int]:
        return sorted(np.random.default_rng([seed, tree, node]).choice(size, share, replace=False).tolist())

    open_ = {(t, 0): subset(t, 0) for t in range(trees)}
    arrays, opened, places, add, best = (_local(x) for x in (_arrays, _unpacked, _places, _add_own, _best))
    for level in range(depth):
        if not open_:
            break
        nodes, first = 1 << level, (1 << level) - 1
        tables = {t: np.zeros((nodes, share), np.int64) for t, _ in open_}
        for (t, n), own in open_.items():
            tables[t][n - first] = own
        current, known = [dict(s) for s in splits], dict(open_)

        def scan(batches: Iterator[pa.RecordBatch], nodes=nodes, first=first, tables=tables, current=current, known=known) -> Iterator[pa.RecordBatch]:
            total = {t: np.zeros((nodes, share, BINS, sums)) for t in tables}
            seen = False
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i].as_py() for c in ("id", "bins", "y", "w")} | {"f": b""}
                    (_, bins, y, _), w, seen = arrays(row, size), opened(row["w"]), True
                    label, even = y.astype(np.int64) if classes else None, bool((w == 1).all())
                    flat, starts = np.ascontiguousarray(bins.T).ravel(), np.arange(len(y)) * size
                    for t, table in tables.items():
                        bag = copies[np.random.default_rng([seed, t, row["id"]]).integers(0, 1 << 16, len(y), dtype=np.uint16)]
                        # Only rows in the bag that reach this level are looked at, with the features of their node.
                        if level:
                            at = places(bins, current[t])
                            own = np.flatnonzero((bag > 0) & (at >= first))
                            node = at[own].astype(np.int64) - first
                        else:
                            own, node = np.flatnonzero(bag > 0), None
                        weight = bag[own].astype(float)
                        if not even:
                            weight *= w[own]
                        add(total[t], flat, starts[own], node, table, [weight] if classes else [weight, weight * y[own]], label[own] if classes else None)
            keys = [k for k in known if seen]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in keys], pa.int32()), pa.array([n for _, n in keys], pa.int32()), pa.array([total[t][n - first].tobytes() for t, n in keys], pa.binary())],
                ["tree", "node", "sums"])

        def choose(key, rows):
            total = np.zeros(share * BINS * sums)
            for cell in rows.column("sums"):
                total += np.frombuffer(cell.as_py())
            t, n = (k.as_py() for k in key)
            slot, *rest = best(total.reshape(share, BINS, sums), range(share), classes)
            row = (t, n, known[t, n][slot] if slot >= 0 else -1, *rest)
            return pa.Table.from_arrays(
                [pa.array([v], pa.int32() if i < 4 else pa.float64() if i == 4 else pa.list_(pa.float64())) for i, v in enumerate(row)],
                ["tree", "node", "feature", "cut", "gain", "whole", "left", "right"])

        found = held.mapInArrow(scan, "tree int, node int, sums binary").groupBy("tree", "node").applyInArrow(
            choose, "tree int, node int, feature int, cut int, gain double, whole array<double>, left array<double>, right array<double>")
        open_ = {}
        for r in found.collect():  # one row per node
            values[r.tree][r.node] = r.whole
            if r.feature >= 0:
                splits[r.tree][r.node] = (r.feature, r.cut)
                gains[r.tree, r.feature] += r.gain
                for child, part in ((2 * r.node + 1, r.left), (2 * r.node + 2, r.right)):
                    values[r.tree][child] = part
                    open_[r.tree, child] = subset(r.tree, child)
    made = [{"split": s, "value": {n: ([x / sum(v) for x in v] if classes else [v[1] / v[0]]) for n, v in own.items() if sum(v if classes else v[:1]) > 0}}
            for s, own in zip(splits, values, strict=True)]
    mean = _normed(sum(_normed(g) for g in gains))
    return TreeModel("vote" if classes else "mean", cuts, made, [1.0 / trees] * trees, mean.tolist())


def boosted(held: DataFrame, cuts: list[list[float]], rounds: int, depth: int, step: float, binary: bool, one: int | None = None) -> TreeModel:
    """Each tree fits the negative gradient of the squared error, or of the log loss of labels -1 and 1; with ``one``, label 1
    is that class and all others are -1. The sums so far are kept with the blocks every ten rounds; trees since then are
    applied in the scan. The root's counts are those of the first round.
    """
    size, held = len(cuts), held.select("bins", "y", "f")
    arrays, places, add, table = (_local(x) for x in (_arrays, _places, _add, _values))
    made: list[dict] = []
    weights: list[float] = []
    recent: list[tuple[dict, dict, float]] = []
    gains, mine = np.zeros(size), None

    def current(row, recent):
        pairs, bins, y, f = arrays(row, size)
        for split, value, weight in recent:
            f = f + (weight * table(value)[:, 0])[places(bins, split)]
        if one is not None:
            y = (y == one).astype(float)
        return pairs, bins, (2 * y - 1 if binary else y), f

    counts = None

    for r in range(rounds):
        split: dict = {}
        value: dict = {}
        open_ = [0]
        for level in range(depth):
            if not open_:
                break
            code = np.full(256, 255, np.uint8)
            code[open_] = np.arange(len(open_))

            def scan(batches: Iterator[pa.RecordBatch], split=dict(split), recent=list(recent), start=r == 0, root=level == 0, nodes=len(open_), code=code) -> Iterator[pa.RecordBatch]:
                total = np.zeros((nodes, size, BINS, 2 if start or not root else 1))
                for batch in batches:
                    for i in range(batch.num_rows):
                        pairs, bins, y, f = current({c: batch.column(c)[i].as_py() for c in ("bins", "y", "f")}, recent)
                        g = y if start else 4 * y / (1 + np.exp(2 * y * f)) if binary else 2 * (y - f)
                        if root:
                            add(total, pairs, None, None, [None, g] if start else [g])
                            continue
                        node = code[places(bins, split)]
                        inside = node != 255
                        rows = slice(None) if inside.all() else np.flatnonzero(inside)
                        add(total, pairs, rows, node[rows], [None, g[rows]])
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

            parts = (held if mine is None else mine).mapInArrow(scan, "sums binary").collect()  # one row per task, of the size of nodes x features x bins
            total = sum(np.frombuffer(p.sums) for p in parts).reshape(len(open_), size, BINS, -1)
            if level:
                sums_of = dict(zip(open_, total))
            else:
                counts = total[0, ..., 0] if r == 0 else counts
                sums_of = {0: np.stack((counts, total[0, ..., -1]), axis=-1)}
            ready, open_ = open_, []
            for n in ready:
                feature, cut, gain, whole, left, right = _best(sums_of[n], list(range(size)), 0)
                value[n] = whole
                if feature >= 0:
                    split[n] = (feature, cut)
                    gains[feature] += gain
                    value[2 * n + 1], value[2 * n + 2] = left, right
                    open_ += [2 * n + 1, 2 * n + 2]
        leaf = {n: [v[1] / v[0]] for n, v in value.items() if v[0] > 0}
        made.append({"split": split, "value": leaf})
        weights.append(1.0 if r == 0 else step)
        recent.append((split, leaf, weights[-1]))
        if len(recent) == REBASE and r + 1 < rounds:
            # From the first blocks with all trees: frames made of one another would double the text of the plan each time.
            every = [(t["split"], t["value"], w) for t, w in zip(made, weights, strict=True)]

            def rebase(batches: Iterator[pa.RecordBatch], recent=every) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    sums = [current({c: batch.column(c)[i].as_py() for c in ("bins", "y", "f")}, recent)[3].tobytes() for i in range(batch.num_rows)]
                    yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), pa.array(sums, pa.binary())], ["bins", "y", "f"])

            if mine is not None:
                mine.unpersist()
            mine = held.mapInArrow(rebase, "bins binary, y binary, f binary").persist(StorageLevel.MEMORY_AND_DISK)
            mine.count()
            recent = []
    if mine is not None:
        mine.unpersist()
    return TreeModel("sign" if binary else "sum", cuts, made, weights, _normed(gains).tolist())


def fit_trees(train: DataFrame, estimators: dict, classes: int = 2, cuts: list[list[float]] | None = None) -> dict[str, TreeModel]:
    """Fits forests and boosted trees with the parameters of their estimators, all on the same blocks. Folds of one frame
    may share the bins of the whole frame, which see no label."""
    if not estimators:
        return {}
    cuts = thresholds(train, width_of(train)) if cuts is None else cuts
    weight = next((e.getWeightCol() for e in estimators.values() if e.isDefined(e.weightCol) and e.getWeightCol()), None)
    held = blocks(train, cuts, weight).persist(StorageLevel.MEMORY_AND_DISK)
    out = {}
    try:
        for name, e in estimators.items():
            if isinstance(e, GBTClassifier) and classes > 2:
                own = [boosted(held, cuts, e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), True, one) for one in range(classes)]
                out[name] = TreeModel("rest", cuts, [t for m in own for t in m.trees], [w for m in own for w in m.weights], [], classes)
            elif isinstance(e, (GBTRegressor, GBTClassifier)):
                out[name] = boosted(held, cuts, e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), isinstance(e, GBTClassifier))
            else:
                out[name] = forest(held, cuts, e.getNumTrees(), e.getMaxDepth(), e.getSeed(), classes if isinstance(e, RandomForestClassifier) else 0)
    finally:
        held.unpersist()
    return out
