"""Linear regression from sufficient statistics.

One aggregate per fold gives the counts, sums and products of features and label. Every candidate of every
penalty is then solved on these small matrices, and its error on a held-out fold follows from the same sums:
tuning reads the data once, whatever the number of candidates and folds. What reaches the driver has the size
of the feature count squared, per fold.

Features are scaled by median and quartile distance first (1 where that is 0), as the penalties depend on the
scale. The scaler is fitted on all training rows, not per fold: it never sees a label.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.plans.packed import _here, _opened, _unpacked, blocks

# Penalties and mixing shares that tuning tries.
GRIDS = {
    "ridge": {"alpha": [0.1, 1.0, 10.0, 100.0]},
    "lasso": {"alpha": [0.1, 1.0, 10.0, 100.0]},
    "elastic_net": {"alpha": [0.1, 1.0, 10.0], "l1_ratio": [0.1, 0.5, 0.9]},
}
# Parameters without tuning.
DEFAULTS = {"ridge": {"alpha": 1.0}, "lasso": {"alpha": 1.0}, "elastic_net": {"alpha": 1.0, "l1_ratio": 0.5}}


@dataclass
class Moments:
    """Count, sums and products of some rows; those of two sets of rows add up."""

    n: float
    x: np.ndarray
    xx: np.ndarray
    y: float
    xy: np.ndarray
    yy: float

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.x + other.x, self.xx + other.xx, self.y + other.y, self.xy + other.xy, self.yy + other.yy)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.x - other.x, self.xx - other.xx, self.y - other.y, self.xy - other.xy, self.yy - other.yy)

    def centred(self) -> tuple[np.ndarray, np.ndarray]:
        """Products of features, and of features and label, about their means."""
        return self.xx - np.outer(self.x, self.x) / self.n, self.xy - self.x * self.y / self.n

    def squared_error(self, intercept: float, coefficients: np.ndarray) -> float:
        """Mean of (y - intercept - coefficients . x)^2 over the rows."""
        b, w = intercept, coefficients
        total = self.yy - 2 * b * self.y - 2 * w @ self.xy + self.n * b * b + 2 * b * (w @ self.x) + w @ self.xx @ w
        return max(0.0, float(total)) / self.n


@dataclass
class Scale:
    """(x - middle) / width per feature."""

    middle: np.ndarray
    width: np.ndarray


def unpacked(data: DataFrame, size: int) -> list[Column]:
    return [vector_to_array("features")[i] for i in range(size)]


def width_of(data: DataFrame) -> int:
    """Features of a design frame, from its schema's attributes."""
    return int(data.schema["features"].metadata["ml_attr"]["num_attrs"])


@contextmanager
def held_blocks(data: DataFrame, fold: str | None = None):
    """Blocks of the rows, kept while the scaler and the sums are taken from them."""
    held = blocks(data, None, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values; the same function leads back, on their bits."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def quartiles(held: DataFrame, size: int) -> np.ndarray | None:
    """Exact interpolated quartiles [feature, 3] of blocks; None without rows.

    The numbers at the asked-for positions are found from their upper bits down, 12 to 16 bits a scan: a scan counts the
    next bits among the values that share the bits known so far. What reaches the driver has 65,536 rows per feature at most
    in the first scan (some hundreds for real numbers), and 4,096 per feature and position in the others.
    """
    opened, ordered, _ = _here(_opened=_opened, _ordered=_ordered, _unpacked=_unpacked)
    known: dict[int, list[int]] = {i: [0] for i in range(size)}
    ranks: list[int] = []
    spots: dict[tuple[int, int], tuple[int, int]] = {}  # (feature, position): bits known so far, position among values with these bits
    upper = 64
    for bits in (16, 12, 12, 12, 12):
        shift = upper - bits

        def run(batches: Iterator[pa.RecordBatch], known=dict(known), upper=upper, shift=shift, bits=bits) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[int, int], np.ndarray] = {}
            for x, *_ in opened(batches, size):
                for i, prefixes in known.items():
                    key = ordered(x[i])
                    for prefix in prefixes:
                        own = key if upper == 64 else key[(key >> upper) == prefix]
                        digit = (own >> shift) + (1 << 15) if upper == 64 else (own >> shift) & ((1 << bits) - 1)
                        if len(digit):
                            found[i, prefix] = found.get((i, prefix), 0) + np.bincount(digit, minlength=1 << bits)
            for (i, prefix), counts in found.items():
                at = np.flatnonzero(counts)
                columns = [pa.array(np.full(len(at), i, np.int32)), pa.array(np.full(len(at), prefix, np.int64)), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["i", "prefix", "digit", "n"])

        counted: dict[tuple[int, int], list[tuple[int, int]]] = {}
        sums = held.mapInArrow(run, "i int, prefix long, digit int, n long").groupBy("i", "prefix", "digit").agg(F.sum("n").alias("n"))
        for r in sums.collect():
            counted.setdefault((r.i, r.prefix), []).append((r.digit, r.n))
        if upper == 64:
            if not counted:
                return None
            rows = sum(n for _, n in counted[0, 0])
            ranks = sorted({int(end((rows - 1) * p)) for p in (0.25, 0.5, 0.75) for end in (np.floor, np.ceil)})
            spots = {(i, r): (0, r) for i in range(size) for r in ranks}
        for (i, r), (prefix, place) in spots.items():
            for digit, n in sorted(counted[i, prefix]):
                if place < n:
                    spots[i, r] = (digit - (1 << 15) if upper == 64 else (prefix << bits) + digit, place)
                    break
                place -= n
        known = {i: sorted({spots[i, r][0] for r in ranks}) for i in range(size)}
        upper = shift
    value = {spot: float(_back(key)) for spot, (key, _) in spots.items()}
    out = np.empty((size, 3))
    for i in range(size):
        for j, p in enumerate((0.25, 0.5, 0.75)):
            place = (rows - 1) * p
            low, high = value[i, int(np.floor(place))], value[i, int(np.ceil(place))]
            out[i, j] = low + (high - low) * (place - np.floor(place))
    return out


def _back(key: int) -> float:
    bits = np.array([key], np.int64)
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(float)[0]


def _scale(held: DataFrame, size: int) -> Scale:
    """Medians and quartile distances of all features of blocks."""
    marks = quartiles(held, size)
    if marks is None:
        return Scale(np.zeros(size), np.ones(size))
    width = marks[:, 2] - marks[:, 0]
    return Scale(marks[:, 1], np.where(width == 0, 1.0, width))


def _moments(held: DataFrame, scale: Scale) -> dict[int, Moments]:
    """Sufficient statistics of label and scaled features by fold, from one scan: tasks turn blocks into the products of
    (1, features, label) with themselves, which are then added."""
    size, middle, width = len(scale.middle), scale.middle, scale.width
    names = [f"s{i}" for i in range((size + 2) ** 2)]
    opened, _ = _here(_opened=_opened, _unpacked=_unpacked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for x, y, _, own in opened(batches, size):
            z = np.vstack((np.ones(len(y)), (x - middle[:, None]) / width[:, None], y))
            for k in np.unique(own).tolist():
                part = z[:, own == k]
                held[k] = held.get(k, 0.0) + part @ part.T
        columns = [pa.array(list(held), pa.int32()), *[pa.array([m.flat[i] for m in held.values()], pa.float64()) for i in range(len(names))]]
        yield pa.RecordBatch.from_arrays(columns, ["fold", *names])

    sums = held.mapInArrow(run, "fold int, " + ", ".join(f"{n} double" for n in names)).groupBy("fold").agg(*[F.sum(n).alias(n) for n in names])
    out = {}
    for r in sums.collect():  # one row per fold
        z = np.array(r[1:]).reshape(size + 2, size + 2)
        out[r.fold] = Moments(float(z[0, 0]), z[0, 1:-1], z[1:-1, 1:-1], float(z[0, -1]), z[1:-1, -1], float(z[-1, -1]))
    return out


def robust_scale(data: DataFrame, size: int) -> Scale:
    with held_blocks(data) as held:
        return _scale(held, size)


def moments(data: DataFrame, scale: Scale, fold: str | None = None) -> dict[int, Moments]:
    with held_blocks(data, fold) as held:
        return _moments(held, scale)


def scaled_moments(data: DataFrame, fold: str | None = None) -> tuple[Scale, dict[int, Moments]]:
    """Scaler of all rows and the sums by fold (0 without one); the rows are turned into blocks once."""
    with held_blocks(data, fold) as held:
        scale = _scale(held, width_of(data))
        return scale, _moments(held, scale)


def solve(kind: str, sums: Moments, alpha: float, l1_ratio: float | None = None) -> tuple[float, np.ndarray]:
    """Intercept and coefficients.

    Ridge minimises the sum of squared errors plus alpha |w|^2; lasso and elastic net the half mean of squared
    errors plus alpha (r |w|_1 + (1 - r) / 2 |w|^2), with r = 1 for lasso. Intercepts carry no penalty.
    """
    gram, product_ = sums.centred()
    if kind == "ridge":
        w = np.linalg.solve(gram + alpha * np.eye(len(gram)), product_)
    else:
        r = 1.0 if kind == "lasso" else l1_ratio
        w = _descend(gram / sums.n, product_ / sums.n, alpha * r, alpha * (1 - r))
    return float((sums.y - w @ sums.x) / sums.n), w


def _descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, rounds: int = 10_000) -> np.ndarray:
    """Coordinate descent on the matrices until no coefficient moves any more."""
    w = np.zeros(len(target))
    for _ in range(rounds):
        before = w.copy()
        for j in np.flatnonzero(np.diag(gram) > 0):
            pull = target[j] - gram[j] @ w + gram[j, j] * w[j]
            w[j] = np.sign(pull) * max(abs(pull) - l1, 0.0) / (gram[j, j] + l2)
        if np.abs(w - before).max(initial=0) <= 1e-12 * max(1.0, np.abs(w).max(initial=0)):
            break
    return w


class MomentRegression:
    """Fits one penalty on a design frame (features, label); the result is an ordinary linear regression model."""

    def __init__(self, kind: str, **parameters: float):
        self.kind, self.parameters = kind, parameters or DEFAULTS[kind]

    def fit(self, data: DataFrame) -> LinearRegressionModel:
        scale, parts = scaled_moments(data)
        return as_model(data, scale, *solve(self.kind, parts[0], **self.parameters))


def fit_together(data: DataFrame, learners: dict[str, MomentRegression]) -> dict[str, LinearRegressionModel]:
    """Several penalties from one scaler and one set of sums."""
    if not learners:
        return {}
    scale, parts = scaled_moments(data)
    sums = parts[0]
    return {name: as_model(data, scale, *solve(learner.kind, sums, **learner.parameters)) for name, learner in learners.items()}


def expanding_errors(data: DataFrame, fold: str, learners: dict[str, MomentRegression]) -> list[tuple[str, int, float]]:
    """(learner, fold, rmse): fitted on the folds before each one and scored on it, all from one scan of sums.

    The scaler is that of all rows.
    """
    if not learners:
        return []
    _, parts = scaled_moments(data, fold)
    out = []
    for name, learner in learners.items():
        before = parts[0]
        for k in range(1, max(parts) + 1):
            out.append((name, k, parts[k].squared_error(*solve(learner.kind, before, **learner.parameters)) ** 0.5))
            before = before + parts[k]
    return out


def as_model(data: DataFrame, scale: Scale, intercept: float, coefficients: np.ndarray) -> LinearRegressionModel:
    """The solution on features as they come, which can be saved and applied like any other model."""
    raw = coefficients / scale.width
    jvm = data.sparkSession._jvm
    vector = Vectors.dense(raw.tolist())
    held = jvm.org.apache.spark.ml.linalg.DenseVector(data.sparkSession.sparkContext._gateway.new_array(jvm.double, len(raw)))
    for i, v in enumerate(vector):
        held.values()[i] = float(v)
    model = jvm.org.apache.spark.ml.regression.LinearRegressionModel(jvm.org.apache.spark.ml.util.Identifiable.randomUID("linReg"), held, float(intercept - raw @ scale.middle))
    return LinearRegressionModel._from_java(model)


def candidates(kind: str) -> list[dict[str, float]]:
    """The full grid of a learner."""
    names = list(GRIDS[kind])
    return [dict(zip(names, values, strict=True)) for values in product(*GRIDS[kind].values())]


def tuned(data: DataFrame, fold: str, kinds: Sequence[str] = tuple(GRIDS)) -> tuple[dict[str, LinearRegressionModel], DataFrame]:
    """Best model per learner, and (model, params, cv_mean, cv_std) of the mean squared error for every candidate.

    ``fold`` numbers the held-out parts. The data are read for the scaler's quartiles and once for the sums.
    The best candidate has the least mean error; the earlier one wins a tie. It is solved on all rows.
    """
    scale, parts = scaled_moments(data, fold)
    total = sum(list(parts.values())[1:], next(iter(parts.values())))
    rows, best = [], {}
    for kind in kinds:
        scored = []
        for parameters in candidates(kind):
            errors = [held.squared_error(*solve(kind, total - held, **parameters)) for held in parts.values()]
            scored.append((float(np.mean(errors)), parameters))
            rows.append((kind, json.dumps(parameters), float(np.mean(errors)), float(np.std(errors))))
        best[kind] = as_model(data, scale, *solve(kind, total, **min(scored, key=lambda s: s[0])[1]))
    return best, data.sparkSession.createDataFrame(rows, "model string, params string, cv_mean double, cv_std double")
