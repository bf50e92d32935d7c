"""Logistic models by Newton's method: one scan a step for all candidates and folds.

Tasks turn blocks of rows into the loss, its gradient and its second derivatives of every model that is still moving; the
steps are solved on these small matrices. A step takes the penalties exactly (coordinate descent where one is absolute), is
halved where the objective does not fall, and some ten steps reach the minimum that ``pyspark.ml`` approaches in up to a
hundred passes per fit. Objective, scaling (by standard deviations, intercepts free of penalty) and results are those of
``LogisticRegression``: two classes have one set of coefficients, more have one each. What reaches the driver has one
row per task, of the size of models x (features x classes) squared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.plans.linear import width_of
from cargolith.plans.packed import _here, _opened, _unpacked, blocks

CHUNK, STEPS = 1 << 11, 60


def fits(estimator) -> bool:
    """Whether the estimator is fitted here: intercept, scaled penalties, no bounds."""
    return (isinstance(estimator, LogisticRegression) and estimator.getStandardization() and estimator.getFitIntercept() and estimator.getFamily() == "auto"
            and not any(estimator.isDefined(p) for p in (estimator.lowerBoundsOnCoefficients, estimator.upperBoundsOnCoefficients,
                                                         estimator.lowerBoundsOnIntercepts, estimator.upperBoundsOnIntercepts, estimator.thresholds)))


def _joined(a, b):
    """Rows, weight, squared weights, mean and squared distances from it of two sets of rows."""
    if a is None:
        return b
    total = a[1] + b[1]
    if total == 0:
        return (a[0] + b[0], *a[1:])
    far = b[3] - a[3]
    return a[0] + b[0], total, a[2] + b[2], a[3] + far * (b[1] / total), a[4] + b[4] + far * far * (a[1] * b[1] / total)


def _scaled(x: np.ndarray, middle: np.ndarray, width: np.ndarray) -> np.ndarray:
    """1 and the scaled features [1 + feature, row]."""
    z = np.ones((len(x) + 1, x.shape[1]))
    np.subtract(x, middle[:, None], out=z[1:])
    z[1:] /= width[:, None]
    return z


def _chances(z: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities [row, model, set of coefficients] and the margins they come from; ``z`` is [feature, row], ``theta`` [model, set, feature]."""
    margin = (z.T @ theta.reshape(-1, len(z)).T).reshape(z.shape[1], *theta.shape[:2])
    if theta.shape[1] == 1:
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700))), margin
    e = np.exp(margin - margin.max(axis=2, keepdims=True))
    return e / e.sum(axis=2, keepdims=True), margin


def spreads(held: DataFrame, size: int) -> dict[tuple[int, float], tuple]:
    """Rows, weight, squared weights, means and squared distances by fold and label, from one scan."""
    opened, joined, _ = _here(_opened=_opened, _joined=_joined, _unpacked=_unpacked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for x, y, w, k in opened(batches, size):
            for key in {*zip(k.tolist(), y.tolist())}:
                own = (k == key[0]) & (y == key[1])
                v, u = x[:, own], w[own]
                total = u.sum()
                mean = v @ u / total if total else np.zeros(size)
                found[key] = joined(found.get(key), (float(own.sum()), float(total), float(u @ u), mean, (v - mean[:, None]) ** 2 @ u))
        for (k, y), v in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([y]), pa.array([np.concatenate([np.ravel(i) for i in v]).tolist()])], ["k", "y", "v"])

    out: dict = {}
    for r in held.mapInArrow(run, "k int, y double, v array<double>").collect():  # one row per task, fold and label
        v = np.array(r.v)
        out[r.k, r.y] = _joined(out.get((r.k, r.y)), (v[0], v[1], v[2], v[3 : 3 + size], v[3 + size :]))
    return out


def _sums(held: DataFrame, size: int, middle: np.ndarray, width: np.ndarray, thetas: np.ndarray, without: Sequence[int]):
    """Loss, gradient and second derivatives of each model on the rows outside its fold, from one scan."""
    models, sets, wide = thetas.shape
    cells = [(a, b) for a in range(sets) for b in range(a, sets)]
    upper = np.triu_indices(wide)
    # One product of matrices per model while they are few; products of features, shared by all models, otherwise.
    shared = models * len(cells) > 8
    opened, chances, scaled, _ = _here(_opened=_opened, _chances=_chances, _scaled=_scaled, _unpacked=_unpacked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, slope, bend = np.zeros(models), np.zeros((models * sets, wide)), np.zeros((len(upper[0]), models * len(cells)))
        for x_, y_, w_, k_ in opened(batches, size):
            for lo in range(0, len(y_), CHUNK):
                y, w, k = (v[lo : lo + CHUNK] for v in (y_, w_, k_))
                z = scaled(x_[:, lo : lo + CHUNK], middle, width)
                p, margin = chances(z, thetas)
                weight = np.where(k[:, None] == without, 0.0, w[:, None])
                if sets == 1:
                    truth = y[:, None, None]
                    m = margin[:, :, 0]
                    loss += (weight * (np.maximum(m, 0) - y[:, None] * m + np.log1p(np.exp(-np.abs(m))))).sum(axis=0)
                else:
                    truth = (y[:, None] == np.arange(sets))[:, None, :]
                    top = margin.max(axis=2)
                    own = np.take_along_axis(margin, y.astype(int)[:, None, None], axis=2)[:, :, 0]
                    loss += (weight * (top + np.log(np.exp(margin - top[:, :, None]).sum(axis=2)) - own)).sum(axis=0)
                slope += ((p - truth) * weight[:, :, None]).reshape(len(y), -1).T @ z.T
                curve = np.stack([weight * p[:, :, a] * ((a == b) - p[:, :, b]) for a, b in cells], axis=2).reshape(len(y), -1)
                if shared:
                    bend += np.concatenate([z[i:] * z[i] for i in range(wide)]) @ curve
                else:
                    for c in range(curve.shape[1]):
                        bend[:, c] += ((z * curve[:, c]) @ z.T)[upper]
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate((loss, slope.ravel(), bend.ravel())).tobytes()], pa.binary())], ["v"])

    total = sum(np.frombuffer(r.v) for r in held.mapInArrow(run, "v binary").collect())  # one row per task
    loss, slope, bend = np.split(total, [models, models + models * sets * wide])
    bend = bend.reshape(len(upper[0]), models, len(cells))
    whole = np.zeros((models, sets, wide, sets, wide))
    for c, (a, b) in enumerate(cells):
        square = np.zeros((models, wide, wide))
        square[:, upper[0], upper[1]] = square[:, upper[1], upper[0]] = bend[:, :, c].T
        whole[:, a, :, b] = whole[:, b, :, a] = square
    return loss, slope.reshape(models, sets * wide), whole.reshape(models, sets * wide, sets * wide)


def _aim(theta: np.ndarray, slope: np.ndarray, bend: np.ndarray, sharp: np.ndarray) -> np.ndarray:
    """The minimum of the quadratic at ``theta`` plus the absolute penalties ``sharp``."""
    if not sharp.any():
        return theta - np.linalg.lstsq(bend, slope, rcond=1e-12)[0]
    v = theta.copy()
    free = np.flatnonzero(np.diag(bend) > 0)
    for _ in range(10_000):
        before = v.copy()
        for j in free:
            pull = bend[j, j] * v[j] - slope[j] - bend[j] @ (v - theta)
            v[j] = np.sign(pull) * max(abs(pull) - sharp[j], 0.0) / bend[j, j]
        if np.abs(v - before).max(initial=0) <= 1e-12 * max(1.0, np.abs(v).max(initial=0)):
            break
    return v


class Fits:
    """Logistic models on the same blocks, each outside a fold of its own (none: -1)."""

    def __init__(self, held: DataFrame, size: int):
        self.held, self.size = held, size
        self.parts = spreads(held, size)
        self.sizes: dict[int, int] = {}
        for (k, _), part in self.parts.items():
            self.sizes[k] = self.sizes.get(k, 0) + int(part[0])
        self.classes = len({y for _, y in self.parts})
        whole = self._spread(-1)
        self.middle, width = whole if whole else (np.zeros(size), np.ones(size))
        self.width = np.where(width > 1e-12 * np.maximum(1.0, np.abs(self.middle)), width, 1.0)

    def sound(self, without: Sequence[int] = (-1,)) -> bool:
        """Whether all of the classes 0, 1, ... have weight outside each of these folds."""
        return self.classes > 1 and all(
            {y for (k, y), part in self.parts.items() if k != out and part[1] > 0} == {float(c) for c in range(self.classes)} for out in without)

    def _spread(self, out: int):
        got = None
        for (k, _), part in sorted(self.parts.items(), key=lambda p: p[0]):
            if k != out:
                got = _joined(got, part)
        if got is None:
            return None
        free = got[1] - got[2] / got[1] if got[1] else 0.0
        return got[3], np.sqrt(got[4] / free) if free > 0 else np.zeros(self.size)

    def solve(self, estimators: Sequence[LogisticRegression], without: Sequence[int]) -> np.ndarray:
        """Coefficients [model, set, 1 + feature] of scaled features, the intercept first."""
        sets, wide, count = 1 if self.classes == 2 else self.classes, self.size + 1, len(estimators)
        blunt, sharp = np.zeros((count, sets, wide)), np.zeros((count, sets, wide))
        for i, (e, out) in enumerate(zip(estimators, without, strict=True)):
            ratio = self._spread(out)[1] / self.width
            blunt[i, :, 1:] = e.getRegParam() * (1 - e.getElasticNetParam()) * ratio**2
            sharp[i, :, 1:] = e.getRegParam() * e.getElasticNetParam() * ratio
        blunt, sharp = blunt.reshape(count, -1), sharp.reshape(count, -1)
        weight = np.array([sum(part[1] for (k, _), part in self.parts.items() if k != out) for out in without])
        at, step = np.zeros((count, sets * wide)), np.zeros((count, sets * wide))
        share, value, fall = np.ones(count), np.full(count, np.inf), np.zeros(count)
        moving = list(range(count))
        for _ in range(STEPS):
            tried = at + share[:, None] * step
            loss, slope, bend = _sums(self.held, self.size, self.middle, self.width, tried[moving].reshape(-1, sets, wide), np.array([without[i] for i in moving]))
            still = []
            for j, i in enumerate(moving):
                new = loss[j] / weight[i] + (blunt[i] * tried[i] ** 2).sum() / 2 + (sharp[i] * np.abs(tried[i])).sum()
                if not new <= value[i] + 1e-4 * share[i] * fall[i] + 1e-14 * abs(value[i] if np.isfinite(value[i]) else 0.0) and share[i] > 1e-9:
                    share[i] /= 2
                    still.append(i)
                    continue
                at[i], value[i], share[i] = tried[i], new, 1.0
                lean = slope[j] / weight[i] + blunt[i] * at[i]
                aim = _aim(at[i], lean, bend[j] / weight[i] + np.diag(blunt[i]), sharp[i])
                step[i] = aim - at[i]
                fall[i] = lean @ step[i] + (sharp[i] * (np.abs(aim) - np.abs(at[i]))).sum()
                if -fall[i] > 1e-13 * max(1.0, abs(value[i])):
                    still.append(i)
                else:
                    at[i] = aim
            moving = still
            if not moving:
                break
        out = at.reshape(count, sets, wide)
        if sets > 1:
            out[:, :, 0] -= out[:, :, 0].mean(axis=1, keepdims=True)
            for i, e in enumerate(estimators):
                if e.getRegParam() == 0:
                    out[i] -= out[i].mean(axis=0)
        return out

    def hits(self, thetas: np.ndarray, within: Sequence[int]) -> np.ndarray:
        """Rows that each model predicts rightly inside a fold, from one scan."""
        size, middle, width, within = self.size, self.middle, self.width, np.array(within)
        opened, chances, scaled, _ = _here(_opened=_opened, _chances=_chances, _scaled=_scaled, _unpacked=_unpacked)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(len(thetas))
            for x_, y_, _, k_ in opened(batches, size):
                for lo in range(0, len(y_), CHUNK):
                    y, k = (v[lo : lo + CHUNK] for v in (y_, k_))
                    p, _ = chances(scaled(x_[:, lo : lo + CHUNK], middle, width), thetas)
                    guess = p[:, :, 0] > 0.5 if p.shape[2] == 1 else p.argmax(axis=2)
                    found += ((guess == y[:, None]) & (k[:, None] == within)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([found.tolist()])], ["v"])

        return sum(np.array(r.v) for r in self.held.mapInArrow(run, "v array<double>").collect())  # one row per task

    def model(self, estimator: LogisticRegression, theta: np.ndarray) -> LogisticRegressionModel:
        """An ordinary model on features as they come."""
        raw = theta[:, 1:] / self.width
        free = theta[:, 0] - raw @ self.middle
        if len(raw) > 1:
            free = free - free.mean()
        spark = self.held.sparkSession
        jvm, gateway = spark._jvm, spark.sparkContext._gateway

        def doubles(values):
            out = gateway.new_array(jvm.double, len(values))
            for i, v in enumerate(values):
                out[i] = float(v)
            return out

        linalg = jvm.org.apache.spark.ml.linalg
        matrix = linalg.DenseMatrix(len(raw), self.size, doubles(raw.ravel().tolist()), True)
        uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("logreg")
        model = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(uid, matrix, linalg.DenseVector(doubles(free.tolist())), self.classes, len(raw) > 1)
        return LogisticRegressionModel._from_java(model).setThreshold(estimator.getThreshold())


def fit_logistic(train: DataFrame, estimators: dict[str, LogisticRegression]) -> dict[str, LogisticRegressionModel]:
    """Fits all on the same blocks; labels that are not all of 0, 1, ... are left to ``pyspark.ml``."""
    return fit_outside(train, estimators, None, [-1])[-1] if estimators else {}


def fit_outside(train: DataFrame, estimators: dict[str, LogisticRegression], fold: str | None, without: Sequence[int]) -> dict[int, dict[str, LogisticRegressionModel]]:
    """For each fold of ``without`` the models of the rows outside it (-1: of all rows), from shared scans."""
    weight = next((e.getWeightCol() for e in estimators.values() if e.isDefined(e.weightCol) and e.getWeightCol()), None)
    held = blocks(train, weight, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        all_ = Fits(held, width_of(train))
        if not all_.sound(without):
            return {k: {n: e.fit(train.filter(F.col(fold) != k) if fold else train) for n, e in estimators.items()} for k in without}
        jobs = [(n, e, k) for k in without for n, e in estimators.items()]
        thetas = all_.solve([e for _, e, _ in jobs], [k for _, _, k in jobs])
        out: dict = {k: {} for k in without}
        for (n, e, k), t in zip(jobs, thetas, strict=True):
            out[k][n] = all_.model(e, t)
        return out
    finally:
        held.unpersist()
