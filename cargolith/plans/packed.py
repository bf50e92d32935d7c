"""Rows in blocks of few bytes, without loss, that scans in numpy read again and again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block, about.
BLOCK = 1 << 13


def _packed(values: np.ndarray) -> bytes:
    """Numbers in the smallest type that holds them exactly, its name first; few different ones as a list and places in it."""
    with np.errstate(all="ignore"):
        for kind in ("u1", "i2", "i4", "f4"):
            small = values.astype(kind)
            if np.array_equal(small.astype(float), values):
                return kind.encode() + small.tobytes()
    if len(np.unique(values[:1024])) <= 256:
        few, places = np.unique(values, return_inverse=True)
        if len(few) <= 256:
            return b"d" + bytes([len(few) - 1]) + few.tobytes() + places.astype(np.uint8).tobytes()
    return b"f8" + values.tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    if held[:1] == b"d":
        count = held[1] + 1
        return np.frombuffer(held, float, count, 2)[np.frombuffer(held, np.uint8, -1, 2 + 8 * count)]
    return np.frombuffer(held, bytes(held[:2]).decode(), -1, 2).astype(float)


def _here(**names):
    """Functions bound to what they use, sent to tasks by value where the package is not installed there."""
    import types

    scope = {"np": np}
    for name, f in names.items():
        scope[name] = types.FunctionType(f.__code__, scope, f.__name__, f.__defaults__)
    return [scope[n] for n in names]


def blocks(data: DataFrame, weight: str | None, fold: str | None) -> DataFrame:
    """Rows in blocks: features one after another, labels, weights and folds (0 without one), each in as few bytes as hold it
    exactly. Blocks are small: an executor's heap has no room for many arrays of megabytes at once."""
    packed, = _here(_packed=_packed)

    def block(held: list) -> pa.RecordBatch:
        x, *rest = (np.concatenate(c) for c in zip(*held))
        parts = [packed(column) for column in x.T]
        cells = [np.array([len(p) for p in parts], np.int32).tobytes() + b"".join(parts), *[packed(c) for c in rest]]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], list("xywk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            held.append([x, *(batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in "ywk")])
            rows += batch.num_rows
            if rows >= BLOCK:
                yield block(held)
                held, rows = [], 0
        if rows:
            yield block(held)

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    k = F.col(fold).cast("int") if fold else F.lit(0)
    rows = data.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), w.alias("w"), k.alias("k"))
    return rows.mapInArrow(run, "x binary, y binary, w binary, k binary")


def _opened(batches: Iterator[pa.RecordBatch], size: int):
    """Features [feature, row], labels, weights and folds of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            held = batch.column("x")[i].as_py()
            ends = 4 * size + np.cumsum(np.frombuffer(held, np.int32, size))
            x = np.array([_unpacked(held[lo:hi]) for lo, hi in zip([4 * size, *ends], ends)])
            y, w, k = (_unpacked(batch.column(c)[i].as_py()) for c in "ywk")
            yield x.reshape(size, len(y)), y, w, k.astype(np.int32)
