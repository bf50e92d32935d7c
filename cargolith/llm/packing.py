"""Best-fit packing by a configuration linear program over the length histogram (operator 6).

Texts are tokenized where they are read; only piece lengths matter afterwards. Their histogram has at most
``capacity`` entries whatever the input. The program, least total of configurations (multisets of lengths
within the capacity) that cover the histogram, is solved by multiplicative weights: a knapsack by dynamic
programming prices all configurations under the present weights, those near the best value are taken in a
small step, and the weights of what they cover fall. Its solution is rounded down at several shares of itself;
what a rounding leaves is packed largest first, each gap by the largest piece that fits, and the rounding with
the fewest sequences counts. Pieces find their place by arithmetic on their rank among pieces of their length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cargolith.llm.common import like, stash
from cargolith.llm.tokens import byte_coder, text_batches

#: Rounds at most; how much of a length's need one round covers at most; how fast a covered length's weight falls;
#: how near to the best value a configuration must come to be taken.
ROUNDS, STEP, RATE, NEAR = 300, 0.3, 3.0, 0.005
#: Shares of the program's solution that rounding tries; what a share leaves goes to best fit.
SHARES = (1.0, 0.9, 0.8, 0.65, 0.5, 0.35, 0.2, 0.1)


def _knapsack(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of any multiset of lengths within 0, 1, ... ``capacity`` (room may stay), and the length it takes last.

    ``values`` is -inf for lengths not on offer (index 0 is length 1); 0 stands for no length.
    """
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    offered = np.flatnonzero(values > -np.inf)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = offered[: np.searchsorted(offered, c)]
        if len(fits):
            gain = best[c - 1 - fits] + values[fits]
            top = int(gain.argmax())
            if gain[top] > best[c]:
                best[c], last[c] = gain[top], fits[top] + 1
    return best, last


def _filled(last: np.ndarray, room: int) -> list[int]:
    """Lengths of the best multiset within ``room``."""
    out = []
    while room > 0:
        if last[room]:
            out.append(int(last[room]))
            room -= out[-1]
        else:
            room -= 1
    return out


def fractional(histogram: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Configurations (lengths, falling) and how often each is used: a fractional cover of ``histogram``.

    Multiplicative weights: a length's weight starts at its share of the capacity and falls by exp(-RATE) on
    the way to full cover. One knapsack prices all configurations; those that start with any length and come
    within NEAR of the best value are taken together, each in a step that no length covers more than STEP in.
    """
    need = histogram.astype(float)
    covered, use = np.zeros(capacity), {}
    sizes = np.arange(1, capacity + 1)
    for _ in range(rounds):
        open_ = (need > 0) & (covered < 1)
        if not open_.any():
            break
        values = np.where(open_, sizes / capacity * np.exp(-RATE * covered), -np.inf)
        best, last = _knapsack(values, capacity)
        heads = np.flatnonzero(open_)
        worth = values[heads] + best[capacity - 1 - heads]
        taken = []
        for k in heads[worth >= (1 - NEAR) * worth.max()]:
            config = tuple(sorted([int(k) + 1, *_filled(last, capacity - 1 - int(k))], reverse=True))
            lengths, each = np.unique(np.array(config) - 1, return_counts=True)
            taken.append((config, lengths, each, float((need[lengths] / each).min())))
        unique = {t[0]: t for t in taken}.values()
        load = np.zeros(capacity)
        for _, lengths, each, most in unique:
            load[lengths] += each * most / need[lengths]
        for config, lengths, each, most in unique:
            step = STEP * most / load[lengths].max()
            use[config] = use.get(config, 0.0) + step
            covered[lengths] += each * step / need[lengths]
    return use


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Largest first, each gap by the largest piece that fits; equal sequences together."""
    left, chosen = left.copy(), []
    while left.any():
        counts, room = np.zeros(capacity, np.int64), capacity
        while True:
            fit = np.flatnonzero((left[:room] - counts[:room]) > 0)
            if not len(fit):
                break
            counts[fit[-1]] += 1
            room -= fit[-1] + 1
        hit = counts > 0
        times = int((left[hit] // counts[hit]).min())
        chosen.append((counts, times))
        left -= counts * times
    return chosen


def _rounded(use: dict[tuple[int, ...], float], histogram: np.ndarray, capacity: int, share: float) -> list[tuple[np.ndarray, int]]:
    """Whole times of a share of each configuration, most used first, and best fit for the pieces left."""
    left, chosen = histogram.astype(np.int64).copy(), []
    for config, x in sorted(use.items(), key=lambda e: (-e[1], e[0])):
        if x * share < 1 - 1e-9:
            break
        counts = np.bincount(np.array(config) - 1, minlength=capacity)
        hit = counts > 0
        times = int(min(np.floor(x * share + 1e-9), (left[hit] // counts[hit]).min()))
        if times > 0:
            chosen.append((counts, times))
            left -= counts * times
    return chosen + _best_fit(left, capacity)


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(counts per length, times used) that cover ``histogram`` (index 0 is length 1) exactly.

    The program's solution is rounded down at several shares of itself, and the rounding with the fewest
    sequences is returned; the larger share wins a tie.
    """
    use = fractional(histogram, capacity)
    return min((_rounded(use, histogram, capacity, share) for share in SHARES), key=lambda chosen: sum(n for _, n in chosen))


def _slots(chosen: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, ...]:
    """Per length and configuration, in order: length, first rank, pieces per sequence, first sequence, offset."""
    rows, ranks, base = [], {}, 0
    for counts, times in chosen:
        offset = 0
        for k in np.flatnonzero(counts)[::-1]:
            length, each = int(k) + 1, int(counts[k])
            rows.append((length, ranks.get(length, 0), each, base, offset))
            ranks[length] = ranks.get(length, 0) + each * times
            offset += length * each
        base += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else tuple(np.zeros((5, 0), np.int64))


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the place among pieces of its length in its task (task, nth)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task, seen = byte_coder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            for i, j in text_batches(texts):
                flat, starts = encode(texts[i:j])
                rows = []
                for k in range(i, j):
                    own = np.append(flat[starts[k - i] : starts[k - i + 1]], end_id).astype("<u4")
                    n, at = len(own), 0
                    cut = n % capacity or capacity
                    piece = 0
                    while at < n:
                        rows.append((ids[k], piece, at, cut - at, zlib.crc32(own[at:cut]), task, int(seen[cut - at])))
                        seen[cut - at] += 1
                        at, cut, piece = cut, cut + capacity, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()], strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    narrow = like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def packed(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: each piece of each row of ``docs``.

    A text's ids end in ``end_id``; only longer ones are cut, into pieces of ``capacity`` of which the first
    may be shorter. NULL and empty texts are one piece of one id. Rows that repeat a doc_id, or have none,
    are packed like any other. An empty table gives no row.
    """
    spark = docs.sparkSession
    held = stash(pieces(docs, os.fspath(path), capacity, end_id), "pieces")
    counts = held.groupBy("task", "length").agg(F.count("*").alias("c"))
    # One row per task and length: pieces of the same length in earlier tasks.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(capacity, np.int64)
    for r in held.groupBy("length").count().collect():  # at most ``capacity`` rows
        histogram[r["length"] - 1] = r["count"]
    length, first, each, sequence, offset = _slots(plan(histogram, capacity))
    edge = np.searchsorted(length, np.arange(capacity + 2))
    shared = spark.sparkContext.broadcast((first, each, sequence, offset, edge))  # bounded by capacity and rounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, each, sequence, offset, edge = shared.value
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = np.zeros(len(size), np.int64)
            for own in np.unique(size):
                rows = size == own
                lo, hi = edge[own], edge[own + 1]
                slot[rows] = lo + np.searchsorted(first[lo:hi], rank[rows], "right") - 1
            within = rank - first[slot]
            out = [sequence[slot] + within // each[slot], offset[slot] + within % each[slot] * size]
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(c, pa.int64()) for c in out)], [*keep, "sequence_id", "offset"])

    ranked = held.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("task", "nth", "base")
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
