"""A byte-level convolutional network in numpy as quality classifier (operator 3).

Input channels of a byte: its value, and whether the ``GRAM`` bytes from it on occurred before in the text.
A filter is a table of weights per tap and byte value; it slides over chunks of ``CHUNK`` bytes that
overlap by ``OVERLAP`` and together cover the whole text. Each chunk gives the maximum of every filter and the
share of repeated bytes; the text's probability is the logistic function of a weighted sum of their means over
all chunks, after a rectifier. The gradient passes through each chunk's maximum only.

Fitting takes the ``SAMPLE`` labelled texts of ``LONGEST`` bytes or less with the smallest hash of their id (``LIMIT``
bytes of them at most, all whole texts); these bounds are the only ones, every text is scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import like, mix, stash, text_slices

FILTERS, TAPS, CHUNK, OVERLAP, GRAM = 8, 5, 1024, 64, 6
SAMPLE, LIMIT, LONGEST, EPOCHS = 3000, 16_000_000, 1_000_000, 4
SEED = 3


def repeated(data: np.ndarray) -> np.ndarray:
    """1 where the GRAM bytes from a place on occurred before within the text (by a hash with room for four times as many)."""
    n = len(data) - GRAM + 1
    out = np.zeros(len(data), np.float32)
    if n <= 0:
        return out
    gram = np.zeros(n, np.uint64)
    for k in range(GRAM):
        gram |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    bits = max(10, int(n * 4).bit_length())
    spot = (mix(gram) >> np.uint64(64 - bits)).astype(np.int64)
    first = np.full(1 << bits, n, np.int32)
    place = np.arange(n, dtype=np.int32)
    first[spot[::-1]] = place[::-1]
    out[:n] = first[spot] < place
    return out


class Network:
    """Weights: ``table`` (tap, byte value, filter), ``repeat`` (filter), ``out`` (filter + 1), ``bias``."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.table = rng.normal(0, 0.1, (TAPS, 256, FILTERS)).astype(np.float32)
        self.repeat = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, FILTERS + 1).astype(np.float32)
        self.bias = np.float32(0)

    def forward(self, data: np.ndarray):
        """Probability of one text, and what the gradient needs. An empty text is one chunk of blanks."""
        if len(data) < TAPS:
            data = np.concatenate((data, np.full(TAPS - len(data), 32, np.uint8)))
        again = repeated(data)
        n = len(data) - TAPS + 1
        response = self.table[0][data[:n]]
        for t in range(1, TAPS):
            response += self.table[t][data[t : t + n]]
        response += again[:n, None] * self.repeat
        starts = np.arange(0, max(1, n - OVERLAP), CHUNK - OVERLAP)
        peaks = np.empty((len(starts), FILTERS), np.float32)
        spots = np.empty((len(starts), FILTERS), np.int64)
        share = np.empty(len(starts), np.float32)
        for k, s in enumerate(starts):
            own = response[s : s + CHUNK]
            spots[k] = own.argmax(axis=0)
            peaks[k] = own[spots[k], np.arange(FILTERS)]
            spots[k] += s
            share[k] = again[s : s + CHUNK].mean()
        features = np.append(np.maximum(peaks, 0).mean(axis=0), share.mean() * 4)
        z = float(features @ self.out + self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), (data, again, features, peaks, spots)

    def step(self, data: np.ndarray, label: float, rate: float) -> None:
        p, (data, again, features, peaks, spots) = self.forward(data)
        slope = np.float32(p - label)
        back = slope * self.out[:FILTERS] / len(peaks)
        self.out -= rate * slope * features
        self.bias -= np.float32(rate * slope)
        live = peaks > 0
        chunk, which = np.nonzero(live)
        at = spots[chunk, which]
        change = (rate * 4 * back[which]).astype(np.float32)
        for t in range(TAPS):
            np.subtract.at(self.table, (t, data[at + t], which), change)
        np.subtract.at(self.repeat, which, change * again[at])


def fit(texts: list[bytes], labels: list[int]) -> Network:
    """Trains on whole texts, in an order that depends on nothing but the seed; no text gives probability 1/2."""
    network = Network()
    if not texts:
        network.out[:] = 0
        return network
    mean = min(0.99, max(0.01, float(np.mean(labels))))
    network.bias = np.float32(np.log(mean / (1 - mean)))
    rng = np.random.default_rng(SEED)
    arrays = [np.frombuffer(t, np.uint8) for t in texts]
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(arrays)):
            network.step(arrays[k], float(labels[k]), 0.1 / (1 + epoch))
    return network


def with_fold(df: DataFrame) -> DataFrame:
    """Adds held_out: crc32 of the id as text leaves 1 when divided by 3 (a NULL id counts as held out)."""
    return df.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True)))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """The network of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality); held-out ids, NULL labels, NULL texts are not used.

    Rows that repeat an id count once: the smallest text, the largest label.
    """
    known = with_fold(like(labels, "doc_id", "quality").filter("doc_id is not null and quality is not null")).filter("not held_out")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = like(docs, "doc_id", "text").filter("text is not null")
    sizes = texts.select("doc_id", F.octet_length("text").alias("size")).groupBy("doc_id").agg(F.min("size").alias("size")).join(known, "doc_id")
    chosen = sizes.filter(F.col("size") <= LONGEST).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = texts.filter(F.octet_length("text") <= LONGEST).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    rows = stash(rows, "training")
    order = rows.select("doc_id", F.octet_length("text").alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # SAMPLE rows
    if not order and sizes.limit(1).count():
        raise ValueError(f"no labelled text has {LONGEST} bytes or less: nothing to fit on")
    within = [r.doc_id for r, so_far in zip(order, accumulate(r.size for r in order), strict=True) if so_far <= LIMIT]
    sample = sorted((r.doc_id, r.text, r.quality) for r in rows.filter(F.col("doc_id").isin(within)).collect())  # SAMPLE rows, LIMIT bytes
    return fit([t.encode() for _, t, _ in sample], [int(q > 0) for _, _, q in sample])


def scored(docs: DataFrame, network: Network, name: str = "score") -> DataFrame:
    """``docs`` with all rows and columns, and column ``name`` (0 to 1); NULL texts count as empty."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(network)  # some 40 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column("text")):
                values = [float(own.forward(data[offs[k] : offs[k + 1]])[0]) for k in range(j - i)]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())], [*part.schema.names, name])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``."""
    network = train(docs, labels)
    narrow = like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = with_fold(scored(narrow, network)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return out.select("doc_id", "held_out", "score", "predicted")
