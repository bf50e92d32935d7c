"""Target-distribution importance resampling (operator 12).

Hashed word runs of the corpus and of the target texts are counted per bucket; each bucket's gain, the log
ratio of its shares, goes to the tasks as one array of ``buckets`` numbers, and a document's weight is the mean
of what its runs read there. Scores (weight plus Gumbel noise from the id's digest) are written once, narrow.
The cutoff is then found by bisection on the number line: each job counts exactly how many rows lie above a few
pivots, first for the score, then for the doc_id among rows of the cutoff's score. Only the rows drawn are
range-partitioned, for their ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import drop_stash, like, stash
from cargolith.llm.lexemes import after_blank, crc_states, slices, spans
from cargolith.operators.ranking import row_numbers

#: Pivots counted in one job of the bisection.
PIVOTS = 15


def features(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bucket) of words, then (row, bucket) of pairs of consecutive words, part by part."""
    for i, data, offs, joined in slices(column, overlap=True):
        starts, ends, text = spans(data, offs)
        state = crc_states(data, starts, ends, np.full(len(starts), 0xFFFFFFFF, np.uint32))
        second = np.flatnonzero(text[1:] == text[:-1]) + 1
        pair = crc_states(data, starts[second], ends[second], after_blank(state[second - 1]))
        one = slice(1 if joined else 0, None)  # the first word of a joined part was counted before
        yield text[one] + i, (~state[one]) % np.uint32(buckets), text[second] + i, (~pair) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many words and pairs of all texts fall into each bucket; each task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, words, _, pairs in features(batch.column("text"), buckets):
                total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = like(texts, "text").select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over its share in the corpus, both smoothed by one."""
    k = len(corpus)
    all_corpus, all_target = float(corpus.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_corpus / ((float(s) + 1) * all_target))) for s, t in zip(corpus, target, strict=True)], np.int64)


def weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain; 0 without a word) of each row with a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for one, word, two, pair in features(batch.column("text"), len(gains)):
                own = np.bincount(one, minlength=n)
                words += own
                count += own + np.bincount(two, minlength=n)
                # Sums of whole numbers far below 2^53: exact in doubles.
                total += (np.bincount(one, gains[word], n) + np.bincount(two, gains[pair], n)).astype(np.int64)
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (words, count, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return _narrow(docs).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _narrow(docs: DataFrame) -> DataFrame:
    return like(docs, "doc_id", "text").filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def smallest_enough(rows: DataFrame, value: Column, low: int, high: int, wanted: int) -> int:
    """The smallest v in [low, high] with at least ``wanted`` rows of ``value`` <= v; one exact count job per step."""
    while low < high:
        pivots = sorted({low + (high - low) * i // (PIVOTS + 1) for i in range(1, PIVOTS + 1)})
        counts = rows.agg(*[F.count_if(value <= p).alias(f"n{k}") for k, p in enumerate(pivots)]).first()
        for p, n in zip(pivots, counts, strict=True):
            if n >= wanted:
                high = p
                break
            low = p + 1
    return low


def drawn(scored: DataFrame, per_cent: int, least_words: int) -> DataFrame:
    """``scored`` (persisted) with ``rank`` 1, 2, ... of the per_cent highest scores among documents of enough words.

    Ties go to the smaller doc_id, then to fewer runs and the smaller weight. No row is moved but those drawn.
    """
    able = scored.filter(F.col("n_words") >= least_words)
    score, key = F.col("score"), F.col("doc_id")
    ends = able.agg(F.count(F.lit(1)).alias("n"), F.min(-score).alias("lo"), F.max(-score).alias("hi")).first()
    wanted = per_cent * ends.n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    cut = -smallest_enough(able, -score, ends.lo, ends.hi, wanted)
    tied = able.filter(score == cut)
    there = able.agg(F.count_if(score > cut).alias("above")).first().above
    span = tied.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    last = smallest_enough(tied, key, span.lo, span.hi, wanted - there)
    taken = (F.col("n_words") >= least_words) & ((score > cut) | ((score == cut) & (key <= last)))
    ranked = row_numbers(scored.filter(taken).select(*columns), [score.desc(), key.asc(), "n_features", "weight"], "rank")
    # A doc_id that repeats at the cutoff can bring a row too many.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")).cast("long"))
    return ranked.select(*columns, "rank").unionByName(scored.filter(~taken).select(*columns, F.lit(None).cast("long").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, per_cent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score, rank (NULL: not drawn) of every row of ``docs`` that has a doc_id.

    ``target`` is a table with a column ``text``. NULL texts have no words: weight 0, never drawn where
    ``least_words`` is above 0. Rows without a doc_id are neither counted nor returned; a row that repeats a
    doc_id is a document of its own. An empty table gives no row; an empty target has gains all the same.
    """
    gains = bucket_gains(bucket_counts(_narrow(docs), buckets), bucket_counts(target, buckets))
    scored = weights(docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    held = stash(scored, "scores")
    out = stash(drawn(held, per_cent, least_words), "resampled")
    drop_stash(held)
    return out
