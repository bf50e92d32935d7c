"""Ranked lexical search over range-maximum posting lists (operator 13).

One scan of the corpus keeps, per document, its number of terms and the occurrences of those terms that the
items ask for; document frequencies and lengths are exact counts over all documents. The documents are dealt by
hash to shards of a bounded number of postings. A shard's documents stand by length, and each term has a posting
list of document positions and impacts with a sparse table over it, which names the greatest impact within any
range of positions in constant time.

An item's search is best-first over intervals of positions. The bound of an interval is the sum over the item's
terms of weight times the greatest impact there. The intervals with the highest bounds are split at the document
that gives the greatest single addend; that document is scored exactly, and the two rests get bounds of their
own. An interval goes when its bound is below the item's k-th best score so far, or equals it while all its
documents have larger ids than that one. Nothing else is left out, so the shard's best documents are exact; the
best of all shards' answers are the answer.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cargolith.llm.common import drop_stash, like, span_hashes, stash
from cargolith.llm.lexemes import slices, spans

#: Postings of a shard (about), intervals split at a time, bytes of item texts and items searched together.
POSTINGS, WIDTH, ITEM_BYTES, ITEMS = 1 << 19, 256, 8 << 20, 4096
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_UPPER = bytes(range(65, 91))


def item_terms(text: str | None) -> Counter:
    """Terms of a text with their repeats, as bytes."""
    raw = (text or "").encode()
    return Counter(_TERM.findall(raw.translate(bytes.maketrans(_UPPER, _UPPER.lower()))))


# --- the corpus, once per block of items -----------------------------------------------------


class Vocabulary:
    """Numbers the terms that the items ask for."""

    def __init__(self, terms: list[bytes]):
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        self.ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in terms], np.int64)
        hashes = span_hashes(self.data, self.starts, self.ends)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        if len(np.unique(hashes)) < len(terms):
            raise RuntimeError("two terms share a hash")

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are terms of the vocabulary, and their numbers. Hashes propose, bytes decide."""
        found = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.sorted, found), len(self.sorted) - 1)
        span = np.flatnonzero(self.sorted[at] == found)
        term = self.order[at[span]]
        size = ends[span] - starts[span]
        same = size == self.ends[term] - self.starts[term]
        span, term, size = span[same], term[same], size[same]
        before = np.cumsum(size) - size
        flat = np.arange(int(size.sum()))
        differs = data[flat + np.repeat(starts[span] - before, size)] != self.data[flat + np.repeat(self.starts[term] - before, size)]
        if differs.any():
            good = np.add.reduceat(differs, before) == 0
            span, term = span[good], term[good]
        return span, term


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n (terms of the text), terms, counts (those of the vocabulary), place: each row with a doc_id."""
    words = Vocabulary(terms)
    size = len(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys = np.zeros(batch.num_rows, np.int64), [np.zeros(0, np.int64)]
            for i, data, offs, _ in slices(batch.column("text")):
                starts, ends, text = spans(data, offs)
                n += np.bincount(text + i, minlength=batch.num_rows)
                span, term = words.numbers(data, starts, ends)
                # Combined per slice: a term that a long text repeats is one entry a slice.
                keys.append(np.stack(np.unique((text[span] + i) * size + term, return_counts=True)).reshape(2, -1))
            both = np.concatenate([k.reshape(2, -1) for k in keys], axis=1)
            key, where = np.unique(both[0], return_inverse=True)
            count = np.bincount(where, both[1], len(key)).astype(np.int32)
            offsets = pa.array(np.searchsorted(key, np.arange(batch.num_rows + 1) * size), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in ((key % size).astype(np.int32), count)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists, batch.column("place")], ["doc_id", "n", "terms", "counts", "place"])

    narrow = like(docs, "doc_id", "text").filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The place deals rows to shards; it holds the row's position, so that rows of one id do not stay together.
    placed = narrow.withColumn("place", F.xxhash64("doc_id", F.monotonically_increasing_id()))
    return placed.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>, place long")


# --- one shard -------------------------------------------------------------------------------


class Peaks:
    """A sparse table: where the greatest of ``values`` stands within any range (the first one of equals)."""

    def __init__(self, values: np.ndarray, longest: int | None = None):
        self.values = values
        levels = [np.arange(len(values), dtype=np.int32)]
        width = 1
        while 2 * width <= (len(values) if longest is None else longest):
            below = levels[-1]
            left, right = below[: len(below) - width], below[width:]
            level = np.where(values[right] > values[left], right, left)
            levels.append(np.concatenate((level, below[len(below) - width :])))
            width *= 2
        self.levels = np.stack(levels)
        self.log = np.zeros(max(2, (len(values) if longest is None else longest) + 1), np.int8)
        for k in range(1, len(levels)):
            self.log[1 << k :] = k

    def at(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For ranges that are not empty."""
        level = self.log[end - first]
        left, right = self.levels[level, first], self.levels[level, end - (1 << level.astype(np.int64))]
        return np.where(self.values[right] > self.values[left], right, left)


class Shard:
    """Posting lists over documents that stand by length, then id."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, documents: int, length: int, vocabulary: int):
        order = np.lexsort((ids, n))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids = ids[order]
        self.lowest = Peaks(-self.ids)
        doc = np.repeat(place, sizes)
        by = np.argsort(terms * len(ids) + doc)
        self.keys = (terms * len(ids) + doc)[by]
        self.doc = doc[by]
        m = 75 + (25 * n[order] * documents) // length
        tf = counts[by].astype(np.int64)
        self.edges = np.searchsorted(self.keys, np.arange(vocabulary + 1) * len(ids))
        self.impacts = Peaks((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.doc]), int(np.diff(self.edges).max(initial=1)))

    def _bounds(self, first: np.ndarray, end: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the greatest addends of each interval, and the document of the greatest of them."""
        row, col = np.nonzero(first < end)
        peak = self.impacts.at(first[row, col], end[row, col])
        addend = np.zeros(first.shape, np.int64)
        addend[row, col] = self.impacts.values[peak] * weights[col]
        doc = np.zeros(first.shape, np.int64)
        doc[row, col] = self.doc[peak]
        top = addend.argmax(axis=1) if first.shape[1] else np.zeros(len(first), np.int64)
        return addend.sum(axis=1), doc[np.arange(len(first)), top]

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and scores of the ``k`` best documents with a score above 0; ties to the smaller id."""
        there = (self.edges[terms] < self.edges[terms + 1]) & (weights > 0)
        terms, weights = terms[there], weights[there]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return ids, scores
        base = terms * len(self.ids)
        first, end = self.edges[terms][None, :], self.edges[terms + 1][None, :]
        low, high = np.zeros(1, np.int64), np.full(1, len(self.ids))
        bound, split = self._bounds(first, end, weights)
        while True:
            live = bound > 0
            if len(ids) == k:
                # Only intervals with a bound equal to the k-th score need a look at their smallest id.
                live = bound > scores[-1]
                tied = np.flatnonzero(bound == scores[-1])
                live[tied] = self.ids[self.lowest.at(low[tied], high[tied])] < ids[-1]
            if not live.all():
                first, end, low, high, bound, split = (x[live] for x in (first, end, low, high, bound, split))
            if not len(bound):
                return ids, scores
            now = np.argpartition(-bound, WIDTH)[:WIDTH] if len(bound) > WIDTH else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[now] = False
            doc = split[now]
            at = np.searchsorted(self.keys, base + doc[:, None])
            hit = (at < end[now]) & (self.doc[np.minimum(at, len(self.doc) - 1)] == doc[:, None])
            score = np.where(hit, self.impacts.values[np.minimum(at, len(self.doc) - 1)] * weights, 0).sum(axis=1)
            ids, scores = np.concatenate((ids, self.ids[doc])), np.concatenate((scores, score))
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
            children = np.concatenate((first[now], at + hit)), np.concatenate((at, end[now]))
            own = self._bounds(*children, weights)
            ranges = np.concatenate((low[now], doc + 1)), np.concatenate((doc, high[now]))
            first, end, low, high, bound, split = (np.concatenate((x[rest], y)) for x, y in zip((first, end, low, high, bound, split), (*children, *ranges, *own), strict=True))


# --- the search ------------------------------------------------------------------------------


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """Items in blocks of bounded size; the driver holds one block at a time."""
    block, size = [], 0
    rows = like(items, "item_id", "text").filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for r in rows.toLocalIterator():
        own = item_terms(r.text)
        if own:
            block.append((r.item_id, own))
            size += len(r.text)
        if size >= ITEM_BYTES or len(block) >= ITEMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _answers(docs: DataFrame, block: list[tuple[int, Counter]], k: int) -> tuple[DataFrame, DataFrame]:
    """item, doc_id, score: the best ``k`` of every shard for each item of the block; and the written postings."""
    terms = sorted({t for _, own in block for t in own})
    number = {t: i for i, t in enumerate(terms)}
    held = stash(postings(docs, terms), "postings")
    size = F.size("terms")
    total = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length"), F.sum(size).alias("postings")).first()
    frequency = np.zeros(len(terms), np.int64)
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term of the block
        frequency[r["term"]] = r["count"]
    documents, length = total.docs or 0, total.length or 0
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
    asked = [(np.array([number[t] for t in own], np.int64), np.array([c * weight[number[t]] for t, c in own.items()], np.int64)) for _, own in block]
    shards = max(1, -(-(total.postings or 0) // POSTINGS))

    def run(table: pa.Table) -> pa.Table:
        lists = table.column("terms").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        shard = Shard(
            table.column("doc_id").to_numpy(), table.column("n").to_numpy(), sizes, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            table.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False), documents, length, len(weight))
        found = [shard.best(t, w, k) for t, w in asked]
        item = np.repeat(np.arange(len(found)), [len(ids) for ids, _ in found])
        return pa.table({"item": pa.array(item, pa.int32()), "doc_id": np.concatenate([ids for ids, _ in found]), "score": np.concatenate([s for _, s in found])})

    dealt = held.filter(size > 0).withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
    return dealt.select("shard", "doc_id", "n", "terms", "counts").groupBy("shard").applyInArrow(run, "item int, doc_id long, score long"), held


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item, scores above 0, best first, ties to the smaller doc_id.

    NULL and empty texts hold no terms: such documents count in no figure and are never found, such items have
    no rows. Rows without an id take no part. A row that repeats a doc_id is a document of its own and can be
    found beside it; a row that repeats an item_id is a search of its own with ranks of its own. Empty tables
    give no rows.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        found, held = _answers(docs, block, k)
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
        top = stash(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "answers")
        drop_stash(held)
        named = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id long")
        out = out.unionByName(top.join(named, "item").select("item_id", "rank", "doc_id", "score"))
    return out
