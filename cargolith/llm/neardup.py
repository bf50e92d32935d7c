"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full shingle sets (operator 4).

A text's signature holds m chunks of w symbols (8 bits of a minimum hash each). By the pigeonhole principle
two signatures that differ in at most 2m - 1 symbols have a chunk with one error at most; each chunk is
therefore indexed w times, with one symbol left out, and all such pairs share a key. m is chosen from the
similarity so that a pair right on the threshold is missed with a probability under ``MISS``.

No bucket is ever expanded into all of its pairs. Equal shingle sets count once. Each text is first compared
with the smallest member of its buckets; what is connected by then needs no further comparison, so that
later rounds only look at buckets that still hold several components, and only at texts outside a bucket's
largest component. The last round compares all pairs left, inside the join by parity maps: a bit for each of ``MAP``
hash values tells whether an odd number of shingles has it, so that two maps differ in at most as many bits as the
sets differ in shingles. Pairs that differ in too many bits cannot reach the similarity; no other is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import components, drop_stash, few_files, like, mix, shingles, stash, text_slices, words

WIDTH = 7
MISS = 1e-5
#: Bits of a parity map, kept as MAP / 64 columns.
MAP = 1024
PARTS = [f"p{k}" for k in range(MAP // 64)]
#: Pairs left per text from which one more round with other pivots comes before the exact one.
DENSE = 500
ROUNDS = 3
#: Texts to a file of the tables in between.
TEXTS = 5_000


def chunk_count(similarity: float, width: int = WIDTH, miss: float = MISS) -> int:
    """The fewest chunks with which a pair of that similarity is missed with a probability under ``miss``."""
    hit = similarity**width + width * (1 - similarity) * similarity ** (width - 1)
    return 1 if hit >= 1 else max(1, int(np.ceil(np.log(miss) / np.log(1 - hit))))


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 2**64, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """doc_id, n (distinct shingles), two halves of the set's fingerprint, its parity map, signature."""
    m = chunk_count(similarity)
    symbols = m * WIDTH
    flips, factors = _multipliers(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_slices(batch.column("text")):
                hashes, _, _, first = words(data, offs)
                marks, at = shingles(hashes, first, size)
                rows = j - i
                odd = np.zeros((rows, MAP), np.uint8)
                n, f1, f2 = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
                for k in range(rows):
                    own = np.unique(marks[at[k] : at[k + 1]])
                    odd[k] = np.bincount((own >> np.uint64(20)) % np.uint64(MAP), minlength=MAP) & 1
                    n[k], f1[k], f2[k] = len(own), own.sum(dtype=np.uint64), mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                full = np.flatnonzero(n)
                least = np.zeros((rows, symbols), np.uint8)
                for c in range(symbols if len(full) else 0):
                    low = np.minimum.reduceat((marks ^ flips[c]) * factors[c], at[full])
                    least[full, c] = (mix(low) >> np.uint64(56)).astype(np.uint8)
                packed = np.packbits(odd, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, rows), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                     *(pa.array(packed[:, k].copy()) for k in range(len(PARTS))), pa.array([x.tobytes() for x in least], pa.binary())],
                    ["doc_id", "n", "f1", "f2", *PARTS, "signature"],
                )

    return like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, n long, f1 long, f2 long, {', '.join(f'{p} long' for p in PARTS)}, signature binary")


def index_keys(reps: DataFrame) -> DataFrame:
    """(key, doc): for each chunk of the signature and each symbol of it, the chunk without that symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                sig = np.stack([np.frombuffer(x, np.uint8) for x in part.column("signature").to_pylist()]).astype(np.uint64)
                rows, total = sig.shape
                chunks = sig.reshape(rows, total // WIDTH, WIDTH)
                weight = mix(np.arange(1, 1 + total, dtype=np.uint64)).reshape(1, -1, WIDTH) | np.uint64(1)
                terms = mix(chunks + np.uint64(1)) * weight
                keys = mix(terms.sum(axis=2, dtype=np.uint64)[:, :, None] - terms + mix(weight))
                ids = np.repeat(part.column("doc").to_numpy(zero_copy_only=False), total)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], ["key", "doc"])

    return reps.select("doc", "signature").mapInArrow(run, "key long, doc long")


def exact_links(pairs: DataFrame, docs: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets have 100 * intersection >= per_cent * union."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for _, _, data, offs in text_slices(column):
            hashes, _, _, first = words(data, offs)
            marks, at = shingles(hashes, first, size)
            out += [np.unique(marks[at[k] : at[k + 1]]) for k in range(len(offs) - 1)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                keep = []
                for x, y in zip(sets(part.column("text_a")), sets(part.column("text_b")), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= per_cent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = like(docs, "doc_id", "text")
    wide = pairs.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return wide.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, per_cent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for each row of ``docs`` (doc_id, text, others ignored).

    Texts are lower-cased (A-Z), cut into words at white space, and linked if the sets of their ``size``-word
    shingles have 100 * intersection >= per_cent * union. NULL and empty texts have an empty set and no link.
    Rows that repeat a doc_id are one node. A NULL doc_id is linked with nothing: component NULL, kept.
    """
    similarity = per_cent / 100
    narrow = like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = stash(signatures(narrow, size, similarity), "signatures")
    named = sigs.filter("n > 0 and doc_id is not null")
    same = ["n", "f1", "f2"]
    rows = sigs.count()
    classes = named.groupBy(*same).agg(F.min("doc_id").alias("doc"), *[F.min(p).alias(p) for p in PARTS], F.min("signature").alias("signature"))
    reps = stash(few_files(classes, rows, TEXTS), "classes")
    texts = reps.count()

    def kept(df: DataFrame, name: str) -> DataFrame:
        return stash(few_files(df, texts, TEXTS), name)

    copies = named.join(reps.select(*same, "doc"), same).filter("doc_id <> doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    keys = index_keys(reps)
    shared = keys.groupBy("key").agg(F.count("*").alias("c"), F.min("doc").alias("pivot")).filter("c > 1").drop("c")
    buckets = kept(keys.join(shared, "key"), "buckets")
    about = reps.select("doc", F.col("n").alias("size"), *PARTS)
    a_side, b_side = ([F.col(c).alias(f"{c}_{x}") for c in ["size", *PARTS]] for x in "ab")
    bits = " + ".join(f"bit_count({p}_a ^ {p}_b)" for p in PARTS)
    # Similarity s means a difference of (1 - s) / (1 + s) of both sizes together at most.
    possible = F.expr(f"({bits}) * {100 + per_cent} <= (size_a + size_b) * {100 - per_cent}")

    def worth(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes and parity maps allow the similarity."""
        x, y = about.select(F.col("doc").alias("a"), *a_side), about.select(F.col("doc").alias("b"), *b_side)
        return pairs.join(x, "a").join(y, "b").filter(possible).select("a", "b")

    first = buckets.filter("doc <> pivot").groupBy(F.col("doc").alias("a")).agg(F.min("pivot").alias("b"))
    links = [kept(exact_links(worth(first), narrow, size, per_cent), "links")]
    for turn in range(1, ROUNDS + 1):
        found = links[0]
        for more in links[1:]:
            found = found.union(more)
        joined = components(found, rows=found.count())
        held = buckets.select("key", "doc").join(joined.withColumnRenamed("node", "doc"), "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))
        parts = held.groupBy("key", "component").agg(F.count("*").alias("c"), F.min(F.struct(F.xxhash64("doc", F.lit(turn)), "doc")).alias("lead"))
        mixed = parts.groupBy("key").agg(
            F.count("*").alias("parts"), F.sum("c").alias("all"), F.max(F.struct("c", "component", F.col("lead.doc").alias("pivot"))).alias("main")
        ).filter("parts > 1").select("key", F.col("main.component").alias("main"), F.col("main.pivot").alias("pivot"), ((F.col("all") - F.col("main.c")) * F.col("all")).alias("work"))
        mixed = kept(mixed, "mixed")
        work = mixed.agg(F.sum("work").alias("w")).first().w or 0
        if not work:
            break
        open_ = kept(held.join(mixed.drop("work"), "key").join(about, "doc"), "open")
        aside = open_.filter("component <> main")
        if work > DENSE * texts and turn < ROUNDS:
            pairs = worth(aside.groupBy(F.col("doc").alias("a")).agg(F.min("pivot").alias("b")))
        else:
            x = aside.select("key", F.col("doc").alias("a"), F.col("component").alias("ca"), "main", *a_side)
            y = open_.select("key", F.col("doc").alias("b"), F.col("component").alias("cb"), *b_side)
            # Two texts that both stand aside meet once; one aside meets all of the main component.
            once = (F.col("ca") != F.col("cb")) & ((F.col("a") < F.col("b")) | (F.col("cb") == F.col("main"))) & possible
            pairs = x.join(y, (x["key"] == y["key"]) & once).select("a", "b").distinct()
        links.append(kept(exact_links(pairs, narrow, size, per_cent), "links"))
        drop_stash(open_)
        drop_stash(mixed)
        if not (work > DENSE * texts and turn < ROUNDS):
            break
    everything = copies
    for more in links:
        everything = everything.union(more)
    final = components(everything, rows=rows + sum(more.count() for more in links))
    drop_stash(buckets)
    out = sigs.select("doc_id", F.col("n").alias("n_shingles")).join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
