"""Helpers shared by the operators: tables in the shared folder, hashed words, linked components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.session import scratch_path

# --- tables in the shared folder -------------------------------------------------------------


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet below ``spark.checkpoint.dir`` and reads it back: the lineage ends there.

    A lost executor re-reads the files; nothing depends on blocks that one machine held.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def drop_stash(df: DataFrame | None) -> None:
    """Removes the files of a stashed frame that nothing reads any more."""
    path = getattr(df, "_stash_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def few_files(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df`` in as many partitions as ``rows`` rows fill with ``each``, two a core at least; never more than it has.

    Where Hadoop's native library is missing, every file written starts a process (``chmod``) from the executor's
    JVM, which for a moment shares all of its memory: many small files cost time, and count that memory twice.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


#: Bytes of rows that go to Python at once; texts can be long, and each task holds several batches.
BATCH_BYTES = "8m"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of ``folder``; also bounds the batches between Spark and Python for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def like(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns of the input can clash with nothing."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


# --- words as numbers ------------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
#: Each byte's number in the rolling sum; A-Z have those of a-z.
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_STEP = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            run = np.full(max(n, 1 << 19), base, np.uint64)
            run[0] = 1
            _powers[k] = np.multiply.accumulate(run)
    return _powers[0][:n], _powers[1][:n]


def text_slices(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes; NULL counts as empty.

    A longer text stands alone: texts are never cut.
    """
    column = pc.fill_null(column.cast(pa.string()), "")
    n = len(column)
    if not n:
        return
    _, ends, raw = column.buffers()
    offs = np.frombuffer(ends, np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, and each text's first word (one more entry than texts).

    A word is a run of bytes other than blank and 0x09-0x0D; A-Z hash as a-z. All texts at once: a word's
    hash is a difference of prefix sums, divided by the power at its start.
    """
    n = len(data)
    gap = _SPACE[data]
    head = np.zeros(n + 1, bool)
    head[offs] = True
    before = np.concatenate(([True], gap[:-1])) if n else np.zeros(0, bool)
    after = np.concatenate((gap[1:], [True])) if n else np.zeros(0, bool)
    starts = np.flatnonzero(~gap & (before | head[:n]))
    ends = np.flatnonzero(~gap & (after | head[1 : n + 1])) + 1
    return span_hashes(data, starts, ends), starts, ends, np.searchsorted(starts, offs, "left")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; A-Z hash as a-z."""
    power, inverse = _power(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power, dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * inverse[starts])


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text by text, and each text's first one.

    A text with fewer words, but one at least, has its whole sequence as its only shingle; one without
    words has none.
    """
    n = len(hashes)
    counts = np.diff(first)
    runs = np.zeros(n, np.uint64)
    for j in range(size):
        runs[: n - j if n > j else 0] += hashes[j:] * _STEP[j]
    of = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(n) - first[:-1][of]
    full = at + size <= counts[of]
    short = (counts[of] < size) & (at == 0)
    out = mix(runs)
    for i in np.flatnonzero(short):
        whole = hashes[i : i + counts[of[i]]]
        out[i] = mix(np.array([(whole * _STEP[: len(whole)]).sum(dtype=np.uint64) + np.uint64(len(whole))], np.uint64))[0]
    keep = full | short
    return out[keep], np.concatenate(([0], np.cumsum(np.bincount(of[keep], minlength=len(counts)))))


# --- components ------------------------------------------------------------------------------

#: Links to a file.
LINKS = 100_000


def components(links: DataFrame, name: str = "components", rows: int | None = None) -> DataFrame:
    """(node, component): the smallest node reachable over the links (a, b); nodes without a link are left out.

    Alternating large and small stars: each round joins every node's neighbours to the smallest of them. All
    rounds are joins on the node, whose hot keys adaptive execution splits; each round's table goes to the
    shared folder, and only a count and a checksum reach the driver. ``rows``: of ``links``, if known.
    """
    a, b = F.col("a"), F.col("b")
    first = links.filter("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = stash(first if rows is None else few_files(first, rows, LINKS), name)
    seen = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if seen == (mark.n, mark.x) or not mark.n:
            break
        seen = (mark.n, mark.x)
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stash(few_files(small.union(lower.select("a", F.col("m").alias("b"))).distinct(), mark.n, LINKS), name)
        drop_stash(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(b.alias("node"), b.alias("component")).distinct())
