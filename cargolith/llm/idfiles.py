"""Token ids as seekable zstandard files (operator 10).

A file is a run of independent zstandard frames, one per document in ascending order, with their content
checksum; then a skippable frame with the doc_ids; then the trailing seek table: a skippable frame with each
frame's compressed size, plain size and checksum (low 32 bits of XXH64 of the plain bytes), the number of
frames, a flag byte and a magic number. Any zstandard reader can decompress the whole file; ours reads the table
from the end and decompresses only the frames of the documents asked for.

Files are written by the tasks that hold a range of doc_ids, under a temporary name and renamed when whole:
a task that is run again overwrites its own file only. The number of ids before each file comes from one row
per file.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cargolith.llm.common import like, stash
from cargolith.llm.tokens import encode_words, library_table, text_batches
from cargolith.session import scratch_path

SEEK_TABLE, INDEX, FOOTER = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1  # fixed values of the format
NO_ID = -(2**63)


def _files(uri: str):
    from pyarrow import fs

    if "://" not in uri:  # a bare path, or Hadoop's file:/path
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents to one file of the format."""

    def __init__(self, sink, level: int = 3):
        import zstandard

        self.sink, self.entries, self.ids = sink, [], []
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress

    def add(self, doc_id: int | None, raw: bytes) -> None:
        import xxhash

        frame = self.compress(raw)
        self.sink.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(NO_ID if doc_id is None else doc_id)

    def finish(self) -> None:
        ids = np.array(self.ids, "<i8").tobytes()
        self.sink.write(struct.pack("<II", INDEX, len(ids)) + ids)
        self.entries.append((len(ids) + 8, 0, 0))
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), 0x80, FOOTER)
        self.sink.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)


class Reader:
    """Opens a file by its seek table; ``ids`` are its documents in order."""

    def __init__(self, source):
        import zstandard

        self.source, size = source, source.size()
        source.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != FOOTER:
            raise ValueError("not a file with a seek table")
        source.seek(size - 9 - 12 * count)
        self.entries = np.frombuffer(source.read(12 * count), "<u4").reshape(-1, 3)
        self.at = np.concatenate(([0], np.cumsum(self.entries[:, 0], dtype=np.int64)))
        source.seek(int(self.at[-2]) + 8)
        self.ids = np.frombuffer(source.read(int(self.entries[-1, 0]) - 8), "<i8")
        self.sizes = self.entries[:-1, 1] // 4
        self.decompress = zstandard.ZstdDecompressor().decompress

    def frame(self, k: int) -> bytes:
        """The plain bytes of document ``k`` of the file, checked."""
        import xxhash

        self.source.seek(int(self.at[k]))
        raw = self.decompress(self.source.read(int(self.entries[k, 0])), max_output_size=max(1, int(self.entries[k, 1])))
        if len(raw) != self.entries[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return raw


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> DataFrame:
    """Writes ``docs`` (doc_id, text) below ``folder``; gives file, n_docs, n_tokens and the tokens before each file.

    Rows are in ascending doc_id order over all files; NULL ids come first, and rows that repeat an id are
    ordered by a hash of the text. NULL and empty texts hold ``end_id`` alone. An empty table writes no file.
    """
    spark = docs.sparkSession
    size = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = os.fspath(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, context = library_table(path, False), TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}.idz"
        writer = sink = None
        files = inner = None
        docs_, tokens = 0, 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            for i, j in text_batches(texts):
                if writer is None:
                    files, inner = _files(name)
                    files.create_dir(inner.rpartition("/")[0], recursive=True)
                    draft = f"{inner}.{context.taskAttemptId()}"
                    sink = files.open_output_stream(draft)
                    writer = Writer(sink)
                flat, starts = encode_words(table, texts[i:j])
                for k in range(i, j):
                    own = np.append(flat[starts[k - i] : starts[k - i + 1]], end_id).astype("<u4")
                    writer.add(ids[k], own.tobytes())
                    docs_ += 1
                    tokens += len(own)
        if writer is not None:
            writer.finish()
            sink.close()
            files.move(draft, inner)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([context.partitionId()]), pa.array([docs_]), pa.array([tokens])], ["file", "part", "n_docs", "n_tokens"])

    narrow = like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.withColumn("h", F.xxhash64("text")).repartitionByRange(size, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    manifest = stash(ordered.mapInArrow(run, "file string, part long, n_docs long, n_tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_ids(manifest: DataFrame, wanted: Iterable[int] | None = None, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids (bytes; with ``digest`` their checksum ids_crc32) of all documents, or of a small set of doc_ids only."""
    last, kind = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    chosen = None if wanted is None else np.array(sorted(wanted), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                files, inner = _files(name)
                with files.open_input_file(inner) as source:
                    reader = Reader(source)
                    starts = before + np.concatenate(([0], np.cumsum(reader.sizes, dtype=np.int64)))
                    rows = np.arange(len(reader.ids)) if chosen is None else np.flatnonzero(np.isin(reader.ids, chosen))
                    for lo in range(0, len(rows), 200):
                        part = rows[lo : lo + 200]
                        ids = pa.array(reader.ids[part], mask=reader.ids[part] == NO_ID)
                        frames = (reader.frame(int(k)) for k in part)
                        values = pa.array([zlib.crc32(x) for x in frames] if digest else list(frames), kind)
                        yield pa.RecordBatch.from_arrays([ids, pa.array(starts[part]), pa.array(reader.sizes[part].astype(np.int64)), values],
                                                         ["doc_id", "start", "n_tokens", last])

    # One row per file: each goes to a task of its own.
    count = max(1, manifest.count())
    return manifest.select("file", "before").repartition(count, "file").mapInArrow(run, f"doc_id long, start long, n_tokens long, {last} {'long' if digest else 'binary'}")


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row, from the files written."""
    return read_ids(write_ids(docs, path, scratch_path(docs.sparkSession, "ids"), end_id), digest=True)
