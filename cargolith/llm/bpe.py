"""Byte-level BPE as recursive queries of an embedded database, one per Spark task (operator 2).

Encoding: each distinct word of the worker's texts (a match of the pattern) is a set of rows (word, position,
token). A step of the recursive query joins neighbouring tokens with the merge table, takes each word's
smallest rank, leftmost first, and contracts that pair; a word leaves the recursion when it has no pair left.
Decoding: rows (text, position, token) join the vocabulary, and an ordered aggregate joins their bytes.

Any pair whose joined bytes have a rank merges, as in the library of the rank files, not only pairs of a
merge list. A word of n bytes takes up to n steps over its remaining tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import like
from cargolith.llm.tokens import LIMIT, PieceTable, text_batches

MEMORY = "160MB"

# Each row knows its word's next token and where that is (-1: none). The right one of two merged tokens becomes their
# sum, so that what it knows stays right; the left one goes, and the row before it learns of the sum. A step's best pair
# of a word is one number: rank, position of the left token, distance of the right one (14 bits).
ENCODE = """
with recursive step(w, i, t, n, next, live) as (
  select w, i, t, n, next, true from letters
  union all
  select x.w, x.i, case when x.i = best.sum then best.rank else x.t end, case when x.n = best.gone then best.sum else x.n end,
    case when x.n = best.gone then best.rank else x.next end, best.rank is not null
  from step x
  left join (
    select w, (key >> 45)::int as rank, ((key >> 14) & 2147483647)::int as gone, (((key >> 14) & 2147483647) + (key & 16383))::int as sum
    from (
      select y.w, min(m.rank::bigint * 35184372088832 + y.i::bigint * 16384 + (y.n - y.i)) as key
      from step y join merges m on m.pair = y.t::bigint * 65536 + y.next
      where y.live and y.n >= 0
      group by y.w)) best on best.w = x.w
  where x.live and (best.rank is null or x.i <> best.gone)
)
select w, t from step where not live order by i
"""
DECODE = "select d, array_to_string(list(b order by i), '') as text from spelled join vocabulary using (t) group by d order by d"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """The merge table and the vocabulary in one in-memory database."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.find = regex.compile(pattern).findall
        ranks = load_ranks(path)
        pairs = [(left, right, rank) for token, rank in ranks.items() for i in range(1, len(token))
                 if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None]
        if max(map(len, ranks)) >= 16384:
            raise ValueError("a token is longer than a step can hold")
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        self.db.register("_m", pa.table({"pair": left * 65536 + right, "rank": rank.astype(np.int32)}))
        self.db.execute("create table merges as select * from _m")
        # Bytes travel as the characters U+0000 to U+00FF.
        self.db.register("_v", pa.table({"t": pa.array(list(ranks.values()), pa.int32()), "b": pa.array([k.decode("latin-1") for k in ranks])}))
        self.db.execute("create table vocabulary as select * from _v")
        self.spelling = [str(i) for i in range(max(ranks.values()) + 1)]
        self.words = PieceTable(self._encode, 2 * LIMIT)

    def _words(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words, and how many each has."""
        raw = [w.encode("utf-8", "surrogatepass") for w in found]
        sizes = np.array([len(r) for r in raw])
        letters = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        at, after, following = np.arange(len(letters), dtype=np.int32), np.arange(1, 1 + len(letters), dtype=np.int32), np.roll(letters, -1)
        after[np.cumsum(sizes) - 1] = following[np.cumsum(sizes) - 1] = -1
        self.db.register("letters", pa.table({"w": np.repeat(np.arange(len(raw), dtype=np.int32), sizes), "i": at, "t": letters, "n": after, "next": following}))
        out = self.db.sql(ENCODE).to_arrow_table()
        self.db.unregister("letters")
        return out["t"].to_numpy().astype(np.uint32), np.bincount(out["w"].to_numpy(), minlength=len(raw))

    def _encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        lo = 0
        while lo < len(found):  # words of some 200 kB at a time
            hi, size = lo, 0
            while hi < len(found) and size < 200_000:
                size += len(found[hi])
                hi += 1
            a, b = self._words(found[lo:hi])
            ids.append(a)
            sizes.append(b)
            lo = hi
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one run, and where each text's ids start (one more entry than texts)."""
        return self.words.lists([self.find(t) for t in texts])

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        of = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        self.db.register("spelled", pa.table({"d": of, "i": np.arange(len(ids), dtype=np.int32), "t": ids.astype(np.int32)}))
        got = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("spelled")
        out = [b""] * (len(starts) - 1)
        for d, text in zip(got["d"].to_pylist(), got["text"].to_pylist(), strict=True):
            out[d] = text.encode("latin-1")
        return out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with all rows, columns and the array ``ids`` (long); NULL and empty texts give an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for i, j in text_batches(texts):
                flat, starts = own.encode(texts[i:j])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(starts.astype(np.int32), flat.astype(np.int64))], [*part.schema.names, ids])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.LongType()))]))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "token_ids", raw: str = "decoded") -> DataFrame:
    """``rows`` with all columns and the bytes ``raw`` of the array ``ids``; NULL gives no bytes, unknown ids fail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = [x or [] for x in part.column(ids).to_pylist()]
                starts = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
                flat = np.array([i for x in lists for i in x], np.int64)
                if len(flat) and (flat.min() < 0 or flat.max() >= len(own.spelling)):
                    raise ValueError("an id is not in the vocabulary")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.decode(flat, starts), pa.binary())], [*part.schema.names, raw])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(raw, T.BinaryType())]))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: encoded, then decoded, without moving the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        sha = hashlib.sha256
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, j in text_batches(texts):
                flat, starts = own.encode(texts[i:j])
                names = own.spelling
                a = [sha(" ".join(map(names.__getitem__, flat[s:e].tolist())).encode()).hexdigest() for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                b = [sha(x).hexdigest() for x in own.decode(flat, starts)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(np.diff(starts), pa.int64()), pa.array(a), pa.array(b)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
