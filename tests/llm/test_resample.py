"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cargolith.llm import resample
from cargolith.llm.lexemes import crc_states, slices, spans
from cargolith.llm.resample import resampled, smallest_enough

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, score string, rank int, weight string, n int"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def runs(text):
    words = WORDS.findall(low(text))
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows, target, per_cent=25, least=20):
    rows = [(i, t) for i, t in rows if i is not None]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(runs(text)[1])
    for text in target:
        t.update(runs(text)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)]
    out, able = [], []
    for i, text in rows:
        words, own = runs(text)
        weight = math.floor(sum(gain[b] for b in own) / len(own)) if own else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None])
        if len(words) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(able[: per_cent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r) for r in out), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None, 2) for i, t in rows], SCHEMA)


def texts(n, seed=3):
    rng = np.random.default_rng(seed)
    stock = ["Alpha", "béta", "42", "x9", "ÄÖ", "the", "The", "naïve", "日本", "a"]
    return [" ".join(rng.choice(stock, rng.integers(0, 60))) + ".\n-" + "!" * int(rng.integers(0, 3)) for _ in range(n)]


def test_against_brute_force(spark):
    body = texts(400)
    rows = list(enumerate(body)) + [(1000 + i, body[0] + body[1]) for i in range(150)]
    rows += [(2000, None), (2001, ""), (2002, "  "), (2003, "q" * 3_000_000), (2004, "long wörd " * 150_000), (None, body[3]), (7, body[7]), (7, body[7]), (8, body[9])]
    target = body[:5] + [None, "", "béta 42 the"]
    got = resampled(frame(spark, rows), spark.createDataFrame([(t, "y") for t in target], "text string, doc_id string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target)


def test_few_rows(spark):
    empty = frame(spark, [])
    target = spark.createDataFrame([("a b",)], "text string")
    assert resampled(empty, target).count() == 0
    rows = [(1, "a " * 30), (2, None)]
    got = resampled(frame(spark, rows), empty)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, [])


@pytest.mark.parametrize("wanted", [1, 2, 37, 99, 100])
def test_bisection(spark, wanted):
    values = sorted((v * 7919) % 1000 - 500 for v in range(100))
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    assert smallest_enough(rows, rows.v, values[0], values[-1], wanted) == values[wanted - 1]


@pytest.mark.parametrize("limit", [7, 64, 1 << 19])
def test_parts_of_long_texts(limit, monkeypatch):
    """Counts do not depend on where a text is cut, within words of any length."""
    monkeypatch.setattr(resample, "slices", lambda c, overlap: slices(c, overlap, limit))
    body = [*texts(20), None, "", "é" * 300 + " b", "x" * 1000, " ".join(["ab"] * 500), "-" * 100]
    got = [Counter() for _ in body]
    for a, b, c, d in resample.features(pa.array(body), 10000):
        for row, bucket in zip(np.concatenate((a, c)), np.concatenate((b, d))):
            got[row][int(bucket)] += 1
    assert got == [Counter(runs(t)[1]) for t in body]


def test_registers_are_crc32():
    words = [b"", b"a", b"word", b"y" * 199, b"z" * 200, b"w" * 201, b"v" * 5000]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    state = crc_states(data, ends - [len(w) for w in words], ends, np.full(len(words), 0xFFFFFFFF, np.uint32))
    assert (~state).tolist() == [zlib.crc32(w) for w in words]


def test_spans():
    starts, ends, text = spans(np.frombuffer("ab1-Ücd".encode(), np.uint8), np.array([0, 1, 1, 8]))
    assert list(zip(starts, ends, text)) == [(0, 1, 0), (1, 3, 2), (4, 8, 2)]
