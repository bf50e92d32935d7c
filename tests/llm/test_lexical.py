"""Ranked search against brute force over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from cargolith.llm import lexical
from cargolith.llm.lexical import Peaks, Vocabulary, ranked
from cargolith.llm.lexemes import spans

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, score string, term int, shard string, place string", "item_id long, text string, rank string, n int"


def terms(text):
    return TERMS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    own = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    own = [(i, c) for i, c in own if c]
    n_docs, length = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        if item is None:
            continue
        asked = Counter(terms(text))
        found = []
        for i, c in own:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def corpus(n, seed=5):
    rng = np.random.default_rng(seed)
    stock = np.array([f"w{i}" for i in range(300)] + ["Ünï", "日本", "THE", "the"])
    share = 1 / np.arange(1, len(stock) + 1)
    return [" ".join(rng.choice(stock, rng.integers(0, 80), p=share / share.sum())) for _ in range(n)]


@pytest.mark.parametrize("per_shard", [1 << 19, 300])
def test_against_brute_force(spark, monkeypatch, per_shard):
    monkeypatch.setattr(lexical, "POSTINGS", per_shard)
    monkeypatch.setattr(lexical, "WIDTH", 8)
    body = corpus(500)
    docs = list(enumerate(body)) + [(1000 + i, body[3] + " " + body[4]) for i in range(250)]  # a third are copies
    docs += [(3000, None), (3001, ""), (3002, "!?"), (None, body[3]), (3003, "w1 w2 " * 200_000), (3004, "w3" * 600_000), (5, body[5]), (5, body[6])]
    items = [(i, body[i * 7]) for i in range(30)] + [(50, None), (51, ""), (52, "nowhere to be found"), (None, "w1"), (53, "w1 W1 w250 w250 日本"), (54, body[3]), (54, body[4])]
    got = ranked(spark.createDataFrame([(i, t, "s", 1, "x", "y") for i, t in docs], DOCS), spark.createDataFrame([(i, t, "r", 1) for i, t in items], ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 2)
    docs, items = list(enumerate(corpus(60))), [(i, f"w{i} w{i + 1}") for i in range(5)]
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "w1 w2", "", 0)], ITEMS)
    assert ranked(docs, some).count() == 0
    assert ranked(spark.createDataFrame([(1, "w1", "", 0, "", "")], DOCS), items).count() == 0


def test_peaks():
    values = np.random.default_rng(1).integers(0, 50, 137)
    peaks = Peaks(values)
    a, b = np.triu_indices(138, 1)
    assert (peaks.at(a, b) == [x + values[x:y].argmax() for x, y in zip(a, b)]).all()


def test_bytes_decide(monkeypatch):
    """Words that merely share a hash with a term are not that term."""
    monkeypatch.setattr(lexical, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    data = np.frombuffer(b"abc xyz abc de", np.uint8)
    starts, ends, _ = spans(data, np.array([0, len(data)]))
    span, term = Vocabulary([b"abc", b"de"]).numbers(data, starts, ends)
    assert list(zip(span, term)) == [(0, 0), (2, 0), (3, 1)]
