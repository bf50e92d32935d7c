"""Near-duplicates and repeated passages against brute force."""

import random
import re

import pytest

from cargolith.llm.common import components
from cargolith.llm.neardup import chunk_count, near_duplicates
from cargolith.llm.substring import repeated_passages, without_repeats

SCHEMA = "doc_id long, text string, n long, a string"


def sets(text, size):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)}


def brute(rows, size, per_cent):
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    own = [(d, sets(t, size)) for d, t in rows]
    for i, (d, x) in enumerate(own):
        for e, y in own[:i]:
            if x and y and 100 * len(x & y) >= per_cent * len(x | y):
                lo, hi = sorted((find(d), find(e)))
                root[hi] = lo
    return {d: (len(s), find(d)) for d, s in own}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for k in range(40):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 8, 60, 120]))
        for _ in range(rng.choice([1, 1, 3, 12])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            sep = rng.choice([" ", "  ", "\n"])
            rows.append((1000 + len(rows), sep.join(w.upper() if rng.random() < 0.1 else w for w in own)))
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "Éa b"), (5, "éa b"), (6, "x y z"), (7, "X Y Z")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "per_cent"), [(3, 85), (5, 80)])
def test_components_match_brute_force(spark, texts, size, per_cent):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in texts], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, size, per_cent).collect()}
    assert got == brute(texts, size, per_cent)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f", 1, None), (9, "a b c d e f", None, "x"), (8, "a b c d e f", 2, ""), (8, "a b c d e f", 2, "")], SCHEMA)
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == [("8", 8, True), ("8", 8, True), ("9", 8, False), ("None", None, True)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_components_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_chunk_count_bounds_the_miss():
    for s in (0.8, 0.85, 0.9):
        hit = s**7 + 7 * (1 - s) * s**6
        assert (1 - hit) ** chunk_count(s) < 1e-5


def test_passages_are_found_and_cut(spark):
    rng = random.Random(1)

    def prose(k):
        return [f"p{rng.randrange(10**6)}" for _ in range(k)]

    passage, short = prose(53), prose(40)
    rows = []
    for i in range(30):
        body = prose(rng.choice([20, 90, 300]))
        at = rng.randrange(len(body))
        middle = passage if i % 3 == 0 else short if i % 3 == 1 else []
        rows.append((i, "\n".join([" ".join(body[:at]), ""]) + " ".join(middle) + " é " + " ".join(body[at:])))
    twice = prose(60)
    rows.append((50, " ".join(twice + prose(7) + twice)))
    rows.append((51, " ".join(prose(45) * 4)))
    rows += [(60, None), (61, ""), (62, "alone")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    _, regions = repeated_passages(df)
    found = regions.collect()
    assert {r.doc_id for r in found} == {*range(0, 30, 3), 50, 51}
    assert len({r.cluster for r in found if r.doc_id < 50}) == 1
    assert all(r.end - r.start == {50: 60, 51: 180}.get(r.doc_id, 54) for r in found)
    cut = {r.doc_id: r.text for r in without_repeats(df).collect()}
    assert len(cut) == len(rows)
    for d, t in rows:
        if d == 50:
            assert cut[d] == " ".join(twice + t.split()[60:67]) + " "
        elif d == 51:
            assert cut[d].split() == t.split()[:45]
        elif d % 3 == 0 and 0 < d < 30:
            assert cut[d].split() == [w for w in t.split() if w not in {*passage, "é"}]
        else:
            assert cut[d] == t


def test_edited_passage_and_empty_table(spark):
    words = [f"q{i}" for i in range(100)]
    edited = list(words)
    edited[50] = "other"
    df = spark.createDataFrame([(1, " ".join(words)), (2, "lead " + " ".join(edited)), (2, "lead " + " ".join(edited))], "doc_id long, text string")
    _, regions = repeated_passages(df)
    assert {(r.doc_id, r.start, r.end) for r in regions.collect()} == {(1, 0, 100), (2, 1, 101)}
    assert without_repeats(df.limit(0)).count() == 0


def test_small_tables_are_written_as_few_files(spark, monkeypatch):
    """Files follow the rows, not the partitions: each costs a process on the executor."""
    from cargolith.llm import common, neardup

    least, files = 2 * spark.sparkContext.defaultParallelism, {}

    def seen(df, name, stash=common.stash):
        out = stash(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(common, "stash", seen)
    monkeypatch.setattr(neardup, "stash", seen)
    wide = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    for k, v in wide.items():
        spark.conf.set(k, v)
    try:
        rng = random.Random(2)
        base = [[f"v{rng.randrange(5000)}" for _ in range(60)] for _ in range(150)]
        rows = [(2 * i + k, " ".join(w[: 60 - k])) for i, w in enumerate(base) for k in (0, 1)]
        got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {d: d - d % 2 for d, _ in rows}
    assert {"classes", "buckets", "links", "components"} <= files.keys()
    assert max(n for name, own in files.items() if name != "signatures" for n in own) <= least
