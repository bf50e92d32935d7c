"""Repeated passages: small texts whose repeats are known."""

import numpy as np

from cargolith.llm import substring


def fresh(name, n):
    return [f"{name}{k}" for k in range(n)]


def alignment(x, y):
    equal = np.array(x) == np.array(y)
    return np.logical_and.reduce([equal[s : len(equal) - substring.SIZE + 1 + s] for s in range(substring.SIZE)])


def edited(x, *places):
    return [f"{w}_" if k in places else w for k, w in enumerate(x)]


def test_both_sides_of_edited_words_are_found():
    x = fresh("w", 133)
    covered = {k for s, e in substring._runs(alignment(x, edited(x, 60, 66, 72)), 45) for k in range(s, e)}
    assert covered >= {*range(60), *range(73, 133)}


def test_runs_are_all_windows_of_the_similarity():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(50, 200))
        same = alignment(x := fresh("w", n), edited(x, *rng.integers(0, n, rng.integers(0, 9))))
        at, want = np.flatnonzero(same), set()
        for i in range(len(at)):
            for j in range(i, len(at)):
                if j > i and at[j] - at[j - 1] > 2 * substring.SIZE:
                    break
                total, equal = at[j] - at[i] + 1, j - i + 1
                if at[j] - at[i] + substring.SIZE >= 45 and 10 * equal >= 8 * (2 * total - equal):
                    want |= {*range(at[i], at[j] + substring.SIZE)}
        assert {k for s, e in substring._runs(same, 45) for k in range(s, e)} == want


def test_places_without_a_passage_around_them_go_on(spark):
    met = spark.createDataFrame(
        [(1, 10, 0, (1, 10, 0)), (2, 10, 0, (1, 10, 0)),  # around a passage: settled
         (1, 90, 0, (1, 90, 0)), (2, 90, 0, (1, 90, 0)), (3, 5, 0, (1, 90, 0)),  # the passage of 1 and 2 lies elsewhere
         (4, 7, 1, (4, 7, 1)), (4, 80, 2, (4, 7, 1))],  # within one text
        "doc_id long, at int, around int, first struct<doc_id:long,at:int,around:int>")
    tested = spark.createDataFrame([(2, 1, 0, 0, 60, 0, 60), (3, 1, -85, None, None, None, None)], "a long, b long, shift int, sa int, ea int, sb int, eb int")
    assert {(r.doc_id, r["at"]) for r in substring._unsettled(met, tested).collect()} == {(1, 90), (2, 90), (3, 5), (4, 7), (4, 80)}


def test_an_exact_passage_beside_a_shared_one_is_found(spark):
    rows = []
    for k in range(12):
        q, p = fresh(f"q{k}x", 70), fresh(f"p{k}x", 52)
        rows.append((k, " ".join(q + fresh(f"f{k}x", 30) + edited(p, 10, 42) + fresh(f"g{k}x", 30))))
        rows.append((100 + k, " ".join(q + fresh(f"h{k}x", 30) + p + fresh(f"i{k}x", 30))))
        rows.append((200 + k, " ".join(fresh(f"j{k}x", 40) + p + fresh(f"k{k}x", 40))))
    links, _ = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.a for r in links.collect() if r.b == r.a - 100 and r.sa <= 40 and r.ea >= 92} == {200 + k for k in range(12)}
