"""Exact dedup against brute force, and the index over several deliveries and sessions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cargolith.llm.digests import UPPER, DigestIndex, digests, exact_duplicates
from cargolith.session import scratch_path

SCHEMA = "doc_id long, text string, digest string, keep_id string, slot int"


def frame(spark, rows):
    """With columns whose names clash with those of the operator."""
    return spark.createDataFrame([(i, t, "x", None, 1) for i, t in rows], SCHEMA)


def brute(rows):
    seen = sorted({(i, (t or "").translate(str.maketrans(UPPER, UPPER.lower()))) for i, t in rows if i is not None})
    groups = {}
    for i, t in seen:
        groups.setdefault(t, []).append(i)
    return sorted((i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in seen)


def test_all_cases(spark):
    rows = [(i, f"Text {i % 50}") for i in range(300)] + [(1000 + i, "HOT text" if i % 2 else "hot TEXT") for i in range(200)]
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, "Äa"), (2004, "äA"), (2005, "Äa"), (None, "hot text"), (None, None), (-9, "x" * 3_000_000), (2006, "X" * 3_000_000)]
    rows += [(5, "Text 5"), (2001, ""), (7, "a second text of one id")]
    got = exact_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_empty_table(spark):
    assert exact_duplicates(frame(spark, [])).count() == 0


def test_deliveries(spark):
    path = scratch_path(spark, "index")
    first = DigestIndex(spark, path, 4)
    first.add(digests(frame(spark, [(1, "a"), (2, "A"), (3, "b")])), 0)
    first.forget()
    again = DigestIndex(spark, path)  # as a later session would
    assert again.buckets == 4
    with pytest.raises(ValueError):
        DigestIndex(spark, path, 8)
    batch = digests(frame(spark, [(9, "a"), (8, "c"), (7, "C")]))
    again.add(batch, 1)
    again.add(batch, 2)  # a repeated delivery adds nothing
    held = {(r.keep_id, r.delivery) for r in again.rows().collect()}
    assert held == {(2, 0), (3, 0), (8, 1)}
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in again.decided(batch).collect()}
    assert got == {(9, 2, 1, False), (8, 8, 2, True), (7, 8, 2, False)}
    small = again.compacted(scratch_path(spark, "index"))
    assert {(r.keep_id, r.delivery) for r in small.rows().collect()} == held


def test_anti_join_leaves_the_index_where_it_is(spark):
    index = DigestIndex(spark, scratch_path(spark, "index"))
    index.add(digests(frame(spark, [(i, f"t{i}") for i in range(100)])), 0)
    rows = digests(frame(spark, [(i, f"t{i}") for i in range(90, 120)]))
    found = index.dealt(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id")))
    plan = found.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.rindex("FileScan"):]
    assert "SortMergeJoin" in plan and "Bucketed: true" in right
    lines = plan.splitlines()
    at = next(k for k, x in enumerate(lines) if "Bucketed: true" in x)
    assert "Exchange" not in "".join(lines[at - 3 : at])
