"""The training sample of the quality classifier."""

import zlib

import pytest

from cargolith.llm import quality


def test_one_long_labelled_text_costs_one_row(spark):
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 3 != 1][:60]
    by_hash = [r.k for r in spark.createDataFrame([(k,) for k in ids], "k long").orderBy("k").selectExpr("k", "xxhash64(k) h").orderBy("h", "k").collect()]
    docs = spark.createDataFrame([(k, "ab cd " * 9 + "&" * (k % 2)) for k in by_hash[1:]], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in by_hash], "doc_id long, quality int")
    long = spark.range(1).selectExpr(f"{by_hash[0]}L as doc_id", "repeat('x', 17000000) as text")
    with_long, without = quality.train(docs.union(long), labels), quality.train(docs, labels)
    assert (with_long.out == without.out).all() and (with_long.table == without.table).all() and with_long.out.any()
    with pytest.raises(ValueError):
        quality.train(long, labels)
