"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.session import drop_stash, stash


def components(links: DataFrame) -> DataFrame:
    """(node, component) over links (a, b): the smallest node that can be reached; nodes without a link are left out.

    Large and small stars in turn: every node hands the smallest of its neighbours to the larger ones, then to the
    smaller ones, until nothing moves. The driver sees a count and a checksum per round.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now, seen = stash(links.filter("a <> b").select(high, low).distinct(), "links"), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if not state.n or state == seen:
            break
        seen = state
        both = now.union(now.select("b", "a")).toDF("u", "v")
        head = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(head, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        head = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(head, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stash(small.union(head.select("a", F.col("m").alias("b"))).distinct(), "links")
        drop_stash(now)
        now = after
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select("b").distinct()
    return leaves.union(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
