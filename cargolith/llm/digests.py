"""Exact dedup by a persistent digest index (operator 11), built-in functions only.

The index is a saved table with one row per distinct text: ``digest`` (SHA-256 of the normalised text), the
document that holds it, and the delivery that brought it. It is bucketed and sorted by the digest. A new
delivery is grouped by digest, dealt to the same buckets, and anti-joined by sort-merge: the index side needs
no exchange. What the index does not hold is appended, one file per bucket. Texts never move, only digests.

Copies of one text can be a third of all rows. Grouping combines them before the shuffle; on the way back to
the documents each digest's result is repeated for those of ``SLOTS`` slots that its documents fall into, so
that a hot digest meets its documents in many tasks (and adaptive execution splits them further).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.llm.common import drop_stash, like, stash
from cargolith.session import scratch_path

#: The letters that are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Slots a digest's documents are dealt to: one bit each of a 64-bit number.
SLOTS = 64


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; NULL is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (32 bytes) of each row with a doc_id; a row that repeats both is the same document."""
    rows = like(docs, "doc_id", "text").filter("doc_id is not null")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")).distinct()


class DigestIndex:
    """A saved table of digests at ``path``, bucketed and sorted by digest.

    Opening an existing path takes up what is stored there, so that later sessions go on with it; its bucket
    count is kept beside the rows and must not be given again. Appending the same delivery twice changes
    nothing, hence a job that was lost half-way can be repeated.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/buckets/_SUCCESS")
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            held = spark.read.schema("buckets int").json(f"{self.path}/buckets").first().buckets
            if buckets not in (None, held):
                raise ValueError(f"{path} has {held} buckets, not {buckets}")
            buckets = held
        else:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").json(f"{self.path}/buckets")
        self.buckets = buckets
        self.table = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, delivery INT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/digests'")

    def rows(self) -> DataFrame:
        """digest, keep_id, delivery of every text the index holds."""
        return self.spark.table(self.table)

    def dealt(self, groups: DataFrame) -> DataFrame:
        """Rows grouped by digest, in the buckets of the index; no second shuffle where grouping dealt them so."""
        same = int(self.spark.conf.get("spark.sql.shuffle.partitions")) == self.buckets
        return groups if same else groups.repartition(self.buckets, "digest")

    def add(self, rows: DataFrame, delivery: int = 0) -> None:
        """Appends the digests of ``rows`` (doc_id, digest) that the index does not hold yet.

        Of equal texts in one delivery the largest doc_id holds; a text held since an earlier one keeps its holder.
        """
        held = self.rows().select("digest").hint("merge")
        found = self.dealt(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id")))
        fresh = found.join(held, "digest", "left_anti").withColumn("delivery", F.lit(delivery))
        fresh.select("digest", "keep_id", "delivery").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def compacted(self, path: str) -> DigestIndex:
        """A copy at ``path`` with one file per bucket, whose scan is sorted without a sort of its own."""
        out = DigestIndex(self.spark, path, self.buckets)
        self.rows().repartition(self.buckets, "digest").write.insertInto(out.table)
        self.spark.catalog.refreshTable(out.table)
        return out

    def forget(self) -> None:
        """Takes the name out of the session's catalogue; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def decided(self, rows: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept, digest of ``rows`` (doc_id, digest), all of them in the index.

        ``group_size`` counts the rows with the same text; ``kept`` says that the row's own id holds the text.
        """
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
        bit = F.lit(1).cast("long")
        groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.bit_or(F.call_function("shiftleft", bit, slot)).alias("bits"))
        held = self.dealt(groups).join(self.rows().select("digest", "keep_id").hint("merge"), "digest")
        used = F.filter(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.call_function("shiftrightunsigned", F.col("bits"), s).bitwiseAND(bit) == 1)
        spread = held.select("digest", "group_size", "keep_id", F.explode(used).alias("slot"))
        out = rows.withColumn("slot", slot).join(spread, ["digest", "slot"])
        return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "digest")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document, through an index of its own.

    The documents come to the index in two deliveries, the upper half of the id range first, so that the holder
    of a text is its largest doc_id although an index never changes a holder. NULL texts are empty texts; rows
    without a doc_id take no part; a repeated row (same id, same text) is one document; an id with several
    texts has one row per text, and is kept for each text that it holds. An empty table gives no row.
    """
    spark = docs.sparkSession
    rows = stash(digests(docs), "digests")
    index = DigestIndex(spark, scratch_path(spark, "digest-index"))
    ends = rows.agg(F.expr("(min(doc_id) div 2) + (max(doc_id) div 2)").alias("middle")).first()
    if ends.middle is not None:
        index.add(rows.filter(F.col("doc_id") > ends.middle), 0)
        index.add(rows.filter(F.col("doc_id") <= ends.middle), 1)
    out = index.decided(rows)
    result = stash(out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")), "exact-duplicates")
    index.forget()
    drop_stash(rows)
    target = spark._jvm.org.apache.hadoop.fs.Path(index.path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return result
