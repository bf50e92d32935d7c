"""From raw documents to packed training sequences: five stages, each written and read by the next.

Every stage works on all that its predecessor kept and takes the columns of ``documents`` (others pass through).
NULL and empty texts survive the quality stage only if their score does; nothing else drops them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.llm import neardup, packing, personal, quality, substring
from cargolith.llm.common import free_name, read_table, stash


def _recount(docs: DataFrame) -> DataFrame:
    """Brings n_chars, where there is one, in line with a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 1/2 or more); fitted on the given labels."""
    network = quality.train(docs, read_table(spark, sf_dir, "labels"))
    name = free_name(docs, "score")
    return quality.scored(docs, network, name).filter(F.col(name) >= 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    gone = neardup.near_duplicates(docs, size=5, per_cent=80).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stand only where they come first."""
    return _recount(substring.without_repeats(docs))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return _recount(personal.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their sequence and offset."""
    return packing.packed(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]
#: Learned scores, minima and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result goes to the shared folder as Parquet."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, name)
    return docs
