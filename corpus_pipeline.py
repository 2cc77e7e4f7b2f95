"""A corpus pipeline: filter, deduplicate, mask secrets, mix sources, encode.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes
each one's result as Parquet under the shared folder and gives it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillwork.llm import queries
from rillwork.llm.common import saved
from rillwork.llm.minhash import keep_first
from rillwork.llm.mixing import mix
from rillwork.llm.quality import keep_good
from rillwork.llm.secrets import mask

#: Words of a shingle in near dedup; the two words of ``op5_minhash_dedup`` are that query's own.
SHINGLE = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the plain limits or are outliers of their language and source."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, by shingles of five words."""
    return keep_first(docs, size=SHINGLE)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; every document stays."""
    return mask(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their target weights."""
    return mix(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's text, and the digests that identify them."""
    return queries.encoded(docs, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scans", secret_scans),
    ("source mixing", source_mixing),
    ("piece encoding", piece_encoding),
]

#: The stages are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return docs
