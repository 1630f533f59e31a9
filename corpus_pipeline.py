"""A corpus pipeline over ``documents``: quality classifier, near-duplicate
removal, benchmark decontamination, mixing to source targets, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``; the last adds the shard.  SQL
can't express the chain (hashed models, signatures, random rounding):
``ORACLE_SQL`` is None, and the tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import decontaminate, mixing, near_dedup, quality, queries, sharding
from cohortkit.llm.common import table, written

ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps: those with null or empty texts
    have weight 1, rows equal in id and text stay or go together, a tie at the
    last place is kept whole."""
    return quality.resample(docs, table(spark, sf_dir, "labels"), queries.GOOD).select(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id
    (null ids last, then the first row); null and empty texts all stay."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark; null and empty texts stay,
    repeated rows are judged each."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it; a null source is a
    source, null and empty texts count no words, rows equal in source, id and text
    share their copies."""
    return mixing.take(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard each belongs to: ``shard``, ``depth``,
    ``shard_bytes``, ``shard_docs``, ``single``.  Columns of ``docs`` of these names
    are replaced; repeated rows and null ids share a bucket, which gets pages."""
    h, size = sharding.id_hash(F.col("doc_id")), sharding.text_bytes(F.col("text"))
    rows = written(docs.select(h.alias("hash"), size.alias("n_bytes")), "bytes")
    cells = sharding.directory(rows, queries.SHARD_BYTES)
    whole = docs.select(F.struct("*").alias("doc"), size.alias("n_bytes"), h.alias("hash"))
    got = sharding.paged(whole, cells, F.col("hash"), queries.SHARD_BYTES)
    added = ["shard", "depth", "shard_bytes", "shard_docs", "single"]
    return got.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in added], *added)


STAGES = [("quality classifier", classify), ("near-dedup", dedup), ("decontamination", decontaminated), ("mixing", mix), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
