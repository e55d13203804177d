"""A training corpus in stages, each applied to all that the stage before it kept.

Low quality goes first, then near copies, then documents that hold benchmark items; what is left is mixed to the
sources' target weights (whole copies are rows that repeat) and written in training order. Rejected documents are
removed by id: a row without an id is never rejected, and rows that repeat an id go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, mix, near, order, rules
from strata.llm.store import saved, table
from strata.session import scratch_path

# Feistel keys, byte-pair tokens and learned rules have no SQL; tests compose the plain versions instead.
ORACLE_SQL = None


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not among ``ids``; whole texts always meet in a sort-merge join."""
    rejected = ids.select("doc_id").distinct()
    return docs.join(rejected.hint("merge"), "doc_id", "left_anti").select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base check or meet a learned rule go."""
    judged = rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    bad = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("NOT kept")
    return _without(docs, bad)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return _without(docs, near.near_duplicates(docs).filter("NOT kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix takes copies of it."""
    figures = [mix.size_of(F.col("text")).alias("size"), mix.draw_of(F.col("doc_id"), F.col("text")).alias("draw")]
    sized = saved(docs.select("doc_id", "source", *figures), "pipeline-sizes")
    packed = docs.select("doc_id", "source", *figures, F.struct("*").alias("document"))
    counted = mix.copies(packed, mix.allot(sized)).select("document", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return counted.select("document.*")


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each sequence was written, and the digest of its tokens."""
    path = order.materialise(docs, scratch_path(spark, "pipeline-order"))
    return order.read(spark, path).select("slot", "shard", "byte_offset", F.sha2("tokens", 256).alias("tokens_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("training order", training_order),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
