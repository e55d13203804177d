"""Pending-file ledger: ordered entries that go from queued to reserved to processed.

Each transition is a projection over the ledger. The entry it touches is found by
a scalar subquery, so there is no join, no shuffle of the ledger and no global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.model import LEDGER


def _waiting(pipeline: str) -> Column:
    return (F.col("target_dag") == pipeline) & (F.col("status") == "queued")


def _held(pipeline: str, run_id: str) -> Column:
    return (
        (F.col("target_dag") == pipeline)
        & (F.col("reserved_run_id") == run_id)
        & F.col("status").isin("queued", "reserved")
    )


def _first(where: Column) -> Column:
    return F.min(F.when(where, F.col("position")))


def next_entry(df: DataFrame, pipeline: str, run_id: str) -> DataFrame:
    """The entry a run is to process: the one it already holds, else the first queued; else none."""
    pick = df.agg(F.coalesce(_first(_held(pipeline, run_id)), _first(_waiting(pipeline))))
    return df.where(F.col("position") == pick.scalar())


def reserve(df: DataFrame, pipeline: str, run_id: str, at: str) -> DataFrame:
    """Mark the first queued entry as reserved by a run, unless the run already holds one."""
    pick = df.agg(F.when(_first(_held(pipeline, run_id)).isNull(), _first(_waiting(pipeline))))
    hit = F.col("position") == pick.scalar()
    return df.withColumns(
        {
            "status": F.when(hit, "reserved").otherwise(F.col("status")),
            "reserved_run_id": F.when(hit, run_id).otherwise(F.col("reserved_run_id")),
            "reserved_at": F.when(hit, at).otherwise(F.col("reserved_at")),
        }
    )


def mark_processed(df: DataFrame, run_id: str, at: str) -> DataFrame:
    """Mark the first entry reserved by a run as processed, whatever its target or status."""
    hit = F.col("position") == df.agg(_first(F.col("reserved_run_id") == run_id)).scalar()
    return df.withColumns(
        {
            "status": F.when(hit, "processed").otherwise(F.col("status")),
            "processed_run_id": F.when(hit, run_id).otherwise(F.col("processed_run_id")),
            "processed_at": F.when(hit, at).otherwise(F.col("processed_at")),
        }
    )


def enqueue(df: DataFrame, names: Sequence[str] | DataFrame, pipeline: str, at: str) -> DataFrame:
    """Append files in the given order after the last entry.

    ``names`` is a short list, or a frame ``(ordinal, file_name)`` whose ordinals
    count from 0 and give the order.
    """
    if not isinstance(names, DataFrame):
        names = df.sparkSession.createDataFrame(list(enumerate(names)), "ordinal bigint, file_name string")
    last = F.coalesce(df.agg(F.max("position")).scalar(), F.lit(-1))
    known = {
        "position": last + 1 + F.col("ordinal"),
        "file_name": F.col("file_name"),
        "status": F.lit("queued"),
        "target_dag": F.lit(pipeline),
        "queued_at": F.lit(at),
    }
    fresh = names.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER]
    )
    return df.unionByName(fresh, allowMissingColumns=True)


def depth(df: DataFrame, pipeline: str) -> DataFrame:
    """One row with the number of entries of a pipeline still queued or reserved, as ``depth``."""
    open_entry = (F.col("target_dag") == pipeline) & F.col("status").isin("queued", "reserved")
    return df.agg(F.count_if(open_entry).alias("depth"))
