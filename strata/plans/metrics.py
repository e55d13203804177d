"""Run-metrics sink and one-pass counters."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources import log


def observe_counts(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """Attach counters that the next action on the frame fills, with ``rows`` always among them.

    Attach them after the last shuffle: the stage that writes the result counts
    each partition once even when a lost executor makes Spark run tasks again,
    while a stage before a shuffle may count a repeated task twice.
    """
    seen = Observation(f"strata-{uuid.uuid4().hex}")
    counted = [F.coalesce(value, F.lit(0)).alias(name) for name, value in counters.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counted), seen


def record(spark: SparkSession, root: str, run_id: str, layer: str, **fields) -> None:
    """Log the record of one (run, layer); it replaces earlier ones when read. No Spark job."""
    log.append(spark, root, {**fields, "run_id": run_id, "layer": layer})


def save(metrics: DataFrame, root: str) -> None:
    """Log many records at once; when read, the one that ended last for each (run, layer) replaces earlier ones."""
    log.append_many(metrics, root)


def compact(spark: SparkSession, root: str) -> int:
    """Gather the log's newest records in few files; returns how many files and folders that replaces."""
    return log.compact(spark, root)
