"""Lineage of a run: its layer records side by side, as summary, flow, events and failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.model import LAYERS

# Texts shown where a record or one of its fields is missing.
PENDING = "Pending"
UNKNOWN = "Unknown"
NO_TIME = "N/A"
NO_SOURCE = "input_data.csv"
NO_CAUSE = "Unknown Error"


def side_by_side(metrics: DataFrame, fields: Sequence[str | Column]) -> DataFrame:
    """One row per run with a struct per layer, null where the layer has no record.

    Where a layer has several records the one that ended last counts.
    """
    record = F.struct(*fields)
    ended = F.coalesce(F.col("end_time"), F.lit(""))
    return metrics.groupBy("run_id").agg(
        *[F.max_by(record, F.when(F.col("layer") == layer, ended)).alias(layer.lower()) for layer in LAYERS]
    )


def status_class(status: Column) -> Column:
    """``success``, ``failed`` or, for any other status, ``pending``; the case counts."""
    return F.when(status == "Success", "success").when(status == "FAILED", "failed").otherwise("pending")


def _shown_status(layer: str, without_status: str = UNKNOWN) -> Column:
    record = F.col(layer.lower())
    return F.when(record.isNull(), PENDING).otherwise(F.coalesce(record["status"], F.lit(without_status)))


def status(metrics: DataFrame) -> DataFrame:
    """Per run the status of each layer and its class."""
    wide = side_by_side(metrics, ["status"])
    shown = [_shown_status(layer).alias(f"{layer.lower()}_status") for layer in LAYERS]
    classes = [status_class(_shown_status(layer)).alias(f"{layer.lower()}_class") for layer in LAYERS]
    return wide.select("run_id", *shown, *classes)


def summary(metrics: DataFrame) -> DataFrame:
    """Each record as ``(run_id, layer, rows, time, status)``; a row count of 0 gives way to the next kind."""
    rows = F.coalesce(
        F.nullif(F.col("output_rows"), F.lit(0)),
        F.nullif(F.col("rows_after"), F.lit(0)),
        F.col("aggregation_count").cast("bigint"),
    )
    return metrics.select("run_id", "layer", rows.alias("rows"), F.col("duration").alias("time"), "status")


def flow(metrics: DataFrame) -> DataFrame:
    """Per run the figures of the flow view. Gold rows are the silver rows where gold succeeded, else 0."""
    wide = side_by_side(
        metrics,
        ["status", "duration", "source", "output_rows", "rows_after", "duplicates_removed", "nulls_filled"],
    )

    def time(layer: str) -> Column:
        return F.coalesce(F.col(layer)["duration"], F.lit(NO_TIME)).alias(f"{layer}_time")

    def number(layer: str, field: str) -> Column:
        return F.coalesce(F.col(layer)[field], F.lit(0))

    silver_rows = number("silver", "rows_after")
    gold_status = _shown_status("Gold", PENDING)
    return wide.select(
        "run_id",
        F.coalesce(F.col("bronze")["source"], F.lit(NO_SOURCE)).alias("source"),
        _shown_status("Bronze", PENDING).alias("bronze_status"),
        number("bronze", "output_rows").alias("bronze_rows"),
        time("bronze"),
        number("silver", "duplicates_removed").alias("duplicates_removed"),
        number("silver", "nulls_filled").alias("nulls_filled"),
        _shown_status("Silver", PENDING).alias("silver_status"),
        silver_rows.alias("silver_rows"),
        time("silver"),
        gold_status.alias("gold_status"),
        F.when(gold_status == "Success", silver_rows).otherwise(0).alias("gold_rows"),
        time("gold"),
    )


def timeline(metrics: DataFrame) -> DataFrame:
    """Events of a run in order: upload, then start and completion of each layer with a record.

    Returns ``(run_id, step, event, at, line)``; at most seven rows per run.
    """
    wide = side_by_side(metrics, ["start_time", "end_time"])
    upload = F.struct(
        F.lit(0).alias("step"),
        F.lit("CSV Uploaded").alias("event"),
        F.lit(None).cast("string").alias("at"),
        F.concat(F.lit("CSV Uploaded -> Run: run_"), F.col("run_id")).alias("line"),
    )
    steps = [upload]
    for rank, layer in enumerate(LAYERS):
        record = F.col(layer.lower())
        for offset, (verb, field) in enumerate((("Started", "start_time"), ("Completed", "end_time"))):
            event = f"{layer} {verb}"
            step = F.struct(
                F.lit(2 * rank + offset + 1).alias("step"),
                F.lit(event).alias("event"),
                record[field].alias("at"),
                F.concat(F.lit(f"{event}: "), F.coalesce(record[field], F.lit("None"))).alias("line"),
            )
            steps.append(F.when(record.isNotNull(), step))
    return wide.select("run_id", F.inline(F.filter(F.array(*steps), lambda step: step.isNotNull())))


def failures(metrics: DataFrame) -> DataFrame:
    """Failed records as ``(run_id, layer, message)``."""
    cause = F.coalesce(F.col("exception"), F.lit(NO_CAUSE))
    return metrics.where(F.col("status") == "FAILED").select(
        "run_id", "layer", F.concat(F.col("layer"), F.lit(" Layer FAILED: "), cause).alias("message")
    )
