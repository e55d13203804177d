"""The three layers: raw (bronze), refined (silver), enriched and partitioned (gold).

Every stage writes once. Its counters ride on that write, placed after the last
shuffle, so they need no further pass over the data.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import session
from strata.functions.naming import col
from strata.model import INGESTED_AT, LOADED_AT, PROCESSED_AT
from strata.operators import clean, columns, quality, schema
from strata.plans import metrics
from strata.plans.config import LayerConfig
from strata.sources import files, tables
from strata.streaming import seen as seen_rows

DEFAULT = LayerConfig()

# Step names in the run records.
STEP_ARTIFACTS = "Remove index columns"
STEP_DEDUPE = "Deduplicate rows"
STEP_FILL = "Fill null values"
STEP_STAMP = f"Add {PROCESSED_AT} timestamp"


def layer_path(root: str, layer: str, batch: int | str | None = None) -> str:
    """Folder of a layer, or of the part of it that one stream batch wrote.

    A batch is named by its number, or as ``<stream>/<number>`` where several streams share a root.
    """
    path = f"{root.rstrip('/')}/{layer.lower()}"
    if batch is None:
        return path
    stream, _, number = str(batch).rpartition("/")
    return f"{path}/stream={stream}/batch_id={number}" if stream else f"{path}/batch_id={number}"


def metrics_path(root: str) -> str:
    return f"{root.rstrip('/')}/metadata"


def refine(df: DataFrame, config: LayerConfig = DEFAULT) -> DataFrame:
    """Silver rows without the stamp: artifacts dropped, deduplicated, nulls filled."""
    df = clean.dedupe(columns.drop_artifacts(df, config.artifacts))
    return clean.fill_nulls(df, config.fill_string, config.fill_number)


def seen_path(root: str, batch: int | str) -> str:
    """Folder of the hashes of the rows that the batches of a stream had."""
    return layer_path(root, "seen", batch).rsplit("/batch_id=", 1)[0]


def refine_counted(df: DataFrame, config: LayerConfig = DEFAULT, mark: Callable[[DataFrame, list[str]], DataFrame] | None = None):
    """:func:`refine` with counters on it: ``(frame, observation)``.

    The number of copies travels with each distinct row, so rows before and after,
    null cells and filled cells are all counted in the stage after the one shuffle.
    ``mark`` adds a column ``known`` to the distinct rows; known rows are counted, but left out.
    """
    df = columns.drop_artifacts(df, config.artifacts)
    distinct = clean.count_copies_screened(df) if config.screen_duplicates else clean.count_copies(df)
    cells = [(F.col(f"c{i}"), field.dataType) for i, field in enumerate(df.schema)]
    gaps = sum(
        (clean.is_gap(cell, dtype).cast("int") for cell, dtype in cells if clean.is_filled(dtype)), F.lit(0)
    )
    distinct = distinct.withColumn("known", F.lit(False)) if mark is None else mark(distinct, df.columns)
    fresh = ~F.col("known")
    counted, seen = metrics.observe_counts(
        distinct.withColumns({"nulls": quality.row_nulls([cell for cell, _ in cells]), "gaps": gaps}),
        rows_before=F.sum("copies"),
        known=F.count_if("known"),
        nulls=F.sum(F.when(fresh, F.col("nulls"))),
        gaps=F.sum(F.when(fresh, F.col("gaps"))),
    )
    filled = [
        clean.filled(cell, dtype, config.fill_string, config.fill_number).alias(f"c{i}")
        for i, (cell, dtype) in enumerate(cells)
    ]
    return counted.filter(fresh).select(*filled).toDF(*df.columns), seen


def enrich(df: DataFrame, config: LayerConfig = DEFAULT) -> DataFrame:
    """Gold rows without the stamp: each rule whose source column exists appends its flag."""
    for rule in config.rules:
        df = columns.flag(df, rule.source, rule.target, rule.equals, rule.then, rule.otherwise)
    return df


def bronze(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    run_id: str,
    config: LayerConfig = DEFAULT,
    schema_in: T.StructType | None = None,
    batch: int | str | None = None,
    source_name: str | None = None,
) -> dict:
    """Write a source file (or frame) with a load stamp to the raw layer."""
    name = source_name or (source.rstrip("/").rsplit("/", 1)[-1] if isinstance(source, str) else "stream")
    path = layer_path(root, "bronze", batch)
    with _recorded(spark, root, run_id, "Bronze", path) as entry:
        entry.update(source=name, input_rows=0, output_rows=0, schema=[])
        df = source
        if isinstance(source, str):
            df = files.read_source(spark, source, schema_in, config.lines, config.malformed)
        marked = F.col(files.MALFORMED).isNotNull() if files.MALFORMED in df.columns else F.lit(False)
        counted, seen = metrics.observe_counts(df, key_nulls=_key_nulls(df, config), malformed=F.count_if(marked))
        tables.write_layer(columns.stamp(counted, INGESTED_AT), path, fmt=config.fmt)
        rows, key_nulls = seen.get["rows"], seen.get["key_nulls"]
        entry.update(input_rows=rows, output_rows=rows, schema=schema.fields(df), key_nulls=key_nulls)
        entry.update(malformed_rows=seen.get["malformed"])
    return entry


def silver(
    spark: SparkSession, root: str, run_id: str, config: LayerConfig = DEFAULT, batch: int | str | None = None
) -> dict:
    """Refine the raw layer. An empty raw layer leaves the refined one as it is."""
    path = layer_path(root, "silver", batch)
    with _recorded(spark, root, run_id, "Silver", path) as entry:
        entry.update(
            rows_before=0, rows_after=0, duplicates_removed=0, nulls_filled=0, nulls_filled_exact=0, transformations=[]
        )
        source = layer_path(root, "bronze", batch)
        df = tables.read_layer(spark, source, config.fmt).drop(files.MALFORMED)
        if df.isEmpty():
            entry["skipped"] = True
        else:
            # A schema that does not fit is refused before any pass over the data.
            tables.check_fits(columns.stamp(columns.drop_artifacts(df, config.artifacts), PROCESSED_AT), path, config.fmt)
            with session.settings(spark, session.shuffle_sized_for(spark, source)):
                mark = None
                if config.across_batches and batch is not None:
                    index, number = seen_path(root, batch), int(str(batch).rpartition("/")[2])
                    mark = lambda distinct, names: seen_rows.mark(distinct, names, index, number)
                refined, seen = refine_counted(df, config, mark)
                tables.write_layer(columns.stamp(refined, PROCESSED_AT), path, fmt=config.fmt)
            figures = _figures(seen.get)
            dropped = len(refined.columns) < len(df.columns)
            entry.update(
                figures,
                rows_after=figures["rows_before"] - figures["duplicates_removed"],
                transformations=[STEP_ARTIFACTS] * dropped + [STEP_DEDUPE, STEP_FILL, STEP_STAMP],
            )
    return entry


def gold(
    spark: SparkSession, root: str, run_id: str, config: LayerConfig = DEFAULT, batch: int | str | None = None
) -> dict:
    """Enrich the refined layer and write it partitioned. A missing or empty one is skipped."""
    path = layer_path(root, "gold", batch)
    with _recorded(spark, root, run_id, "Gold", path) as entry:
        entry.update(kpis_generated=[], aggregation_count=0, output_datasets=[])
        source = layer_path(root, "silver", batch)
        df = tables.layer_or_none(spark, source, config.fmt)
        if df is None or df.isEmpty():
            entry["skipped"] = True
        else:
            fired = [rule for rule in config.rules if rule.source in df.columns]
            part = config.partition_by if config.partition_by in df.columns else None
            out = enrich(columns.stamp(df, LOADED_AT), config)
            gather = config.rebalance
            if gather is None:
                gather = part is not None and tables.leaves_small_files(df, part, session.stored_bytes(spark, source))
            if gather:
                out = tables.spread_for_write(out, part)
                writing = session.shuffle_sized_for(spark, source)
            else:
                # A writer per value stays open, so rows need no sort by value either.
                writing = {"spark.sql.maxConcurrentOutputFileWriters": tables.DIRECT_VALUES}
            out, seen = metrics.observe_counts(out, key_nulls=_key_nulls(out, config))
            entry.update(
                kpis_generated=[rule.label or f"{rule.target} added" for rule in fired]
                + ([f"Partitioned by {part}"] if part else []),
                aggregation_count=len(fired),
            )
            with session.settings(spark, writing):
                tables.write_layer(out, path, partition_by=part, merge_schema=True, fmt=config.fmt)
            entry.update(
                output_datasets=[f"gold_partitioned_by_{part}" if part else "gold_unpartitioned"],
                key_nulls=seen.get["key_nulls"],
            )
    return entry


def run(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    run_id: str,
    config: LayerConfig = DEFAULT,
    schema_in: T.StructType | None = None,
    batch: int | str | None = None,
    source_name: str | None = None,
) -> list[dict]:
    """Take a source through all three layers and return their records."""
    return [
        bronze(spark, source, root, run_id, config, schema_in, batch, source_name),
        silver(spark, root, run_id, config, batch),
        gold(spark, root, run_id, config, batch),
    ]


def _figures(seen: dict) -> dict:
    return {
        "rows_before": seen["rows_before"],
        "duplicates_removed": seen["rows_before"] - seen["rows"] + seen["known"],
        "nulls_filled": seen["nulls"],
        "nulls_filled_exact": seen["gaps"],
    }


def _key_nulls(df: DataFrame, config: LayerConfig) -> Column:
    """Counter of null keys: in the raw layer it sees them, after filling only those of unfilled types."""
    return F.count_if(col(config.key).isNull() if config.key in df.columns else F.lit(False))


@contextmanager
def _recorded(spark: SparkSession, root: str, run_id: str, layer: str, output: str) -> Iterator[dict]:
    """Record a stage whether it succeeds or fails; a failure is raised again."""
    began = time.monotonic()
    entry = {
        "layer": layer,
        "job": f"{layer.lower()}_job",
        "app_name": f"{layer}Job",
        "output": output,
        "start_time": _now(),
        "status": "Success",
        "skipped": False,
    }
    try:
        yield entry
    except Exception as error:
        entry.update(status="FAILED", exception=str(error))
        raise
    finally:
        entry.update(end_time=_now(), duration=f"{time.monotonic() - began:.2f} sec")
        metrics.record(spark, metrics_path(root), run_id, **entry)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
