"""Record schemas shared by the run-metrics, run-history and ledger operators."""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ("Bronze", "Silver", "Gold")

# Names of the lineage columns a row collects on its way.
INGESTED_AT = "_ingest_timestamp"
PROCESSED_AT = "_processed_at"
LOADED_AT = "gold_loaded_at"

# Field names of run records, ledger entries and pipeline runs.
METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("output_rows", T.LongType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("duplicates_removed", T.LongType()),
        T.StructField("nulls_filled", T.LongType()),
        T.StructField("nulls_filled_exact", T.LongType()),
        T.StructField("transformations", T.ArrayType(T.StringType())),
        T.StructField("kpis_generated", T.ArrayType(T.StringType())),
        T.StructField("aggregation_count", T.IntegerType()),
        T.StructField("output_datasets", T.ArrayType(T.StringType())),
        T.StructField(
            "schema",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("type", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("exception", T.StringType()),
        T.StructField("skipped", T.BooleanType()),
        T.StructField("key_nulls", T.LongType()),
        T.StructField("malformed_rows", T.LongType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("target_dag", T.StringType()),
        T.StructField("queued_at", T.StringType()),
        T.StructField("reserved_run_id", T.StringType()),
        T.StructField("reserved_at", T.StringType()),
        T.StructField("processed_run_id", T.StringType()),
        T.StructField("processed_at", T.StringType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("conf", T.MapType(T.StringType(), T.StringType())),
    ]
)
