"""Queries that take a table through the layers, in one batch or as a stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from strata import incremental, layers, metrics, runs, tables
from strata.plans.config import FlagRule, LayerConfig
from strata.session import scratch_path
from strata.workloads.inputs import DIRTY, derived, plain
from strata.workloads.registry import query, table

_DIRTY = plain(DIRTY)
STAMPS = ("_ingest_timestamp", "_processed_at", "gold_loaded_at", "batch_id", "stream")
CONFIG = LayerConfig(
    rules=(FlagRule("p", "urgency", "2-HIGH", "urgent", "regular", "Urgency added"),),
    partition_by="s",
    key="o_orderkey",
)
_SILVER = f"""
SELECT DISTINCT o_orderkey, coalesce(p, 'unknown') AS p, coalesce(t, 0) AS t, s, d FROM {_DIRTY}
"""


def exported(spark, sf_dir):
    """The dirty orders with an index column, as an export tool would leave it."""
    return derived(spark, sf_dir, DIRTY).withColumn("index", F.monotonically_increasing_id())


def refined(spark, sf_dir):
    """Run all layers over the dirty orders and return the root folder."""
    root = scratch_path(spark, "layers")
    layers.run(spark, exported(spark, sf_dir), root, "run-1", CONFIG, source_name="orders.csv")
    return root


@query(_SILVER)
def silver_transform(spark, sf_dir):
    return layers.refine(derived(spark, sf_dir, DIRTY), CONFIG)


@query(_SILVER)
def silver_layer(spark, sf_dir):
    root = scratch_path(spark, "layers")
    layers.bronze(spark, exported(spark, sf_dir), root, "run-1", CONFIG)
    layers.silver(spark, root, "run-1", CONFIG)
    return tables.read_layer(spark, layers.layer_path(root, "silver")).drop(*STAMPS)


@query(f"""
SELECT *, CASE WHEN p = '2-HIGH' THEN 'urgent' ELSE 'regular' END AS urgency FROM ({_SILVER})
""")
def gold_layer(spark, sf_dir):
    root = refined(spark, sf_dir)
    return tables.read_layer(spark, layers.layer_path(root, "gold")).drop(*STAMPS)


@query(f"""
SELECT *, CASE WHEN p = '2-HIGH' THEN 'urgent' ELSE 'regular' END AS urgency FROM ({_SILVER})
""")
def csv_to_gold(spark, sf_dir):
    path = scratch_path(spark, "orders.csv")
    exported(spark, sf_dir).write.option("header", True).csv(path)
    root = scratch_path(spark, "layers")
    layers.run(spark, path, root, "run-1", CONFIG)
    gold = tables.read_layer(spark, layers.layer_path(root, "gold")).drop(*STAMPS)
    return gold.withColumns({"o_orderkey": F.col("o_orderkey").cast("bigint"), "d": F.col("d").cast("timestamp_ntz")})


@query(f"""
WITH dirty AS {_DIRTY}, kept AS (SELECT DISTINCT * FROM dirty),
     counts AS (SELECT (SELECT count(*) FROM dirty) AS n_in, count(*) AS n_out,
                       3 * count(*) - count(p) - count(t) - count(d) AS n_null,
                       2 * count(*) - count(p) - count(t) AS n_fill FROM kept)
SELECT 'Bronze' AS layer, 'bronze_job' AS job, 'orders.csv' AS source, 'Success' AS status,
       n_in AS input_rows, n_in AS output_rows, CAST(NULL AS BIGINT) AS rows_before, CAST(NULL AS BIGINT) AS rows_after,
       CAST(NULL AS BIGINT) AS duplicates_removed, CAST(NULL AS BIGINT) AS nulls_filled,
       CAST(NULL AS BIGINT) AS nulls_filled_exact, CAST(NULL AS INT) AS aggregation_count,
       CAST(0 AS BIGINT) AS key_nulls, CAST(NULL AS VARCHAR) AS steps FROM counts
UNION ALL
SELECT 'Silver', 'silver_job', NULL, 'Success', NULL, NULL, n_in, n_out, n_in - n_out, n_null, n_fill, NULL, NULL,
       'Remove index columns, Deduplicate rows, Fill null values, Add _processed_at timestamp' FROM counts
UNION ALL
SELECT 'Gold', 'gold_job', NULL, 'Success', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 1, 0,
       'Urgency added, Partitioned by s, gold_partitioned_by_s' FROM counts
""")
def layer_metrics(spark, sf_dir):
    root = refined(spark, sf_dir)
    records = runs.read_metrics(spark, layers.metrics_path(root))
    steps = F.concat_ws(", ", "transformations", "kpis_generated", "output_datasets")
    return records.select(
        "layer",
        "job",
        "source",
        "status",
        "input_rows",
        "output_rows",
        "rows_before",
        "rows_after",
        "duplicates_removed",
        "nulls_filled",
        "nulls_filled_exact",
        "aggregation_count",
        "key_nulls",
        F.nullif(steps, F.lit("")).alias("steps"),
    )


_STREAM_CONFIG = LayerConfig(rules=(), partition_by=None, key=None)


def _batches(spark, folder_frame, folder):
    """Write a table as many files and return how many of them make a third of the table."""
    parallelism = max(spark.sparkContext.defaultParallelism, 3)
    folder_frame.repartition(parallelism).write.parquet(folder)
    return -(-parallelism // 3)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice,
       coalesce(NULLIF(o_orderpriority, '5-LOW'), 'unknown') AS o_orderpriority
FROM orders
""")
def stream_on_arrival(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )
    root = scratch_path(spark, "stream")
    max_files = _batches(spark, orders, f"{root}/in")
    stream = incremental.on_arrival(
        spark,
        f"{root}/in",
        f"{root}/layers",
        orders.schema,
        f"{root}/checkpoint",
        fmt="parquet",
        config=_STREAM_CONFIG,
        mode="append",
        max_files=max_files,
        every="0 seconds",
    )
    stream.processAllAvailable()
    stream.stop()
    return tables.read_layer(spark, layers.layer_path(f"{root}/layers", "silver")).drop(*STAMPS)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_drain(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    root = scratch_path(spark, "stream")
    max_files = _batches(spark, events, f"{root}/in")
    for _ in range(2):  # the second drain finds nothing new
        incremental.drain(
            spark,
            f"{root}/in",
            f"{root}/layers",
            events.schema,
            f"{root}/checkpoint",
            fmt="parquet",
            config=_STREAM_CONFIG,
            mode="append",
            max_files=max_files,
        )
    return tables.read_layer(spark, layers.layer_path(f"{root}/layers", "gold")).drop(*STAMPS)


@query("SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events")
def stream_across_batches(spark, sf_dir):
    """All events, then those of every other user again, in batches of their own; each row stays once."""
    events = table(spark, sf_dir, "events")
    root = scratch_path(spark, "stream")
    config = replace(_STREAM_CONFIG, across_batches=True)
    for part in (events, events.filter("user_id % 2 = 0"), events.unionByName(events.filter("user_id % 3 = 0"))):
        part.write.mode("append").parquet(f"{root}/in")
        incremental.drain(
            spark, f"{root}/in", f"{root}/layers", events.schema, f"{root}/checkpoint", "parquet", config, max_files=None
        )
    return tables.read_layer(spark, layers.layer_path(f"{root}/layers", "silver")).drop(*STAMPS)


_QUEUE = """
SELECT CAST(row_number() OVER (ORDER BY o_orderpriority) AS BIGINT) AS position,
       concat('o_orderpriority=', o_orderpriority) AS file_name, 'queued' AS status, 'scheduled' AS target_dag,
       CAST(min(o_orderdate) AS STRING) AS queued_at, CAST(NULL AS STRING) AS reserved_run_id,
       CAST(NULL AS STRING) AS reserved_at, CAST(NULL AS STRING) AS processed_run_id,
       CAST(NULL AS STRING) AS processed_at
FROM {orders} GROUP BY o_orderpriority
"""


def _scheduled_runs(spark, sf_dir):
    """Queue the orders of each priority as a file of their own and run the queue to its end."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "queue")
    orders.write.partitionBy("o_orderpriority").option("header", True).csv(f"{root}/in")
    derived(spark, sf_dir, _QUEUE).write.parquet(f"{root}/ledger/0")
    done, records = 0, True
    while records:
        entries = spark.read.parquet(f"{root}/ledger/{done}")
        entries, records = incremental.run_next(
            spark, entries, f"{root}/in", f"{root}/layers", "scheduled", f"scheduled__{done + 1}", "2026-07-02T05:00:00", _STREAM_CONFIG
        )
        if records:
            done += 1
            entries.write.parquet(f"{root}/ledger/{done}")
    return entries, f"{root}/layers"


@query(f"""
SELECT position, file_name, 'processed' AS status, target_dag, queued_at, 'scheduled__' || position AS reserved_run_id,
       '2026-07-02T05:00:00' AS reserved_at, 'scheduled__' || position AS processed_run_id, '2026-07-02T05:00:00' AS processed_at
FROM {plain(_QUEUE)}
""")
def scheduled_ledger(spark, sf_dir):
    return _scheduled_runs(spark, sf_dir)[0]


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
WHERE o_orderpriority = (SELECT max(o_orderpriority) FROM orders)
""")
def scheduled_layer(spark, sf_dir):
    like = table(spark, sf_dir, "orders").drop("o_orderpriority")
    silver = tables.read_layer(spark, layers.layer_path(_scheduled_runs(spark, sf_dir)[1], "silver")).drop(*STAMPS)
    return silver.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema))


@query("""
SELECT count(*) AS rows, count(*) FILTER (WHERE l_returnflag = 'R') AS returned FROM lineitem
""")
def observed_counts(spark, sf_dir):
    root = scratch_path(spark, "observed")
    returned = F.count_if(F.col("l_returnflag") == "R")
    df, seen = metrics.observe_counts(table(spark, sf_dir, "lineitem"), returned=returned)
    tables.write_layer(df, root)
    got = seen.get
    return spark.createDataFrame([(got["rows"], got["returned"])], "rows bigint, returned bigint")
