"""Queries over what used to be lost at the input: lines, headers, malformed rows, queues, warnings."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import incremental, layers, runs, sources, tables
from strata.plans.config import LayerConfig
from strata.session import scratch_path
from strata.workloads.inputs import derived
from strata.workloads.layering import _QUEUE, STAMPS
from strata.workloads.registry import query, table

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_PLAIN = LayerConfig(rules=(), partition_by=None, key="o_orderkey")


@query(f"SELECT {_ORDERS} FROM orders")
def json_lines_to_gold(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path, root = scratch_path(spark, "orders") + ".json", scratch_path(spark, "layers")
    orders.write.json(path)
    config = LayerConfig(rules=(), partition_by="o_orderpriority", key="o_orderkey", lines=True)
    layers.run(spark, path, root, "run-1", config, schema_in=orders.schema)
    return tables.read_layer(spark, layers.layer_path(root, "gold")).select(*orders.columns)


@query(f"SELECT {_ORDERS} FROM orders")
def csv_reordered_header(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders.csv")
    orders.select(*reversed(orders.columns)).write.option("header", True).csv(path)
    return sources.read_csv(spark, path, orders.schema)


@query(f"""
SELECT {_ORDERS}, CAST(NULL AS BIGINT) AS batch FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT {_ORDERS}, NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, NULL, o_orderdate, o_orderpriority, 7 FROM orders WHERE o_orderstatus = 'P'
""")
def csv_two_headers(spark, sf_dir):
    """One folder with the columns in two orders, and files that have one column more and one less."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders.csv")
    orders.where("o_orderstatus = 'F'").write.option("header", True).csv(path)
    orders.where("o_orderstatus = 'O'").select(*reversed(orders.columns)).write.mode("append").option("header", True).csv(path)
    other = orders.where("o_orderstatus = 'P'").select(F.lit(7).alias("batch"), *reversed(orders.drop("o_totalprice").columns))
    other.write.mode("append").option("header", True).csv(path)
    found = sources.read_csv(spark, path)
    kept = [F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema]
    return found.select(*kept, F.col("batch").cast("bigint").alias("batch"))


@query("""
SELECT count(*) AS input_rows, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS malformed_rows,
       count(*) FILTER (WHERE o_orderkey % 3 = 0) AS key_nulls FROM orders
""")
def malformed_rows(spark, sf_dir):
    """A third of the rows has text where the key is to be a number."""
    orders = table(spark, sf_dir, "orders")
    path, root = scratch_path(spark, "orders.csv"), scratch_path(spark, "layers")
    key = F.col("o_orderkey").cast("string")
    spoiled = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("no "), key)).otherwise(key)
    orders.withColumn("o_orderkey", spoiled).write.option("header", True).csv(path)
    config = LayerConfig(rules=(), partition_by=None, key="o_orderkey", malformed="keep")
    layers.bronze(spark, path, root, "run-1", config, orders.schema)
    return runs.read_metrics(spark, layers.metrics_path(root)).select("input_rows", "malformed_rows", "key_nulls")


@query("""
SELECT * FROM (VALUES ('Silver', 'skipped: no input'), ('Gold', 'skipped: no input')) AS w(layer, warning)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey IS NULL)
""")
def skipped_layers(spark, sf_dir):
    """No order lacks a key, so the raw layer is empty and the stages after it are skipped."""
    root = scratch_path(spark, "layers")
    layers.run(spark, table(spark, sf_dir, "orders").where("o_orderkey IS NULL"), root, "run-1", _PLAIN)
    return runs.warnings(runs.read_metrics(spark, layers.metrics_path(root))).select("layer", "warning")


@query("""
SELECT 'Bronze' AS layer, 'run-2' AS run_id, count(*) AS rows FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'Silver', 'run-2', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'Gold', 'run-1', NULL
""")
def latest_records(spark, sf_dir):
    root = scratch_path(spark, "layers")
    orders = table(spark, sf_dir, "orders")
    layers.run(spark, orders.where("o_orderstatus = 'F'"), root, "run-1", _PLAIN)
    layers.bronze(spark, orders.where("o_orderstatus = 'O'"), root, "run-2", _PLAIN)
    layers.silver(spark, root, "run-2", _PLAIN)
    newest = runs.latest_records(runs.read_metrics(spark, layers.metrics_path(root)))
    return newest.select("layer", "run_id", F.coalesce("output_rows", "rows_after").alias("rows"))


def _drained_queue(spark, sf_dir):
    """Queue the orders of each priority as a file and run all of them through the stored queue."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "queue")
    orders.write.partitionBy("o_orderpriority").option("header", True).csv(f"{root}/in")
    incremental.store_ledger(derived(spark, sf_dir, _QUEUE), f"{root}/ledger")
    done = 0
    while incremental.run_stored(
        spark, f"{root}/ledger", f"{root}/in", f"{root}/layers", "scheduled", f"run-{done + 1}", "2031-07-02T05:00:00", _PLAIN
    ):
        done += 1
    return incremental.load_ledger(spark, f"{root}/ledger"), f"{root}/layers"


@query("""
SELECT position, file_name, 'processed' AS status, 'run-' || position AS reserved_run_id, 'run-' || position AS processed_run_id
FROM (SELECT CAST(row_number() OVER (ORDER BY o_orderpriority) AS BIGINT) AS position,
             concat('o_orderpriority=', o_orderpriority) AS file_name FROM (SELECT DISTINCT o_orderpriority FROM orders))
""")
def queue_drained(spark, sf_dir):
    return _drained_queue(spark, sf_dir)[0].select("position", "file_name", "status", "reserved_run_id", "processed_run_id")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
WHERE o_orderpriority = (SELECT max(o_orderpriority) FROM orders)
""")
def queue_last_layer(spark, sf_dir):
    like = table(spark, sf_dir, "orders").drop("o_orderpriority")
    gold = tables.read_layer(spark, layers.layer_path(_drained_queue(spark, sf_dir)[1], "gold")).drop(*STAMPS)
    return gold.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema))
