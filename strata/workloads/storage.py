"""Queries over sources, sinks and schemas. Each writes a whole table and reads it back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import sources, tables
from strata.session import scratch_path
from strata.workloads.registry import query, table

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _as_written(df: DataFrame, like: DataFrame) -> DataFrame:
    """Cast inferred types back: inference narrows whole numbers to what the file needs."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema])


@query(f"SELECT {_ORDERS} FROM orders")
def csv_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders.csv")
    orders.write.option("header", True).csv(path)
    return _as_written(sources.read_source(spark, path), orders)


@query(f"SELECT {_ORDERS} FROM orders")
def csv_scan_with_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders.csv")
    orders.write.option("header", True).csv(path)
    return sources.read_csv(spark, path, orders.schema)


def _json_arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one JSON array per partition, so each file written from them is one array."""
    lead = "["
    for batch in batches:
        if len(batch):
            lines = "," + batch["value"]
            lines.iloc[0] = lead + batch["value"].iloc[0]
            lead = ","
            yield lines.to_frame()
    yield pd.DataFrame({"value": ["]" if lead == "," else "[]"]})


@query(f"SELECT {_ORDERS} FROM orders")
def json_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders") + ".json"
    rows = orders.select(F.to_json(F.struct("*")).alias("value"))
    rows.mapInPandas(_json_arrays, "value string").write.text(path)
    return _as_written(sources.read_source(spark, path), orders)


@query(f"SELECT {_ORDERS} FROM orders")
def json_lines_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders.json")
    orders.write.json(path)
    return sources.read_json(spark, path, orders.schema, lines=True)


@query("""
SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders
UNION ALL
SELECT o_orderkey, NULL, o_totalprice FROM orders
""")
def raw_union_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "raw")
    orders.select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/a")
    orders.select("o_orderkey", "o_totalprice").write.parquet(f"{root}/b")
    return tables.scan_files(spark, f"{root}/a", f"{root}/b", f"{root}/absent")


@query("""
SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS price, CAST(o_custkey AS VARCHAR) AS who, CAST(o_orderdate AS DATE)::TIMESTAMP AS day
FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate FROM orders
UNION ALL SELECT o_custkey, NULL, NULL, NULL FROM orders
""")
def raw_union_widened(spark, sf_dir):
    """Two kinds of files in one folder, a third in another: whole and real numbers, numbers and texts, days and times."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "raw")
    whole = orders.selectExpr("o_orderkey", "int(floor(o_totalprice)) AS price", "o_custkey AS who", "date(o_orderdate) AS day")
    whole.write.parquet(f"{root}/a")
    orders.selectExpr("o_orderkey", "o_totalprice AS price", "o_orderstatus AS who", "o_orderdate AS day").write.mode("append").parquet(f"{root}/a")
    orders.selectExpr("int(o_custkey) AS o_orderkey").write.parquet(f"{root}/b")
    return tables.scan_files(spark, f"{root}/a", f"{root}/b", f"{root}/absent", widened=True)


@query("""
SELECT * FROM (VALUES ('price', 'double,int', 'double'), ('who', 'bigint,string', 'string')) AS c("column", types, merged)
WHERE EXISTS (SELECT 1 FROM orders)
""")
def raw_type_clashes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "raw")
    orders.selectExpr("o_orderkey", "int(floor(o_totalprice)) AS price", "o_custkey AS who").write.parquet(root)
    orders.selectExpr("o_orderkey", "o_totalprice AS price", "o_orderstatus AS who").write.mode("append").parquet(root)
    return tables.type_clashes(spark, root).withColumn("types", F.concat_ws(",", F.array_sort("types")))


@query("SELECT event_id, event_type, value FROM events")
def partition_files_scan(spark, sf_dir):
    root = scratch_path(spark, "raw")
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    tables.write_layer(tables.spread_for_write(events, "event_type"), root, partition_by="event_type")
    return tables.scan_files(spark, root)


@query(f"SELECT {_ORDERS} FROM orders")
def overwrite_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "layer")
    tables.write_layer(orders, path)
    tables.write_layer(orders, path)
    return tables.read_layer(spark, path)


@query(f"SELECT {_ORDERS} FROM orders")
def overwrite_that_fails(spark, sf_dir):
    """A writer that stops midway leaves the former rows, also in a partitioned table."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "layer")
    schema = tables.write_layer(orders, path, partition_by="o_orderpriority")
    stops = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("stopped midway"))).otherwise(F.col("o_orderstatus"))
    try:
        tables.write_layer(orders.withColumn("o_orderstatus", stops.cast("string")), path, partition_by="o_orderpriority")
    except PySparkException as error:
        if "stopped midway" not in str(error):
            raise
    return tables.read_layer(spark, path, schema=schema)


@query("""
SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN '01' WHEN 'O' THEN '02' ELSE '3.0' END AS part
FROM orders
""")
def partitioned_write(spark, sf_dir):
    part = F.when(F.col("o_orderstatus") == "F", "01").when(F.col("o_orderstatus") == "O", "02").otherwise("3.0")
    df = table(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"), "o_totalprice")
    path = scratch_path(spark, "layer")
    schema = tables.write_layer(tables.spread_for_write(df, "part"), path, partition_by="part")
    return tables.read_layer(spark, path, schema=schema)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer")
def schema_conform(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "layer")
    tables.write_layer(customer, path)
    tables.write_layer(customer.drop("c_mktsegment"), path)
    return tables.read_layer(spark, path)


@query("""
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey, c_acctbal, c_mktsegment,
       upper(c_mktsegment) AS segment
FROM customer
""")
def schema_evolve(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "layer")
    tables.write_layer(customer, path)
    changed = customer.drop("c_name").withColumn("segment", F.upper("c_mktsegment"))
    tables.write_layer(changed, path, merge_schema=True)
    return tables.read_layer(spark, path)


@query("""
SELECT 'orders' AS origin, o_orderkey AS key, o_orderstatus AS status, CAST(NULL AS DOUBLE) AS balance FROM orders
UNION ALL
SELECT 'customer', c_custkey, NULL, c_acctbal FROM customer
""")
def union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("origin"), F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("key"), F.lit("customer").alias("origin")
    )
    return tables.union_all([orders, customer])


@query("SELECT page_id, url, lower(url) LIKE '%.html' OR lower(url) LIKE '%.csv' AS valid FROM pages")
def validate_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return sources.validate_names(pages, (".html", ".csv"), "url")
