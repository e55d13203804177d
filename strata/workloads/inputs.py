"""Inputs derived from the given tables, in SQL that Spark and the oracle both run.

The tables hold no nulls and no equal rows, so both are brought in here by
column values: a third of the orders twice, and three columns with nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.workloads.registry import table

_DIRTY_COLUMNS = """
    o_orderkey,
    NULLIF(o_orderpriority, '5-LOW') AS p,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS t,
    o_orderstatus AS s,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS d
"""

DIRTY = f"""
SELECT {_DIRTY_COLUMNS} FROM {{orders}}
UNION ALL
SELECT {_DIRTY_COLUMNS} FROM {{orders}} WHERE o_orderstatus = 'F'
"""

_METRICS = """
SELECT
    RUN AS run_id,
    CASE o_orderstatus WHEN 'O' THEN 'Bronze' WHEN 'P' THEN 'Silver' ELSE 'Gold' END AS layer,
    CASE WHEN o_orderstatus = 'O' THEN concat('file_', max(o_orderpriority), '.csv') END AS source,
    CASE WHEN o_orderstatus = 'O' THEN count(*) END AS input_rows,
    CASE WHEN o_orderstatus = 'O'
        THEN CAST(sum(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) AS BIGINT) END AS output_rows,
    CASE WHEN o_orderstatus = 'P' THEN count(*) END AS rows_before,
    CASE WHEN o_orderstatus = 'P'
        THEN CAST(sum(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) AS BIGINT) END AS rows_after,
    CASE WHEN o_orderstatus = 'P'
        THEN CAST(sum(CASE WHEN o_totalprice > 400000 THEN 0 ELSE 1 END) AS BIGINT) END AS duplicates_removed,
    CASE WHEN o_orderstatus = 'P'
        THEN CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) END AS nulls_filled,
    CASE WHEN o_orderstatus = 'F' THEN CAST(count(DISTINCT o_orderpriority) AS INT) END AS aggregation_count,
    CAST(min(o_orderdate) AS STRING) AS start_time,
    CAST(max(o_orderdate) AS STRING) AS end_time,
    concat(CAST(count(*) AS STRING), '.00 sec') AS duration,
    CASE max(o_orderpriority) WHEN '5-LOW' THEN 'Success' WHEN '4-NOT SPECIFIED' THEN 'FAILED' END AS status,
    CASE WHEN max(o_orderpriority) = '4-NOT SPECIFIED' AND min(o_orderpriority) = '1-URGENT'
        THEN concat('orders from ', CAST(min(o_orderkey) AS STRING)) END AS exception
FROM {orders}
GROUP BY 1, o_orderstatus
"""

# One run per customer, and one run per month for the queries that write a file per record.
METRICS = _METRICS.replace("RUN", "CAST(o_custkey AS STRING)")
MONTHLY_METRICS = _METRICS.replace("RUN", "substr(CAST(o_orderdate AS STRING), 1, 7)")

RUNS = """
SELECT
    event_type AS pipeline_id,
    concat(
        CASE event_type WHEN 'click' THEN 'manual__' WHEN 'purchase' THEN 'scheduled__' ELSE 'api__' END,
        CAST(event_id AS STRING)) AS run_id,
    CASE WHEN value > 20 THEN 'success' ELSE 'failed' END AS state,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS STRING) END AS start_date
FROM {events}
"""

# Run ids repeat and partly meet the ledger's; one pipeline names its file in the run itself.
FILE_RUNS = """
SELECT
    event_id,
    event_type AS pipeline_id,
    concat('run_', CAST(user_id * 20 AS STRING)) AS run_id,
    CASE event_type WHEN 'signup' THEN concat('conf_', CAST(user_id AS STRING), '.csv') WHEN 'view' THEN '' END
        AS conf_file
FROM {events}
"""

LEDGER = """
SELECT
    o_orderkey AS position,
    concat('file_', CAST(o_orderkey AS STRING), '.csv') AS file_name,
    CASE o_orderstatus WHEN 'F' THEN 'queued' WHEN 'O' THEN 'reserved' ELSE 'processed' END AS status,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'event_driven' ELSE 'scheduled' END AS target_dag,
    CAST(o_orderdate AS STRING) AS queued_at,
    CASE WHEN o_orderstatus <> 'F' THEN concat('run_', CAST(o_custkey AS STRING)) END AS reserved_run_id,
    CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS STRING) END AS reserved_at,
    CASE WHEN o_orderstatus = 'P' THEN concat('run_', CAST(o_custkey AS STRING)) END AS processed_run_id,
    CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS STRING) END AS processed_at
FROM {orders}
"""


def plain(sql: str) -> str:
    """The same SQL over the plain table names, as a parenthesised subquery."""
    return f"({sql.format(orders='orders', events='events')})"


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the inputs above on the tables of a folder."""
    names = [name for name in ("orders", "events") if "{" + name + "}" in sql]
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def file_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline runs whose ``conf`` map may name a file."""
    df = derived(spark, sf_dir, FILE_RUNS)
    return df.withColumn("conf", F.create_map(F.lit("file_name"), F.col("conf_file"))).drop("conf_file")
