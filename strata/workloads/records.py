"""Queries over run records, the ledger, lineage and formatting."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import fmt, ledger, lineage, metrics, report, runs, tables
from strata.model import METRICS as METRICS_SCHEMA
from strata.session import scratch_path
from strata.workloads import inputs
from strata.workloads.inputs import LEDGER, METRICS, MONTHLY_METRICS, RUNS, derived, plain
from strata.workloads.registry import query, table

_METRICS = plain(METRICS)
_MONTHLY = plain(MONTHLY_METRICS)
_RUNS = plain(RUNS)
_LEDGER = plain(LEDGER)
_FILE_RUNS = plain(inputs.FILE_RUNS)


# Runs


def _recent_sql(pipelines: str, k: int) -> str:
    return f"""
WITH top AS (
    SELECT * FROM {_RUNS} WHERE pipeline_id IN ({pipelines})
    QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY start_date DESC NULLS LAST, run_id) <= {k}),
numbered AS (
    SELECT *, CAST(row_number() OVER (ORDER BY start_date DESC NULLS LAST, pipeline_id, run_id) AS INT) AS position
    FROM top)
SELECT *, CASE WHEN starts_with(run_id, 'manual__') THEN 'Manual Run '
               WHEN starts_with(run_id, 'scheduled__') THEN 'Scheduled Run '
               ELSE 'Pipeline Run ' END || position AS display_name
FROM numbered
"""


@query(_recent_sql("'click', 'purchase', 'error', 'view', 'signup'", 6))
def recent_runs(spark, sf_dir):
    return runs.recent(derived(spark, sf_dir, RUNS), ["click", "purchase", "error", "view", "signup"])


@query(_recent_sql("'purchase'", 10))
def recent_runs_of_one(spark, sf_dir):
    return runs.recent(derived(spark, sf_dir, RUNS), ["purchase"], k=10)


@query(_recent_sql("'click', 'purchase', 'error'", 1500))
def recent_runs_deep(spark, sf_dir):
    return runs.recent(derived(spark, sf_dir, RUNS), ["click", "purchase", "error"], k=1500)


@query("""
SELECT event_id AS run_id, event_type AS state, 'event_driven' AS pipeline_id FROM events
UNION ALL SELECT o_orderkey, o_orderstatus, 'scheduled' FROM orders
""")
def union_runs(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("state"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("state")
    )
    return runs.union_runs({"event_driven": events, "scheduled": orders})


_FILE_FOR_RUN = f"""
WITH ledger AS {_LEDGER},
named AS (
    SELECT processed_run_id AS run_id, position, file_name FROM ledger WHERE processed_run_id IS NOT NULL
    UNION ALL
    SELECT reserved_run_id, position, file_name FROM ledger WHERE reserved_run_id IS NOT NULL),
last AS (SELECT run_id, arg_max(file_name, position) AS file_name FROM named GROUP BY run_id)
SELECT r.event_id, r.pipeline_id, r.run_id,
       coalesce(NULLIF(r.conf_file, ''), l.file_name,
                CASE WHEN r.pipeline_id = 'purchase' THEN 'Queued file' ELSE 'Not available' END) AS file_name
FROM {_FILE_RUNS} r LEFT JOIN last l ON r.run_id = l.run_id
"""


@query(_FILE_FOR_RUN)
def file_for_run(spark, sf_dir):
    found = runs.attach_file(inputs.file_runs(spark, sf_dir), derived(spark, sf_dir, LEDGER), "purchase")
    return found.select("event_id", "pipeline_id", "run_id", "file_name")


# The same lookup with the broadcast ruled out, as for a ledger beyond the bound.
@query(_FILE_FOR_RUN)
def file_for_run_shuffled(spark, sf_dir):
    found = runs.attach_file(
        inputs.file_runs(spark, sf_dir), derived(spark, sf_dir, LEDGER), "purchase", max_broadcast_rows=0
    )
    return found.select("event_id", "pipeline_id", "run_id", "file_name")


@query(f"""
SELECT run_id,
       coalesce(max(input_rows) FILTER (WHERE layer = 'Bronze'), 0) AS rows_uploaded,
       coalesce(max(output_rows) FILTER (WHERE layer = 'Bronze'), 0) AS rows_processed,
       coalesce(max(duplicates_removed) FILTER (WHERE layer = 'Silver'), 0) AS duplicates_removed,
       coalesce(max(nulls_filled) FILTER (WHERE layer = 'Silver'), 0) AS nulls_filled,
       coalesce(max(rows_after) FILTER (WHERE layer = 'Silver'), 0) AS final_rows
FROM {_METRICS} GROUP BY run_id
""")
def quality_summary(spark, sf_dir):
    return runs.quality_summary(derived(spark, sf_dir, METRICS))


_SAVED = "run_id, layer, source, input_rows, output_rows, rows_before, rows_after, status, duration, exception"


def _saved(spark, sf_dir):
    root = scratch_path(spark, "metadata")
    metrics.save(tables.conform(derived(spark, sf_dir, MONTHLY_METRICS), METRICS_SCHEMA), root)
    return runs.read_metrics(spark, root)


@query(f"SELECT {_SAVED} FROM {_MONTHLY}")
def read_metrics(spark, sf_dir):
    return _saved(spark, sf_dir).select(*_SAVED.split(", "))


@query(f"""
SELECT run_id, layer, source, input_rows, output_rows, rows_before, rows_after, status,
       CASE WHEN layer = 'Gold' THEN 'again' ELSE duration END AS duration, exception
FROM {_METRICS}
""")
def records_replaced(spark, sf_dir):
    """A record per customer and layer, logged in bulk, one layer logged again, and the log compacted."""
    root = scratch_path(spark, "metadata")
    found = tables.conform(derived(spark, sf_dir, METRICS), METRICS_SCHEMA)
    metrics.save(found, root)
    metrics.save(found.where("layer = 'Gold'").withColumn("duration", F.lit("again")), root)
    metrics.compact(spark, root)
    return runs.read_metrics(spark, root).select(*_SAVED.split(", "))


@query(f"SELECT DISTINCT run_id FROM {_MONTHLY}")
def list_runs(spark, sf_dir):
    return runs.list_runs(_saved(spark, sf_dir))


@query(f"SELECT start_time AS time, layer, status, duration FROM {_MONTHLY}")
def run_history(spark, sf_dir):
    folder = scratch_path(spark, "history")
    records = derived(spark, sf_dir, MONTHLY_METRICS).orderBy("start_time", "layer")
    records.write.option("maxRecordsPerFile", 1).json(folder)
    return runs.history(runs.read_history(spark, folder))


def _entries_sql(metrics_sql: str) -> str:
    numbers = ["input_rows", "output_rows", "rows_before", "rows_after", "duplicates_removed", "nulls_filled"]
    texts = ["layer", "source", "aggregation_count", "start_time", "end_time", "duration", "status", "exception"]
    present = [key for key in runs.RECORD_KEYS if key in numbers + texts]
    return "\nUNION ALL\n".join(
        f"SELECT run_id, layer, CAST({i} AS INT) AS position, '{key}' AS key, CAST({key} AS VARCHAR) AS value "
        f"FROM {metrics_sql} WHERE {key} IS NOT NULL"
        for i, key in enumerate(present)
    )


@query(_entries_sql(_METRICS))
def unpivot_metrics(spark, sf_dir):
    return runs.unpivot_metrics(derived(spark, sf_dir, METRICS))


@query(f"""
WITH records AS {_METRICS}, entry AS ({_entries_sql('records')}),
block AS (
    SELECT run_id, layer, string_agg(' - ' || key || ': ' || value || chr(10), '' ORDER BY position) AS text
    FROM entry GROUP BY run_id, layer),
wide AS (
    SELECT run_id, max(text) FILTER (WHERE layer = 'Bronze') AS b, max(text) FILTER (WHERE layer = 'Silver') AS s,
           max(text) FILTER (WHERE layer = 'Gold') AS g
    FROM block GROUP BY run_id),
missing AS (SELECT ' - Status: No metrics found (Job may have failed or skipped)' || chr(10) AS text)
SELECT run_id, 'PIPELINE EXECUTION REPORT' || chr(10) || '=========================' || chr(10)
       || 'Run ID: ' || run_id || chr(10) || 'Date:   2031-03-08 10:11:12' || chr(10) || chr(10)
       || '[BRONZE LAYER]' || chr(10) || coalesce(b, missing.text) || chr(10)
       || '[SILVER LAYER]' || chr(10) || coalesce(s, missing.text) || chr(10)
       || '[GOLD LAYER]' || chr(10) || coalesce(g, missing.text) || chr(10) AS report
FROM wide, missing
""")
def run_report(spark, sf_dir):
    return report.render(derived(spark, sf_dir, METRICS), "2031-03-08 10:11:12")


# Ledger

_LEDGER_COLUMNS = """position, file_name, status, target_dag, queued_at, reserved_run_id, reserved_at,
    processed_run_id, processed_at"""


def _held(run: str) -> str:
    return f"""(SELECT min(position) FROM ledger WHERE target_dag = 'scheduled' AND reserved_run_id = '{run}'
        AND status IN ('queued', 'reserved'))"""


_WAITING = "(SELECT min(position) FROM ledger WHERE target_dag = 'scheduled' AND status = 'queued')"


def _next_sql(run: str) -> str:
    return f"""WITH ledger AS {_LEDGER}
SELECT {_LEDGER_COLUMNS} FROM ledger WHERE position = coalesce({_held(run)}, {_WAITING})"""


def _reserve_sql(run: str) -> str:
    return f"""WITH ledger AS {_LEDGER},
pick AS (SELECT CASE WHEN {_held(run)} IS NULL THEN {_WAITING} END AS picked)
SELECT position, file_name, CASE WHEN position = picked THEN 'reserved' ELSE status END AS status, target_dag, queued_at,
       CASE WHEN position = picked THEN '{run}' ELSE reserved_run_id END AS reserved_run_id,
       CASE WHEN position = picked THEN '2026-07-02T05:00:00' ELSE reserved_at END AS reserved_at,
       processed_run_id, processed_at
FROM ledger, pick"""


@query(_next_sql("run_new"))
def ledger_next(spark, sf_dir):
    return ledger.next_entry(derived(spark, sf_dir, LEDGER), "scheduled", "run_new")


@query(_next_sql("run_1"))
def ledger_next_held(spark, sf_dir):
    return ledger.next_entry(derived(spark, sf_dir, LEDGER), "scheduled", "run_1")


@query(_reserve_sql("run_new"))
def ledger_reserve(spark, sf_dir):
    return ledger.reserve(derived(spark, sf_dir, LEDGER), "scheduled", "run_new", "2026-07-02T05:00:00")


@query(_reserve_sql("run_1"))
def ledger_reserve_held(spark, sf_dir):
    return ledger.reserve(derived(spark, sf_dir, LEDGER), "scheduled", "run_1", "2026-07-02T05:00:00")


@query(f"""
WITH ledger AS {_LEDGER}, pick AS (SELECT min(position) AS picked FROM ledger WHERE reserved_run_id = 'run_1')
SELECT position, file_name, CASE WHEN position = picked THEN 'processed' ELSE status END AS status, target_dag,
       queued_at, reserved_run_id, reserved_at,
       CASE WHEN position = picked THEN 'run_1' ELSE processed_run_id END AS processed_run_id,
       CASE WHEN position = picked THEN '2026-07-02T05:10:00' ELSE processed_at END AS processed_at
FROM ledger, pick
""")
def ledger_mark(spark, sf_dir):
    return ledger.mark_processed(derived(spark, sf_dir, LEDGER), "run_1", "2026-07-02T05:10:00")


@query(f"""
WITH ledger AS {_LEDGER}
SELECT {_LEDGER_COLUMNS} FROM ledger
UNION ALL
SELECT (SELECT max(position) FROM ledger) + 1 + page_id, 'page_' || page_id || '.csv', 'queued', 'scheduled',
       '2026-07-01T21:00:00+05:30', NULL, NULL, NULL, NULL
FROM pages
""")
def ledger_enqueue(spark, sf_dir):
    page = F.col("page_id")
    names = table(spark, sf_dir, "pages").select(
        page.alias("ordinal"), F.concat(F.lit("page_"), page, F.lit(".csv")).alias("file_name")
    )
    return ledger.enqueue(derived(spark, sf_dir, LEDGER), names, "scheduled", "2026-07-01T21:00:00+05:30")


@query(f"""
SELECT count(*) AS depth FROM {_LEDGER} WHERE target_dag = 'scheduled' AND status IN ('queued', 'reserved')
""")
def ledger_depth(spark, sf_dir):
    return ledger.depth(derived(spark, sf_dir, LEDGER), "scheduled")


# Lineage


def _wide(*fields: str) -> str:
    picks = [
        f"max({field}) FILTER (WHERE layer = '{layer}') AS {layer.lower()}_{field}"
        for layer in ("Bronze", "Silver", "Gold")
        for field in ("layer", *fields)
    ]
    return f"(SELECT run_id, {', '.join(picks)} FROM {_METRICS} GROUP BY run_id) AS wide"


def _status_sql(layer: str, unknown: str) -> str:
    return f"CASE WHEN wide.{layer}_layer IS NULL THEN 'Pending' ELSE coalesce(wide.{layer}_status, '{unknown}') END"


def _class_sql(layer: str) -> str:
    return f"""CASE {_status_sql(layer, 'Unknown')} WHEN 'Success' THEN 'success' WHEN 'FAILED' THEN 'failed'
        ELSE 'pending' END"""


@query(f"""
SELECT run_id,
       {_status_sql('bronze', 'Unknown')} AS bronze_status, {_class_sql('bronze')} AS bronze_class,
       {_status_sql('silver', 'Unknown')} AS silver_status, {_class_sql('silver')} AS silver_class,
       {_status_sql('gold', 'Unknown')} AS gold_status, {_class_sql('gold')} AS gold_class
FROM {_wide('status')}
""")
def lineage_status(spark, sf_dir):
    return lineage.status(derived(spark, sf_dir, METRICS))


@query(f"""
SELECT run_id, layer, coalesce(NULLIF(output_rows, 0), NULLIF(rows_after, 0), aggregation_count) AS rows,
       duration AS time, status
FROM {_METRICS}
""")
def run_summary(spark, sf_dir):
    return lineage.summary(derived(spark, sf_dir, METRICS))


@query(f"""
SELECT run_id, coalesce(bronze_source, 'input_data.csv') AS source,
       {_status_sql('bronze', 'Pending')} AS bronze_status, coalesce(bronze_output_rows, 0) AS bronze_rows,
       coalesce(bronze_duration, 'N/A') AS bronze_time,
       coalesce(silver_duplicates_removed, 0) AS duplicates_removed, coalesce(silver_nulls_filled, 0) AS nulls_filled,
       {_status_sql('silver', 'Pending')} AS silver_status, coalesce(silver_rows_after, 0) AS silver_rows,
       coalesce(silver_duration, 'N/A') AS silver_time,
       {_status_sql('gold', 'Pending')} AS gold_status,
       CASE WHEN wide.gold_status = 'Success' THEN coalesce(silver_rows_after, 0) ELSE 0 END AS gold_rows,
       coalesce(gold_duration, 'N/A') AS gold_time
FROM {_wide('status', 'duration', 'source', 'output_rows', 'rows_after', 'duplicates_removed', 'nulls_filled')}
""")
def lineage_flow(spark, sf_dir):
    return lineage.flow(derived(spark, sf_dir, METRICS))


def _event_sql(layer: str, step: int, verb: str, field: str) -> str:
    return f"""SELECT run_id, {step} AS step, '{layer} {verb}' AS event, {field} AS at,
       '{layer} {verb}: ' || coalesce({field}, 'None') AS line FROM {_METRICS} WHERE layer = '{layer}'"""


@query(
    "\nUNION ALL\n".join(
        [
            f"""SELECT DISTINCT run_id, 0 AS step, 'CSV Uploaded' AS event, CAST(NULL AS VARCHAR) AS at,
       'CSV Uploaded -> Run: run_' || run_id AS line FROM {_METRICS}"""
        ]
        + [
            _event_sql(layer, 2 * rank + offset + 1, verb, field)
            for rank, layer in enumerate(("Bronze", "Silver", "Gold"))
            for offset, (verb, field) in enumerate((("Started", "start_time"), ("Completed", "end_time")))
        ]
    )
)
def timeline(spark, sf_dir):
    return lineage.timeline(derived(spark, sf_dir, METRICS))


@query(f"""
SELECT run_id, layer, layer || ' Layer FAILED: ' || coalesce(exception, 'Unknown Error') AS message
FROM {_METRICS} WHERE status = 'FAILED'
""")
def failures(spark, sf_dir):
    return lineage.failures(derived(spark, sf_dir, METRICS))


# Formatting

_TEXT_TIME = """CASE event_type WHEN 'click' THEN CAST(ts AS STRING)
    WHEN 'view' THEN concat(replace(CAST(ts AS STRING), ' ', 'T'), '+00:00')
    WHEN 'purchase' THEN concat(CAST(ts AS STRING), '+02:00')
    WHEN 'error' THEN concat('no time ', CAST(event_id AS STRING)) WHEN 'signup' THEN '' END"""


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN concat('no time ', event_id) WHEN 'signup' THEN 'Not available'
    WHEN 'purchase' THEN strftime(ts + INTERVAL 210 MINUTE, '%d %b %Y, %I:%M:%S %p') || ' IST'
    ELSE strftime(ts + INTERVAL 330 MINUTE, '%d %b %Y, %I:%M:%S %p') || ' IST' END AS shown,
    CASE event_type WHEN 'error' THEN concat('no time ', event_id) WHEN 'signup' THEN 'Not available'
    WHEN 'purchase' THEN strftime(ts + INTERVAL 210 MINUTE, '%d %b %Y, %I:%M:%S %p')
    ELSE strftime(ts + INTERVAL 330 MINUTE, '%d %b %Y, %I:%M:%S %p') END AS without_zone
FROM events
""")
def fmt_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.expr(_TEXT_TIME).alias("text"))
    text = F.col("text")
    return events.select(
        "event_id", fmt.display_ts(text).alias("shown"), fmt.display_ts(text, suffix="").alias("without_zone")
    )


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'unknown' WHEN 'view' THEN 'unknown' ELSE event_type END AS state
FROM events
""")
def fmt_status(spark, sf_dir):
    kind = F.col("event_type")
    state = F.when(kind == "click", "").when(kind != "view", F.upper(kind))
    return table(spark, sf_dir, "events").select("event_id", fmt.status(state).alias("state"))


@query("""
SELECT event_id, 'Rows ' || upper(event_type[1]) || event_type[2:] || ' Total' AS label FROM events
""")
def fmt_label(spark, sf_dir):
    key = F.concat(F.lit("rows_"), F.col("event_type"), F.lit("_total"))
    return table(spark, sf_dir, "events").select("event_id", fmt.label(key).alias("label"))


@query("SELECT o_orderkey, format('{:,}', o_orderkey * 12345) AS shown FROM orders")
def fmt_thousands(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key, fmt.thousands(key * 12345).alias("shown"))


@query("SELECT event_id, printf('%.2f sec', value) AS shown FROM events")
def fmt_duration(spark, sf_dir):
    shown = fmt.duration(F.lit(0), F.col("value")).alias("shown")
    return table(spark, sf_dir, "events").select("event_id", shown)
