"""Queries over cleaning, flags, quality checks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import clean, columns, footers, preview, profile, quality, schema, states, tables
from strata.session import scratch_path
from strata.workloads.inputs import DIRTY, derived, plain
from strata.workloads.registry import query, table

_DIRTY = plain(DIRTY)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def drop_artifacts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    exported = orders.select(key.alias("_c0"), key.alias("Unnamed: 0"), key, "o_totalprice", key.alias("index"))
    return columns.drop_artifacts(exported)


@query("SELECT event_id, value, TIMESTAMP '2026-07-01 16:05:00' AS _ingest_timestamp FROM events")
def load_stamp(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    stamped = columns.stamp(events, "_ingest_timestamp", "2026-07-01 16:05:00")
    return stamped.withColumn("_ingest_timestamp", F.col("_ingest_timestamp").cast("timestamp_ntz"))


@query(f"SELECT DISTINCT o_orderkey, p, t, s, d FROM {_DIRTY}")
def dedupe(spark, sf_dir):
    return clean.dedupe(derived(spark, sf_dir, DIRTY))


@query(f"""
SELECT o_orderkey AS c0, p AS c1, t AS c2, s AS c3, d AS c4, count(*) AS copies FROM {_DIRTY}
GROUP BY o_orderkey, p, t, s, d
""")
def dedupe_screened(spark, sf_dir):
    return clean.count_copies_screened(derived(spark, sf_dir, DIRTY))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem")
def dedupe_hot(spark, sf_dir):
    cols = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"]
    return clean.dedupe(table(spark, sf_dir, "lineitem").select(*cols))


@query(f"""
SELECT count(*) AS rows_before, count(DISTINCT (o_orderkey, p, t, s, d)) AS rows_after,
       count(*) - count(DISTINCT (o_orderkey, p, t, s, d)) AS duplicates_removed
FROM {_DIRTY}
""")
def dedupe_stats(spark, sf_dir):
    return clean.dedupe_stats(derived(spark, sf_dir, DIRTY))


@query(f"""
SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (WHERE p IS NULL) AS p,
       count(*) FILTER (WHERE t IS NULL) AS t, count(*) FILTER (WHERE s IS NULL) AS s,
       count(*) FILTER (WHERE d IS NULL) AS d
FROM {_DIRTY}
""")
def null_counts(spark, sf_dir):
    return quality.null_counts(derived(spark, sf_dir, DIRTY))


@query(f"""
SELECT CAST(sum(CASE WHEN p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS p,
       CAST(sum(CASE WHEN d IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS d
FROM {_DIRTY}
""")
def null_sums(spark, sf_dir):
    return quality.null_sums(derived(spark, sf_dir, DIRTY), ["p", "d"])


@query(f"""
SELECT count(*) FILTER (WHERE p IS NULL) + count(*) FILTER (WHERE t IS NULL) + count(*) FILTER (WHERE d IS NULL)
       AS total_nulls
FROM {_DIRTY}
""")
def total_nulls(spark, sf_dir):
    return quality.total_nulls(derived(spark, sf_dir, DIRTY))


@query(f"SELECT o_orderkey, coalesce(p, 'unknown') AS p, coalesce(t, 0) AS t, s, d FROM {_DIRTY}")
def fill_nulls(spark, sf_dir):
    return clean.fill_nulls(derived(spark, sf_dir, DIRTY))


@query("""
SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE value END AS value,
       CASE WHEN event_type = 'click' THEN 'unknown' ELSE event_type END AS event_type
FROM events
""")
def fill_nan(spark, sf_dir):
    kind = F.col("event_type")
    value = F.when(kind == "error", F.lit(float("nan"))).when(kind != "view", F.col("value"))
    events = table(spark, sf_dir, "events")
    return clean.fill_nulls(
        events.select("event_id", value.alias("value"), F.nullif(kind, F.lit("click")).alias("event_type"))
    )


@query(f"""
SELECT o_orderkey, p, t, s, d, CASE WHEN p = '2-HIGH' THEN 'urgent' ELSE 'regular' END AS urgency FROM {_DIRTY}
""")
def flag(spark, sf_dir):
    return columns.flag(derived(spark, sf_dir, DIRTY), "p", "urgency", "2-HIGH", "urgent", "regular")


_SURVIVED = """CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN ' 1.0 ' WHEN '3-MEDIUM' THEN '0'
    WHEN '4-NOT SPECIFIED' THEN 'unknown' END"""


@query(f"""
SELECT o_orderkey, {_SURVIVED} AS "Survived",
       CASE WHEN CAST(TRY_CAST(trim({_SURVIVED}) AS DOUBLE) AS INT) = 1 THEN 'Survived' ELSE 'Did not survive' END
       AS "SurvivalStatus"
FROM orders
""")
def flag_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SURVIVED).alias("Survived"))
    return columns.flag(orders, "Survived", "SurvivalStatus", 1, "Survived", "Did not survive")


@query(f"SELECT o_orderkey, p, t, s, d FROM {_DIRTY} WHERE p IS NULL")
def null_rows(spark, sf_dir):
    return quality.null_rows(derived(spark, sf_dir, DIRTY), "p")


@query(f"""
SELECT 'key_not_null' AS rule, 'd' AS "column", count(*) FILTER (WHERE d IS NULL) AS violations,
       CASE WHEN count(*) FILTER (WHERE d IS NULL) > 0 THEN 'warning' ELSE 'ok' END AS severity
FROM {_DIRTY}
""")
def check_key(spark, sf_dir):
    return quality.check_key(derived(spark, sf_dir, DIRTY), "d")


def _profile_sql(part: str, source: str, cols: list[str], group: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT {part} AS part, '{c}' AS "column", count(*) AS n, CAST(min({c}) AS VARCHAR) AS "min",
        CAST(max({c}) AS VARCHAR) AS "max", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {source} {group}"""
        for c in cols
    )


@query(_profile_sql("s", _DIRTY, ["o_orderkey", "p", "t", "d"], "GROUP BY s"))
def column_profile(spark, sf_dir):
    return profile.column_profile(derived(spark, sf_dir, DIRTY), by="s")


_LINEITEM = """
l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate
""".split()


@query(_profile_sql("CAST(NULL AS VARCHAR)", "lineitem", _LINEITEM, ""))
def column_profile_whole(spark, sf_dir):
    return profile.column_profile(table(spark, sf_dir, "lineitem"))


@query(_profile_sql("CAST(NULL AS VARCHAR)", "lineitem", _LINEITEM, ""))
def profile_from_footers(spark, sf_dir):
    """The same figures of a stored table, those of numbers without reading a row."""
    path = scratch_path(spark, "layer")
    tables.write_layer(table(spark, sf_dir, "lineitem"), path)
    return footers.table_profile(spark, path)


def _states(spark, sf_dir):
    """The states of the line items' batches, dealt out by order; the first batch is replayed."""
    path, batches = scratch_path(spark, "states"), 4
    lineitem = table(spark, sf_dir, "lineitem")
    for batch in [*range(batches), 0]:
        states.add(lineitem.filter(F.pmod("l_orderkey", F.lit(batches)) == batch), path, batch, distinct=["l_partkey"])
    return states.load(spark, path)


@query(_profile_sql("CAST(NULL AS VARCHAR)", "lineitem", _LINEITEM, ""))
def profile_from_states(spark, sf_dir):
    """The same figures again, merged from what each batch left."""
    return states.column_profile(_states(spark, sf_dir)).drop("distinct_values")


@query("SELECT 'Gold' AS layer, count(*) AS rows, 11 AS columns, 'Not available' AS last_updated FROM lineitem")
def summary_from_states(spark, sf_dir):
    return states.layer_summary(_states(spark, sf_dir), "Gold")


_SHOWN = "strftime(max({0}) + INTERVAL 330 MINUTE, '%d %b %Y, %I:%M:%S %p')"


def _layers(spark, sf_dir):
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    return {
        "Bronze": events.withColumnRenamed("ts", "_ingest_timestamp"),
        "Silver": orders.withColumnRenamed("o_orderdate", "_ingest_timestamp"),
        "Gold": table(spark, sf_dir, "lineitem"),
        "Empty": tables.scan_files(spark, scratch_path(spark, "absent")),
    }


@query(f"SELECT {_SHOWN.format('ts')} AS last_updated FROM events")
def last_updated(spark, sf_dir):
    return profile.last_updated(table(spark, sf_dir, "events").withColumnRenamed("ts", "_ingest_timestamp"))


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS last_updated FROM events")
def last_updated_short(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "_ingest_timestamp")
    return profile.last_updated(events, tz="UTC", pattern="yyyy-MM-dd HH:mm", missing="N/A")


@query(f"""
SELECT 'Bronze' AS layer, count(*) AS rows, 6 AS columns, {_SHOWN.format('ts')} AS last_updated FROM events
UNION ALL SELECT 'Silver', count(*), 6, {_SHOWN.format('o_orderdate')} FROM orders
UNION ALL SELECT 'Gold', count(*), 11, 'Not available' FROM lineitem
UNION ALL SELECT 'Empty', 0, 0, 'Not available'
""")
def layer_summary(spark, sf_dir):
    return profile.layer_summary(_layers(spark, sf_dir))


@query("""
SELECT (SELECT count(*) FROM events) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)
       AS total_records, CAST(3 AS BIGINT) AS active_layers
""")
def platform_totals(spark, sf_dir):
    return profile.platform_totals(_layers(spark, sf_dir))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def peek(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return preview.peek(orders, ["o_orderkey", "o_totalprice"], 5, order_by=["o_orderdate", "o_orderkey"])


# Both views of the schema come with the figures of the columns they list, read from the whole table.
@query("""
SELECT position, name, CAST(4 AS INT) AS n_more, (SELECT count(*) FROM orders) AS n
FROM (VALUES (1, 'o_orderkey'), (2, 'o_custkey')) AS head(position, name)
""")
def column_head(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    head = preview.column_head(orders, 2)
    stats = profile.column_profile(orders.select(*orders.columns[:2])).withColumnRenamed("column", "name")
    return head.join(stats, "name").select("position", "name", "n_more", "n")


@query(f"""
WITH dirty AS {_DIRTY}
SELECT 1 AS position, 'o_orderkey' AS name, 'LongType()' AS type, count(*) AS n, count(*) - count(o_orderkey) AS nulls
FROM dirty
UNION ALL SELECT 2, 'p', 'StringType()', count(*), count(*) - count(p) FROM dirty
UNION ALL SELECT 3, 't', 'DoubleType()', count(*), count(*) - count(t) FROM dirty
UNION ALL SELECT 4, 's', 'StringType()', count(*), count(*) - count(s) FROM dirty
UNION ALL SELECT 5, 'd', 'TimestampNTZType()', count(*), count(*) - count(d) FROM dirty
""")
def describe(spark, sf_dir):
    df = derived(spark, sf_dir, DIRTY)
    stats = profile.column_profile(df).withColumnRenamed("column", "name")
    return schema.describe(df).join(stats, "name").select("position", "name", "type", "n", "nulls")
