"""The physical plans that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata import clean, columns, ledger, lineage, lookup, profile, quality, report, runs, tables
from strata.model import LEDGER, METRICS


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "t")
    df = spark.range(1000).select(
        F.col("id").alias("k"), (F.col("id") % 5).alias("p"), F.col("id").cast("string").alias("s"), F.rand(1).alias("d")
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("records") / "t")
    spark.createDataFrame([], METRICS).write.parquet(path)
    return spark.read.schema(METRICS).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return sum(line.lstrip(" +-:*").startswith("Exchange ") for line in text.splitlines())


def test_row_operators_do_not_shuffle(wide):
    df = columns.flag(clean.fill_nulls(columns.drop_artifacts(columns.stamp(wide, "at"))), "k", "f", 1, "a", "b")
    assert exchanges(plan(df)) == 0
    assert exchanges(plan(quality.null_rows(wide, "k"))) == 0
    assert "PushedFilters: [IsNull(k)]" in plan(quality.null_rows(wide, "k"))


def test_dedupe_collapses_copies_before_its_one_shuffle(wide):
    text = plan(clean.dedupe(wide))
    assert exchanges(text) == 1 and text.count("HashAggregate") == 2
    text = plan(clean.count_copies(wide))
    assert exchanges(text) == 1 and "partial_count" in text


def test_aggregates_read_only_their_columns(wide):
    assert "ReadSchema: struct<k:bigint>" in plan(quality.null_sums(wide, ["k"]))
    assert "ReadSchema: struct<>" in plan(profile.platform_totals({"a": wide}))
    assert "ReadSchema: struct<p:bigint,d:double>" in plan(profile.column_profile(wide.select("p", "d"), "p"))
    assert "SortAggregate" not in plan(profile.column_profile(wide.select("p", "k", "d"), "p"))


def test_text_bounds_need_no_sort(wide):
    text = plan(profile.column_profile(wide, "p"))
    assert "ObjectHashAggregate" in text and "Sort" not in text.replace("SortOrder", "") and exchanges(text) == 1


def test_top_k_is_limited_before_the_shuffle_for_any_k(spark, tmp_path):
    path = str(tmp_path / "runs")
    spark.createDataFrame([(f"p{i % 2}", f"r{i:05}", f"{i:05}") for i in range(9000)], "pipeline_id string, run_id string, start_date string").write.parquet(path)
    df = spark.read.parquet(path)
    assert plan(runs.recent(df, ["p0", "p1"], 6)).count("WindowGroupLimit") == 2
    large = runs.recent(df, ["p0", "p1"], 2500)
    assert "hashpartitioning(pipeline_id" in plan(large) and "part" in plan(large)
    got = [r.run_id for r in large.collect()]
    assert got == [f"r{i:05}" for i in range(8999, 3999, -1)]


@pytest.mark.parametrize("view", [lineage.status, lineage.flow, lineage.timeline, report.render, runs.quality_summary])
def test_record_views_shuffle_once_with_partial_results(records, view):
    text = plan(view(records))
    assert exchanges(text) == 1 and "partial_" in text and "collect_list" not in text


@pytest.mark.parametrize("view", [lineage.summary, lineage.failures, runs.unpivot_metrics])
def test_record_rows_do_not_shuffle(records, view):
    assert exchanges(plan(view(records))) == 0


def test_lookup_joins(spark, wide):
    right = wide.groupBy("k").agg(F.max("d").alias("v"))
    assert "BroadcastHashJoin" in plan(lookup.attach(wide, right, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup.attach(wide, right, "k", max_broadcast_rows=0))
        assert "SortMergeJoin" in text and "TakeOrderedAndProject(limit=1000" in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ledger_lookup_filters_the_scan(spark, tmp_path):
    path = str(tmp_path / "ledger")
    spark.createDataFrame([], LEDGER).write.parquet(path)
    text = plan(ledger.next_entry(spark.read.schema(LEDGER).parquet(path), "s", "r"))
    assert "DataFilters: [isnotnull(position" in text and "Join" not in text


def test_rebalance_is_a_hint_for_adaptive_execution(wide):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(tables.spread_for_write(wide, "p"))
    assert exchanges(plan(tables.spread_for_write(wide, "absent"))) == 0
