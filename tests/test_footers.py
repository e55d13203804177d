"""Figures from file footers against a full scan."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from strata import footers, profile, tables

ROWS = [
    (k, None if k % 5 == 0 else k * 1.5, f"t{k}", date(2024, 1, 1 + k % 9), datetime(2024, 1, 1, k % 24), k % 3 == 0, k % 4) for k in range(200)
]
SCHEMA = "`a.b` bigint, d double, s string, day date, at timestamp, ok boolean, part int"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("part", [None, "part"])
def test_same_as_a_scan(spark, root, part):
    tables.write_layer(spark.createDataFrame(ROWS, SCHEMA).repartition(5), f"{root}/t", partition_by=part)
    got = footers.table_profile(spark, f"{root}/t")
    assert rows(got) == rows(profile.column_profile(tables.read_layer(spark, f"{root}/t")))
    assert footers.row_count(spark, f"{root}/t") == 200


def test_no_row_is_read_for_numbers(spark, root):
    tables.write_layer(spark.createDataFrame(ROWS, SCHEMA), f"{root}/t")
    before = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    plan = footers.from_footers(spark, f"{root}/t", ["a.b", "d", "day"], ["ok", "s"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(a.b), MIN(a.b), MAX(a.b)" in plan.replace("`", "")
    assert plan.count("PushedAggregation") == 1 and "PushedAggregation: []" not in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == before
    plain = tables.read_layer(spark, f"{root}/t").agg({"d": "max"})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation" not in plain


def test_not_a_number_needs_a_scan(spark, root):
    tables.write_layer(spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "d double").coalesce(1), f"{root}/t")
    (row,) = footers.table_profile(spark, f"{root}/t").collect()
    assert (row["n"], row["min"], row["max"], row["nulls"]) == (3, "1.0", "NaN", 1)


def test_empty_table(spark, root):
    tables.write_layer(spark.createDataFrame([], SCHEMA), f"{root}/t")
    assert rows(footers.table_profile(spark, f"{root}/t")) == rows(profile.column_profile(tables.read_layer(spark, f"{root}/t")))
