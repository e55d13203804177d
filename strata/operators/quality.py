"""Null counts and the key check. Each is one pass with one small aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.naming import by_position, col


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the null count of every column under its own name; NaN is no null."""
    frame = by_position(df)
    return frame.agg(*[F.count_if(frame[c].isNull()).alias(c) for c in frame.columns]).toDF(*df.columns)


def null_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null counts of chosen columns as a sum: an empty table gives null, not 0."""
    sums = [F.sum(col(c).isNull().cast("int")).alias(f"c{i}") for i, c in enumerate(cols)]
    return df.agg(*sums).toDF(*cols)


def row_nulls(values: Sequence[Column]) -> Column:
    """Number of nulls among the columns of one row."""
    return reduce(add, [value.isNull().cast("int") for value in values], F.lit(0))


def total_nulls(df: DataFrame) -> DataFrame:
    """One row with the number of null cells over all columns, as ``total_nulls``."""
    frame = by_position(df)
    nulls = row_nulls([frame[c] for c in frame.columns])
    return frame.agg(F.coalesce(F.sum(nulls), F.lit(0)).alias("total_nulls"))


def null_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is null."""
    return df.where(col(key).isNull())


def check_key(df: DataFrame, key: str) -> DataFrame:
    """Key-null check as ``(rule, column, violations, severity)``; no row where the key is absent.

    Violations are a warning and never stop a run.
    """
    if key not in df.columns:
        return df.sparkSession.createDataFrame([], "rule string, column string, violations bigint, severity string")
    violations = F.count_if(col(key).isNull())
    return df.agg(
        F.lit("key_not_null").alias("rule"),
        F.lit(key).alias("column"),
        violations.alias("violations"),
        F.when(violations > 0, "warning").otherwise("ok").alias("severity"),
    )
