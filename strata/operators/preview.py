"""Small looks at a layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.naming import col


def peek(
    df: DataFrame, cols: Sequence[str] | None = None, n: int = 5, order_by: Sequence[str] | None = None
) -> DataFrame:
    """First ``n`` rows of some columns; any rows unless ``order_by`` says which come first."""
    if order_by:
        df = df.orderBy(*[col(c) for c in order_by])
    picked = df.select(*[col(c) for c in cols]) if cols else df
    return picked.limit(n)


def column_head(df: DataFrame, k: int = 12) -> DataFrame:
    """First ``k`` column names as ``(position, name, n_more)``; ``n_more`` counts the rest."""
    names = df.columns
    rows = [(i + 1, name) for i, name in enumerate(names[:k])]
    head = df.sparkSession.createDataFrame(rows, "position int, name string")
    return head.withColumn("n_more", F.lit(max(len(names) - k, 0)))
