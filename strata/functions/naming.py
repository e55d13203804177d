"""Column-name helpers that hold for any header a source file may carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Reference a top-level column whose name may hold dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def by_position(df: DataFrame) -> DataFrame:
    """Rename the columns ``c0, c1, …`` so that no header can be misread or ambiguous."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])
