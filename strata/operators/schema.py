"""Schema description as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fields(df: DataFrame) -> list[dict[str, str]]:
    """Column names and types as plain records."""
    return [{"name": f.name, "type": str(f.dataType)} for f in df.schema.fields]


def describe(df: DataFrame) -> DataFrame:
    """Schema as ``(position, name, type)``. Reads no data."""
    rows = [(i + 1, f["name"], f["type"]) for i, f in enumerate(fields(df))]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
