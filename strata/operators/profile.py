"""Layer profiles: column statistics, roll-ups, last update."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import fmt
from strata.functions.naming import by_position
from strata.model import INGESTED_AT
from strata.sources.tables import union_all


def column_profile(df: DataFrame, by: str | None = None) -> DataFrame:
    """Row count, minimum, maximum and null count per column, optionally per value of ``by``.

    Returns ``(part, column, n, min, max, nulls)`` with the values as text; ``part``
    is null without ``by``. Types without an order give null bounds.
    """
    frame = by_position(df)
    fields = [(f"c{i}", f) for i, f in enumerate(df.schema) if f.name != by]
    aggs = [F.count(F.lit(1)).alias("n")]
    if by is not None:
        # Text bounds alone would be found by sorting all rows by group. One typed aggregate makes Spark hash the
        # groups in objects instead, which sorts only what exceeds a bounded number of groups per task.
        # The result has to use it, or the optimizer drops it: it is 0 and never null, as no group is empty.
        aggs[0] = (aggs[0] + F.percentile_approx(F.lit(0), F.lit(0.5), F.lit(1))).alias("n")
    for name, field in fields:
        ordered = has_order(field.dataType)
        aggs.append((F.min(name) if ordered else F.lit(None)).cast("string").alias(f"{name}_min"))
        aggs.append((F.max(name) if ordered else F.lit(None)).cast("string").alias(f"{name}_max"))
        aggs.append(F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"))
    part = F.lit(None).cast("string") if by is None else F.col(f"c{df.columns.index(by)}").cast("string")
    grouped = frame.agg(*aggs) if by is None else frame.groupBy(part.alias("part")).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"),
                F.col("n"),
                F.col(f"{name}_min").alias("min"),
                F.col(f"{name}_max").alias("max"),
                F.col(f"{name}_nulls").alias("nulls"),
            )
            for name, field in fields
        ]
    )
    return grouped.select(part.alias("part") if by is None else F.col("part"), F.inline(rows))


def last_updated(
    df: DataFrame,
    column: str = INGESTED_AT,
    tz: str = fmt.DISPLAY_ZONE,
    pattern: str = fmt.DISPLAY_PATTERN,
    missing: str = fmt.MISSING,
) -> DataFrame:
    """One row with the newest load time for display, as ``last_updated``."""
    return df.agg(newest(df, column, tz, pattern, missing).alias("last_updated"))


def layer_summary(layers: Mapping[str, DataFrame], column: str = INGESTED_AT) -> DataFrame:
    """One row per layer: ``(layer, rows, columns, last_updated)``; an empty layer has 0 columns."""
    return union_all(
        df.agg(
            F.lit(name).alias("layer"),
            F.count(F.lit(1)).alias("rows"),
            F.when(F.count(F.lit(1)) > 0, len(df.columns)).otherwise(0).alias("columns"),
            newest(df, column, fmt.DISPLAY_ZONE, fmt.DISPLAY_PATTERN, fmt.MISSING).alias("last_updated"),
        )
        for name, df in layers.items()
    )


def platform_totals(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row: ``total_records`` over all layers and the number of non-empty ``active_layers``."""
    return layer_summary(layers).agg(
        F.sum("rows").alias("total_records"), F.count_if(F.col("rows") > 0).alias("active_layers")
    )


def newest(df: DataFrame, column: str, tz: str, pattern: str, missing: str) -> Column:
    if column not in df.columns:
        return F.lit(missing)
    newest = F.max(F.col(column))
    if isinstance(df.schema[column].dataType, T.TimestampType):
        clock = F.convert_timezone(None, F.lit("UTC"), newest)
    elif isinstance(df.schema[column].dataType, T.StringType):
        clock = fmt.utc_clock(newest)
    else:
        clock = newest.cast("timestamp_ntz")
    return F.coalesce(fmt.display_clock(clock, tz, pattern), F.lit(missing))


def has_order(dtype: T.DataType) -> bool:
    return isinstance(
        dtype, (T.NumericType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )
