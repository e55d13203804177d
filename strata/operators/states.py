"""Profiles kept per batch: each batch leaves a small state, and the states of all batches merge into the profile.

An appended batch is read once, when its state is made; later profiles read the states alone. A state has one row per
``part``: ``(part, n, of)``, where ``of`` holds for each column its typed bounds, its nulls and, if asked for, a sketch
of its distinct values. A column that a batch lacks counts as null in all of its rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import fmt
from strata.functions.naming import by_position
from strata.model import INGESTED_AT
from strata.operators.profile import has_order, newest
from strata.sources import tables

# Types whose values a sketch takes as they are; others are sketched as text.
_SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def state(df: DataFrame, by: str | None = None, distinct: Iterable[str] = ()) -> DataFrame:
    """The state of a batch, per value of ``by`` where one is named; ``distinct`` names the columns to sketch."""
    distinct = set(distinct)
    if unknown := distinct - set(df.columns):
        raise ValueError(f"no such columns to sketch: {sorted(unknown)}")
    frame = by_position(df)
    fields = []
    for i, field in enumerate(df.schema):
        if field.name == by:
            continue
        value, ordered = F.col(f"c{i}"), has_order(field.dataType)
        figures = [
            (F.min(value) if ordered else F.lit(None).cast("string")).alias("min"),
            (F.max(value) if ordered else F.lit(None).cast("string")).alias("max"),
            F.count_if(value.isNull()).alias("nulls"),
        ]
        if field.name in distinct:
            figures.append(F.hll_sketch_agg(value if isinstance(field.dataType, _SKETCHED) else value.cast("string")).alias("seen"))
        fields.append(F.struct(*figures).alias(field.name))
    part = F.lit(None).cast("string") if by is None else F.col(f"c{df.columns.index(by)}").cast("string")
    aggs = [F.count(F.lit(1)).alias("n"), F.struct(*fields).alias("of")]
    if by is None:
        return frame.agg(*aggs).select(part.alias("part"), "n", "of")
    return frame.groupBy(part.alias("part")).agg(*aggs)


def merged(states: DataFrame) -> DataFrame:
    """States of many batches as the one state of all their rows."""
    fields = []
    for field in states.schema["of"].dataType:
        own = F.col("of").getField(field.name)
        figures = [
            F.min(own.getField("min")).alias("min"),
            F.max(own.getField("max")).alias("max"),
            F.sum(F.coalesce(own.getField("nulls"), F.col("n"))).alias("nulls"),
        ]
        if "seen" in field.dataType.names:
            figures.append(F.hll_union_agg(own.getField("seen"), F.lit(True)).alias("seen"))
        fields.append(F.struct(*figures).alias(field.name))
    return states.groupBy("part").agg(F.sum("n").alias("n"), F.struct(*fields).alias("of"))


def add(df: DataFrame, path: str, batch: int | str, by: str | None = None, distinct: Iterable[str] = ()) -> None:
    """Store the state of a batch. A replayed batch replaces its own state, so no row counts twice."""
    tables.write_layer(state(df, by, distinct), f"{path.rstrip('/')}/batch={batch}")


def load(spark: SparkSession, path: str) -> DataFrame:
    """The stored states of all batches; columns that came later are null in earlier ones."""
    return spark.read.option("mergeSchema", True).parquet(path).drop("batch")


def column_profile(states: DataFrame) -> DataFrame:
    """``(part, column, n, min, max, nulls)`` as of :func:`strata.profile.column_profile`, from states alone.

    Where any column was sketched, ``distinct_values`` is the estimate of its distinct values (null for the others).
    """
    whole = merged(states)
    fields = whole.schema["of"].dataType
    sketched = any("seen" in field.dataType.names for field in fields)
    rows = []
    for field in fields:
        own = F.col("of").getField(field.name)
        figures = [F.lit(field.name).alias("column"), F.col("n")]
        figures += [own.getField(bound).cast("string").alias(bound) for bound in ("min", "max")]
        figures.append(own.getField("nulls").alias("nulls"))
        if sketched:
            has = "seen" in field.dataType.names
            figures.append((F.hll_sketch_estimate(own.getField("seen")) if has else F.lit(None).cast("bigint")).alias("distinct_values"))
        rows.append(F.struct(*figures))
    return whole.select("part", F.inline(F.array(*rows)))


def layer_summary(states: DataFrame, layer: str, column: str = INGESTED_AT) -> DataFrame:
    """One row as of :func:`strata.profile.layer_summary`, from states alone; a column of the groups is not counted."""
    names = states.schema["of"].dataType.names
    newest_of = states.select("n", *([F.col("of").getField(column).getField("max").alias(column)] if column in names else []))
    rows = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return newest_of.agg(
        F.lit(layer).alias("layer"),
        rows.alias("rows"),
        F.when(rows > 0, len(names)).otherwise(0).alias("columns"),
        newest(newest_of, column, fmt.DISPLAY_ZONE, fmt.DISPLAY_PATTERN, fmt.MISSING).alias("last_updated"),
    )
