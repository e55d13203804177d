"""Column operators: load stamps, artifact columns, rule flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import by_position, col

# Index columns that CSV and pandas exports leave behind.
ARTIFACTS = ("_c0", "Unnamed: 0", "index")


def stamp(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """Append a load time, one value per query; ``at`` fixes it."""
    value = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn(name, value)


def drop_artifacts(df: DataFrame, names: Sequence[str] = ARTIFACTS) -> DataFrame:
    """Drop index columns by exact name, so ``Index`` stays where ``index`` goes."""
    keep = [(f"c{i}", name) for i, name in enumerate(df.columns) if name not in names]
    if len(keep) == len(df.columns):
        return df
    return by_position(df).select(*[p for p, _ in keep]).toDF(*[name for _, name in keep])


def matches(value: Column, dtype: T.DataType, equals) -> Column:
    """Whether a column equals a constant; text is read as a whole number for an int constant.

    Text that is no number gives null, and decimals are cut off: ``'1.0'`` matches 1.
    """
    if isinstance(equals, int) and not isinstance(equals, bool):
        if isinstance(dtype, T.StringType):
            digits = F.regexp_extract(F.trim(value), r"^([+-]?\d+)(\.\d*)?$", 1)
            return digits.try_cast("bigint") == F.lit(equals)
        if isinstance(dtype, T.BooleanType):
            return value.cast("int") == F.lit(equals)
    return value == F.lit(equals)


def flag(df: DataFrame, source: str, target: str, equals, then, otherwise) -> DataFrame:
    """Append ``then`` where ``source`` equals a constant, else ``otherwise`` (also for null).

    The frame passes unchanged where it has no column of that exact name.
    """
    if source not in df.columns:
        return df
    hit = matches(col(source), df.schema[source].dataType, equals)
    return df.withColumn(target, F.when(hit, F.lit(then)).otherwise(F.lit(otherwise)))
