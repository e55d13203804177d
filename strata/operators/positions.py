"""Places of rows in an order over all of them, and cuts after the first rows of a group, without one task for all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import SHUFFLE_PARTITIONS, scratch_path

_AT, _TIE, _PART, _FIRST = "_at", "_tie", "_part", "_first"
# Bits of Spark's increasing ids that number the rows of a partition.
_ROW_BITS = 33
# Lengths at which a text is cut: for ISO times the day, then the second.
PREFIXES = (10, 19)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 1-based place of each row in an order over all rows.

    Rows are dealt out by range and sorted there, rows equal in the order too; each range then starts where the counts
    of those before it end. The sorted rows are written below the scratch folder, so the ranges stay as they are. Only
    one count per range passes through a single task.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get(SHUFFLE_PARTITIONS))
    path = scratch_path(spark, "numbered")
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    sorted_rows = tied.repartitionByRange(parts, *order, F.col(_TIE)).sortWithinPartitions(*order, F.col(_TIE)).drop(_TIE)
    sorted_rows.withColumn(_AT, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(_PART, F.shiftright(_AT, _ROW_BITS).cast("int"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(_PART).count()
    first = counts.select(_PART, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(_FIRST))
    place = F.col(_FIRST) + F.col(_AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return rows.join(F.broadcast(first), _PART).withColumn(name, place).drop(_PART, _FIRST, _AT)


def upper_part(df: DataFrame, group: str, text: str, k: int) -> DataFrame:
    """Rows that can be among the ``k`` with the largest ``text`` of their group, null last: those, and few beyond.

    Counts per prefix of the text find the prefix at which ``k`` is reached, first by a short one, then within it by a
    longer one; all rows from there up stay. Only counts are shuffled. There must be few groups.
    """

    def prefix(length: int) -> Column:
        return F.coalesce(F.substring(text, 1, length), F.lit(""))

    rows = df.select(group, text, F.lit(k).cast("bigint").alias("_wanted"))
    for i, length in enumerate(PREFIXES):
        floors = _floors(rows.select(group, prefix(length).alias("_prefix"), "_wanted"), group)
        if i + 1 < len(PREFIXES):
            narrowed = df.select(group, text).join(F.broadcast(floors), group)
            rows = narrowed.where(prefix(length) == F.col("_floor")).drop("_floor")
    kept = df.join(F.broadcast(floors.drop("_wanted")), group, "left")
    return kept.where(F.col("_floor").isNull() | (prefix(PREFIXES[-1]) >= F.col("_floor"))).drop("_floor")


def _floors(rows: DataFrame, group: str) -> DataFrame:
    """Per group the prefix at which the wanted number is reached, and how many are wanted of it; none if never reached."""
    counts = rows.groupBy(group, "_prefix", "_wanted").count()
    above = Window.partitionBy(group).orderBy(F.col("_prefix").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(above), F.lit(0))
    reached = counts.withColumn("_before", before).where("_before < _wanted AND _before + count >= _wanted")
    return reached.select(group, F.col("_prefix").alias("_floor"), (F.col("_wanted") - F.col("_before")).alias("_wanted"))
