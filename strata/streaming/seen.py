"""Rows that earlier batches of a stream already had, found in a stored index of row hashes.

Each batch leaves the 128-bit hashes of its distinct rows below ``batch=<n>``, dealt into buckets by hash; now and then
those of settled batches are folded into one table ``upto=<n>``. A batch is compared with the batches before it only,
never with its own entry, so a replayed batch gives the same rows again. The index is not shuffled for a batch whose
hashes fit a broadcast, and buckets that the batch does not touch are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.model import INGESTED_AT
from strata.operators import lookup
from strata.sources import tables

BUCKETS = 64
# Batches after which their hashes are folded into one table.
FOLD_EVERY = 32
_ENTRY = "high bigint, low bigint, bucket int"
_KEY = ["bucket", "high", "low"]


def row_hash(values: list[Column]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. Nulls are hashed by their place, which the hash function alone would skip."""
    nulls = [value.isNull() for value in values]
    return F.xxhash64(*values, *nulls), F.xxhash64(F.lit(1), *nulls, *values)


def mark(distinct: DataFrame, names: list[str], path: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """Add ``known``: whether a row was in an earlier batch. Stores the batch's hashes first.

    ``distinct`` holds distinct rows as ``c0, c1, …``, named ``names`` in the source; the order of the columns does not
    matter between batches, their names and types do; the load stamp is left aside. Unequal rows are told apart by 128
    bits.
    """
    spark = distinct.sparkSession
    order = sorted((i for i, name in enumerate(names) if name != INGESTED_AT), key=lambda i: names[i])
    high, low = row_hash([F.col(f"c{i}") for i in order])
    hashed = distinct.withColumns({"high": high, "low": low})
    own = f"{path.rstrip('/')}/batch={batch}"
    keys = hashed.select("high", "low", F.pmod("high", F.lit(buckets)).cast("int").alias("bucket"))
    tables.write_layer(tables.spread_for_write(keys, "bucket"), own, partition_by="bucket")
    known = _earlier(spark, path, batch)
    if known is None:
        return distinct.withColumn("known", F.lit(False))
    mine = spark.read.schema(_ENTRY).parquet(own)
    # At most one value per bucket.
    touched = [row[0] for row in mine.select("bucket").distinct().collect()]
    known = known.filter(F.col("bucket").isin(touched))
    if lookup.fits_broadcast(mine):
        mine = F.broadcast(mine)
    hits = known.join(mine, _KEY, "left_semi").select("high", "low").distinct().withColumn("known", F.lit(True))
    marked = hashed.join(hits, ["high", "low"], "left")
    return marked.select(*distinct.columns, F.coalesce("known", F.lit(False)).alias("known"))


def fold(spark: SparkSession, path: str, before: int) -> None:
    """Fold the hashes of all batches before one into a single table, then drop their own.

    ``before`` must be settled: batches before it are not replayed. A fold that is cut off leaves entries twice, which
    does no harm.
    """
    known = _earlier(spark, path, before)
    if known is None:
        return
    newest = f"{path.rstrip('/')}/upto={before - 1}"
    former = _folders(spark, path)
    if ("upto", before - 1) in former:
        return
    tables.write_layer(tables.spread_for_write(known.distinct(), "bucket"), newest, partition_by="bucket")
    fs, _ = tables.at(spark, path)
    for kind, number in former:
        if number < before:
            fs.delete(tables.at(spark, f"{path.rstrip('/')}/{kind}={number}")[1], True)


def _earlier(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """Entries of all batches before one, None without any."""
    found = _folders(spark, path)
    folded = max((number for kind, number in found if kind == "upto" and number < batch), default=-1)
    parts = [f"upto={folded}"] * (folded >= 0)
    parts += [f"batch={number}" for kind, number in found if kind == "batch" and folded < number < batch]
    if not parts:
        return None
    return tables.union_all(spark.read.schema(_ENTRY).parquet(f"{path.rstrip('/')}/{part}") for part in parts)


def _folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Kind and number of the index's folders; as many as batches since the last fold."""
    fs, folder = tables.at(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted((m[1], int(m[2])) for m in (re.fullmatch(r"(batch|upto)=(\d+)", name) for name in names) if m)
