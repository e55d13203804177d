"""Run records as an append log below ``<root>/log``.

``one/<stamp>-<id>.json`` holds a single record that a driver puts there without a Spark job; ``bulk/<stamp>-<id>/`` is a
Parquet folder of many, written by tasks. Nothing is changed in place: each record carries the time at which it was
logged, and a reader takes the newest of each run and layer. :func:`compact` writes the newest ones as one bulk folder
and then removes the files that were listed before they were read, so that no record is missing at any time.
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.model import METRICS
from strata.sources import tables

LOGGED = "_logged"
_ENTRY = T.StructType([*METRICS.fields, T.StructField(LOGGED, T.LongType())])
_PYTHON = {T.StringType: str, T.LongType: int, T.IntegerType: int, T.BooleanType: bool, T.ArrayType: list}
_CLOCK = threading.Lock()
_last = 0


def append(spark: SparkSession, root: str, record: dict) -> None:
    """Log one record; it is there as a whole or not at all. Fields outside the record schema are left out."""
    own = {f.name: record[f.name] for f in METRICS if record.get(f.name) is not None}
    for field in METRICS:
        value = own.get(field.name)
        if value is not None and not isinstance(value, _PYTHON[type(field.dataType)]):
            raise TypeError(f"{field.name} of a run record cannot be {value!r}")
    stamp = _stamp()
    name = _name(stamp)
    fs, draft = tables.at(spark, f"{_folder(root)}/.{name}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({**own, LOGGED: stamp}).encode()))
    out.close()
    _publish(spark, fs, draft, f"{_folder(root)}/one", f"{name}.json")


def append_many(records: DataFrame, root: str) -> None:
    """Log many records at once, in as few files as their size calls for; of those for one run and layer the last to end counts."""
    stamp = _stamp()
    _write_bulk(records.select(*METRICS.names, F.lit(stamp).cast("bigint").alias(LOGGED)), root, _name(stamp))


def entries(spark: SparkSession, root: str) -> DataFrame | None:
    """All logged records with the time of logging, replaced ones included; None where nothing was logged."""
    frames = []
    one, bulk = (f"{_folder(root)}/{kind}" for kind in ("one", "bulk"))
    if tables.path_exists(spark, one):
        frames.append(spark.read.schema(_ENTRY).option("mode", "FAILFAST").json(one))
    if tables.path_exists(spark, bulk):
        frames.append(spark.read.schema(_ENTRY).option("recursiveFileLookup", True).parquet(bulk))
    return tables.union_all(frames) if frames else None


def newest(records: DataFrame, *more: Column) -> DataFrame:
    """The record logged last for each run and layer (and ``more``); of those logged at once the one that ended last."""
    order = F.struct(F.col(LOGGED), F.coalesce("end_time", F.lit("")))
    keys = [F.col("run_id").alias("of_run"), F.col("layer").alias("of_layer"), *more]
    whole = F.struct(*METRICS.names, LOGGED)
    return records.groupBy(*keys).agg(F.max_by(whole, order).alias("record")).select("record.*")


def compact(spark: SparkSession, root: str) -> int:
    """Rewrite the log as one bulk folder of its newest records; returns how many files and folders that replaces.

    Safe beside writers and other compactions. A scan that still reads the removed files fails and is to be repeated.
    """
    listed = []
    for kind in ("one", "bulk"):
        fs, folder = tables.at(spark, f"{_folder(root)}/{kind}")
        if fs.exists(folder):
            listed += [status.getPath() for status in fs.listStatus(folder)]
    if len(listed) < 2:
        return 0
    _write_bulk(newest(entries(spark, root)), root, _name(_stamp()))
    for path in listed:
        fs.delete(path, True)
    return len(listed)


def _write_bulk(records: DataFrame, root: str, name: str) -> None:
    spark = records.sparkSession
    fs, draft = tables.at(spark, f"{_folder(root)}/.{name}")
    try:
        records.hint("rebalance").write.parquet(draft.toString())
    except BaseException:
        fs.delete(draft, True)
        raise
    _publish(spark, fs, draft, f"{_folder(root)}/bulk", name)


def _publish(spark: SparkSession, fs, draft, folder: str, name: str) -> None:
    """Names are drawn anew each time, so the new one is always free."""
    fs.mkdirs(tables.at(spark, folder)[1])
    if not fs.rename(draft, tables.at(spark, f"{folder}/{name}")[1]):
        raise OSError(f"could not put {name} into {folder}")


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/log"


def _name(stamp: int) -> str:
    return f"{stamp:020d}-{uuid.uuid4().hex}"


def _stamp() -> int:
    """Microseconds, never the same twice in a process; several drivers are ordered by their clocks."""
    global _last
    with _CLOCK:
        _last = max(_last + 1, time.time_ns() // 1000)
        return _last
