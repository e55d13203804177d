"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Bytes of stored data per shuffle partition: about 1 GiB once decompressed into rows.
STORED_BYTES_PER_PARTITION = 256 * 1024 * 1024
# Above this the shuffle's own bookkeeping costs more than larger partitions that spill.
MAX_SHUFFLE_PARTITIONS = 32_768
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

DEFAULTS = {
    # Naive text times are UTC everywhere in the run records.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of a shuffle partition after coalescing or splitting, and so of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Splits a hot partition value over several writers after a REBALANCE hint.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build(app_name: str = "strata", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build a session. The master is left to spark-submit unless one is named."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local temporary folder: on a
    cluster the executors would each see a different disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not has_scratch(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="strata-")
    return f"{base.rstrip('/')}/strata/{name}-{uuid.uuid4().hex}"


def has_scratch(spark: SparkSession) -> bool:
    """Whether there is a scratch folder that all executors see."""
    master = spark.conf.get("spark.master", "local")
    return bool(spark.conf.get("spark.checkpoint.dir", None) or re.fullmatch(r"local(\[[^\]]*\])?", master))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context; they need not share the driver's path."""
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='strata-')}/strata", "zip", os.path.dirname(here), os.path.basename(here))
    context.addPyFile(archive)
    context._strata_shipped = True


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Use some SQL settings for a while and put the former ones back.

    Where several threads of a session ask for the same setting at once, the largest number holds for all of them,
    and the former value comes back when the last one leaves.
    """
    with _LOCK:
        for key, value in values.items():
            held = _HELD.setdefault((spark, key), [spark.conf.get(key, None)])
            held.append(str(value))
            spark.conf.set(key, _largest(held[1:]))
    try:
        yield
    finally:
        with _LOCK:
            for key, value in values.items():
                held = _HELD[spark, key]
                held.reverse()
                held.remove(str(value))
                held.reverse()
                if len(held) > 1:
                    spark.conf.set(key, _largest(held[1:]))
                    continue
                del _HELD[spark, key]
                if held[0] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, held[0])


_LOCK = threading.Lock()
# For each session and setting: its former value, then the values asked for by whoever is within settings() now.
_HELD: dict[tuple[SparkSession, str], list[str | None]] = {}


def _largest(values: list[str]) -> str:
    return max(values, key=int) if all(v.isdigit() for v in values) else values[-1]


def shuffle_sized_for(spark: SparkSession, path: str) -> dict[str, object]:
    """Setting that raises the number of shuffle partitions to what the data below ``path`` needs.

    The number is never lowered; adaptive execution merges what turns out small.
    """
    needed = min(-(-stored_bytes(spark, path) // STORED_BYTES_PER_PARTITION), MAX_SHUFFLE_PARTITIONS)
    return {SHUFFLE_PARTITIONS: max(int(spark.conf.get(SHUFFLE_PARTITIONS)), needed)}
