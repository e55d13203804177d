"""Several workers on one stored ledger: each takes an entry by creating a file that only one of them can create.

Claims lie in ``<ledger>/claims`` as ``<position>-<attempt>``, with run and lease inside, and ``<position>-done``. A lease
that ran out lets another worker create the next attempt; of the attempts on one entry a single one can finish it. The
ledger's state is not rewritten for a claim: :func:`view` joins the claims to it, and :func:`fold` moves finished ones
into a new state.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.model import LEDGER
from strata.plans import layers
from strata.plans.config import LayerConfig
from strata.sources import tables
from strata.streaming import incremental

# Seconds after which a worker that has not finished counts as dead; longer than any file takes.
LEASE = 6 * 3600
# Free entries tried before the claims are read again.
_TRIED = 32
_BODY = "run_id string, at string, until string"
_CLAIMS = "position bigint, attempt int, run_id string, at string, until string, done_run_id string, done_at string, done boolean"


class LostClaim(RuntimeError):
    """Another worker has taken the entry since, or has finished it."""


@dataclass(frozen=True)
class Claim:
    position: int
    attempt: int
    file_name: str
    run_id: str


def claims(spark: SparkSession, path: str) -> DataFrame:
    """The newest claim of each position, and what finished it where ``done``."""
    folder = _folder(path)
    if not tables.path_exists(spark, folder):
        return spark.createDataFrame([], _CLAIMS)
    files = spark.read.format("binaryFile").load(folder)
    position, kind = (F.regexp_extract("path", r"(\d+)-(\d+|done)$", group) for group in (1, 2))
    body = F.from_json(F.col("content").cast("string"), _BODY)
    found = files.select(position.cast("bigint").alias("position"), kind.alias("kind"), body.alias("body"))
    started = F.col("kind") != "done"
    claim = F.struct(F.when(started, F.col("kind").cast("int")).alias("attempt"), "body.*")
    grouped = found.groupBy("position").agg(F.max(F.when(started, claim)).alias("claim"), F.max(F.when(~started, F.col("body"))).alias("end"))
    ended = [F.col("end.run_id").alias("done_run_id"), F.col("end.at").alias("done_at"), F.col("end").isNotNull().alias("done")]
    return grouped.select("position", "claim.*", *ended)


def view(entries: DataFrame, claimed: DataFrame) -> DataFrame:
    """The ledger with its claims: entries come out reserved or processed; ``attempt`` and ``until`` tell the newest claim."""
    held, done = F.col("attempt").isNotNull(), F.coalesce("done", F.lit(False))
    own = {
        "status": F.when(done, "processed").when(held, "reserved"),
        "reserved_run_id": F.when(held, F.col("run_id")),
        "reserved_at": F.when(held, F.col("at")),
        "processed_run_id": F.col("done_run_id"),
        "processed_at": F.col("done_at"),
    }
    joined = entries.join(claimed, "position", "left")
    return joined.select(
        *(F.coalesce(own[name], F.col(name)).alias(name) if name in own else F.col(name) for name in LEDGER.names), "attempt", "until"
    )


def take(spark: SparkSession, path: str, pipeline: str, run_id: str, at: str, lease: int = LEASE) -> Claim | None:
    """Claim the first entry of a pipeline that is queued or whose lease has run out; None where none is.

    A run that already holds an entry gets it again. ``at`` is the time now, as ISO text in UTC.
    """
    until = (datetime.fromisoformat(at) + timedelta(seconds=lease)).isoformat(timespec="seconds")
    body = json.dumps({"run_id": run_id, "at": at, "until": until})
    while True:
        entries = view(incremental.load_ledger(spark, path), claims(spark, path))
        entries = entries.filter((F.col("target_dag") == pipeline) & F.col("status").isin("queued", "reserved"))
        mine = (F.col("reserved_run_id") == run_id) & F.col("attempt").isNotNull()
        free = (F.col("status") == "queued") | (F.col("until") < F.lit(at))
        rows = entries.filter(F.coalesce(mine, F.lit(False)) | free).select("position", "file_name", "attempt", F.coalesce(mine, F.lit(False)).alias("mine"))
        rows = rows.orderBy(F.col("mine").desc(), "position").limit(_TRIED).collect()
        for row in rows:
            if row["mine"]:
                return Claim(row["position"], row["attempt"], row["file_name"], run_id)
            attempt = (row["attempt"] or 0) + 1
            if _create(spark, f"{_folder(path)}/{row['position']}-{attempt}", body):
                return Claim(row["position"], attempt, row["file_name"], run_id)
        if not rows:
            return None


def finish(spark: SparkSession, path: str, claim: Claim, at: str) -> None:
    """Mark a claimed entry as processed; raises :class:`LostClaim` where another worker has it by now."""
    fs, later = tables.at(spark, f"{_folder(path)}/{claim.position}-{claim.attempt + 1}")
    body = json.dumps({"run_id": claim.run_id, "at": at})
    if fs.exists(later) or not _create(spark, f"{_folder(path)}/{claim.position}-done", body):
        raise LostClaim(f"entry {claim.position} was taken from {claim.run_id}")


def fold(spark: SparkSession, path: str) -> None:
    """Store a state of the ledger that holds all finished claims, then remove their files. One folding worker at a time."""
    done = claims(spark, path).filter("done")
    # As many as entries finished since the last fold.
    finished = [(row["position"], row["attempt"]) for row in done.select("position", "attempt").collect()]
    if not finished:
        return
    positions = spark.createDataFrame([(position,) for position, _ in finished], "position bigint")
    incremental.store_ledger(view(incremental.load_ledger(spark, path), done.join(positions, "position", "left_semi")).drop("attempt", "until"), path)
    fs, _ = tables.at(spark, path)
    for position, attempts in finished:
        # The mark goes last: an entry whose files are half removed still counts as finished.
        for kind in [*range(1, (attempts or 0) + 1), "done"]:
            fs.delete(tables.at(spark, f"{_folder(path)}/{position}-{kind}")[1], False)


def run_claimed(
    spark: SparkSession,
    path: str,
    folder: str,
    root: str,
    pipeline: str,
    run_id: str,
    at: str,
    config: LayerConfig = LayerConfig(),
    lease: int = LEASE,
) -> list[dict]:
    """Claim the next file of a stored ledger, refine it and mark it; its records, none where nothing is free.

    A run that fails keeps its claim: a retry with the same id takes it again, any other run once the lease is over.
    """
    claim = take(spark, path, pipeline, run_id, at, lease)
    if claim is None:
        return []
    records = layers.run(spark, f"{folder.rstrip('/')}/{claim.file_name}", root, run_id, config)
    finish(spark, path, claim, at)
    return records


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/claims"


def _create(spark: SparkSession, path: str, body: str) -> bool:
    """Put a whole file where none must be, and say whether it was this call that did.

    It is written beside and gets its name in one step, which HDFS and local file systems refuse where the name is
    taken. Object stores whose rename copies give no such promise.
    """
    fs, target = tables.at(spark, path)
    beside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    _, draft = tables.at(spark, beside)
    out = fs.create(draft, False)
    out.write(bytearray(body.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return fs.rename(draft, target)
        # A local rename would replace the file; a link does not.
        os.link(draft.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)
