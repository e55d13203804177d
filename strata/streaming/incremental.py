"""Source files as a stream: refine each batch on arrival, or drain all that wait.

The state of a batch never reaches the next one, unless ``LayerConfig.across_batches`` asks that rows of earlier batches
be left out. With ``mode="append"`` each batch has its own folder
``stream=<name>/batch_id=<n>``, which a replay after a failure overwrites; with ``mode="overwrite"`` a layer holds the
last batch only. Files are taken whatever their age.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.model import LEDGER
from strata.operators import ledger
from strata.plans import layers
from strata.plans.config import LayerConfig
from strata.sources import files, tables
from strata.streaming import seen

# Older than any file; Spark's default would leave out files a week older than the newest one seen.
MAX_FILE_AGE = "36500d"
SOURCE_FILE = "_source_file"


def schema_of(spark: SparkSession, path: str, lines: bool = False) -> T.StructType:
    """Schema of a source file, to declare for the stream of files like it."""
    return files.read_source(spark, path, lines=lines).schema


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "csv",
    max_files: int | None = None,
    lines: bool = False,
    malformed: str = "fail",
    max_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream of the files that arrive in a folder; ``max_files`` bounds the files per batch.

    A CSV file whose header differs from the schema in names or order is refused. Malformed rows fail the batch, or
    come with their text in column ``_malformed``. ``lines`` reads one JSON object per line.
    """
    reader = spark.readStream.option("maxFileAge", max_age)
    if fmt in ("csv", "json"):
        if malformed == "fail":
            reader = reader.option("mode", "FAILFAST")
        else:
            schema = T.StructType([*schema, T.StructField(files.MALFORMED, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", files.MALFORMED)
    reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    elif fmt == "json":
        reader = reader.option("multiLine", not lines)
    return reader.format(fmt).load(folder)


def refine_batch(
    root: str,
    config: LayerConfig = layers.DEFAULT,
    mode: str = "append",
    stream: str | None = None,
    whole_json: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that takes a batch through the three layers.

    ``stream`` names the run ids and folders of its batches; without one it is the id of the query, which its
    checkpoint keeps. With ``whole_json`` batches name each row's file in column ``_source_file``, and those files are
    checked to hold one JSON value.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is overwrite or append, not {mode}")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        if whole_json:
            # As many names as files in the batch.
            names = [unquote(row[0]) for row in batch.select(SOURCE_FILE).distinct().collect()]
            if names:
                files.check_single_values(spark, *names)
            batch = batch.drop(SOURCE_FILE)
        part = f"{name}/{batch_id}" if mode == "append" else None
        if config.across_batches and part is not None and batch_id % seen.FOLD_EVERY == 0:
            # The batch before this one has ended, so no earlier one is replayed.
            seen.fold(spark, layers.seen_path(root, part), batch_id)
        layers.run(spark, batch, root, f"{name}_batch_{batch_id}", config, batch=part)

    return process


def on_arrival(
    spark: SparkSession,
    folder: str,
    root: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "csv",
    config: LayerConfig = layers.DEFAULT,
    mode: str = "append",
    max_files: int | None = 1,
    every: str = "10 seconds",
    stream: str | None = None,
) -> StreamingQuery:
    """Start refining files as they arrive, by default one file per batch."""
    return _started(spark, folder, root, schema, checkpoint, fmt, config, mode, max_files, stream, {"processingTime": every})


def drain(
    spark: SparkSession,
    folder: str,
    root: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "csv",
    config: LayerConfig = layers.DEFAULT,
    mode: str = "append",
    max_files: int | None = 1,
    stream: str | None = None,
) -> StreamingQuery:
    """Refine all files that wait, by default one after the other, then stop.

    A second call with the same checkpoint takes only files that came since.
    """
    query = _started(spark, folder, root, schema, checkpoint, fmt, config, mode, max_files, stream, {"availableNow": True})
    query.awaitTermination()
    return query


def _started(spark, folder, root, schema, checkpoint, fmt, config, mode, max_files, stream, trigger) -> StreamingQuery:
    source = file_stream(spark, folder, schema, fmt, max_files, config.lines, config.malformed)
    whole_json = fmt == "json" and not config.lines
    if whole_json:
        source = source.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    process = refine_batch(root, config, mode, stream, whole_json)
    return source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run_next(
    spark: SparkSession,
    entries: DataFrame,
    folder: str,
    root: str,
    pipeline: str,
    run_id: str,
    at: str,
    config: LayerConfig = layers.DEFAULT,
) -> tuple[DataFrame, list[dict]]:
    """Refine the next file of a pipeline's ledger: ``(ledger afterwards, records)``.

    With nothing pending the ledger comes back as it is, with no records. This works on frames only; use
    :func:`run_stored` to keep the entry of a failing run reserved.
    """
    entry = ledger.next_entry(entries, pipeline, run_id).select("file_name").first()
    if entry is None:
        return entries, []
    reserved = ledger.reserve(entries, pipeline, run_id, at)
    source = f"{folder.rstrip('/')}/{entry['file_name']}"
    records = layers.run(spark, source, root, run_id, config)
    return ledger.mark_processed(reserved, run_id, at), records


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored state of a ledger; an empty one where none is stored."""
    newest = max((number for number, complete in _states(spark, path).items() if complete), default=-1)
    return spark.createDataFrame([], LEDGER) if newest < 0 else spark.read.schema(LEDGER).parquet(f"{path}/state={newest}")


def store_ledger(entries: DataFrame, path: str) -> None:
    """Store a state of a ledger as a whole, beside the former one, which it may have been read from.

    States before the former one are removed. One writer at a time: the folder of a state is made by one write, so a
    second writer of the same state fails instead of mixing entries.
    """
    spark = entries.sparkSession
    states = _states(spark, path)
    entries.write.mode("error").parquet(f"{path}/state={max(states, default=-1) + 1}")
    done = sorted(number for number, complete in states.items() if complete)
    for number in done[:-1]:
        fs, folder = _file_system(spark, f"{path}/state={number}")
        fs.delete(folder, True)


def run_stored(
    spark: SparkSession,
    path: str,
    folder: str,
    root: str,
    pipeline: str,
    run_id: str,
    at: str,
    config: LayerConfig = layers.DEFAULT,
) -> list[dict]:
    """Refine the next file of a stored ledger and return its records; none where nothing is pending.

    The reservation is stored before the run and the mark after it. A run that fails leaves its entry reserved, and a
    retry with the same id takes it again.
    """
    entries = load_ledger(spark, path)
    entry = ledger.next_entry(entries, pipeline, run_id).select("file_name").first()
    if entry is None:
        return []
    store_ledger(ledger.reserve(entries, pipeline, run_id, at), path)
    records = layers.run(spark, f"{folder.rstrip('/')}/{entry['file_name']}", root, run_id, config)
    store_ledger(ledger.mark_processed(load_ledger(spark, path), run_id, at), path)
    return records


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _states(spark: SparkSession, path: str) -> dict[int, bool]:
    """Numbers of the states below a path, and whether each was written completely."""
    if not tables.path_exists(spark, path):
        return {}
    fs, folder = _file_system(spark, path)
    found = [status.getPath() for status in fs.listStatus(folder)]
    at = spark._jvm.org.apache.hadoop.fs.Path
    return {int(p.getName()[6:]): fs.exists(at(p, "_SUCCESS")) for p in found if p.getName().startswith("state=")}
