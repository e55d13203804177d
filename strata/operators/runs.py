"""Run records: reading them, recent runs, the file a run worked on, quality per run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import fmt
from strata.model import METRICS
from strata.operators import lookup, positions
from strata.sources import log, tables
from strata.sources.tables import union_all

# Order in which the fields of a record are listed.
RECORD_KEYS = (
    "layer",
    "source",
    "input_rows",
    "output_rows",
    "schema",
    "rows_before",
    "rows_after",
    "duplicates_removed",
    "nulls_filled",
    "transformations",
    "kpis_generated",
    "aggregation_count",
    "output_datasets",
    "start_time",
    "end_time",
    "duration",
    "status",
    "job",
    "output",
    "app_name",
    "exception",
    # Fields of our own.
    "skipped",
    "key_nulls",
    "nulls_filled_exact",
    "malformed_rows",
)

# Largest k for which Spark's window group limit works (its default threshold).
GROUP_LIMIT = 1000

# Texts for a run without a known file.
QUEUED_FILE = "Queued file"

_RECORD_FILE = r"/run_[^/]+/(bronze|silver|gold)\.json$|/run_id=[^/]+/layer=[^/]+/[^/]+\.json$"
_HISTORY = "start_time string, layer string, status string, duration string, _corrupt_record string"


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Scan the run records below a root, the newest for each run and layer.

    They are read from the log (:mod:`strata.sources.log`) and from folders ``run_<id>/<layer>.json`` and
    ``run_id=<id>/layer=<layer>/*.json``, which count as older than the log; there the run id is that of the folder.
    """
    logged = log.entries(spark, root)
    fs, path = tables.at(spark, root)
    if logged is not None and not any(status.getPath().getName().startswith("run_") for status in fs.listStatus(path)):
        return log.newest(logged).select(*METRICS.names)
    kept = _folder_records(spark, root)
    if logged is None:
        return kept.select(*METRICS.names)
    # Records of folders that name no layer stay apart, each under its own file.
    kept = kept.withColumn("file", F.when(F.col("layer").isNull(), F.col("file"))).withColumn(log.LOGGED, F.lit(0).cast("bigint"))
    both = kept.unionByName(logged.withColumn("file", F.lit(None).cast("string")))
    return log.newest(both, F.col("file")).select(*METRICS.names)


def _folder_records(spark: SparkSession, root: str) -> DataFrame:
    # The schema is fixed, as an empty ``schema`` list would otherwise be read as a list of texts.
    body = T.StructType([f for f in METRICS if f.name != "run_id"])
    path = _unescaped(F.col("_metadata.file_path"))
    keyed = path.contains("/run_id=")
    run_id = F.when(keyed, _unescaped(F.regexp_extract(path, "/run_id=([^/]+)/", 1))).otherwise(
        F.regexp_extract(path, "/run_([^/]+)/[^/]+$", 1)
    )
    layer = F.coalesce(F.col("layer"), F.nullif(F.regexp_extract(path, "/layer=([^/]+)/", 1), F.lit("")))
    # The root is listed without a pattern, as a pattern does not match names with a colon;
    # the condition on the path then leaves all other files unread.
    records = (
        spark.read.schema(body)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .json(root)
        .where(F.col("_metadata.file_path").rlike(_RECORD_FILE))
    )
    return records.withColumns({"run_id": run_id, "layer": layer, "file": path}).select(*METRICS.names, "file")


def read_history(spark: SparkSession, folder: str) -> DataFrame:
    """Scan a flat history folder; files that are no JSON object are skipped.

    Returns ``(file_name, start_time, layer, status, duration)``.
    """
    records = spark.read.schema(_HISTORY).option("multiLine", True).json(folder)
    return records.where(F.col("_corrupt_record").isNull()).select(
        _unescaped(F.col("_metadata.file_name")).alias("file_name"), "start_time", "layer", "status", "duration"
    )


def history(df: DataFrame) -> DataFrame:
    """History listing, newest first by time-prefixed file name: ``(time, layer, status, duration)``."""
    return df.orderBy(F.col("file_name").desc()).select(
        F.col("start_time").alias("time"), "layer", "status", "duration"
    )


def list_runs(metrics: DataFrame) -> DataFrame:
    """Distinct run ids in descending text order."""
    return metrics.select("run_id").distinct().orderBy(F.col("run_id").desc())


def union_runs(runs: Mapping[str, DataFrame]) -> DataFrame:
    """All pipelines' runs as one table, tagged with the pipeline they belong to."""
    return union_all(df.withColumn("pipeline_id", F.lit(name)) for name, df in runs.items())


def recent(runs: DataFrame, pipelines: Sequence[str], k: int = 6) -> DataFrame:
    """Newest ``k`` runs of each named pipeline in one list, newest first, missing start last.

    Adds the 1-based ``position`` in that list and a ``display_name``. Up to ``GROUP_LIMIT``, each task keeps ``k`` rows
    per pipeline before the shuffle and the list, of at most ``k`` rows per named pipeline, is numbered in one place.
    Beyond it, counts by start time leave out older runs before any shuffle, and ranges of the rest are numbered by
    many tasks.
    """
    newest_first = [F.col("start_date").desc_nulls_last(), F.col("pipeline_id"), F.col("run_id")]
    named = runs.where(F.col("pipeline_id").isin(*pipelines))
    if k > GROUP_LIMIT:
        listed = _recent_by_ranges(named, newest_first, k)
    else:
        top = _first_of(named, ["pipeline_id"], newest_first, k)
        merged = top.orderBy(*newest_first).limit(k * len(pipelines))
        listed = merged.withColumn("position", F.row_number().over(Window.orderBy(*newest_first)))
    return listed.withColumn("display_name", fmt.run_name(F.col("run_id"), F.col("position")))


def _recent_by_ranges(named: DataFrame, newest_first: list[Column], k: int) -> DataFrame:
    newest = positions.upper_part(named, "pipeline_id", "start_date", k)
    ranked = positions.numbered(newest, [F.col("pipeline_id"), *newest_first], "rank")
    starts = ranked.groupBy("pipeline_id").agg(F.min("rank").alias("start"))
    top = ranked.join(F.broadcast(starts), "pipeline_id").where(F.col("rank") - F.col("start") < k)
    listed = positions.numbered(top.select(*named.columns), newest_first, "position")
    return listed.withColumn("position", F.col("position").cast("int"))


def _first_of(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).drop("rank")


def latest_records(metrics: DataFrame) -> DataFrame:
    """The record that ended last for each layer, over all runs; ties go to the larger run id."""
    whole = F.struct(*metrics.columns)
    ended = F.struct(F.coalesce("end_time", F.lit("")), F.coalesce("run_id", F.lit("")))
    return metrics.groupBy(F.col("layer").alias("of")).agg(F.max_by(whole, ended).alias("record")).select("record.*")


def warnings(metrics: DataFrame) -> DataFrame:
    """What a run should be looked at for although it did not fail: ``(run_id, layer, warning)``."""
    found = F.array(
        F.when(F.col("key_nulls") > 0, F.concat(F.col("key_nulls").cast("string"), F.lit(" rows without a key"))),
        F.when(F.col("malformed_rows") > 0, F.concat(F.col("malformed_rows").cast("string"), F.lit(" malformed rows kept"))),
        F.when(F.col("skipped"), F.lit("skipped: no input")),
    )
    return metrics.select("run_id", "layer", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("warning"))


def attach_file(
    runs: DataFrame,
    ledger: DataFrame,
    scheduled_pipeline: str,
    max_broadcast_rows: int = lookup.MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add the ``file_name`` a run worked on.

    The run's own ``conf`` comes first, then the last ledger entry that names the
    run, then a text that depends on whether the pipeline is the scheduled one.
    """
    last_entry = (
        ledger.select(
            F.explode(F.array_distinct(F.array("processed_run_id", "reserved_run_id"))).alias("run_id"),
            "position",
            F.coalesce(F.col("file_name"), F.lit(fmt.MISSING)).alias("entry_file"),
        )
        .where(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(F.max_by("entry_file", "position").alias("entry_file"))
    )
    found = lookup.attach(runs, last_entry, "run_id", max_broadcast_rows)
    fallback = F.when(F.col("pipeline_id") == scheduled_pipeline, QUEUED_FILE).otherwise(fmt.MISSING)
    own = F.nullif(F.col("conf")["file_name"], F.lit(""))
    return found.withColumn("file_name", F.coalesce(own, F.col("entry_file"), fallback)).drop("entry_file")


def quality_summary(metrics: DataFrame) -> DataFrame:
    """Per run: rows uploaded and processed, duplicates removed, nulls filled, final rows; absent gives 0."""

    def of(layer: str, field: str, name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("layer") == layer, F.col(field))), F.lit(0)).alias(name)

    return metrics.groupBy("run_id").agg(
        of("Bronze", "input_rows", "rows_uploaded"),
        of("Bronze", "output_rows", "rows_processed"),
        of("Silver", "duplicates_removed", "duplicates_removed"),
        of("Silver", "nulls_filled", "nulls_filled"),
        of("Silver", "rows_after", "final_rows"),
    )


def entries(metrics: DataFrame) -> Column:
    """The fields present in a record as an array of ``(position, key, value)`` with text values."""
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(key).alias("key"), _as_text(metrics.schema[key].dataType, key).alias("value")
        )
        for i, key in enumerate(k for k in RECORD_KEYS if k in metrics.columns)
    ]
    return F.filter(F.array(*rows), lambda row: row["value"].isNotNull())


def unpivot_metrics(metrics: DataFrame) -> DataFrame:
    """Each record as rows ``(run_id, layer, position, key, value)`` in key order."""
    return metrics.select("run_id", "layer", F.inline(entries(metrics)))


def _as_text(dtype: T.DataType, key: str) -> Column:
    if isinstance(dtype, T.ArrayType):
        return fmt.schema_list(F.col(key)) if isinstance(dtype.elementType, T.StructType) else fmt.text_list(F.col(key))
    if isinstance(dtype, T.BooleanType):
        # Only what happened is listed.
        return F.when(F.col(key), F.lit("true"))
    return F.col(key).cast("string")


def _unescaped(text: Column) -> Column:
    # A plus sign is literal in a path, while the decoder would read it as a space.
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
