"""Layer tables: scan, whole-table overwrite, schema enforcement and evolution."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import by_position, col
from strata.sources import widen

# Parquet stores these as one physical integer, so a narrower one fits a wider one.
_INT_FAMILY = (T.ByteType, T.ShortType, T.IntegerType)
# A writer keeps at most this many files open, one per partition value.
DIRECT_VALUES = 16
# Files of a partitioned write are to hold this much on average.
FILE_BYTES = 64 * 1024 * 1024
_NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_layer(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Scan a layer table.

    Without ``schema`` a partition column comes back last and with a type read
    off its directory names. With the written schema both are as written.
    """
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        path_exists(spark, path)
    if schema is None:
        return reader.load(path)
    return reader.schema(schema).load(path).select(*[col(f.name) for f in schema])


def layer_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Scan a layer table, or None where nothing has been written yet."""
    if not path_exists(spark, path):
        return None
    try:
        return read_layer(spark, path, fmt)
    except AnalysisException as error:
        if _has_no_data(error):
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can reach.

    Where a replacement was cut off between its two renames, the new table is put in place first.
    """
    fs, target = at(spark, path)
    if fs.exists(target):
        return True
    ready = _beside(spark, path, "ready")
    # Its writer, or another reader, may be faster; then the table is there as well.
    return bool(ready) and (_renamed(fs, ready[0], target) or fs.exists(target))


def at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def _named_beside(spark: SparkSession, path: str, kind: str, name: str):
    """A folder next to the table, on the same file system; the leading dot hides it from every scan."""
    _, target = at(spark, path)
    return spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{kind}-{name}")


def _beside(spark: SparkSession, path: str, kind: str) -> list:
    """What earlier writes left next to a table."""
    fs, target = at(spark, path)
    if not fs.exists(target.getParent()):
        return []
    prefix = f".{target.getName()}.{kind}-"
    found = [status.getPath() for status in fs.listStatus(target.getParent())]
    return sorted((p for p in found if p.getName().startswith(prefix)), key=lambda p: p.getName())


def _renamed(fs, source, target) -> bool:
    try:
        return fs.rename(source, target)
    except Exception as error:
        if "FileNotFoundException" in str(error):
            return False
        raise


def _settle(spark: SparkSession, path: str) -> None:
    """Finish or undo what a lost writer of this table left: a whole new table is put in place, the rest goes."""
    for ready in _beside(spark, path, "ready"):
        _swap(spark, path, ready)
    fs, target = at(spark, path)
    former = _beside(spark, path, "old")
    if former and not fs.exists(target):
        _renamed(fs, former.pop(), target)
    for leftover in former + _beside(spark, path, "new"):
        fs.delete(leftover, True)


def _swap(spark: SparkSession, path: str, ready) -> None:
    """Put a whole table in the place of the former one, which goes last."""
    fs, target = at(spark, path)
    old = _named_beside(spark, path, "old", uuid.uuid4().hex)
    replaced = fs.exists(target) and _renamed(fs, target, old)
    if not _renamed(fs, ready, target) and not fs.exists(target):
        if replaced:
            _renamed(fs, old, target)
        raise OSError(f"the new table could not be put at {path}")
    if replaced:
        fs.delete(old, True)


def scan_files(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    strict: bool = True,
    skipped: list[str] | None = None,
    widened: bool = False,
) -> DataFrame:
    """Concatenate all Parquet files below ``paths`` by column name; absent columns are null.

    With ``widened=True`` columns whose type differs among files get the type that holds the values of all (see
    :func:`strata.sources.widen.wider`), and :func:`type_clashes` tells which. Paths without files count as empty. An unreadable path, or files whose types cannot be merged, raise. With
    ``strict=False`` such a path is left out as a whole and its name is appended to ``skipped``, which must be given.
    Without ``schema`` the footers of all files are read to merge their columns.
    """
    if not strict and skipped is None:
        raise ValueError("a lenient scan needs a list for the paths it skips")
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    frames = []
    for path in paths:
        if not path_exists(spark, path):
            continue
        try:
            frames += _by_schema(spark, path) if widened and schema is None else [reader.parquet(path)]
        except Exception as error:
            if _has_no_data(error):
                continue
            if strict:
                raise
            skipped.append(path)
    if not frames:
        return spark.createDataFrame([], schema or T.StructType([]))
    return widen.union_widened(frames) if widened else union_all(frames)


def type_clashes(spark: SparkSession, *paths: str) -> DataFrame:
    """``(column, types, merged)``: columns whose type differs among the Parquet files below ``paths``, and the wider type."""
    frames = [df for path in paths if path_exists(spark, path) for df in _by_schema(spark, path)]
    if not frames:
        return spark.createDataFrame([], "column string, types array<string>, merged string")
    return widen.clashes(frames)


def _by_schema(spark: SparkSession, path: str) -> list[DataFrame]:
    """Scans of the files below a path, as many as it takes to keep files apart whose types cannot be merged.

    Executors read the footers. Where they clash, the files are halved until each part merges, and equal schemas are
    then read as one, so the jobs grow with the number of clashes, not of files.
    """
    whole = _merged(spark, path, [path])
    if whole is not None:
        return [whole]
    parts: dict[str, list[str]] = {}
    waiting = [sorted(unquote(name) for name in spark.read.schema("unread int").parquet(path).inputFiles())]
    while waiting:
        files = waiting.pop()
        df = _merged(spark, path, files)
        if df is not None:
            parts.setdefault(df.schema.json(), []).extend(files)
        elif len(files) == 1:
            return [spark.read.option("mergeSchema", True).parquet(path)]
        else:
            waiting += [files[len(files) // 2 :], files[: len(files) // 2]]
    return [_merged(spark, path, files) for files in parts.values()]


def _merged(spark: SparkSession, path: str, files: list[str]) -> DataFrame | None:
    """A scan of some files below a path, or None where their types differ."""
    reader = spark.read.option("mergeSchema", True)
    if files != [path]:
        reader = reader.option("basePath", path)
    try:
        return reader.parquet(*files)
    except Exception as error:
        if "CANNOT_MERGE" in str(error) or "Failed merging schema" in str(error):
            return None
        raise


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column absent from one input is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def conform(
    df: DataFrame, target: T.StructType, merge: bool = False, loose: Iterable[str] = ()
) -> DataFrame:
    """Project ``df`` onto the column order and types of ``target``.

    A missing column is null. An extra column is an error, or with ``merge`` is
    appended after the existing ones; nested fields follow the same rule. A
    changed type is an error. Columns in ``loose`` keep their own type.
    """
    loose = {name.lower() for name in loose}
    frame = by_position(df)
    given = {f.name.lower(): (F.col(f"c{i}"), f.dataType) for i, f in enumerate(df.schema)}
    names, picked = [], []
    for field in target:
        value, dtype = given.pop(field.name.lower(), (None, None))
        if value is None:
            value = F.lit(None).cast(field.dataType)
        elif field.name.lower() not in loose:
            value = _fit(value, dtype, field.dataType, merge, field.name)
        names.append(field.name)
        picked.append(value)
    if given and not merge:
        raise ValueError(f"columns not in the target table: {sorted(given)}")
    for i, field in enumerate(df.schema):
        if field.name.lower() in given:
            names.append(field.name)
            picked.append(F.col(f"c{i}"))
    return frame.select(*[value.alias(f"p{i}") for i, value in enumerate(picked)]).toDF(*names)


def check_fits(df: DataFrame, path: str, fmt: str = "parquet", merge_schema: bool = False) -> None:
    """Refuse data whose schema does not fit the table in place; looks at schemas only."""
    existing = layer_or_none(df.sparkSession, path, fmt) if fmt == "parquet" else None
    if existing is not None and existing.columns:
        conform(df, existing.schema, merge_schema)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    merge_schema: bool = False,
    fmt: str = "parquet",
) -> T.StructType:
    """Overwrite a layer table as a whole and return the schema written.

    The new files are written beside the table and swapped in by two renames when they are whole, so a writer that
    fails or is lost at any time leaves the former rows, and between the renames a reader puts the new table in place
    itself. One writer per table at a time. A file system whose rename copies (an object store) keeps the former rows
    until then as well, but the swap takes as long as the copy; a scan that still runs at the swap fails and is to be
    repeated. Other formats than Parquet replace their tables themselves.

    The data must fit the table already there (see :func:`conform`).
    ``partition_by`` applies only where the column exists. Use
    :func:`spread_for_write` beforehand to keep the partition files few.
    ``fmt="delta"`` leaves both checks to that format.
    """
    spark = df.sparkSession
    if partition_by not in df.columns:
        partition_by = None
    if fmt == "parquet":
        _check_not_read(df, path)
        existing = layer_or_none(spark, path, fmt)
        if existing is not None and existing.columns:
            df = conform(df, existing.schema, merge_schema, loose=[partition_by] if partition_by else [])
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("mergeSchema", str(merge_schema).lower())
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt != "parquet":
        writer.save(path)
        return df.schema
    _settle(spark, path)
    fs, _ = at(spark, path)
    name = uuid.uuid4().hex
    staged, ready = _named_beside(spark, path, "new", name), _named_beside(spark, path, "ready", name)
    try:
        # All partition values are written, whatever the session's overwrite mode.
        writer.option("partitionOverwriteMode", "static").save(staged.toString())
    except BaseException:
        fs.delete(staged, True)
        raise
    if not _renamed(fs, staged, ready):
        raise OSError(f"the table written for {path} is gone")
    _swap(spark, path, ready)
    return df.schema


def _check_not_read(df: DataFrame, path: str) -> None:
    """An overwrite deletes first: refuse it where the data still has to be read from there."""
    spark = df.sparkSession
    if not path_exists(spark, path):
        return
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder)
    prefix = folder.toUri().toString().rstrip("/") + "/"
    roots = [f"{root.rstrip('/')}/" for root in _read_roots(df)]
    inside = any(root.startswith(prefix) for root in roots)
    # A folder above the target is read in parts; only then do its files have to be looked at.
    if not inside and any(prefix.startswith(root) for root in roots):
        inside = any(name.startswith(prefix) for name in df.inputFiles())
    if inside:
        raise ValueError(f"{path} cannot be overwritten with data read from it")


def _read_roots(df: DataFrame) -> list[str]:
    """Paths that the scans of a frame start from, however many files lie below them."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        relation = getattr(leaves.apply(i), "relation", None)
        relation = relation() if leaves.apply(i).getClass().getSimpleName() == "LogicalRelation" else None
        if relation is not None and relation.getClass().getSimpleName() == "HadoopFsRelation":
            paths = relation.location().rootPaths()
            roots += [paths.apply(k).toUri().toString() for k in range(paths.size())]
    return roots


def spread_for_write(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Gather each partition value into few files, splitting hot values at run time.

    The hint lets adaptive execution cut a value that holds a large share of the
    rows over as many writers as its size calls for, which a hash repartition
    on the column would not. It costs one shuffle of the data.
    """
    if partition_by is None or partition_by not in df.columns:
        return df
    return df.hint("rebalance", col(partition_by))


def leaves_small_files(df: DataFrame, column: str, stored: int, least: int = FILE_BYTES) -> bool:
    """Whether writing straight from the scan leaves files below ``least`` bytes; reads the partition column only.

    Each task then writes a file per value it meets. ``stored`` is the size of what is scanned. One task writes one
    file per value at best, whatever their size, so there a shuffle gains nothing unless the values are many.
    """
    values = df.agg(F.approx_count_distinct(col(column))).first()[0]
    tasks = scan_tasks(df.sparkSession, stored)
    return values > DIRECT_VALUES or (tasks > 1 and stored < least * tasks * values)


def scan_tasks(spark: SparkSession, stored: int) -> int:
    """About how many tasks Spark makes of a scan of so many bytes."""
    size = lambda key: spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    split = max(size("spark.sql.files.openCostInBytes"), stored // max(1, spark.sparkContext.defaultParallelism))
    return -(-stored // min(size("spark.sql.files.maxPartitionBytes"), split)) or 1


def _has_no_data(error: Exception) -> bool:
    condition = (error.getCondition() or "") if isinstance(error, AnalysisException) else ""
    return any(condition.startswith(name) for name in _NO_DATA)


def _fit(value: Column, given: T.DataType, wanted: T.DataType, merge: bool, name: str) -> Column:
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        return _fit_struct(value, given, wanted, merge, name)
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        if _plain(given.elementType) == _plain(wanted.elementType):
            return value
        return F.transform(value, lambda x: _fit(x, given.elementType, wanted.elementType, merge, name))
    if isinstance(given, T.NullType):
        return value.cast(wanted)
    if isinstance(given, _INT_FAMILY) and isinstance(wanted, _INT_FAMILY):
        if _INT_FAMILY.index(type(given)) <= _INT_FAMILY.index(type(wanted)):
            return value.cast(wanted)
    elif _plain(given) == _plain(wanted):
        return value
    raise ValueError(f"column {name}: {given.simpleString()} does not fit {wanted.simpleString()}")


def _fit_struct(value: Column, given: T.StructType, wanted: T.StructType, merge: bool, name: str) -> Column:
    fields = {f.name.lower(): f for f in given}
    parts = []
    for field in wanted:
        own = fields.pop(field.name.lower(), None)
        if own is None:
            part = F.lit(None).cast(field.dataType)
        else:
            part = _fit(value.getField(own.name), own.dataType, field.dataType, merge, f"{name}.{field.name}")
        parts.append(part.alias(field.name))
    if fields and not merge:
        raise ValueError(f"fields not in the target table: {name}.{sorted(fields)}")
    parts += [value.getField(f.name).alias(f.name) for f in fields.values()]
    return F.when(value.isNotNull(), F.struct(*parts))


def _plain(dtype: T.DataType) -> str:
    return dtype.simpleString()
