"""Source-file scans: CSV, JSON, and the choice between them by file name.

No row is lost or changed without a sign. Columns follow the header's names, a file that holds more than its reader
would return is refused, and malformed rows fail the read unless they are to be kept with a mark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import by_position
from strata.session import has_scratch
from strata.sources import arrays, cells, widen

# Holds the text of a malformed row where such rows are kept.
MALFORMED = "_malformed"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, malformed: str = "fail"
) -> DataFrame:
    """Scan CSV with a header row; types are inferred unless ``schema`` is given.

    Files whose headers differ are joined by column name, a column absent from a file being null there. Their cells are
    parsed once, into the scratch folder, and get the types that fit the cells of all files (see
    :func:`strata.sources.cells.typed_once`); where executors share no scratch folder such files are refused. With one
    header Spark infers the types, which reads the source once more; that takes less time than to write it down.

    A given schema is matched by header name: a column absent from the header is null, one absent from the schema is
    an error, and a further file whose header differs is refused.

    A cell that does not fit its type, and a row shorter or longer than the header, fails the read. With
    ``malformed="keep"`` its readable cells stay and the row's text is in column ``_malformed``.
    """
    _check_choice(malformed)
    header = spark.read.option("header", True).csv(path)
    if schema is None:
        kinds = cells.headers(spark, path)
        if len(kinds) > 1:
            return _joined_by_header(spark, path, kinds, malformed)
        inferred = spark.read.option("header", True).option("inferSchema", True).csv(path)
        reader = spark.read.option("mode", "FAILFAST").schema(inferred.schema) if malformed == "fail" else _with_mark(spark, inferred.schema)
        return reader.option("header", True).csv(path)
    declared = {f.name.lower(): f for f in schema}
    extra = [name for name in header.columns if name.lower() not in declared]
    if extra:
        raise ValueError(f"columns not in the declared schema: {extra}")
    found = T.StructType([T.StructField(name, declared[name.lower()].dataType) for name in header.columns])
    if malformed == "fail":
        reader = spark.read.schema(found).option("mode", "FAILFAST")
    else:
        reader = _with_mark(spark, found)
    df = reader.option("header", True).option("enforceSchema", False).csv(path)
    at = {name.lower(): i for i, name in enumerate(df.columns)}
    wanted = [*schema, *([T.StructField(MALFORMED, T.StringType())] if malformed == "keep" else [])]
    picked = [
        F.col(f"c{at[f.name.lower()]}") if f.name.lower() in at else F.lit(None).cast(f.dataType) for f in wanted
    ]
    return by_position(df).select(*(c.alias(f"p{i}") for i, c in enumerate(picked))).toDF(*(f.name for f in wanted))


def _joined_by_header(spark: SparkSession, path: str, kinds: dict[str, list[str]], malformed: str) -> DataFrame:
    """All files by column name, with the types that the cells of all of them fit."""
    if not has_scratch(spark):
        raise ValueError(f"files of {path} differ in their header: {sorted(kinds)[:2]}; set spark.checkpoint.dir to join them")
    frames = []
    for files in kinds.values():
        # These have one and the same header; repeated and empty names in it are made unique.
        names = spark.read.option("header", True).csv(files[0]).columns
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        reader = spark.read.option("mode", "FAILFAST").schema(schema) if malformed == "fail" else _with_mark(spark, schema)
        if not set("*?[{") & set(path):
            # Columns that stand for folders come along.
            reader = reader.option("basePath", path)
        frames.append(reader.option("header", True).csv(files))
    return _mark_last(cells.typed_once(widen.union_widened(frames), (MALFORMED,)))


def _mark_last(df: DataFrame) -> DataFrame:
    if MALFORMED not in df.columns or df.columns[-1] == MALFORMED:
        return df
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i] == MALFORMED)
    return by_position(df).select(*(f"c{i}" for i in order)).toDF(*(df.columns[i] for i in order))


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    lines: bool = False,
    malformed: str = "fail",
) -> DataFrame:
    """Scan JSON files holding one object or one array of objects each.

    Blocks of such a file are cut into records by many tasks, into the scratch folder (see
    :func:`strata.sources.arrays.as_lines`); where executors share none, a file is read by one task. A file with more
    than one value is refused, as all but the first would be lost. ``lines=True`` reads one object per line instead and
    copies nothing. Records that cannot be read, or whose values do not fit a given schema, fail the read; with
    ``malformed="keep"`` their text is in column ``_malformed``.
    """
    _check_choice(malformed)
    named = path
    if not lines and has_scratch(spark):
        path, lines = arrays.as_lines(spark, path), True
    elif not lines:
        check_single_values(spark, path)
    if schema is None:
        reader = spark.read.option("multiLine", not lines).option("columnNameOfCorruptRecord", MALFORMED)
        schema = reader.json(path).schema
        if malformed == "fail" and MALFORMED in schema.names or schema.names == [MALFORMED]:
            raise ValueError(f"no readable JSON record in {named}" if len(schema) == 1 else f"malformed JSON in {named}")
        schema = T.StructType([f for f in schema if f.name != MALFORMED])
    reader = spark.read.schema(schema).option("mode", "FAILFAST") if malformed == "fail" else _with_mark(spark, schema)
    return reader.option("multiLine", not lines).json(path)


def check_single_values(spark: SparkSession, *paths: str) -> None:
    """Refuse JSON files that hold several values one after the other.

    Outside of texts, a closing bracket directly before an opening one stands only between two such values.
    """
    bare = F.regexp_replace("value", r'"(?:[^"\\]++|\\.)*+"', "")
    several = spark.read.text(list(paths), wholetext=True).where(bare.rlike(r"[}\]]\s*[{\[]"))
    found = several.select("_metadata.file_path").first()
    if found:
        raise ValueError(f"{found[0]} holds more than one JSON value: read it with lines=True")


def is_json(path: str) -> bool:
    """Whether a file name selects the JSON reader; every other name selects CSV."""
    return path.lower().endswith(".json")


def read_source(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    lines: bool = False,
    malformed: str = "fail",
) -> DataFrame:
    """Scan a source file with the reader its name selects; ``lines`` applies to JSON."""
    if is_json(path):
        return read_json(spark, path, schema, lines, malformed)
    return read_csv(spark, path, schema, malformed)


def _check_choice(malformed: str) -> None:
    if malformed not in ("fail", "keep"):
        raise ValueError(f"malformed rows are to fail or to keep, not {malformed}")


def _with_mark(spark: SparkSession, schema: T.StructType):
    marked = T.StructType([*schema, T.StructField(MALFORMED, T.StringType())])
    return spark.read.schema(marked).option("columnNameOfCorruptRecord", MALFORMED)


def name_is_valid(name: Column, exts: Sequence[str] = (".csv",)) -> Column:
    """Whether a file name ends, in any case, with one of ``exts``."""
    lowered = F.lower(name)
    valid = F.lit(False)
    for ext in exts:
        valid = valid | lowered.endswith(ext.lower())
    return F.coalesce(valid, F.lit(False))


def validate_names(names: DataFrame, exts: Sequence[str] = (".csv",), column: str = "file_name") -> DataFrame:
    """Mark each file name as valid or not by its extension."""
    return names.withColumn("valid", name_is_valid(F.col(column), exts))
