"""Column types of text cells: a mergeable state per column, filled in the pass that parses the cells.

Each cell is of the narrowest kind that it fits. The state of a column is the set of kinds seen, as bits, and the most
digits; states of tasks merge by OR and by maximum, so any division of the input gives the same types.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import by_position
from strata.session import scratch_path

INT, LONG, DECIMAL, REAL, DATE, TIME, BOOLEAN, TEXT = (1 << k for k in range(8))
_NUMBERS, _TIMES = INT | LONG | DECIMAL | REAL, DATE | TIME
_MOST_DIGITS, _LONG_DIGITS, _INT_DIGITS = 38, 20, 10

# Files whose first line is read at the same time.
READERS = 16

_WHOLE, _POINTED = "^[+-]?[0-9]+$", r"^[+-]?[0-9]+\.?$"
_NUMBER = r"^[\x00-\x20]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|Inf|Infinity)[\x00-\x20]*$"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[\x00-\x20]*([+-]?[0-9]{4,6}(-[0-9]{1,2}){0,2}([ T].*)?|T?[0-9]{1,2}:.*)[\x00-\x20]*$"
# Bounds of int and bigint, without sign.
_LARGEST_INT, _SMALLEST_INT = "2147483647", "2147483648"
_LARGEST_LONG, _SMALLEST_LONG = "9223372036854775807", "9223372036854775808"


def kind(cell: Column) -> Column:
    """The bit of the narrowest kind that a cell fits; 0 for null and empty cells, which fit all.

    Whole numbers are compared as texts and times are cast only where they look like one: a failing cast costs an
    exception.
    """
    whole = cell.rlike(_WHOLE)
    return (
        F.when(cell.isNull() | (cell == ""), 0)
        .when(whole & ((F.length(cell) < len(_LARGEST_INT)) | _fits(cell, _LARGEST_INT, _SMALLEST_INT)), INT)
        .when(whole & _fits(cell, _LARGEST_LONG, _SMALLEST_LONG), LONG)
        .when(cell.rlike(_POINTED) & (_digits(cell) <= _MOST_DIGITS), DECIMAL)
        .when(cell.rlike(_NUMBER), REAL)
        .when(cell.rlike(_DAY) & cell.try_cast("date").isNotNull(), DATE)
        .when(cell.rlike(_MOMENT) & cell.try_cast("timestamp").isNotNull(), TIME)
        .when(F.lower(cell).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def _body(cell: Column) -> Column:
    """A whole number without sign, leading zeros and a point behind it."""
    return F.regexp_replace(cell, r"^[+-]?0*|\.$", "")


def _fits(cell: Column, largest: str, smallest: str) -> Column:
    """Whether a whole number lies between two bounds of as many digits."""
    body = _body(cell)
    bound = F.when(cell.startswith("-"), smallest).otherwise(largest)
    return (F.length(body) < len(largest)) | ((F.length(body) == len(largest)) & (body <= bound))


def _digits(cell: Column) -> Column:
    return F.length(_body(cell))


def _decimal_digits(cell: Column) -> Column:
    """Digits of a cell that may be a decimal; other whole numbers are too short to matter."""
    long = (F.length(cell) >= len(_LARGEST_LONG)) | cell.endswith(".")
    return F.when(long, F.when(cell.rlike(_POINTED), _digits(cell)))


def merged(kinds: int | None, digits: int | None) -> T.DataType:
    """The type of a column from its state: the narrowest one that every cell fits."""
    kinds = kinds or 0
    groups = [g for g in (_NUMBERS, _TIMES, BOOLEAN, TEXT) if kinds & g]
    if len(groups) != 1 or kinds & TEXT:
        return T.StringType()
    if kinds & REAL:
        return T.DoubleType()
    if kinds & DECIMAL:
        least = _LONG_DIGITS if kinds & LONG else _INT_DIGITS if kinds & INT else 0
        return T.DecimalType(max(digits or 1, least), 0)
    if kinds & _NUMBERS:
        return T.LongType() if kinds & LONG else T.IntegerType()
    if kinds & _TIMES:
        return T.TimestampType() if kinds & TIME else T.DateType()
    return T.BooleanType()


def typed_once(texts: DataFrame, untyped: tuple[str, ...] = ()) -> DataFrame:
    """A frame with its text columns as the types that all their cells fit; columns named in ``untyped`` stay text.

    The source is parsed once: its cells are written to the scratch folder as they are, the states of the columns ride
    on that write, and the result casts what was written, column by column as they are asked for.
    """
    names, plain = texts.columns, by_position(texts)
    # Columns that stand for folders have their types already.
    text = [isinstance(f.dataType, T.StringType) and name not in untyped for f, name in zip(plain.schema, names, strict=True)]
    typed = [c for c, is_text in zip(plain.columns, text, strict=True) if is_text]
    seen = Observation(f"strata-{uuid.uuid4().hex}")
    states = [F.count(F.lit(1)).alias("rows")]
    for c in typed:
        states.append(F.bit_or(kind(F.col(c))).alias(f"k{c}"))
        states.append(F.max(_decimal_digits(F.col(c))).alias(f"d{c}"))
    path = scratch_path(texts.sparkSession, "cells")
    plain.observe(seen, *states).write.parquet(path)
    found = seen.get
    stored = texts.sparkSession.read.schema(plain.schema).parquet(path)
    picked = []
    for c in plain.columns:
        wanted = merged(found[f"k{c}"], found[f"d{c}"]) if c in typed else None
        as_is = wanted is None or isinstance(wanted, T.StringType)
        picked.append((F.col(c) if as_is else F.when(F.col(c) != "", F.col(c)).cast(wanted)).alias(c))
    return stored.select(*picked).toDF(*names)


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The different first lines of the files below a path, each with its files, in the order of their first file.

    Only the first line of each file is read, by some threads of the driver; blank lines before it and files without a
    line do not count.
    """
    names = sorted(unquote(name) for name in spark.read.schema("value string").text(path).inputFiles())
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda name: _first_line(spark, name), names))
    found: dict[str, list[str]] = {}
    for name, line in zip(names, lines, strict=True):
        if line is not None:
            found.setdefault(line, []).append(name)
    return found


def _first_line(spark: SparkSession, name: str) -> str | None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(name)
    stream = target.getFileSystem(conf).open(target)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    text = codec.createInputStream(stream) if codec else stream
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
    try:
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        reader.close()
