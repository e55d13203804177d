"""JSON files that hold one array or object, read by many tasks: blocks are summed up, then cut on their own.

Whether a byte stands within a text, and how deep within brackets, depends on all bytes before it. But the effect of a
block on that state is small: a flip for its quotes and, for either state at its start, a change of depth. So

1. each block of a file is summed up, by the task that reads it;
2. the summaries, one row per block, are chained along each file to the state at the start of every block;
3. each block then finds the commas between the records of the array and cuts its own records; what stands before the
   first and behind the last of them is joined with its neighbours, a record per block boundary.

The records go to the scratch folder, one per line, where Spark's reader for JSON lines infers types and splits as for
any such file. Files are UTF-8. Blocks are those of Spark's text reader, whose lines here end with a closing brace, so
that neither a file without line ends nor a long record makes a long line.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_path, ship_package

# Bytes taken together by the loops below.
CHUNK = 1 << 22
_QUOTE, _ESCAPE, _COMMA, _SPACES = 34, 92, 44, (9, 10, 13, 32)
_OPEN, _CLOSE, _LINE_ENDS = (91, 123), (93, 125), (10, 13)
# Names of files that Spark unpacks.
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")
_BOM = b"\xef\xbb\xbf"

SUMMARY = "file string, at bigint, part bigint, bytes bigint, size bigint, flips boolean, outside bigint, inside bigint, first int"
PIECES = "file string, at bigint, kind string, value string, top bigint, low bigint, ending bigint"


def _spaces(data: np.ndarray) -> np.ndarray:
    return np.isin(data, _SPACES)


def _quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes; a chunk never starts behind a backslash."""
    quote = data == _QUOTE
    escape = data == _ESCAPE
    if escape.any():
        plain = np.where(~escape, np.arange(len(data)), -1)
        last = np.maximum.accumulate(plain)
        at = np.flatnonzero(quote)
        at = at[at > 0]
        run = at - 1 - last[at - 1]
        quote[at[run % 2 == 1]] = False
    return quote


def _marks(data: np.ndarray, within: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: whether it stands in a text, the depth behind it, and the change it makes."""
    quote = _quotes(data)
    text = (np.cumsum(quote) + within) % 2 == 1
    step = np.zeros(len(data), np.int64)
    free = ~text
    step[np.isin(data, _OPEN) & free] = 1
    step[np.isin(data, _CLOSE) & free] = -1
    return text | quote, depth + np.cumsum(step), step


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """File, block, size of the file and some bytes, in order; the braces that ended the lines are back."""
    for batch in batches:
        files, at = batch.column("file").to_pylist(), batch.column("at").to_pylist()
        size, values = batch.column("size").to_pylist(), batch.column("value")
        held = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64))
        ends = [i for i in range(1, len(at)) if at[i] != at[i - 1] or files[i] != files[i - 1]] + [batch.num_rows]
        lo = 0
        for end in ends:
            while lo < end:
                hi = min(end, max(lo + 1, int(np.searchsorted(held, held[lo] + CHUNK, side="right"))))
                yield files[lo], at[lo], size[lo], b"}".join(values.slice(lo, hi - lo).to_pylist()) + b"}"
                lo = hi


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of chunks; those of a block follow each other by ``part``."""
    for part, (file, at, size, raw) in enumerate(_blocks(batches)):
        data = np.frombuffer(raw, np.uint8)
        _, depth, _ = _marks(data, False, 0)
        _, other, _ = _marks(data, True, 0)
        seen = np.flatnonzero(~_spaces(data))
        first = int(data[seen[0]]) if len(seen) else None
        if raw.startswith(_BOM) and at == 0:
            first = int(data[seen[seen >= 3][0]])
        row = {"file": file, "at": at, "part": part, "bytes": len(raw), "size": size, "flips": bool(_quotes(data).sum() % 2),
               "outside": int(depth[-1]), "inside": int(other[-1]), "first": first}
        yield pa.RecordBatch.from_pylist([row], schema=_SUMMED)


_SUMMED = pa.schema(
    [("file", pa.string()), ("at", pa.int64()), ("part", pa.int64()), ("bytes", pa.int64()), ("size", pa.int64()), ("flips", pa.bool_()),
     ("outside", pa.int64()), ("inside", pa.int64()), ("first", pa.int32())]
)


class _State(NamedTuple):
    """What is known at the start of a block."""

    within: bool
    depth: int
    #: Of its file: whether it holds an array, whether the brace behind its last line is none of its own, its last block.
    array: bool
    surplus: bool
    last: int


def _chained(rows: list[dict]) -> dict[tuple[str, int], _State]:
    """The states at the starts of all blocks, chained along each file."""
    starts: dict[tuple[str, int], tuple[bool, int]] = {}
    ends: dict[str, dict] = {}
    for row in sorted(rows, key=lambda r: (r["file"], r["at"], r["part"])):
        end = ends.setdefault(row["file"], {"within": False, "depth": 0, "first": None, "bytes": 0, "size": row["size"], "last": 0})
        starts.setdefault((row["file"], row["at"]), (end["within"], end["depth"]))
        end["first"] = end["first"] or row["first"]
        end["bytes"] += row["bytes"]
        end["depth"] += row["inside"] if end["within"] else row["outside"]
        end["within"] ^= row["flips"]
        end["last"] = row["at"]
    found = {}
    for (file, at), (within, depth) in starts.items():
        end = ends[file]
        # Spark's reader takes a byte order mark away. The size of a packed file says nothing of its bytes; there the
        # brackets have to tell.
        surplus = end["depth"] == -1 if file.endswith(_PACKED) else end["bytes"] - end["size"] in (1, 1 - len(_BOM))
        found[file, at] = _State(within, depth, end["first"] == _OPEN[0], surplus, end["last"])
    return found


def _cutter(states: dict[tuple[str, int], _State]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _by_block(_with_ends(_blocks(batches), states)):
            yield from _cut_block(chunks, states)

    return cut


def _cut_block(chunks: Iterator[tuple[str, int, bytes, bool]], states: dict[tuple[str, int], _State]) -> Iterator[pa.RecordBatch]:
    """The records of one block, the pieces at its two ends, and figures of its brackets."""
    block, rest, any_cut = None, [], False
    for file, at, raw, final in chunks:
        if block is None:
            block, (within, depth, array, _, _) = (file, at), states[file, at]
        data = np.frombuffer(raw, np.uint8)
        if not len(data):
            continue
        text, level, step = _marks(data, within, depth)
        # A value begins where anything but space stands at depth 0.
        outer = (level - step == 0) & (step != -1) & ~_spaces(data) & ~np.isin(data, list(_BOM))
        low = -1 if (text & np.isin(data, _LINE_ENDS)).any() else int(level.min())
        yield _rows(block, "figures", top=int(outer.sum()), low=low, ending=int(level[-1]) if final else 0)
        bounds = np.flatnonzero((data == _COMMA) & (level == 1) & ~text).tolist() if array else []
        if bounds:
            values = [raw[lo + 1 : hi] for lo, hi in zip([-1, *bounds], bounds, strict=False)]
            values[0] = b"".join([*rest, values[0]])
            if not any_cut:
                yield _rows(block, "head", [_text(values.pop(0))])
            # An element that is missing leaves a line that no reader takes.
            yield _rows(block, "record", [_text(value).strip(" \t") or "," for value in values])
            rest, any_cut = [], True
        rest.append(raw[bounds[-1] + 1 :] if bounds else raw)
        within, depth = bool((int(_quotes(data).sum()) + within) % 2), int(level[-1])
    yield _rows(block, "tail" if any_cut else "whole", [_text(b"".join(rest))])


def _by_block(chunks: Iterator[tuple]) -> Iterator[Iterator[tuple]]:
    for _, own in groupby(chunks, key=lambda chunk: chunk[:2]):
        yield own


def _with_ends(blocks: Iterator[tuple], states: dict[tuple[str, int], _State]) -> Iterator[tuple[str, int, bytes, bool]]:
    """Take back the brace that the end of a file was given, and tell which bytes are the last of a file."""
    held = None
    for block in chain(blocks, [None]):
        if held is not None:
            file, at, _, raw = held
            state = states[file, at]
            final = (block is None or block[:2] != held[:2]) and at == state.last
            yield file, at, raw[:-1] if final and state.surplus else raw, final
        held = block


_PIECES = pa.schema(
    [("file", pa.string()), ("at", pa.int64()), ("kind", pa.string()), ("value", pa.string()), ("top", pa.int64()), ("low", pa.int64()), ("ending", pa.int64())]
)


def _text(value: bytes) -> str:
    """Part of a record in one line: line ends stand between its parts only, as texts cannot hold them."""
    return value.replace(b"\r", b" ").replace(b"\n", b" ").decode("utf-8", "replace")


def _rows(block: tuple[str, int], kind: str, values: list[str] | None = None, **figures: int) -> pa.RecordBatch:
    values = [None] if values is None else values
    same = {"file": block[0], "at": block[1], "kind": kind, **figures}
    columns = [pa.array(values, f.type) if f.name == "value" else pa.repeat(pa.scalar(same.get(f.name), f.type), len(values)) for f in _PIECES]
    return pa.RecordBatch.from_arrays(columns, schema=_PIECES)


def as_lines(spark: SparkSession, *paths: str) -> str:
    """Write the records of JSON files below ``paths`` one per line and return the folder.

    Each file holds one array, whose elements are the records, or one object. A file that holds several values is
    refused. A file that ends within its value, or whose brackets do not match, leaves a line that cannot be read, and
    so does an element that is missing between two commas; no record of it is lost.
    """
    ship_package(spark)
    read = spark.read.option("lineSep", "}").text(list(paths))
    source = read.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.col("_metadata.file_size").alias("size"),
    )
    root = scratch_path(spark, "json")
    # A few figures per block, in number like the driver's own list of the blocks to read.
    states = _chained([row.asDict() for row in source.mapInArrow(_summed, SUMMARY).collect()])
    source.mapInArrow(_cutter(states), PIECES).write.partitionBy("kind").parquet(f"{root}/pieces")
    pieces = spark.read.schema(PIECES).parquet(f"{root}/pieces")
    figures = pieces.filter("kind = 'figures'").groupBy("file")
    judged = figures.agg(F.sum("top").alias("top"), F.min("low").alias("low"), F.sum("ending").alias("ending"))
    several = judged.filter("top > 1 AND low >= 0").orderBy("file").select("file").first()
    if several:
        raise ValueError(f"{several[0]} holds more than one JSON value: read it with lines=True")
    broken = judged.filter("low < 0 OR ending > 0").select("file", F.lit(True).alias("broken"))
    edges = _edges(pieces.filter("kind IN ('head', 'whole', 'tail')"))
    arrays = spark.createDataFrame([(f,) for f in sorted({f for (f, _), state in states.items() if state.array})], "file string")
    single = edges.join(arrays, "file", "left_anti").select(F.regexp_replace("value", "^\ufeff", "").alias("value"))
    joined = edges.join(arrays, "file", "left_semi")
    inner = F.when(F.col("first"), F.regexp_replace("value", "^\ufeff?\\s*\\[", "")).otherwise(F.col("value"))
    inner = F.trim(F.when(F.col("last"), F.regexp_replace(inner, "\\]\\s*$", "")).otherwise(inner))
    # An array without elements has one empty piece between its brackets; any other empty piece is a missing element.
    elements = joined.select(F.when((inner == "") & ~(F.col("first") & F.col("last")), ",").otherwise(inner).alias("value")).filter("value <> ''")
    elements = pieces.filter("kind = 'record'").select("value").unionByName(elements)
    # An array within the array is no record.
    elements = elements.select(F.when(F.col("value").startswith("["), F.concat(F.lit(","), "value")).otherwise(F.col("value")).alias("value"))
    marks = broken.select(F.concat(F.lit("[unclosed: "), "file").alias("value"))
    elements.unionByName(single.filter("trim(value) <> ''")).unionByName(marks).write.text(f"{root}/lines")
    return f"{root}/lines"


def _edges(pieces: DataFrame) -> DataFrame:
    """The records that lie across block boundaries: ``(file, value, first, last)``, whether a file begins or ends in them."""
    along = Window.partitionBy("file").orderBy("at", F.col("kind") == "tail")
    numbered = pieces.withColumn("record", F.sum((F.col("kind") == "tail").cast("int")).over(along))
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))
    joined = numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "").alias("value"))
    last = Window.partitionBy("file")
    return joined.select("file", "value", (F.col("record") == 0).alias("first"), (F.col("record") == F.max("record").over(last)).alias("last"))
