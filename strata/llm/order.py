"""Training order: every sequence of tokens gets a global slot by a keyed permutation and is written at its place.

Documents become tokens, each ended by a separator, and the documents of a part (task) form a stream that is cut into
sequences; the last one is filled up with separators. Each part gets as many sequence numbers as its bytes could ever
need, counted beforehand, so that numbers are known without tokenising twice. A Feistel network over the next power of
four permutes the numbers; numbers it sends beyond the end are permuted again until they fall inside (cycle-walking),
which keeps it a permutation. A sequence's slot is its rank by permuted number.

A shard holds the sequences of ``shard_sequences`` permuted numbers in a row, in order. It is a file of records of one
length: two bytes per token, least first, then a line feed that the text sink adds. So the place of any slot follows
from the lengths of the files, and reading can be taken up at any slot. Tokens are shuffled once and kept nowhere else.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.store import saved, texts_of
from strata.session import settings

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of that vocabulary: its split pattern and a free id, used as separator and filling.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50_256
_END = np.array([SEPARATOR], "<u2").tobytes()
SEQUENCE_TOKENS = 512
# Sequence numbers per shard: at most 16 MiB at the default length, 6 with usual text; a reader holds one shard per task.
SHARD_SEQUENCES = 16_384
# Rows that Spark hands to a Python worker at once: some MB of text, so that two workers stay small beside the JVM.
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000}
# The pieces of a sequence are put together from sorted rows, one sequence at a time, not in a table of sequences.
FROM_SORTED = {"spark.sql.execution.useObjectHashAggregateExec": "false"}
KEY = "training-order"
ROUNDS = 6

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The tokenizer of a vocabulary file's content, made once per process."""
    name = hashlib.sha256(ranks).hexdigest()
    if name not in _encodings:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        _encodings[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encodings[name]


def _token_bytes(batches: Iterator[pa.RecordBatch], ranks: bytes) -> Iterator[bytes]:
    """The tokens of each document with the separator, two bytes each."""
    encode = encoding(ranks).encode_to_numpy
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            for text in batch.column(1).slice(lo, 200).to_pylist():
                yield encode(text, disallowed_special=()).astype("<u2").tobytes() + _END if text else _END
        pa.default_memory_pool().release_unused()


def round_keys(key: str) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.sha256(f"{key}:{k}".encode()).digest()[:8], "little") for k in range(ROUNDS)], np.uint64)


def permute(numbers: np.ndarray, size: int, key: str = KEY, back: bool = False) -> np.ndarray:
    """A keyed permutation of ``range(size)``, or its inverse."""
    half = np.uint64(max(1, -(-max(size - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = round_keys(key)
    out = numbers.astype(np.uint64)
    left = np.arange(len(out))
    while len(left):
        a, b = out[left] >> half, out[left] & mask
        for k in range(ROUNDS):
            if back:
                a, b = b ^ (_scramble(a, keys[ROUNDS - 1 - k]) & mask), a
            else:
                a, b = b, a ^ (_scramble(b, keys[k]) & mask)
        out[left] = (a << half) | b
        left = left[out[left] >= np.uint64(size)]
    return out.astype(np.int64)


def _scramble(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _pieces(docs: DataFrame, ranks: bytes, room: dict[int, tuple[int, int]], size: int, length: int, key: str) -> DataFrame:
    """``(place_in_order, place, bytes)``: documents cut where sequences begin, with the permuted number of the sequence.

    ``room`` has the first sequence number of each part and how many it may use. Numbers of different parts never
    meet; a part that needs more than its room, as it was read differently before, fails.
    """

    def batch_of(numbers: list[int], places: list[int], contents: list[bytes]) -> pa.RecordBatch:
        order = permute(np.array(numbers, np.int64), size, key)
        return pa.RecordBatch.from_arrays(
            [pa.array(order), pa.array(places, pa.int32()), pa.array(contents, pa.binary())], names=["number", "place", "bytes"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        first, most = room.get(part, (0, 0))
        rows: tuple[list, list, list] = ([], [], [])
        for ids in _token_bytes(batches, ranks):
            end = at + len(ids) // 2
            if end > most * length:
                raise ValueError(f"part {part} of the documents was read differently the second time")
            for number in range(at // length, (end - 1) // length + 1):
                start = max(at, number * length)
                rows[0].append(first + number)
                rows[1].append(start - number * length)
                rows[2].append(ids[2 * (start - at) : 2 * (min(end, (number + 1) * length) - at)])
            at = end
            if len(rows[0]) >= 2000:
                yield batch_of(*rows)
                rows = ([], [], [])
        yield batch_of(*rows)

    return docs.mapInArrow(run, "number bigint, place int, bytes binary")


def materialise(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_sequences: int = SHARD_SEQUENCES,
    key: str = KEY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> str:
    """Write the shards below ``path`` and return it; ``read`` and ``sequences_of`` read them.

    The stream follows the parts and rows of ``docs``. A null text counts as empty: it is a separator alone. The last
    sequence is filled up with separators. Repeated rows are written as often as they come; other columns are ignored.
    An empty table writes a manifest and no shard. The path must not exist.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        ranks = file.read()
    docs = texts_of(docs, id_col, text_col)
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        # What comes out of a shuffle may be dealt otherwise when it is read again.
        docs = saved(docs, "order-texts")
    same = BATCH_ROWS | {"spark.sql.files.minPartitionNum": spark.sparkContext.defaultParallelism}
    with settings(spark, same):
        # A text has at most a token per byte, and its separator.
        most = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("most")
        parts = docs.groupBy(F.spark_partition_id().alias("part")).agg(most).orderBy("part").collect()
    needed = [-(-row["most"] // sequence_tokens) for row in parts]
    ends = np.cumsum(needed, dtype=np.int64).tolist()
    size = ends[-1] if ends else 0
    room = {row["part"]: (end - n, n) for row, end, n in zip(parts, ends, needed, strict=True)}
    spark.createDataFrame(
        [(size, sequence_tokens, shard_sequences, key)], "numbers bigint, sequence_tokens int, shard_sequences int, key string"
    ).coalesce(1).write.json(f"{path}/manifest")
    if not size:
        return path
    pieces = _pieces(docs, ranks, room, size, sequence_tokens, key).withColumn("bytes", F.col("bytes").cast("string"))
    pieces = pieces.withColumn("shard", F.expr(f"number div {shard_sequences}")).repartition("shard")
    whole = pieces.groupBy("shard", "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "bytes"))), lambda x: x["bytes"]), "").alias("record"))
    filling = np.full(sequence_tokens, SEPARATOR, "<u2").tobytes().hex()
    record = F.concat(F.col("record").cast("binary"), F.unhex(F.lit(filling)))
    record = F.substring(record, 1, 2 * sequence_tokens).cast("string")
    with settings(spark, same | FROM_SORTED):
        whole.sortWithinPartitions("shard", "number").select("shard", record.alias("value")).write.partitionBy("shard").text(f"{path}/shards")
    return path


def shards(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """``(shard, first slot, slots)`` of every shard file, from the files' lengths alone."""
    about = spark.read.json(f"{path}/manifest").first()
    if not about["numbers"]:
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/shards")
    number = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("bigint")
    rows = files.select(number.alias("shard"), (F.col("length") / (2 * about["sequence_tokens"] + 1)).cast("bigint")).collect()
    out, at = [], 0
    for shard, n in sorted(map(tuple, rows)):
        out.append((shard, at, n))
        at += n
    return out


def read(spark: SparkSession, path: str, from_slot: int = 0) -> DataFrame:
    """``(slot, shard, byte_offset, tokens)`` from a slot on, ``tokens`` as two bytes each; earlier shards stay unread."""
    wanted = [(shard, first, max(0, from_slot - first)) for shard, first, n in shards(spark, path) if first + n > from_slot]
    if not wanted:
        return spark.createDataFrame([], "slot bigint, shard bigint, byte_offset bigint, tokens binary")
    stride = 2 * spark.read.json(f"{path}/manifest").first()["sequence_tokens"] + 1
    files = spark.read.format("binaryFile").load([f"{path}/shards/shard={shard}" for shard, _, _ in wanted])
    number = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("bigint")
    places = spark.createDataFrame(wanted, "shard bigint, first bigint, skip int")
    files = files.select(number.alias("shard"), "content").join(F.broadcast(places), "shard")
    rows = files.select("shard", "first", "content", F.explode(F.sequence(F.col("skip"), (F.length("content") / stride).cast("int") - 1)).alias("k"))
    return rows.select(
        (F.col("first") + F.col("k")).alias("slot"),
        "shard",
        (F.col("k") * F.lit(stride)).cast("bigint").alias("byte_offset"),
        F.substring("content", F.col("k") * stride + 1, F.lit(stride - 1)).alias("tokens"),
    )
