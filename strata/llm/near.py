"""Near-duplicate documents: MinHash bands propose, odd sketches screen, full shingle sets confirm.

A document is the set of its five-word shingles, ASCII letters lower-cased. 128 MinHash samples form 32 bands of 4;
a pair at the threshold of 0.75 shares no band once in 200,000. The samples are also folded into an odd sketch, a
bitmap of parities: the population count of two sketches' XOR estimates how many samples differ, and pairs more than
five standard deviations off the threshold are not looked at further. All others are decided by their full sets.

Documents with equal sets are one class, and only its smallest id goes on. All documents of a band's bucket meet in
the group of the bucket's smallest id (its hub), where one task finds every link that joins two components. A group
above ``GROUP_SHINGLES`` is dealt out in blocks, each with the hub; what the hub does not join is then compared with
every block. So no pair of a bucket is left out and no list of pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as w
from strata.llm.components import components
from strata.llm.store import saved, texts_of

SHINGLE = 5
ROWS, BANDS = 4, 32
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
SIMILAR, OF = 75, 100
# Differing bits of two sketches at a similarity of 0.75: 57 on average, standard deviation below 9.
SCREEN_BITS = 100
# Shingles that one task compares at once (8 bytes each, a few arrays of them).
GROUP_SHINGLES = 1_000_000

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, (3, SAMPLES), dtype=np.uint64)
_XOR, _TIMES, _SALT = _SEEDS[0], _SEEDS[1] * np.uint64(2) + np.uint64(1), _SEEDS[2]
SIGNATURE = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def shingles(piece: w.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of a piece, row by row and sorted, with each row's first entry and the end."""
    words = piece.words()
    hashes, row = words.hashes(), words.row
    grams = w.grams(hashes, SHINGLE)
    whole = np.flatnonzero(row[: len(grams)] == row[SHINGLE - 1 :]) if len(grams) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    values = np.concatenate([grams[whole], w.span_hashes(hashes, words.first[short], words.first[short + 1])])
    rows = np.concatenate([row[whole], short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(piece.rows + 1))


def minima(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The MinHash samples of each row that has shingles: one row per sample."""
    filled = first[:-1][np.diff(first) > 0]
    out = np.empty((SAMPLES, len(filled)), np.uint64)
    for i in range(SAMPLES):
        out[i] = np.minimum.reduceat((values ^ _XOR[i]) * _TIMES[i], filled) if len(filled) else 0
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Each sample flips one bit of its document's bitmap, so that equal samples of two documents cancel in an XOR."""
    out = np.zeros((samples.shape[1], SKETCH_BITS // 64), np.uint64)
    every = np.arange(samples.shape[1])
    for i in range(SAMPLES):
        bit = w.mix(samples[i] ^ _SALT[i]) % np.uint64(SKETCH_BITS)
        out[every, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in w.pieces(batch.column(1), w.LOWER):
            values, first = shingles(piece)
            counts = np.diff(first)
            samples = minima(values, first)
            keys = np.empty((samples.shape[1], BANDS), np.uint64)
            for band in range(BANDS):
                key = np.full(samples.shape[1], band + 1, np.uint64)
                for sample in samples[band * ROWS : (band + 1) * ROWS]:
                    key = w.mix(key ^ sample)
                keys[:, band] = key
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (values, w.mix(values ^ _SALT[0]))]
            filled = (counts > 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.lo, piece.rows),
                    w.longs(counts),
                    *(w.longs(w.as_long(x[first[1:]] - x[first[:-1]])) for x in sums),
                    w.lists(w.longs(w.as_long(keys.reshape(-1))), filled * BANDS),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shingle count, set fingerprint and band keys of every document."""
    return texts_of(docs, id_col, text_col).mapInArrow(_signed, SIGNATURE)


def candidates(classes: DataFrame) -> DataFrame:
    """``(hub, doc_id, n_shingles)``: for every bucket with two classes or more, its members beside its smallest id."""
    rows = classes.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).filter("hub < last").drop("last")
    return rows.join(buckets, "band").groupBy("hub", "doc_id").agg(F.max("n_shingles").alias("n_shingles"))


def _links(table: pa.Table, first: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links found between rows ``first`` and all rows: ids and the smallest id each is joined to.

    Only links that join two components are needed, so a row is compared with those outside of its component.
    """
    ids = table["doc_id"].to_numpy()
    values, rows, sketches = [], [], np.zeros((len(ids), SKETCH_BITS // 64), np.uint64)
    at = 0
    for piece in w.pieces(table["text"], w.LOWER):
        found, begin = shingles(piece)
        counts = np.diff(begin)
        values.append(found)
        rows.append(at + np.repeat(np.arange(piece.rows), counts))
        sketches[at + np.flatnonzero(counts)] = odd_sketches(minima(found, begin))
        at += piece.rows
    value, row = np.concatenate(values), np.concatenate(rows)
    size = np.bincount(row, minlength=len(ids))
    begin = np.concatenate([[0], np.cumsum(size)])
    _, token = np.unique(value, return_inverse=True)
    where = row[np.argsort(token, kind="stable")]
    postings = np.concatenate([[0], np.cumsum(np.bincount(token))])
    label = np.unique(ids, return_index=True)[1][np.unique(ids, return_inverse=True)[1]]
    for y in [*first, *later]:
        differ = np.bitwise_count(sketches ^ sketches[y]).sum(1)
        open_ = (label != label[y]) & (differ <= SCREEN_BITS)
        if not open_.any():
            continue
        own = token[begin[y] : begin[y + 1]]
        start, count = postings[own], postings[own + 1] - postings[own]
        at = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        shared = np.bincount(where[at], minlength=len(ids))
        for x in np.flatnonzero(open_ & (OF * shared >= SIMILAR * (size + size[y] - shared))):
            if label[x] != label[y]:
                label[label == label[x]] = label[y]
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    return ids, least[label]


def _block_links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links of a block: the hub is compared first, then every row that may stand alone."""
    table = table.take(pc.sort_indices(table["doc_id"]))
    ids = table["doc_id"].to_numpy()
    hub = ids == key[0].as_py()
    outside = table["outside"].to_numpy(zero_copy_only=False).astype(bool) & ~hub
    a, b = _links(table, np.flatnonzero(hub), np.flatnonzero(outside))
    moved = a != b
    return pa.table({"a": w.longs(a[moved]), "b": w.longs(b[moved])})


def links(docs: DataFrame, classes: DataFrame, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """``(a, b)`` between class representatives, enough of the links to give all components."""
    members = saved(candidates(classes), "near-members")
    sizes = members.groupBy("hub").agg(F.sum("n_shingles").alias("all_shingles"))
    blocks = sizes.select("hub", F.ceil(F.col("all_shingles") / group_shingles).cast("int").alias("blocks"))
    dealt = members.join(blocks, "hub").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    # The hub stands in each block.
    hub_blocks = F.when(F.col("doc_id") == F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    dealt = dealt.withColumn("at", hub_blocks)
    # Whole texts always meet in a sort-merge join: the same plan at every size.
    whole = saved(dealt.join(docs.hint("merge"), "doc_id").drop("n_shingles"), "near-texts")
    outside = F.lit(True).alias("outside")
    found = saved(
        whole.select("hub", F.explode("at").alias("block"), "doc_id", "text", outside)
        .groupBy("hub", "block")
        .applyInArrow(_block_links, "a bigint, b bigint"),
        "near-links",
    )
    split = whole.filter("blocks > 1")
    if split.isEmpty():
        return found
    # What its hub's component does not hold is compared with all blocks of the group.
    label = components(found)
    own = label.select(F.col("node").alias("doc_id"), F.col("component").alias("own"))
    hubs = label.select(F.col("node").alias("hub"), F.col("component").alias("hubs"))
    split = split.join(own, "doc_id", "left").join(hubs, "hub", "left").withColumn(
        "outside", ~F.coalesce("own", "doc_id").eqNullSafe(F.coalesce("hubs", "hub"))
    )
    left = split.filter("outside").groupBy("hub").agg(F.sum(F.length("text")).alias("chars"))
    left = left.select("hub", F.ceil(F.col("chars") / (6 * group_shingles)).cast("int").alias("outs"))
    split = split.join(left, "hub")
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), "outs").cast("int")
    # An outside row is the left side of its own part against every block; every row is a right side of all parts.
    sides = split.select("hub", "doc_id", "text", "outside", "block", F.explode(F.sequence(F.lit(0), F.col("outs") - 1)).alias("part"))
    left_side = split.filter("outside").select(
        "hub", "doc_id", "text", F.lit(True).alias("outside"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part.alias("part")
    )
    more = (
        left_side.unionByName(sides.withColumn("outside", F.lit(False)))
        .groupBy("hub", "block", "part")
        .applyInArrow(_block_links, "a bigint, b bigint")
    )
    return saved(found.unionByName(more), "near-links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_shingles: int = GROUP_SHINGLES
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per document; one document of each component is kept.

    Null and wordless texts have no shingles and link with nothing. Rows that repeat an id are one node. Rows without
    an id keep a null component and stay. Empty tables give no rows; other columns are ignored.
    """
    docs = texts_of(docs, id_col, text_col)
    signed = saved(signatures(docs), "near-signatures")
    key = ["n_shingles", "set_a", "set_b"]
    filled = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy(*key).agg(F.min("doc_id").alias("class_id"))
    first = classes.select(F.col("class_id").alias("doc_id"), *key)
    unique = filled.join(first, ["doc_id", *key], "left_semi")
    label = components(links(docs, unique, group_shingles))
    # Rows that repeat an id with other words tie their classes together.
    with_class = signed.select("doc_id", *key).join(classes, key, "left")
    with_label = with_class.join(label.withColumnRenamed("node", "class_id"), "class_id", "left")
    return with_label.select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
