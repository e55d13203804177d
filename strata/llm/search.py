"""Ranked lexical search: hashed max-sketches bound the scores, exact rescoring in descending order of the bounds.

The impact of a term in a document grows with its occurrences and falls with the document's length. A document's
sketch has ``HASHES`` lines of ``COORDINATES`` entries; every term is hashed to one entry of each line, which holds the
largest number of occurrences among the document's terms there. As the impact grows with that number, the least of a
term's entries gives an upper bound, and the weighted sum over a query's terms an upper bound of the score.

1. One pass over the whole texts writes length, sketch and the occurrences of the asked terms for each document.
2. Counts over that table give the weights.
3. Each task looks up the bounds of its documents for all queries of a pass at once, as a product of matrices in
   blocks. For each query it scores documents exactly from the highest bound down, until the bound falls below the
   k-th score found so far. So the rest need no score, and no result can be lost.
4. The lists of the tasks, of k rows a query at most, are merged in two rounds.

Queries are a set of their own: they are taken in passes of a bounded number of terms, so what the driver and each
task hold of them does not grow with either table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import words as w
from strata.llm.store import saved, texts_of

# Lines of a sketch, and entries of each, a power of two.
HASHES, COORDINATES = 3, 1024
# Terms of queries held at once; an item's terms stay together.
TERMS_A_PASS = 20_000
# Bounds of at most so many pairs of document and term are computed together, for at most so many documents.
BLOCK_PAIRS, BLOCK_ROWS = 1 << 22, 1024
# Documents scored between two looks at the threshold.
STRIDE = 32
# The impact is below this for any number of occurrences.
MOST_IMPACT = 1_000_000
# An entry of this value stands for as many occurrences or more.
FULL = 255
ROUND_ONE = 64

#: Bytes of terms: digits, letters, and all bytes of characters beyond ASCII.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

INDEX = "doc_id bigint, n bigint, sketch binary, terms array<int>, times array<bigint>"
FOUND = "item_id bigint, doc_id bigint, score bigint"


def _counted_terms(piece: w.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each row with repeats, then row, hash and occurrences of each distinct one, by row and hash."""
    words = piece.words(TERM)
    hashes = words.hashes()
    order = np.lexsort((hashes, words.row))
    row, own = words.row[order], hashes[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return words.counts, row[at], own[at], np.diff(np.append(at, len(own)))


def coordinates(hashes: np.ndarray) -> list[np.ndarray]:
    """The entry of each term in every line."""
    bits = np.uint64(COORDINATES.bit_length() - 1)
    return [((hashes >> (bits * np.uint64(line))) & np.uint64(COORDINATES - 1)).astype(np.int64) for line in range(HASHES)]


def sketch(rows: int, row: np.ndarray, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The lines of each row over all its distinct terms."""
    lines = np.zeros((rows, HASHES, COORDINATES), np.uint8)
    most = np.minimum(times, FULL).astype(np.uint8)
    for line, at in enumerate(coordinates(hashes)):
        np.maximum.at(lines[:, line], (row, at), most)
    return lines.reshape(rows, HASHES * COORDINATES)


def impact(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item."""
    for batch in batches:
        for piece in w.pieces(batch.column(1), w.LOWER):
            _, row, hashes, _ = _counted_terms(piece)
            ids = batch.column(0).slice(piece.lo, piece.rows).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([ids, w.longs(w.as_long(hashes))], names=["item_id", "term"])


def _indexer(asked: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Length, sketch, and the occurrences of the asked terms (sorted hashes), for each document."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in w.pieces(batch.column(1), w.LOWER):
                counts, row, hashes, times = _counted_terms(piece)
                lines = sketch(piece.rows, row, hashes, times)
                place = np.minimum(np.searchsorted(asked, hashes), len(asked) - 1)
                hit = asked[place] == hashes
                per_row = np.bincount(row[hit], minlength=piece.rows)
                columns = [
                    batch.column(0).slice(piece.lo, piece.rows),
                    w.longs(counts),
                    pa.array([line.tobytes() for line in lines], pa.binary()),
                    w.lists(pa.array(place[hit].astype(np.int32)), per_row),
                    w.lists(w.longs(times[hit]), per_row),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sketch", "terms", "times"])

    return index


class _Best:
    """The k highest scores of one query in a task."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.order = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids: list[int | None] = []

    @property
    def threshold(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, order: np.ndarray, ids: list[int | None]) -> None:
        score, order, ids = np.append(self.score, score), np.append(self.order, order), self.ids + ids
        best = np.lexsort((order, -score))[: self.k]
        best = best[score[best] > 0]
        self.score, self.order, self.ids = score[best], order[best], [ids[i] for i in best]


class Queries:
    """A pass of queries: their ids, and the places of their terms among the asked ones, whose entries and weights it has."""

    def __init__(self, ids: list[int | None], terms: list[np.ndarray], asked: np.ndarray, weight: np.ndarray):
        self.ids, self.terms, self.weight = ids, terms, weight
        self.at = [line * COORDINATES + own for line, own in enumerate(coordinates(asked))]
        #: For each asked term and query the weight, 0 where the query lacks the term.
        self.lookup = np.zeros((len(asked), len(ids)), np.float32)
        for q, own in enumerate(terms):
            self.lookup[own, q] = weight[own]

    def bounds(self, lines: np.ndarray, m: np.ndarray) -> np.ndarray:
        """For some sketches and all queries, no less than the score."""
        times = lines[:, self.at[0]]
        for at in self.at[1:]:
            times = np.minimum(times, lines[:, at])
        most = times.astype(np.float32)
        most *= np.float32(1e9) / (np.float32(1000) * most + np.float32(8) * m[:, None].astype(np.float32))
        most[times == FULL] = MOST_IMPACT
        # A little more than the sum, so that rounding never makes it too small.
        return most @ self.lookup * np.float32(1.001) + 1

    def scored(self, q: int, chosen: np.ndarray, block: _Block) -> np.ndarray:
        """Exact scores of some documents of a block."""
        weight = np.zeros(len(self.weight), np.int64)
        weight[self.terms[q]] = self.weight[self.terms[q]]
        start, size = block.first[chosen], block.first[chosen + 1] - block.first[chosen]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        sums = np.zeros(len(at) + 1, np.int64)
        np.cumsum(weight[block.terms[at]] * block.impact[at], out=sums[1:])
        return sums[ends] - sums[ends - size]


class _Block:
    """Some documents of the index."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids = batch.column("doc_id").to_pylist()
        # Rows without an id come behind all others of the same score.
        top = np.iinfo(np.int64).max
        self.order = np.array([top if i is None else i for i in self.ids], np.int64)
        self.m = batch.column("m").to_numpy()
        self.lines = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(len(self.ids), -1)
        terms = batch.column("terms")
        self.first = terms.offsets.to_numpy().astype(np.int64)
        self.first = self.first - self.first[0]
        self.terms = terms.flatten().to_numpy()
        self.impact = impact(batch.column("times").flatten().to_numpy(), np.repeat(self.m, np.diff(self.first)))


def _rescore(queries: Queries, q: int, bound: np.ndarray, block: _Block, best: _Best) -> None:
    """Take documents by descending bound until the bound falls below the k-th score."""
    left = np.flatnonzero(bound >= best.threshold)
    left = left[np.argsort(-bound[left], kind="stable")]
    for lo in range(0, len(left), STRIDE):
        chosen = left[lo : lo + STRIDE]
        if bound[chosen[0]] < best.threshold:
            return
        best.offer(queries.scored(q, chosen, block), block.order[chosen], [block.ids[i] for i in chosen])


def _ranker(queries: Queries, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in queries.ids]
        rows = max(1, min(BLOCK_ROWS, BLOCK_PAIRS // len(queries.weight)))
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                block = _Block(batch.slice(lo, rows))
                bounds = queries.bounds(block.lines, block.m)
                for q in range(len(queries.ids)):
                    _rescore(queries, q, bounds[:, q], block, best[q])
        item = [i for i, b in zip(queries.ids, best, strict=True) for _ in b.ids]
        columns = [
            pa.array(item, pa.int64()),
            pa.array([i for b in best for i in b.ids], pa.int64()),
            w.longs(np.concatenate([b.score for b in best])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    return rank


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    ranked = Window.partitionBy("item_id", *group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _pass(docs: DataFrame, part: list, k: int) -> DataFrame:
    """The best documents of each task for the queries of one pass, given as (item, hash) rows."""
    by_item: dict = {}
    for item, term in part:
        by_item.setdefault(item, []).append(term)
    asked = np.unique(np.array([term for _, term in part], np.int64).view(np.uint64))
    index = saved(docs.mapInArrow(_indexer(asked), INDEX), "search-index")
    count, length = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(asked), np.int64)
    for term, n in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holding[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)
    terms = [np.searchsorted(asked, np.array(own, np.int64).view(np.uint64)) for own in by_item.values()]
    queries = Queries(list(by_item), terms, asked, weight)
    long = index.filter("n > 0").select("*", F.expr(f"10 + (90 * n * {count}L) div {max(length, 1)}L").alias("m"))
    return saved(long.mapInArrow(_ranker(queries, k), FOUND), "search-found")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    terms_a_pass: int = TERMS_A_PASS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each item the ``k`` documents of the highest score above 0.

    Terms are runs of letters, digits and characters beyond ASCII in the whole texts, A-Z lower-cased; each term of an
    item counts once. Equal scores come by ascending id, rows without an id last. Null and empty texts have no terms:
    such documents are never found, such items find nothing. Rows that repeat an id are documents of their own; items
    that repeat an id are one item with the terms of all. Other columns are ignored. An empty table of either kind
    gives no rows. Terms are compared by 64-bit hashes.
    """
    docs = texts_of(docs, id_col, text_col)
    named = texts_of(items, item_col, item_text_col).withColumnRenamed("doc_id", "item_id")
    asked = saved(named.mapInArrow(_asked, "item_id bigint, term bigint").distinct(), "search-asked")
    passes = -(-asked.count() // terms_a_pass)
    mine = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0))), F.lit(max(passes, 1)))
    parts = [asked.filter(mine == p).orderBy("item_id", "term").collect() for p in range(passes)]
    found = [_pass(docs, part, k) for part in parts if part]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    merged = reduce(DataFrame.unionByName, found).withColumn("round", F.spark_partition_id() % ROUND_ONE)
    merged = _first(merged, k, "round").drop("rank", "round")
    return _first(merged, k).select("item_id", "rank", "doc_id", "score")
