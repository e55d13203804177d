"""Benchmark decontamination by templates.

Words are lower-cased and freed of punctuation; numbers, names and units become typed placeholders. What is left are
templates, and windows of ``WINDOW`` template words are hash-joined between documents and benchmark items. Windows on
one diagonal (same distance between the places) with other values in their slots are one alignment. It counts only if
its slots are consistent: each value of the item stands for one value of the document and the other way round. So a question is caught whose numbers
or names were exchanged, but not chance meetings of templates. Windows with few literal words are no templates.

Beside them windows of the plain lower-cased words are joined the same way, so a verbatim copy is caught whatever its
slots and whatever its case. These count always, also where values elsewhere are inconsistent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as w
from strata.llm.store import saved, texts_of

# Units that stand behind a number or end it.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s ms min h hr hrs hour hours day days week weeks month months year years "
    "second seconds minute minutes meter meters metre metres kilometer kilometers gram grams kilogram kilograms liter liters "
    "litre litres mile miles inch inches foot feet pound pounds dollar dollars cent cents euro euros percent degree degrees "
    "hz khz mhz ghz w kw v a j kj mb gb tb kb"
).split()
WINDOW = 8
LEAST_LITERAL = 5
# Items of fewer words are not sought.
LEAST_WORDS = 5
# What must be found of an item in a document: this share of its windows, or a passage of 13 words if that is less.
COVERED = 0.5
PASSAGE_WINDOWS = 13 - WINDOW + 1
# Bits of the first filter: 2 MB, whatever the size of the benchmark.
FILTER_BITS = 24

FOUND = "id bigint, hash bigint, at bigint, slots array<bigint>"
SCHEMA = f"{FOUND}, literal boolean, windows bigint, templates bigint, size bigint"
_NUMBER, _NAME, _UNIT, _BOTH = (np.uint64(0x5BD1E9955BD1E995 * k % (1 << 64)) for k in (3, 5, 7, 11))
_KEPT = w.SPACE.copy()
_KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SMALL = np.zeros(256, bool)
_SMALL[97:123] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:;\n\"")] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    end = np.cumsum([len(u) for u in UNITS])
    return np.sort(w.span_hashes(w._BYTE_VALUES[data], end - [len(u) for u in UNITS], end))


_UNIT_HASHES = _unit_hashes()


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _lowered(piece: w.Piece) -> w.Piece:
    """Letters beyond ASCII lower-cased too; bytes that are no UTF-8 stay."""
    if not len(piece.data) or piece.data.max() < 128:
        return piece
    bounds = np.ascontiguousarray(piece.bounds, np.int64)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(piece.data))]
    try:
        low = pc.utf8_lower(pa.Array.from_buffers(pa.large_string(), piece.rows, buffers))
        ends = np.frombuffer(low.buffers()[1], np.int64)[: piece.rows + 1]
        return w.Piece(np.frombuffer(low.buffers()[2], np.uint8)[: ends[-1]], ends, piece.lo)
    except pa.ArrowInvalid:
        raw = piece.data.tobytes()
        rows = [raw[a:b].decode(errors="surrogateescape").lower().encode(errors="surrogateescape") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return w.Piece(np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)]), piece.lo)


class Template:
    """Template words of a piece: their hashes, which of them are slots, and the hashes of the plain words."""

    def __init__(self, piece: w.Piece):
        kept = _KEPT[piece.data]
        where = np.flatnonzero(kept)
        count = np.concatenate([[0], np.cumsum(kept)])
        self.words = words = w.Piece(w.LOWER[piece.data[kept]], count[piece.bounds], piece.lo).words()
        self.plain = _lowered(words.piece).words().hashes()
        start, end = words.start, words.end
        if not len(words):
            self.hashes, self.slot = self.plain, np.zeros(0, bool)
            return
        digits = words.byte_sums(_DIGIT)
        number = digits == end - start
        head = np.concatenate([[0], np.cumsum(_DIGIT[words.piece.data])])
        led = (digits > 0) & ~number & (head[start + digits] - head[start] == digits)
        suffix = w.span_hashes(w._BYTE_VALUES[words.piece.data], start + digits, end)
        both = led & _among(suffix, _UNIT_HASHES)
        follows = np.zeros(len(words), bool)
        follows[1:] = number[:-1] & (words.row[1:] == words.row[:-1])
        unit = follows & _among(self.plain, _UNIT_HASHES)
        # A name starts with a capital inside a sentence and goes on in small letters.
        first = where[start]
        raw = piece.data[first]
        second = piece.data[np.minimum(first + 1, len(piece.data) - 1)]
        capital = _CAPITAL[raw] | ((raw == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        small = np.concatenate([[0], np.cumsum(_SMALL[piece.data])])
        last = where[end - 1]
        capital &= small[last + 1] > small[first]
        enders = np.concatenate([[0], np.cumsum(_ENDS[piece.data])])
        inside = np.zeros(len(words), bool)
        inside[1:] = (words.row[1:] == words.row[:-1]) & (enders[first[1:]] == enders[last[:-1] + 1])
        name = capital & inside & ~number & ~both & ~unit
        self.slot = number | both | unit | name
        self.hashes = np.select([number, both, unit, name], [_NUMBER, _BOTH, _UNIT, _NAME], self.plain)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, hashes and numbers of slots of the windows of a size within one row, and which have enough literal words.

        Each window stands for its plain words, without slots, and again for its template if it has slots and enough
        literal words.
        """
        row = self.words.row
        if len(row) < size:
            none = np.zeros(0, np.int64)
            return none, np.zeros(0, np.uint64), none, np.zeros(0, bool)
        slots = np.concatenate([[0], np.cumsum(self.slot)])
        n = slots[size:] - slots[:-size]
        literal = size - n >= min(size, LEAST_LITERAL)
        inside = row[: len(row) - size + 1] == row[size - 1 :]
        plain, filled = np.flatnonzero(inside), np.flatnonzero(inside & literal & (n > 0))
        at = np.concatenate([plain, filled])
        hashes = np.concatenate([w.grams(self.plain, size)[plain], w.grams(self.hashes, size)[filled]])
        return at, hashes, np.concatenate([np.zeros(len(plain), np.int64), n[filled]]), literal[at]


def _columns(ids: pa.Array, piece: w.Piece, own: Template, at: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """A row per window, with the plain hashes of its slots."""
    row = own.words.row[at]
    before = np.concatenate([[0], np.cumsum(own.slot)])[at]
    values = own.plain[own.slot]
    index = np.repeat(before - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(at) else np.zeros(0, np.int64)
    return [
        ids.slice(piece.lo, piece.rows).take(pa.array(row)),
        w.longs(w.as_long(hashes)),
        w.longs(at - own.words.first[row]),
        w.lists(w.longs(w.as_long(values[index])), n),
    ]


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of benchmark items; an item shorter than a window is one window of its own length."""
    for batch in batches:
        for piece in w.pieces(batch.column(1)):
            own = Template(piece)
            counts = own.words.counts
            parts = []
            for size in range(LEAST_WORDS, WINDOW + 1):
                windows = own.windows(size)
                chosen = (counts[own.words.row[windows[0]]] == size) | (size == WINDOW)
                parts.append((*(x[chosen] for x in windows), np.full(chosen.sum(), size)))
            at, hashes, n, literal, size = (np.concatenate(x) for x in zip(*parts, strict=True))
            row = own.words.row[at]
            windows = np.bincount(row[n == 0], minlength=piece.rows)
            templates = np.bincount(row[(n == 0) & literal], minlength=piece.rows)
            yield pa.RecordBatch.from_arrays(
                [*_columns(batch.column(0), piece, own, at, hashes, n), pa.array(literal), w.longs(windows[row]), w.longs(templates[row]), w.longs(size)],
                names=["id", "hash", "at", "slots", "literal", "windows", "templates", "size"],
            )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(doc_id, item_id, covered, exchanged)``: items found in documents, the share of their windows found, and
    whether slot values differ from the item's.

    The share is of all windows, or of those with at least five literal words if that is more. Words are compared in
    lower case, letter by letter; an item whose slots were exchanged is found only where names keep their capitals, and
    by its windows with at least five literal words.

    Null and empty texts hold nothing; items of fewer than five words are not sought. Rows without an id are not
    reported. Rows that repeat an id count as one document. An empty benchmark or table gives no rows.
    """
    items = saved(texts_of(benchmark, item_col, item_text_col).dropna().mapInArrow(_item_rows, SCHEMA), "template-items")
    # Numbers from 1 on: Spark's bitmaps then hold number n as bit n - 1 of all buckets in order.
    bit = F.pmod("hash", F.lit(1 << FILTER_BITS)) + 1
    sets = items.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    packed = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in sets:
        lo = (row["k"] - 1) * 4096
        packed[lo : lo + 4096] = np.frombuffer(row["bits"], np.uint8)
    bytes_of_filter = packed.tobytes()
    sizes = sorted(row["size"] for row in items.select("size").distinct().collect()) or [WINDOW]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bytes_of_filter, np.uint8)
        for batch in batches:
            for piece in w.pieces(batch.column(1)):
                own = Template(piece)
                parts = []
                for size in sizes:
                    at, hashes, n, _ = own.windows(size)
                    number = w.as_long(hashes) % (1 << FILTER_BITS)
                    hit = (table[number >> 3] >> (number & 7).astype(np.uint8)) & 1 == 1
                    parts.append((at[hit], hashes[hit], n[hit]))
                at, hashes, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                # Plain words that a document repeats count once.
                row = own.words.row[at]
                order = np.lexsort((hashes, row))
                new = np.ones(len(at), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
                once = order[new | (n[order] > 0)]
                at, hashes, n = at[once], hashes[once], n[once]
                yield pa.RecordBatch.from_arrays(_columns(batch.column(0), piece, own, at, hashes, n), names=["id", "hash", "at", "slots"])

    places = texts_of(docs, id_col, text_col).dropna().mapInArrow(found, FOUND).withColumnRenamed("id", "doc_id")
    item = items.select(
        F.col("id").alias("item_id"), "hash", F.col("at").alias("item_at"), "literal", "windows", "templates", F.col("slots").alias("item_slots")
    )
    met = places.join(item, "hash").filter(F.size("slots") == F.size("item_slots"))
    # Windows of equal values meet as plain words, without slots and whatever their diagonal.
    met = met.filter((F.size("slots") == 0) | (F.col("slots") != F.col("item_slots")))
    diagonal = F.when(F.size("slots") > 0, F.col("at") - F.col("item_at"))
    pairs = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    lines = met.groupBy("doc_id", "item_id", "windows", "templates", diagonal.alias("diagonal")).agg(
        F.collect_set(F.struct("item_at", "literal")).alias("places"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    one = lambda side: F.size(F.array_distinct(F.col("pairs").getField(side)))
    consistent = lines.filter((one("item") == F.size("pairs")) & (one("doc") == F.size("pairs")))
    out = consistent.groupBy("doc_id", "item_id", "windows", "templates").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.max(F.exists("pairs", lambda x: x["item"] != x["doc"])).alias("exchanged"),
    )
    out = out.withColumn("n", F.size("places")).withColumn("n_templates", F.size(F.filter("places", lambda x: x["literal"])))
    enough = lambda n, of: (F.col(n) > 0) & (F.col(n) >= F.least(F.lit(COVERED) * F.col(of), F.lit(PASSAGE_WINDOWS)))
    share = lambda n, of: F.col(n) / F.nullif(F.col(of), F.lit(0))
    return out.filter(enough("n", "windows") | enough("n_templates", "templates")).select(
        "doc_id", "item_id", F.greatest(share("n", "windows"), share("n_templates", "templates")).alias("covered"), "exchanged"
    )
