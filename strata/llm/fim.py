"""Fill-in-middle: each text is cut in three pieces, which are put in another order with marks between them.

All of it is a pipeline of Arrow kernels over some rows at a time. Texts are split into lists of units; the lists are
flattened, each unit with its row; a unit's ordinal is its place less that of its row's first unit; ordinals against
the two cuts of the row give its role; the units of each role are filtered out, rebuilt as one list per row and joined.
The cuts and the form come from a keyed digest of the id, so they do not depend on how rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.store import texts_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Of 100 texts about so many are cut, and of 100 that are cut so many have the suffix first.
CUT_OF_100, SPM_OF_100 = 90, 20
# Rows are taken together up to this size; a longer text is taken alone and whole.
SLICE_BYTES = 1 << 20

# Over UTF-8 bytes: a run of letters, another ASCII byte, or one character of several bytes.
_UNIT = rb"([A-Za-z]+|[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
# A byte that UTF-8 never uses, set behind each unit.
_END = b"\xff"
RESULT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def numbers(id_col: str, seed: str) -> list[Column]:
    """Four numbers below 2^32 from the digest of ``seed:id``; an id that is null counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def _below(value: pa.Array, size: pa.Array | int) -> pa.Array:
    """Remainder; Arrow has no such kernel."""
    return pc.subtract(value, pc.multiply(pc.divide(value, size), size))


def _counted(counts: pa.Array) -> pa.Array:
    """Offsets of lists of the given lengths."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)])


def split(text: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """All units in order, the row of each, and how many each row has."""
    units = pc.split_pattern(pc.replace_substring_regex(text, pattern=_UNIT, replacement=rb"\1" + _END), pattern=_END)
    flat, row = pc.list_flatten(units), pc.list_parent_indices(units)
    # Behind the last mark stands one empty part per row, and no unit is empty.
    real = pc.greater(pc.binary_length(flat), 0)
    count = pc.subtract(pc.cast(pc.list_value_length(units), pa.int64()), 1)
    return flat.filter(real), row.filter(real), count


def cut(text: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Units of each row, and its prefix, middle and suffix."""
    flat, row, count = split(text)
    room = pc.add(count, 1)
    one, two = _below(h1, room), _below(h2, room)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    place = pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), len(flat))), 1)
    ordinal = pc.subtract(place, pc.take(_counted(count), row))
    after_low = pc.greater_equal(ordinal, pc.take(low, row))
    after_high = pc.greater_equal(ordinal, pc.take(high, row))
    roles = (
        (pc.invert(after_low), low),
        (pc.and_not(after_low, after_high), pc.subtract(high, low)),
        (after_high, pc.subtract(count, high)),
    )
    lists = [pa.LargeListArray.from_arrays(_counted(size), flat.filter(chosen)) for chosen, size in roles]
    return count, [pc.binary_join(of_role, pa.scalar(b"", pa.large_binary())) for of_role in lists]


def rearranged(text: pa.Array, h: list[pa.Array], cut_of_100: int, spm_of_100: int) -> list[pa.Array]:
    """The result columns behind the id for some whole texts (bytes, no nulls)."""
    count, (prefix, middle, suffix) = cut(text, h[0], h[1])
    marked = pc.or_(pc.or_(*(pc.match_substring(text, pattern=mark) for mark in (PREFIX, SUFFIX))), pc.match_substring(text, pattern=MIDDLE))
    plain = pc.or_(pc.or_(pc.equal(count, 0), marked), pc.greater_equal(_below(h[2], 100), cut_of_100))
    spm = pc.less(_below(h[3], 100), spm_of_100)
    mark = {m: pa.scalar(m, pa.large_binary()) for m in (PREFIX, SUFFIX, MIDDLE)}
    empty = pa.scalar(b"", pa.large_binary())
    as_psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, empty)
    as_spm = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, empty)
    output = pc.if_else(plain, text, pc.if_else(spm, as_spm, as_psm))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    chars = [
        pc.if_else(plain, none, pc.cast(pc.utf8_length(piece.cast(pa.large_string())), pa.int64())) for piece in (prefix, middle)
    ]
    return [count, form, *chars, output.cast(pa.large_string()).cast(pa.string())]


def _slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of each slice."""
    ends = pc.cumulative_sum(pc.cast(pc.binary_length(text), pa.int64())).to_numpy()
    lo, done = 0, 0
    while lo < len(ends):
        hi = max(lo + 1, int(ends.searchsorted(done + SLICE_BYTES, side="right")))
        yield lo, hi - lo
        lo, done = hi, int(ends[hi - 1])


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    cut_of_100: int = CUT_OF_100,
    spm_of_100: int = SPM_OF_100,
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for every row: units, form, code points, new text.

    A unit is a run of ASCII letters or one other character. The prefix ends behind one of the ``n + 1`` cuts between
    units and the middle behind another, both drawn from the id. ``psm`` puts the suffix before the middle, ``spm``
    before the prefix; ``plain`` leaves the text as it is. Null and empty texts, and texts that hold a mark, are plain,
    so :func:`restored` gives back every text. Rows that repeat an id have the same draws; rows without an id draw as
    for an empty one. Texts are taken whole, whatever their length. Other columns are ignored; an empty table gives no
    rows. One pass, no shuffle.
    """
    rows = texts_of(docs, id_col, text_col).select("doc_id", "text", *numbers("doc_id", seed))

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
            for lo, size in _slices(text):
                own = batch.slice(lo, size)
                columns = rearranged(text.slice(lo, size), own.columns[2:], cut_of_100, spm_of_100)
                names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), *columns], names=names)

    return rows.mapInArrow(change, RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text before the cut; marks stand only where :func:`fill_in_middle` set them."""
    pieces = F.split(output, "<[PSM]>", -1)
    at = {name: F.get(pieces, F.lit(k)) for name, k in (("one", 1), ("two", 2), ("middle", 3))}
    psm = F.concat(at["one"], at["middle"], at["two"])
    spm = F.concat(at["two"], at["middle"], at["one"])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
