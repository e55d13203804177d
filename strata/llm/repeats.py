"""Repeated passages: words covered by a window that an earlier document also holds.

Each word becomes one letter (a few bits of its hash), so a document is a string with one letter per word and phrases
are found in it by Aho-Corasick automata.

1. *Phrases.* Of the ``SEED``-word phrases in each window the one with the smallest hash is picked, so documents that
   share a window pick the same phrase in it. Phrases picked in two documents or more recur.
2. *Confirmation.* A picked phrase comes with the hash of its context, the widest span that a window with the phrase
   can reach. Where an earlier document has the same phrase in the same context, the whole context is a recurring
   passage. Two different contexts of a phrase share a window only if they agree on the ``SIDE`` words before the
   phrase or on those behind it. Contexts that so agree with another one are open: the first document of each shows
   its single windows.
3. *Location.* Documents are dealt out by id, together with the recurring phrases they hold. Each part compiles the
   phrases of its own documents into an automaton and streams the documents past it. So each automaton is bounded by
   its part of the text, parts are as many as the stored bytes call for, and a phrase that a third of all documents
   share is one entry in each.
4. Windows shown in step 2 are counted by 128-bit hash over all documents, and those with an earlier document are
   removed as well, from the words that step 3 left of the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as w
from strata.llm.store import parts_for, saved, texts_of

WINDOW = 50
SEED = 12
REACH = WINDOW - SEED
# Of a shared window with the phrase in it, as many words or more stand on one side of the phrase.
SIDE = REACH // 2
# A phrase of SEED letters fits into one bigint.
LETTER_BITS = 5

PICKED = "doc_id bigint, phrase bigint, context bigint, sides bigint"
_SPANS = "array<struct<start:bigint,end:bigint>>"
LOCATED = (
    f"row bigint, doc_id bigint, n_words bigint, spans {_SPANS}, kept string, windows array<struct<a:bigint,b:bigint,start:bigint>>"
)
_SECOND = np.uint64(0xA0761D6478BD642F)


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over each run of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def letters(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - LETTER_BITS)).astype(np.uint16) + 1


def phrases(letter: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The letters of the phrases that start at the given words, packed into one bigint each."""
    packed = np.zeros(len(at), np.int64)
    for k in range(SEED):
        packed = (packed << LETTER_BITS) | (letter[at + k].astype(np.int64) - 1)
    return packed


def spelled(phrase: int) -> str:
    """The phrase as a string of letters again."""
    mask = (1 << LETTER_BITS) - 1
    return "".join(chr(1 + ((phrase >> (LETTER_BITS * (SEED - 1 - k))) & mask)) for k in range(SEED))


def _windows(words: w.Words) -> np.ndarray:
    """Which words start a window within their row."""
    if len(words) < WINDOW:
        return np.zeros(0, bool)
    return words.row[: len(words) - WINDOW + 1] == words.row[WINDOW - 1 :]


def picks(words: w.Words, hashes: np.ndarray) -> np.ndarray:
    """Where the picked phrases of all windows start."""
    inside = _windows(words)
    if not inside.any():
        return np.zeros(0, np.int64)
    order = w.grams(hashes, SEED) | np.uint64(1)
    least = np.where(inside, _slide(order, REACH + 1, np.minimum), np.uint64(0))
    pad = np.zeros(REACH, np.uint64)
    return np.flatnonzero(_slide(np.concatenate([pad, least, pad]), REACH + 1, np.maximum) == order)


def contexts(words: w.Words, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the span that windows with the phrase at each given word can reach."""
    row = words.row[at]
    start = np.maximum(at - REACH, words.first[row])
    end = np.minimum(at + WINDOW, words.first[row + 1])
    return start, end, w.as_long(w.mix(w.span_hashes(hashes, start, end) ^ (at - start).astype(np.uint64)))


def sides(words: w.Words, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 32-bit hashes in one bigint: the ``SIDE`` words before each phrase, and those behind it; 0 where there are fewer."""
    row, packed = words.row[at], np.zeros(len(at), np.uint64)
    for lo, there in ((at - SIDE, at - SIDE >= words.first[row]), (at + SEED, at + SEED + SIDE <= words.first[row + 1])):
        start = np.where(there, lo, 0)
        own = (w.span_hashes(hashes, start, start + np.where(there, SIDE, 0)) >> np.uint64(32)) | np.uint64(1)
        packed = (packed << np.uint64(32)) | np.where(there, own, np.uint64(0))
    return w.as_long(packed)


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in w.pieces(batch.column(1)):
            words = piece.words()
            hashes = words.hashes()
            at = picks(words, hashes)
            row, (_, _, context) = words.row[at], contexts(words, hashes, at)
            order = np.lexsort((context, row))
            new = np.ones(len(at), bool)
            new[1:] = (context[order][1:] != context[order][:-1]) | (row[order][1:] != row[order][:-1])
            once = order[new]
            ids = batch.column(0).slice(piece.lo, piece.rows).take(pa.array(row[once]))
            values = (phrases(letters(hashes), at[once]), context[once], sides(words, hashes, at[once]))
            yield pa.RecordBatch.from_arrays([ids, *map(w.longs, values)], names=["doc_id", "phrase", "context", "sides"])


def _open(found: DataFrame) -> DataFrame:
    """``(phrase, context)`` of the contexts that agree with another one of the phrase on a side."""
    side = F.explode(F.array(F.shiftrightunsigned("sides", 32), F.expr("-(sides & 4294967295)")))
    halves = found.filter("several").select("phrase", "context", side.alias("side")).filter("side <> 0").distinct()
    agreed = halves.groupBy("phrase", "side").agg(F.min("context").alias("c"), F.max("context").alias("d")).filter("c < d")
    return halves.join(agreed.select("phrase", "side"), ["phrase", "side"], "left_semi").select("phrase", "context").distinct()


def recurring(docs: DataFrame) -> DataFrame:
    """``(doc_id, phrase, context, first, open)`` for the picked phrases of two documents or more."""
    picked = saved(docs.filter("doc_id IS NOT NULL").mapInArrow(_picked, PICKED), "repeats-picked")
    shared = (
        picked.groupBy("phrase")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("context").alias("c"), F.max("context").alias("d"))
        .filter("low < high")
        .select("phrase", (F.col("c") < F.col("d")).alias("several"))
    )
    found = saved(picked.join(shared.hint("merge"), "phrase"), "repeats-shared")
    first = found.groupBy("phrase", "context").agg(F.min("doc_id").alias("first"))
    opened = _open(found).withColumn("open", F.lit(True)).hint("merge")
    contexts = first.join(opened, ["phrase", "context"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    return found.select("doc_id", "phrase", "context").join(contexts.hint("merge"), ["phrase", "context"])


class _Part:
    """The recurring phrases of one part of the documents, as an automaton, and what is known of their contexts."""

    def __init__(self, batches: list[pa.RecordBatch]):
        get = lambda name: np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in batches])
        self.automaton = ahocorasick.Automaton()
        if batches:
            for phrase in np.unique(get("phrase")).tolist():
                self.automaton.add_word(spelled(phrase), True)
            self.automaton.make_automaton()
            self.context, at = np.unique(get("context"), return_index=True)
            self.first, self.open = get("first")[at], get("open")[at].astype(bool)

    def locate(self, letter: np.ndarray, words: w.Words) -> np.ndarray:
        """Words at which a phrase starts."""
        if not len(self.automaton):
            return np.zeros(0, np.int64)
        string = letter.tobytes().decode("utf-16-le")
        found = []
        for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if hi - lo >= WINDOW:
                found += [end + 1 - SEED for end, _ in self.automaton.iter(string, lo, hi)]
        return np.array(found, np.int64)


def _merged(start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """A mask of the words in any of the spans."""
    cover = np.zeros(size + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, end, -1)
    return np.cumsum(cover)[:size] > 0


def _spans(gone: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


def _joined(raw: bytes, gone: np.ndarray) -> str:
    own = raw.split()
    if gone.any():
        own = [word for word, out in zip(own, gone.tolist(), strict=True) if not out]
    return b" ".join(own).decode()


def _located_rows(part: _Part, batch: pa.RecordBatch) -> Iterator[dict]:
    ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
    for piece in w.pieces(batch.column("text")):
        words = piece.words()
        hashes = words.hashes()
        at = part.locate(letters(hashes), words)
        gone, shown = np.zeros(len(words), bool), np.zeros(0, np.int64)
        if len(at):
            start, end, context = contexts(words, hashes, at)
            k = np.minimum(np.searchsorted(part.context, context), len(part.context) - 1)
            known = part.context[k] == context
            own = np.array([np.iinfo(np.int64).min if i is None else i for i in ids[piece.lo : piece.lo + piece.rows]])[words.row[at]]
            later = known & (part.first[k] < own)
            gone = _merged(start[later], end[later], len(words))
            show = known & (part.first[k] == own) & part.open[k]
            shown = np.flatnonzero(_merged(start[show], end[show] - (WINDOW - 1), len(words)))
        a = w.as_long(w.span_hashes(hashes, shown, shown + WINDOW))
        b = w.as_long(w.span_hashes(w.mix(hashes ^ _SECOND), shown, shown + WINDOW))
        cut = np.searchsorted(shown, words.first).tolist()
        for r in range(piece.rows):
            lo, hi = int(words.first[r]), int(words.first[r + 1])
            raw = piece.data[piece.bounds[r] : piece.bounds[r + 1]].tobytes()
            yield {
                "row": rows[piece.lo + r],
                "doc_id": ids[piece.lo + r],
                "n_words": hi - lo,
                "spans": _spans(gone[lo:hi]),
                "kept": _joined(raw, gone[lo:hi]),
                "windows": [
                    {"a": int(a[i]), "b": int(b[i]), "start": int(shown[i]) - lo} for i in range(cut[r], cut[r + 1])
                ] or None,
            }


_WINDOW_TYPE = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int64())])
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_LOCATED_TYPE = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", _SPAN_TYPE), ("kept", pa.string()),
     ("windows", pa.list_(_WINDOW_TYPE))]
)
_ROWS = 1000


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrase rows come first, then the documents that hold them."""
    waiting: list[pa.RecordBatch] = []
    part = None
    for batch in batches:
        is_text = batch.column("is_text").to_numpy(zero_copy_only=False).astype(bool)
        if part is None and not is_text.all():
            waiting.append(batch.filter(pa.array(~is_text)))
        if not is_text.any():
            continue
        part = part or _Part(waiting)
        rows = batch.filter(pa.array(is_text))
        for lo in range(0, rows.num_rows, _ROWS):
            yield pa.RecordBatch.from_pylist(list(_located_rows(part, rows.slice(lo, _ROWS))), schema=_LOCATED_TYPE)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take the windows found elsewhere out of what is left of each document."""
    schema = pa.schema([_LOCATED_TYPE.field(i) for i in range(1, 5)])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            start = np.array([s["start"] for s in row["spans"]], np.int64)
            end = np.array([s["end"] for s in row["spans"]], np.int64)
            more = np.array(row["starts"] or [], np.int64)
            left = ~_merged(start, end, row["n_words"])
            gone = _merged(np.append(start, more), np.append(end, more + WINDOW), row["n_words"])
            kept = _joined(row["kept"].encode(), gone[left])
            out.append({"doc_id": row["doc_id"], "n_words": row["n_words"], "spans": _spans(gone), "kept": kept})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, spans, kept)``: word spans to remove, and the other words joined by one space.

    A word is removed if a window of 50 consecutive words over it also starts in a document with a smaller id; windows
    are judged on the input. Null and empty texts have no words. Rows that repeat an id do not remove each other; rows
    without an id neither remove nor lose words. Other columns are ignored; an empty table gives no rows.
    """
    docs = texts_of(docs, id_col, text_col)
    known = recurring(docs)
    # Rows that share an id and a text have one number and one result.
    texts = docs.select(
        F.coalesce("doc_id", F.xxhash64("text")).alias("key"), F.lit(True).alias("is_text"), F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text"
    )
    phrases_ = known.select(F.col("doc_id").alias("key"), F.lit(False).alias("is_text"), *known.columns)
    rows = phrases_.unionByName(texts, allowMissingColumns=True)
    dealt = rows.repartition(parts_for(docs), "key").sortWithinPartitions("is_text").drop("key")
    located = saved(dealt.mapInArrow(_located, LOCATED), "repeats-located")
    result = ["doc_id", "n_words", "spans", "kept"]
    shown = located.filter("windows IS NOT NULL").select("row", "doc_id", F.inline("windows"))
    first = shown.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    again = shown.join(first.hint("merge"), ["a", "b"]).filter("doc_id > first").groupBy("row").agg(F.collect_set("start").alias("starts"))
    # Texts meet the windows only where a row shows some.
    pending = located.filter("windows IS NOT NULL").select("row", *result).join(again.hint("merge"), "row", "left")
    done = pending.mapInArrow(_finished, f"doc_id bigint, n_words bigint, spans {_SPANS}, kept string")
    return located.filter("windows IS NULL").select(result).unionByName(done)
