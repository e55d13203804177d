"""Language by compression: the language whose dictionary packs a text smallest.

For each language a bounded sample of labelled texts becomes a zstandard raw-content dictionary. A text is reduced to
lower-case letters and spaces and packed, block by block, with each dictionary; blocks are short, so that the
dictionary and not the text's own beginning decides. The whole text counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.store import texts_of

# Learning is bounded per language: so many texts, so many characters of each, so many bytes in the end. A longer text
# gives so many blocks, spread evenly from its beginning to its end.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 4000, 112 * 1024
SAMPLE_BLOCKS = 4
BLOCK_CHARS = 4000
LEVEL = 6
# A text is accepted if the next best dictionary needs so much more.
MARGIN = 0.02
NONE = "und"

# Of each language so many times the texts needed are left to be put in order.
SAMPLE_ROOM = 4
_RANGE = 1 << 30
_LETTER, _OTHER = regex.compile(r"\p{L}"), regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> str:
    """Lower-case letters with their marks (accents, vowel signs); every run of other characters is one space."""
    found = _OTHER.sub(" ", text.lower()).strip()
    return found if _LETTER.search(found) else ""


def held_out(id_col: Column) -> Column:
    """Whether the remainder of the id's checksum is 1; a null id counts as empty."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def excerpt(text: Column) -> Column:
    """A text of at most ``SAMPLE_CHARS`` characters, else ``SAMPLE_BLOCKS`` blocks of it, as many characters in all."""
    size = SAMPLE_CHARS // SAMPLE_BLOCKS
    last = (F.length(text) - size).cast("bigint")
    start = [(F.floor(last * k / (SAMPLE_BLOCKS - 1)) + 1).cast("int") for k in range(SAMPLE_BLOCKS)]
    return F.when(F.length(text) <= SAMPLE_CHARS, text).otherwise(F.concat_ws(" ", *(text.substr(at, F.lit(size)) for at in start)))


def dictionaries(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, bytes]:
    """Dictionary bytes by language, the most frequent first, from rows chosen by the hash of their text.

    Different texts of any length are chosen, the same ones however rows are dealt out; a long one teaches by its excerpt. Null labels and texts teach nothing.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("lang IS NOT NULL AND length(text) > 0")
    hashed = rows.select("lang", F.xxhash64("text").alias("hash"), excerpt(F.col("text")).alias("text"))
    counted = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("hash").alias("texts")).collect()
    frequent = {row["lang"]: row["rows"] for row in counted}
    if not frequent:
        return {}
    # Hashes below a cut that leaves about enough different texts of each language, so that few reach the ordering.
    cuts = {row["lang"]: int(min(1.0, SAMPLE_ROOM * SAMPLE_TEXTS / max(row["texts"], 1)) * _RANGE) for row in counted}
    cut = F.element_at(F.create_map(*(F.lit(x) for pair in cuts.items() for x in pair)), F.col("lang"))
    few = hashed.filter(F.pmod("hash", F.lit(_RANGE)) < cut).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("hash")
    sample = few.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE_TEXTS).orderBy("lang", "k").collect()
    parts: dict[str, list[str]] = {}
    for row in sample:
        parts.setdefault(row["lang"], []).append(letters(row["text"]))
    out = {lang: " ".join(dict.fromkeys(x for x in texts if x)).encode()[:DICTIONARY_BYTES] for lang, texts in parts.items()}
    return {lang: content for lang, content in sorted(out.items(), key=lambda x: (-frequent[x[0]], x[0])) if content}


@lru_cache(maxsize=4)
def _packers(contents: tuple[tuple[str, bytes], ...]) -> list[Callable[[bytes], bytes]]:
    out = []
    for _, content in contents:
        kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kind.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=kind, write_content_size=False, write_dict_id=False).compress)
    return out


def classify(text: str | None, contents: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """The language, and by how much its size undercuts the next one's (0 to 1)."""
    plain = letters(text or "")
    if not contents or not any(map(str.isalpha, plain)):
        return NONE, 0.0
    blocks = [plain[i : i + BLOCK_CHARS].encode() for i in range(0, len(plain), BLOCK_CHARS)]
    sizes = [sum(len(pack(block)) for block in blocks) for pack in _packers(contents)]
    best, *rest = sorted(sizes)
    return contents[sizes.index(best)][0], 1 - best / rest[0] if rest else 1.0


def languages(docs: DataFrame, learned: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, accepted)`` per document; a narrow margin is not accepted.

    Null texts, texts without a letter, and all texts where nothing was learned are ``und`` with score 0. Equal sizes
    go to the language with more labelled texts. Repeated rows are judged each; other columns are ignored.
    """
    contents = tuple(learned.items())

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                names, scores = zip(*(classify(text.as_py(), contents) for text in part.column(1)), strict=True)
                accepted = [score >= MARGIN for score in scores]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                    names=["doc_id", "lang_pred", "score", "accepted"],
                )

    return texts_of(docs, id_col, text_col).mapInArrow(predicted, "doc_id bigint, lang_pred string, score double, accepted boolean")
