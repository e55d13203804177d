from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import words as w

from . import brute

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t*", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_match_the_pattern(texts):
    got = []
    for piece in w.pieces(pa.array(texts, pa.string())):
        words = piece.words()
        own = [bytes(piece.data[a:b]).decode() for a, b in zip(words.start, words.end, strict=True)]
        got += [own[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    assert got == [brute.words(text) for text in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    seen: dict = {}
    for piece in w.pieces(pa.array(texts, pa.string())):
        words = piece.words()
        for a, b, value in zip(words.start, words.end, words.hashes().tolist(), strict=True):
            assert seen.setdefault(bytes(piece.data[a:b]), value) == value
    assert len(set(seen.values())) == len(seen)


def test_pieces_never_cut_a_row(monkeypatch):
    monkeypatch.setattr(w, "PIECE_BYTES", 10)
    texts = ["x" * 25, "a b", None, "", "c d e f", "y" * 11]
    parts = list(w.pieces(pa.array(texts)))
    assert sum(p.rows for p in parts) == len(texts)
    assert [p.lo for p in parts] == list(np.cumsum([0, *(p.rows for p in parts)])[:-1])
    assert b"".join(p.data.tobytes() for p in parts).decode() == "".join(t or "" for t in texts)
    sliced = pa.array(texts).slice(2, 3)
    assert b"".join(p.data.tobytes() for p in w.pieces(sliced)).decode() == "c d e f"


def test_grams_depend_on_order_and_content_only():
    one = w.grams(np.array([1, 2, 3, 1, 2, 3, 2], np.uint64), 3)
    assert one[0] == one[3] and len(set(one.tolist())) == 4
    assert len(w.grams(np.array([1], np.uint64), 3)) == 0
