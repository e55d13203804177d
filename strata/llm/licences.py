"""Licence scans: an Aho-Corasick automaton finds tags and notice phrases, a shunting-yard parser reads expressions.

Texts are reduced to words (ASCII letters lower-cased, digits and all non-ASCII characters count as letters) joined by
one space, so a phrase is found wherever its words stand consecutively, whatever stands between them. The text behind
a licence tag is read as an expression of licence names joined by AND, OR and WITH.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import words as w
from strata.llm.store import texts_of

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases and their labels.
NOTICES = {
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "apache license 2 0": "apache-2",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
# Tag names that have a label of their own here; others keep their name in lower case.
TAG_LABELS = {
    "mit": "mit",
    "apache-2.0": "apache-2",
    "cc-by-nc-4.0": "cc-by-nc",
    "gpl-3.0": "gpl-3",
    "gpl-3.0-only": "gpl-3",
    "gpl-3.0-or-later": "gpl-3",
    "gpl-2.0": "gpl-2",
    "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2",
}
# What a reader must grant in turn: 0 nothing but notices, 1 changed files, 2 whole works, 3 unknown or restricted.
DUTIES = {
    0: ("mit", "apache-2", "bsd", "isc", "unlicense", "cc0", "zlib", "0bsd", "cc-by"),
    1: ("lgpl", "mpl", "epl"),
    2: ("gpl", "agpl", "cc-by-sa"),
}
# How sure one place of each kind is.
TAG_WEIGHT, BASE_WEIGHT, NOTICE_WEIGHT = 0.95, 0.9, 0.8

_EXPRESSION = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+|\S")
_RANK = {"OR": 1, "AND": 2, "WITH": 3}
_TABLE = np.full(256, 32, np.uint8)
_TABLE[48:58], _TABLE[97:123], _TABLE[65:91] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)

RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, expressions array<string>, duty int"
)


def _name(found: bytes) -> str:
    return found.decode("latin-1")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """All phrases as padded words; each holds its kind, its label and its length."""
    out = ahocorasick.Automaton()
    kinds: dict[str, list[tuple[str, str]]] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            kinds.setdefault(f" {_name(phrase.encode())} ", []).append((kind, label))
    for key, meanings in kinds.items():
        out.add_word(key, (len(key), meanings))
    out.make_automaton()
    return out


def duty_of(label: str) -> int:
    for duty, names in DUTIES.items():
        if any(label == name or label.startswith(f"{name}-") for name in names) and not label.startswith("cc-by-n"):
            if not (duty == 0 and label.startswith("cc-by-sa")):
                return duty
    return 3


def postfix(expression: str) -> list[str]:
    """The tokens of a licence expression, operators after what they join; ValueError if it is malformed."""
    out: list[str] = []
    waiting: list[str] = []
    operand = True
    for token in _TOKEN.findall(expression):
        upper = token.upper()
        if token == "(":
            if not operand:
                raise ValueError("a name stands before (")
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if operand or not waiting:
                raise ValueError("unmatched )")
            waiting.pop()
        elif upper in _RANK:
            if operand:
                raise ValueError(f"nothing stands before {upper}")
            while waiting and _RANK.get(waiting[-1], 0) >= _RANK[upper]:
                out.append(waiting.pop())
            waiting.append(upper)
            operand = True
        elif operand and re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.+:-]*", token):
            out.append(token)
            operand = False
        else:
            raise ValueError(f"unexpected {token}")
    while waiting:
        if waiting[-1] == "(":
            raise ValueError("unmatched (")
        out.append(waiting.pop())
    if operand:
        raise ValueError("it ends too early")
    return out


def evaluate(expression: str) -> tuple[set[str], int]:
    """Labels named by an expression, and the duty it leaves: OR lets the reader choose, AND binds to both.

    An exception (WITH) eases a duty on whole works to one on changed files; its own name is no licence.
    """
    stack: list[tuple[set[str], int]] = []
    for token in postfix(expression):
        if token not in _RANK:
            label = TAG_LABELS.get(token.lower().rstrip("+"), token.lower().rstrip("+"))
            stack.append(({label}, duty_of(label)))
            continue
        (names, duty), (left, other) = stack.pop(), stack.pop()
        if token == "WITH":
            stack.append((left, 1 if other == 2 else other))
        else:
            stack.append((left | names, min(duty, other) if token == "OR" else max(duty, other)))
    return stack.pop()


def _expressions(text: str) -> list[str]:
    """What stands behind each tag, without comment ends."""
    return [re.sub(r"\s*(\*/|-->|\*\)|#}|\"\"\"|''').*$", "", found).strip() for found in _EXPRESSION.findall(text)]


def scan(text: bytes, raw: str) -> tuple:
    """The result columns for one text, given with its bytes already reduced to words and spaces."""
    own = text.split()
    joined = f" {_name(b' '.join(own))} "
    places, base, labels, tagged, doubt, duties = [], set(), set(), False, 1.0, []
    starts: list[int] = []
    for end, (length, meanings) in automaton().iter(joined):
        for kind, label in meanings:
            if kind == "tag":
                tagged = True
                continue
            labels.add(label)
            if kind == "base":
                base.add(label)
                # Where each word starts, looked up by halving: one pass however many places there are.
                starts = starts or [gap.end() for gap in re.finditer(" ", joined)]
                places.append(bisect_right(starts, end - length + 2) - 1)
            doubt *= 1 - (BASE_WEIGHT if kind == "base" else NOTICE_WEIGHT)
    spelled = []
    for expression in _expressions(raw) if tagged else []:
        try:
            names, duty = evaluate(expression)
        except ValueError:
            continue
        spelled.append(expression)
        duties.append(duty)
        labels |= names
        doubt *= 1 - TAG_WEIGHT
    # Phrases are notices that all bind; a tag's expression says itself how its parts combine.
    duties += [duty_of(label) for label in (base if tagged else labels)]
    return (
        len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(labels)), 1 - doubt, spelled, max(duties, default=None),
    )


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")),
         ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
         ("expressions", pa.list_(pa.string())), ("duty", pa.int32())]
    )
    for batch in batches:
        for piece in w.pieces(batch.column(1)):
            reduced, raw = _TABLE[piece.data].tobytes(), piece.data.tobytes()
            bounds = piece.bounds.tolist()
            rows = [scan(reduced[a:b], raw[a:b].decode() if b"dentifier" in (x := raw[a:b]) or b"DENTIFIER" in x else "")
                    for a, b in zip(bounds, bounds[1:], strict=False)]
            columns = [pa.array(c, field.type) for c, field in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.lo, piece.rows), *columns], schema=schema)


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places, labels, certainty, parsed expressions and duty of every document.

    Null and empty texts have no words, places or labels (label columns are then empty strings, the duty is null).
    A malformed expression names no licence. Repeated rows are scanned each; other columns are ignored.
    """
    return texts_of(docs, id_col, text_col).mapInArrow(_scanned, RESULT)
