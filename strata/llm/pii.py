"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds select.

All in DataFrame functions. Base kinds are patterns with checks. Beside them, generators of high recall propose
overlapping spans, each described by a few small integers: its format and the words around it. The spans of all
documents are counted by these features, apart for training and calibration documents, together with how many of
them are right: those that touch a base span, and those that spell a value otherwise which is a base span elsewhere
in the documents (a phone number without its plus, a card number with dots). On this table, whose size the features
bound, gradient-boosted trees are fitted; they go back to Spark as conditional expressions. Only spans that touch no
base span can be selected, so those alone calibrate: per generator the lowest score is chosen above which enough of
them are right. Of the overlapping spans above it the one of the highest score is selected.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strata.llm.store import saved

# The base patterns. Runs are possessive and start where a run of their characters starts (or the last match ended),
# which finds the same leftmost matches in time linear in the text.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Generators: name and pattern. Recall is what counts here.
GENERATORS = {
    "maybe_mail": r"(?<![^\x20\x09-\x0D@<>\"])[^\x20\x09-\x0D@<>\"]++@[^\x20\x09-\x0D@<>\"]++",
    "maybe_number": r"[+(]?[0-9][0-9().\x20/-]{5,}[0-9]",
    "maybe_address": r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]++(?:[.:]++[0-9A-Fa-f]++){3,}+",
}
# Words that announce personal data.
HINTS = ("mail", "tel", "phone", "call", "fax", "mobile", "card", "visa", "ip", "address", "contact", "host")

# Features and the number of their levels.
FEATURES = {"digits": 7, "letters": 3, "dots": 5, "gaps": 4, "plus": 2, "brackets": 2, "length": 5, "hint": 2, "glued": 2}
TREES, DEPTH, RATE, LEAST_WEIGHT = 20, 3, 0.3, 2.0
# A threshold needs so many calibration spans above it, and that share of them right.
CALIBRATION_SPANS, PRECISION = 20, 0.95

_SPAN = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
# Characters of context.
BEFORE = 16


def matches(text: Column, pattern: str, worth: Column, check: Callable[[Column], Column] = F.isnotnull) -> Column:
    """The matches that pass the check, in order, none where ``worth`` is false; the others only move the position.

    Start and end (code points, end exclusive), text, and the characters around it up to the neighbouring matches.
    Every step copies the state, so the gaps between matches come with the hits and only what passes is collected.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    parts = F.arrays_zip(hits.alias("hit"), gaps.alias("gap"), F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))).alias("rest"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, part: Column) -> Column:
        hit, gap = part["hit"], part["gap"]
        start = acc["at"] + F.length(gap)
        end = start + F.length(hit)
        found = F.struct(
            start.alias("start"), end.alias("end"), hit.alias("hit"),
            F.substring(gap, -BEFORE, BEFORE).alias("before"), F.substring(part["rest"], 1, 1).alias("after"),
        )
        # The last part is the gap behind the last hit.
        kept = F.when(F.coalesce(check(hit), F.lit(False)), F.concat(acc["out"], F.array(found))).otherwise(acc["out"])
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), kept.alias("out"))

    return F.when(worth, F.aggregate(parts, state, step, lambda acc: acc["out"])).otherwise(F.array().cast(_SPAN))


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(k % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= F.lit("255")))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each base kind; matches that fail their check are dropped and not tried again."""
    numeric = text.rlike("[0-9]")
    length = lambda hit: F.length(digits_of(hit))
    return {
        "email": matches(text, EMAIL, F.instr(text, "@") > 0),
        "ip": matches(text, IP, text.rlike(r"[0-9]\.[0-9]"), lambda hit: F.forall(F.split(hit, r"\."), _small)),
        "card": matches(text, CARD, numeric, lambda hit: F.when(length(hit).between(13, 19), luhn(digits_of(hit))).otherwise(F.lit(False))),
        "phone": matches(text, PHONE, F.instr(text, "+") > 0, lambda hit: length(hit).between(9, 15)),
    }


def value_of(kind: str, hit: Column) -> Column:
    """A hash of what a span says however it is spelled: its digits, the parts of an address, the letters of a mail address."""
    if kind in ("email", "maybe_mail"):
        said = F.regexp_replace(F.regexp_replace(F.lower(hit), r"[\[({]dot[\])}]", ""), "[^a-z0-9@]", "")
    elif kind in ("ip", "maybe_address"):
        said = F.regexp_replace(F.lower(hit), "[^0-9a-f]+", ".")
    else:
        said = digits_of(hit)
    return F.xxhash64(said)


def _level(value: Column, *bounds: int) -> Column:
    """How many of the ascending bounds a value reaches."""
    out = F.lit(0)
    for k, bound in enumerate(bounds, 1):
        out = F.when(value >= bound, F.lit(k)).otherwise(out)
    return out.cast("tinyint")


def candidates(text: Column) -> dict[str, Column]:
    """For each generator its spans with their features."""

    def described(kind: str, span: Column) -> Column:
        hit = span["hit"]
        removed = lambda chars: F.length(hit) - F.length(F.regexp_replace(hit, chars, ""))
        before, after = F.lower(span["before"]), span["after"]
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            value_of(kind, hit).alias("value"),
            _level(removed("[0-9]"), 1, 7, 9, 13, 16, 17).alias("digits"),
            _level(removed("[A-Za-z]"), 1, 8).alias("letters"),
            _level(removed(r"\."), 1, 2, 3, 4).alias("dots"),
            _level(removed(r"[\x20/-]"), 1, 2, 4).alias("gaps"),
            hit.startswith("+").cast("tinyint").alias("plus"),
            (F.instr(hit, "(") > 0).cast("tinyint").alias("brackets"),
            _level(F.length(hit), 10, 14, 17, 24).alias("length"),
            before.rlike("|".join(HINTS)).cast("tinyint").alias("hint"),
            F.coalesce(after.rlike("[A-Za-z0-9_]") | before.rlike("[A-Za-z0-9_]$"), F.lit(False)).cast("tinyint").alias("glued"),
        )

    def of(kind: str) -> Callable[[Column], Column]:
        return lambda span: described(kind, span)

    worth = {"maybe_mail": F.instr(text, "@") > 0, "maybe_number": text.rlike("[0-9]{2}"), "maybe_address": text.rlike("[0-9][.:][0-9A-Fa-f]")}
    return {name: F.transform(matches(text, pattern, worth[name]), of(name)) for name, pattern in GENERATORS.items()}


@dataclass(frozen=True)
class Node:
    """A leaf with its value, or a question: is the feature at least the bound?"""

    value: float = 0.0
    feature: str = ""
    bound: int = 0
    no: Node | None = None
    yes: Node | None = None

    def score(self, cell: dict) -> float:
        node = self
        while node.feature:
            node = node.yes if cell[node.feature] >= node.bound else node.no
        return node.value

    def column(self, of: Column) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(of[self.feature] >= self.bound, self.yes.column(of)).otherwise(self.no.column(of))


def _tree(cells: list[tuple[dict, float, float]], depth: int) -> Node:
    """A regression tree on gradients ``(cell, gradient, curvature)`` by the usual second-order gain."""
    g, h = sum(x[1] for x in cells), sum(x[2] for x in cells)
    leaf = Node(value=RATE * g / (h + 1.0))
    best = (1e-6, "", 0)
    if depth:
        for feature, levels in FEATURES.items():
            for bound in range(1, levels):
                gy = sum(x[1] for x in cells if x[0][feature] >= bound)
                hy = sum(x[2] for x in cells if x[0][feature] >= bound)
                if min(hy, h - hy) < 1e-9:
                    continue
                gain = gy * gy / (hy + 1.0) + (g - gy) ** 2 / (h - hy + 1.0) - g * g / (h + 1.0)
                if gain > best[0]:
                    best = (gain, feature, bound)
    if not best[1]:
        return leaf
    _, feature, bound = best
    yes = [x for x in cells if x[0][feature] >= bound]
    no = [x for x in cells if x[0][feature] < bound]
    return Node(feature=feature, bound=bound, yes=_tree(yes, depth - 1), no=_tree(no, depth - 1))


@dataclass(frozen=True)
class Model:
    """Trees, the score they start from, and the score from which a generator's spans are selected (None: never)."""

    start: float
    trees: tuple[Node, ...]
    thresholds: dict[str, float | None]

    def score(self, cell: dict) -> float:
        return self.start + sum(tree.score(cell) for tree in self.trees)

    def column(self, of: Column) -> Column:
        out = F.lit(self.start)
        for tree in self.trees:
            out = out + tree.column(of)
        return out


def fit(cells: list[Row]) -> Model:
    """``cells``: generator, the features, ``held`` (for calibration), ``touches``, ``n`` spans and ``right`` of them."""
    train = [(c.asDict(), c["n"], c["right"]) for c in cells if not c["held"]]
    n, right = sum(x[1] for x in train), sum(x[2] for x in train)
    start = math.log((right + 0.5) / (n - right + 0.5))
    score = [start] * len(train)
    trees: list[Node] = []
    for _ in range(TREES if n >= LEAST_WEIGHT else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        tree = _tree([(c, r - m * q, m * q * (1 - q)) for (c, m, r), q in zip(train, p, strict=True)], DEPTH)
        trees.append(tree)
        score = [s + tree.score(c) for s, (c, _, _) in zip(score, train, strict=True)]
    model = Model(start, tuple(trees), {})
    thresholds: dict[str, float | None] = {}
    for name in GENERATORS:
        scored = sorted(((model.score(c.asDict()), c["n"], c["right"]) for c in cells if c["held"] and not c["touches"] and c["generator"] == name), reverse=True)
        total = good = 0
        thresholds[name] = None
        for k, (value, m, r) in enumerate(scored):
            total, good = total + m, good + r
            last = k + 1 == len(scored) or scored[k + 1][0] < value
            if last and total >= CALIBRATION_SPANS and good >= PRECISION * total:
                thresholds[name] = value
    return Model(start, tuple(trees), thresholds)


def _meets(span: Column, others: Column) -> Column:
    return F.exists(others, lambda x: (x["start"] < span["end"]) & (span["start"] < x["end"]))


def _cell(generator: str) -> Callable[[Column], Column]:
    """A span of the generator with its features, whether it touches a base span, and its value where it does not."""

    def cell(x: Column) -> Column:
        touches = _meets(x, F.col("base"))
        return F.struct(
            F.lit(generator).alias("generator"), touches.alias("touches"), F.when(~touches, x["value"]).alias("value"), *(x[f].alias(f) for f in FEATURES)
        )

    return cell


def _cells(found: DataFrame) -> list[Row]:
    """Spans and right ones per generator and features; equal values of equal features meet the known ones as one row."""
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    spans = found.select(held.alias("held"), F.inline(F.concat(*(F.transform(name, _cell(name)) for name in GENERATORS))))
    of = ["held", "generator", "touches", *FEATURES]
    counted = spans.groupBy("value", *of).agg(F.count("*").alias("n"))
    known = found.select(F.explode(F.transform("base", lambda x: x["value"])).alias("value")).distinct().withColumn("known", F.lit(True))
    right = F.when(F.col("touches") | F.col("known").isNotNull(), F.col("n")).otherwise(0)
    return counted.join(known, "value", "left").groupBy(*of).agg(F.sum("n").alias("n"), F.sum(right).alias("right")).orderBy(*of).collect()


def _proposed(model: Model, name: str, threshold: float) -> Column:
    """The spans of a generator above its threshold that touch no base span, with minus their score first."""
    scored = F.transform(
        name, lambda x: F.struct((-model.column(x)).alias("rank"), x["start"].alias("start"), x["end"].alias("end"), F.lit(name).alias("generator"))
    )
    return F.filter(scored, lambda x: (x["rank"] <= F.lit(1e-9 - threshold)) & ~_meets(x, F.col("base")))


def _best(proposed: Column) -> Column:
    """Of overlapping proposals the one of the highest score, then the first, then the shortest."""
    none = F.array().cast("array<struct<rank:double,start:int,end:int,generator:string>>")
    return F.aggregate(F.array_sort(proposed), none, lambda out, x: F.when(_meets(x, out), out).otherwise(F.concat(out, F.array(x))))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, an array of spans per base kind and per generator, each ``(start, end)`` in code points.

    Generator spans are those that the model selects; they touch no base span and no other selected one.
    A null text counts as empty and has no spans. Without any candidate nothing is selected. Rows that repeat an id
    are read each; other columns are ignored.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def valued(kind: str) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), value_of(kind, x["hit"]).alias("value"))

    found = saved(
        rows.select(
            "doc_id",
            *(F.transform(spans, valued(kind)).alias(kind) for kind, spans in base_spans(text).items()),
            *(spans.alias(name) for name, spans in candidates(text).items()),
        ),
        "pii-spans",
    ).withColumn("base", F.concat(*KINDS))
    model = fit(_cells(found))
    proposed = [_proposed(model, name, threshold) for name, threshold in model.thresholds.items() if threshold is not None]
    place = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    out = found.withColumn("best", _best(F.concat(*proposed))) if proposed else found

    def selected(name: str) -> Column:
        if model.thresholds[name] is None:
            return F.array().cast("array<struct<start:int,end:int>>")
        return F.array_sort(F.transform(F.filter("best", lambda x: x["generator"] == name), place))

    return out.select("doc_id", *(F.transform(kind, place).alias(kind) for kind in KINDS), *(selected(name).alias(name) for name in GENERATORS))


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of all spans by kind as given, then start, joined by commas."""

    def spelled(kind: str) -> Callable[[Column], Column]:
        return lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string"))

    return F.array_join(F.concat(*(F.transform(F.array_sort(kind), spelled(kind)) for kind in kinds)), ",")
