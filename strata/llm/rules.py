"""Quality rules: a decision list learned by sequential covering from labelled text statistics.

Every text is counted once, by whole columns. A bounded sample of labelled rows then grows conjunctions of
thresholds that single out the low-quality rows, one rule at a time: conditions are added while they raise FOIL's
gain, dropped again while that serves rows held back from growing, and the rows a rule covers are set aside before
the next is sought. The list is emitted as one ordered Spark conditional, so applying it costs no Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import words as w
from strata.llm.store import saved, texts_of

# Fixed values of the base checks.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks"]
# Ratios that rules may name: numerator and denominator.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
}
# Labelled rows used for learning, at most; the bound on what reaches the driver.
MAX_ROWS = 20_000
MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 12, 4, 40
# A rule must be right on this share of the rows held back that it covers, and cover so many of them.
PRECISION, LEAST_COVERED = 0.95, 3


def _chosen(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_SYMBOL, _MARK = _chosen(SYMBOLS), _chosen(".,;:!?")
_UPPER, _DIGIT = _chosen("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _chosen("0123456789")
_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def _again(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many entries of the same row have the same value, for each entry."""
    order = np.lexsort((values, rows))
    new = np.ones(len(order), bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(order), np.int64)
    out[order] = np.bincount(group)[group] if len(order) else 0
    return out


def _repeat_words(words: w.Words) -> np.ndarray:
    """Words per row that stand in a three-word window found twice or more in the row."""
    row = words.row
    grams = w.grams(words.hashes(), 3)
    at = np.flatnonzero(row[: len(grams)] == row[2:]) if len(grams) else np.zeros(0, np.int64)
    at = at[_again(grams[at], row[at]) > 1]
    cover = np.zeros(len(words) + 4, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + 3, -1)
    return w.sums_by_row((np.cumsum(cover)[: len(words)] > 0).astype(np.int64), words.first)


def _lines(piece: w.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word per row, and how many of them equal an earlier one."""
    breaks = np.flatnonzero(piece.data == 10)
    start = np.unique(np.concatenate([piece.bounds[:-1], breaks + 1]))
    start = start[start < len(piece.data)]
    row = np.searchsorted(piece.bounds, start, side="right") - 1
    end = np.minimum(np.append(start[1:], len(piece.data)), piece.bounds[row + 1])
    end = end - (piece.data[end - 1] == 10) if len(end) else end
    solid = np.concatenate([[0], np.cumsum(~w.SPACE[piece.data])])
    full = solid[end] > solid[start]
    start, end, row = start[full], end[full], row[full]
    hashes = w.span_hashes(w._BYTE_VALUES[piece.data], start, end)
    counts = np.bincount(row, minlength=piece.rows)
    order = np.lexsort((hashes, row))
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    return counts, np.bincount(row[order][1:][same], minlength=piece.rows)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in w.pieces(batch.column(1)):
            words = piece.words()
            by_row = {name: w.sums_by_row(words.byte_sums(table), words.first) for name, table in
                      (("word_chars", _CHARACTER), ("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_marks", _MARK))}
            by_row["n_words"] = words.counts
            by_row["n_repeat_words"] = _repeat_words(words)
            by_row["n_lines"], by_row["n_dup_lines"] = _lines(piece)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(piece.lo, piece.rows), *(w.longs(by_row[name]) for name in COUNTS)], names=["doc_id", *COUNTS]
            )


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of every document; a null text counts as empty."""
    return texts_of(docs, id_col, text_col).mapInArrow(_counted, "doc_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTS))


def ratio(name: str) -> Column:
    over, under = RATIOS[name]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    stat: str
    at_least: bool
    bound: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.stat] >= self.bound if self.at_least else rows[self.stat] <= self.bound

    def column(self) -> Column:
        value = ratio(self.stat)
        return value >= F.lit(self.bound) if self.at_least else value <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.at_least else '<='} {self.bound:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Rule, rows: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for condition in rule:
        out &= condition.holds(rows)
    return out


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition of the largest gain until no good row is left or nothing gains."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best, gain = None, 1e-9
        for stat, values in rows.items():
            for bound in np.unique(np.quantile(values[inside], np.linspace(0, 1, THRESHOLDS), method="nearest")):
                for at_least in (True, False):
                    now = inside & (values >= bound if at_least else values <= bound)
                    p, n = (bad & now).sum(), (~bad & now).sum()
                    if p and n < n0 and (found := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Condition(stat, at_least, float(bound)), found
        if best is None:
            break
        rule, inside = (*rule, best), inside & best.holds(rows)
    return rule


def _worth(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = covered(rule, rows, len(bad))
    p, n = (bad & inside).sum(), (~bad & inside).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray) -> list[Rule]:
    """Rules in order. ``held`` marks the rows kept back for pruning and acceptance."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES and (bad & left & ~held).any():
        part = lambda mask: ({k: v[mask] for k, v in rows.items()}, bad[mask])
        rule = _grow(*part(left & ~held))
        check, truth = part(left & held)
        while len(rule) > 1 and _worth(rule[:-1], check, truth) >= _worth(rule, check, truth):
            rule = rule[:-1]
        inside = covered(rule, check, len(truth))
        if not rule or inside.sum() < LEAST_COVERED or truth[inside].mean() < PRECISION:
            break
        rules.append(rule)
        left &= ~covered(rule, rows, len(bad))
    return rules


def _least(labelled: DataFrame, n: int) -> DataFrame:
    """Rows below a cut of the hash that leaves ``n`` rows or few more, so that no task offers more for the sample."""
    rows, share = labelled.count(), 0.0
    while True:
        # The hash is even over distinct ids; where few ids have most rows, the cut moves up until enough rows pass.
        share = max(2 * share, (n + 6 * n**0.5) / max(rows, 1))
        if share >= 1:
            return labelled
        below = labelled.filter(F.col("chosen") < int((share - 0.5) * 2.0**64))
        if below.count() >= n:
            return below


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> list[Rule]:
    """Learn from at most ``max_rows`` labelled documents, chosen by the hash of their id.

    Rows without an id or a label, and documents whose labels contradict each other, teach nothing.
    """
    agreed = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").dropna().groupBy("doc_id")
    agreed = agreed.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    counted = stats.filter(~base_failed()).select("doc_id", *(ratio(name).alias(name) for name in RATIOS))
    chosen = F.xxhash64("doc_id").alias("chosen")
    labelled = saved(counted.join(agreed, "doc_id").select(chosen, "quality", *RATIOS), "quality-labelled")
    sample = _least(labelled, max_rows).orderBy("chosen", *RATIOS).limit(max_rows).collect()
    if not sample:
        return []
    rows = {name: np.array([r[name] for r in sample], float) for name in RATIOS}
    return learn(rows, np.array([r["quality"] == 0 for r in sample]), np.arange(len(sample)) % 3 == 0)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def rule_number(rules: list[Rule]) -> Column:
    """The first rule that holds, counted from 1; 0 where none does."""
    out = F.lit(0)
    for k in range(len(rules), 0, -1):
        holds = F.lit(True)
        for condition in rules[k - 1]:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(k)).otherwise(out)
    return out


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS
) -> DataFrame:
    """Counts, base verdict, the number and text of the deciding rule, and whether each document is kept.

    Empty and null texts have no words and fail the base check. Without labels there are no rules, and what passes
    the base check is kept. Rows that repeat an id are judged each by its own text; other columns are ignored.
    """
    stats = saved(statistics(docs, id_col, text_col), "quality-statistics")
    rules = fit(stats, labels, max_rows)
    spelled = F.array(*(F.lit(" and ".join(map(str, rule))) for rule in rules)).cast("array<string>")
    return (
        stats.withColumn("base_failed", base_failed())
        .withColumn("rule", F.when(F.col("base_failed"), F.lit(0)).otherwise(rule_number(rules)))
        .withColumn("rule_text", F.when(F.col("rule") > 0, F.get(spelled, F.col("rule") - 1)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )
