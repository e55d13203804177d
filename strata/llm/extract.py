"""Main text of pages: a linear-chain conditional random field over the leaf blocks of the document tree.

A page is a sequence of leaf blocks; each is main text or not. A block's features are the tags, classes and ids of the
elements around it and figures of its text (length, share of links, how it ends). Their weights, and those of the
changes between the two states along the page, maximise the likelihood of labelled pages; Viterbi decoding gives the
most likely sequence for every page.

Labelled pages are of two kinds. Pages that mark their article as such label themselves; at most ``max_pages`` of them
are sampled, each learned twice, once without that mark, so that the weights carry over to pages without it. Beside
them stand made-up pages in many layouts, which also cover notices, forms and comments that the sample may lack.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import Block, leaf_blocks
from strata.session import ship_package

MAX_PAGES, MADE_PAGES = 300, 400
# Of a labelled page so many runs of so many blocks are learned at most, spread over the page.
RUNS, RUN = 2, 200
ROUNDS, RATE, DECAY = 120, 0.2, 1e-3
# Rows of a result batch.
ROWS = 256
# What is remembered of the elements around blocks within a task.
REMEMBERED = 50_000

MARKS = frozenset({"article", "main"})
# Words of tags, classes and ids that set something apart from the article around it.
APART = frozenset(
    (
        "nav aside footer form dialog .nav .menu .sidebar .ad .ads .advert .advertisement .promo .sponsored .banner .cookie .notice "
        ".consent .comment .comments .reply .replies .share .social .related .newsletter .subscribe .breadcrumb .breadcrumbs .footer"
    ).split()
)
RESULT = "page_id bigint, url string, text string, n_blocks bigint, n_main bigint"

Features = list[str]


class Model(NamedTuple):
    weights: dict[str, float]
    #: ``change[a][b]``: from a block of state ``a`` to one of state ``b``; 1 is main text.
    change: tuple[tuple[float, float], tuple[float, float]]


def _around(block: Block) -> Features:
    return [f"^{trait}" for trait in sorted(block.around) if trait not in ("html", "body")]


def _own(block: Block, first: bool, last: bool, again: bool) -> Features:
    """Features of a block beside the elements around it."""
    text, size = block.text, len(block.text)
    length = size.bit_length()
    links = 4 * block.linked // size if block.linked < size else 4
    end = text[-1] if text[-1] in ".!?:;,…" else "a" if text[-1].isalpha() else "0"
    commas = min(text.count(",") + text.count("."), 6)
    capital = "A" if text[0].isupper() else "a"
    found = ["*", f"tag {block.tag}", f"length {length}", f"links {links}", f"end {end}", f"stops {commas}", f"starts {capital}",
             f"{block.tag} {length}", f"{block.tag} links {links}", f"length {length} end {end}"]
    if "©" in text:
        found.append("copyright")
    if first:
        found.append("first")
    if last:
        found.append("last")
    if again:
        found.append("again")
    return found


def _owns(blocks: list[Block]) -> Iterator[Features]:
    seen: set[str] = set()
    for i, block in enumerate(blocks):
        yield _own(block, i == 0, i == len(blocks) - 1, block.text in seen)
        seen.add(block.text)


def features(blocks: list[Block]) -> list[Features]:
    return [_around(block) + own for block, own in zip(blocks, _owns(blocks), strict=True)]


def self_labelled(blocks: list[Block]) -> list[int]:
    """Labels of a page that marks its article."""
    mark = "article" if any("article" in b.around for b in blocks) else "main"
    return [int(mark in b.around and not b.around & APART) for b in blocks]


# Made-up pages. The words mean nothing; the layouts are what is learned.
_SYLLABLES = "ba den lor mi tas ver no sel ku ran pe dro fi gan hu".split()
_CONTENT = (
    ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
    ('<div id="main-content"><div class="post-body">', "</div></div>"), ('<div class="entry-content">', "</div>"),
    ('<section class="story">', "</section>"), ('<div class="article-text">', "</div>"), ('<div class="c1"><div>', "</div></div>"),
    ("<table><tr><td>", "</td></tr></table>"), ("<div>", "</div>"), ("", ""),
)


class _Maker:
    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.main: set[str] = set()

    def words(self, low: int, high: int) -> str:
        pick = self.random
        return " ".join("".join(pick.choices(_SYLLABLES, k=pick.randint(1, 4))) for _ in range(pick.randint(low, high)))

    def sentence(self) -> str:
        text = self.words(3, 16).capitalize()
        if self.random.random() < 0.3:
            text = text.replace(" ", ", ", 1)
        return text + self.random.choice("...!?")

    def prose(self, most: int) -> str:
        return " ".join(self.sentence() for _ in range(self.random.randint(1, most)))

    def kept(self, text: str) -> str:
        self.main.add(text)
        return text

    def links(self, low: int, high: int, item: str = "li") -> str:
        return "".join(f'<{item}><a href="/x">{self.words(1, 4).capitalize()}</a></{item}>' for _ in range(self.random.randint(low, high)))

    def chance(self, share: float, *made: Callable[[], str]) -> str:
        return self.random.choice(made)() if self.random.random() < share else ""

    def menu(self) -> str:
        tag, end = self.random.choice([("<nav>", "</nav>"), ('<div class="menu">', "</div>"), ('<div id="top-nav">', "</div>"), ("<header>", "</header>")])
        return f"{tag}<ul>{self.links(2, 9)}</ul>{end}"

    def header(self) -> str:
        return f"<header><div>{self.words(1, 3).capitalize()}</div><p>{self.words(2, 6)}</p></header>"

    def advert(self) -> str:
        name = self.random.choice(["ad", "ads", "advert", "promo", "sponsored", "banner"])
        return f'<div class="{name}">{self.prose(2)}</div>'

    def notice(self) -> str:
        name = self.random.choice(["cookie-notice", "notice", "consent", "cookie-banner", "alert notice"])
        return f'<div class="{name}"><p>{self.prose(2)}</p><button>{self.words(1, 2)}</button></div>'

    def side(self) -> str:
        tag, end = self.random.choice([("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<div id="sidebar">', "</div>")])
        return f"{tag}<h3>{self.words(1, 3).capitalize()}</h3><ul>{self.links(1, 6)}</ul><p>{self.prose(2)}</p>{end}"

    def related(self) -> str:
        return f'<div class="related"><h3>{self.words(1, 3).capitalize()}</h3>{self.links(2, 5, "p")}</div>'

    def share(self) -> str:
        return f'<div class="{self.random.choice(["share", "social"])}">{self.links(2, 4, "span")}</div>'

    def form(self) -> str:
        return f'<form><p>{self.prose(1)}</p><label>{self.words(1, 3)}</label><input><button>{self.words(1, 2)}</button></form>'

    def comments(self) -> str:
        one = self.random.choice(['<article class="comment">{}</article>', '<div class="comment">{}</div>', '<li class="reply">{}</li>'])
        all_ = "".join(one.format(f"<b>{self.words(1, 2)}</b><p>{self.prose(3)}</p>") for _ in range(self.random.randint(1, 4)))
        return f'<section id="comments" class="comments"><h2>{self.words(1, 2).capitalize()}</h2>{all_}</section>'

    def footer(self) -> str:
        tag, end = self.random.choice([("<footer>", "</footer>"), ('<div class="footer">', "</div>"), ('<div id="footer">', "</div>")])
        return f"{tag}&copy; {self.words(1, 3)} &middot; {self.prose(2)}{end}"

    def body(self) -> str:
        pick, parts = self.random, []
        title = self.kept(self.words(1, 9).capitalize() + pick.choice(["", ".", "?"]))
        parts.append(pick.choice(["<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h2>{}</h2>"]).format(title))
        for _ in range(pick.randint(1, 14)):
            parts.append(
                pick.choices(
                    [
                        lambda: f"<p>{self.kept(self.prose(6))}</p>",
                        lambda: f"<p><b>{self.kept(self.prose(4))}<br></p>",
                        lambda: f"<h2>{self.kept(self.words(1, 6).capitalize())}</h2>",
                        lambda: "<ul>" + "".join(f"<li>{self.kept(self.prose(2))}</li>" for _ in range(pick.randint(1, 4))) + "</ul>",
                        lambda: f"<blockquote><p>{self.kept(self.prose(3))}</p></blockquote>",
                        lambda: f"<p>{self.kept(self.words(1, 2).capitalize() + '.')}</p>",
                        lambda: f"<figure><img><figcaption>{self.kept(self.sentence())}</figcaption></figure>",
                        lambda: f"<pre>{self.kept(self.words(3, 12))}</pre>",
                        lambda: "<table><tr>" + "".join(f"<td>{self.kept(self.words(1, 4))}</td>" for _ in range(3)) + "</tr></table>",
                    ],
                    [8, 2, 1, 1, 1, 1.5, 0.4, 0.4, 0.4],
                )[0]()
            )
            parts.append(self.chance(0.06, self.advert, self.share, self.related, self.side))
        return "".join(parts)

    def page(self) -> str:
        start, end = self.random.choice(_CONTENT)
        before = [self.chance(0.3, self.notice), self.chance(0.4, self.header), self.chance(0.9, self.menu), self.chance(0.4, self.advert)]
        inside = self.body() + self.chance(0.25, self.share, self.related, self.comments)
        after = [self.chance(0.4, self.side), self.chance(0.3, self.comments), self.chance(0.25, self.form), self.chance(0.9, self.footer)]
        self.random.shuffle(before)
        return f"<html><body>{''.join(before)}{start}{inside}{end}{''.join(after)}</body></html>"


def made_page(seed: int) -> tuple[str, set[str]]:
    """A page in a made-up layout, and the texts of its main blocks."""
    maker = _Maker(seed)
    return maker.page(), maker.main


def _runs(found: list[Features], labels: list[int]) -> Iterator[tuple[list[Features], list[int]]]:
    """All blocks of a page, or of a long one some runs of them."""
    whole = [(lo, lo + RUN) for lo in range(0, len(found), RUN)]
    step = max(1, -(-len(whole) // RUNS))
    for lo, hi in whole[::step]:
        yield found[lo:hi], labels[lo:hi]


def _made() -> Iterator[tuple[list[Features], list[int]]]:
    for seed in range(MADE_PAGES):
        page, main = made_page(seed)
        blocks = leaf_blocks(page)
        yield from _runs(features(blocks), [int(b.text in main) for b in blocks])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled runs of pages that mark their article, with and without the mark."""
    for batch in batches:
        out = []
        for page in batch.column(0).to_pylist():
            blocks = leaf_blocks(page or "")
            for found, labels in _runs(features(blocks), self_labelled(blocks)):
                unmarked = [[f for f in own if f[1:] not in MARKS] for own in found]
                out += [{"features": found, "labels": labels}, {"features": unmarked, "labels": labels}]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("features", pa.list_(pa.list_(pa.string()))), ("labels", pa.list_(pa.int32()))]))


def sample(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES) -> DataFrame:
    """At most ``max_pages`` pages that mark their article, by hash: the same ones however the rows are dealt out.

    The marked pages are counted first, so that about four times as many as needed are left to be put in order.
    """
    marked = pages.select(F.col(html_col).cast("string").alias("html")).filter("html ILIKE '%<article%' OR html ILIKE '%<main%'")
    share = min(1.0, 4 * max_pages / max(marked.count(), 1))
    key = F.xxhash64("html")
    few = marked.withColumn("key", key).filter(F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30)))
    return few.orderBy("key").limit(max_pages).select("html")


def labelled(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES) -> list[tuple[list[Features], list[int]]]:
    """Runs of labelled blocks, their features and labels; their number is bounded whatever the table's size."""
    ship_package(pages.sparkSession)
    rows = sample(pages, html_col, max_pages).mapInArrow(_examples, "features array<array<string>>, labels array<int>").collect()
    return [([list(own) for own in row.features], list(row.labels)) for row in rows]


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1, keepdims=True)
    return top[..., 0] + np.log(np.exp(a - top).sum(axis=-1))


def _chances(score: np.ndarray, size: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For padded sequences: chance of main text at each block, and of each change, summed over all."""
    runs, longest = score.shape
    emit = np.stack([np.zeros_like(score), score], axis=-1)
    ahead, behind = np.zeros((longest, runs, 2)), np.zeros((longest, runs, 2))
    ahead[0] = emit[:, 0]
    for t in range(1, longest):
        ahead[t] = emit[:, t] + _log_sum(ahead[t - 1][:, None, :] + change.T[None])
    for t in range(longest - 2, -1, -1):
        step = _log_sum(change[None] + (emit[:, t + 1] + behind[t + 1])[:, None, :])
        behind[t] = np.where((t + 1 < size)[:, None], step, 0)
    every = np.arange(runs)
    total = _log_sum(ahead[size - 1, every])
    main = np.exp(ahead[..., 1] + behind[..., 1] - total).T
    pair = ahead[:-1, :, :, None] + change + (emit.transpose(1, 0, 2)[1:] + behind[1:])[:, :, None, :] - total[None, :, None, None]
    inside = np.arange(1, longest)[:, None] < size
    return main, (np.exp(np.where(inside[..., None, None], pair, -np.inf))).sum(axis=(0, 1))


def fit(examples: Iterable[tuple[list[Features], list[int]]]) -> Model:
    """Weights of the greatest likelihood, with a quadratic penalty, by gradient steps of adapted size."""
    examples = [(found, labels) for found, labels in examples if found]
    size = np.array([len(labels) for _, labels in examples])
    longest, number = int(size.max()), {}
    column, at = [], []
    for r, (found, _) in enumerate(examples):
        for t, own in enumerate(found):
            column += [number.setdefault(name, len(number)) for name in own]
            at += [r * longest + t] * len(own)
    column, at = np.array(column), np.array(at)
    inside = np.arange(longest) < size[:, None]
    label = np.zeros((len(size), longest), np.int64)
    for r, (_, labels) in enumerate(examples):
        label[r, : len(labels)] = labels
    both = inside[:, 1:]
    seen = np.array([[((label[:, :-1] == a) & (label[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    blocks = inside.sum()
    weight, moment, square = (np.zeros(len(number) + 4) for _ in range(3))
    for step in range(1, ROUNDS + 1):
        score = np.bincount(at, weight[:-4][column], minlength=label.size).reshape(label.shape)
        main, changes = _chances(score, size, weight[-4:].reshape(2, 2))
        miss = np.where(inside, label - main, 0).reshape(-1)
        gain = np.append(np.bincount(column, miss[at], minlength=len(number)), (seen - changes).reshape(-1)) / blocks
        gain -= DECAY / blocks * weight
        moment = 0.9 * moment + 0.1 * gain
        square = 0.99 * square + 0.01 * gain * gain
        weight += RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    change = weight[-4:].tolist()
    return Model(dict(zip(number, weight[:-4].tolist(), strict=True)), ((change[0], change[1]), (change[2], change[3])))


def train(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES) -> Model:
    """A model from a bounded sample of pages that label themselves and from made-up pages."""
    return fit([*_made(), *labelled(pages, html_col, max_pages)])


def viterbi(score: list[float], change: tuple[tuple[float, float], tuple[float, float]]) -> list[int]:
    """The most likely states."""
    (stay, rise), (fall, hold) = change
    came, no, yes = [], 0.0, 0.0
    for i, own in enumerate(score):
        if i:
            from_no, from_yes = (no + stay, yes + fall), (no + rise, yes + hold)
            came.append((from_no[1] > from_no[0], from_yes[1] >= from_yes[0]))
            no, yes = max(from_no), max(from_yes)
        yes += own
    states = [int(yes > no)] if score else []
    for back in reversed(came):
        states.append(int(back[states[-1]]))
    return states[::-1]


class Reader:
    """A model at work; what it found about elements around blocks is remembered."""

    def __init__(self, model: Model):
        self.weights, self.change = model
        self.known: dict[frozenset[str], float] = {}

    def around(self, block: Block) -> float:
        if block.around not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[block.around] = sum(self.weights.get(name, 0.0) for name in _around(block))
        return self.known[block.around]

    def main(self, blocks: list[Block]) -> list[str]:
        get = self.weights.get
        score = [self.around(block) + sum(get(name, 0.0) for name in own) for block, own in zip(blocks, _owns(blocks), strict=True)]
        return [block.text for block, state in zip(blocks, viterbi(score, self.change), strict=True) if state]


def main_text(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_blocks, n_main)`` for every row: the blocks of main text, joined by two line ends.

    Character references are decoded, white space within a block becomes one space; nothing else changes and nothing is
    cut off. Null and empty pages, and pages without main text, have the empty text. Repeated rows are read each.
    Malformed pages are read as far as they go. Other columns are ignored; an empty table gives no rows. One pass, no
    shuffle.
    """
    ship_package(pages.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_blocks", pa.int64()), ("n_main", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                some = batch.slice(lo, ROWS)
                texts, counts = [], []
                for page in some.column(2):
                    blocks = leaf_blocks(page.as_py() or "")
                    main = reader.main(blocks)
                    texts.append("\n\n".join(main))
                    counts.append((len(blocks), len(main)))
                columns = [some.column(0), some.column(1), pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    named = (F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return pages.select(*named).mapInArrow(read, RESULT)
