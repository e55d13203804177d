"""Leaf blocks of a page: runs of text that no block element cuts, each with the elements around it."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# Fixed values of HTML: elements that hold no text of a page, elements without an end, and those within a line.
SILENT = (
    "script style template noscript noembed noframes head title iframe object svg canvas select textarea button option datalist audio video"
).split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    (
        "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
        "small span strike strong sub sup time tt u var wbr"
    ).split()
)
# Elements whose text is taken as it stands up to their end, whatever looks like a tag in it.
_RAW = "script|style|textarea|title|noscript|iframe|noembed|noframes"
# A start tag of the first ends an open element of the second.
_ENDS_ITSELF = frozenset("li dd dt option tr td th thead tbody tfoot".split())
_SAME = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",), "option": ("option",)}
_HOLDERS = frozenset("ul ol dl table select datalist".split())
_SILENT = frozenset(SILENT)

_MARKUP = re.compile(
    rf"""<!--.*?(?:-->|\Z) | <({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z) | <[!?][^>]*>
    | <(/?)([a-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)> | <(/?)([a-z][^\s/>]*)([^>]*)>""",
    re.I | re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_OPEN_END = re.compile(r"<[a-z/!?]", re.I)


class Block(NamedTuple):
    #: Text with white space as one space.
    text: str
    #: Characters of it within links.
    linked: int
    #: The innermost block element, and what is known of all elements around: ``tag``, and ``.word`` of classes and ids.
    tag: str
    around: frozenset[str]


class _Element(NamedTuple):
    tag: str
    around: frozenset[str]
    block: str
    link: bool
    silent: bool


_NOTHING = _Element("", frozenset(), "", False, False)


def _traits(tag: str, attributes: str) -> set[str]:
    found = {tag}
    if "=" in attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            words = re.sub(r"([a-z])([A-Z])", r"\1 \2", match[2] or match[3] or match[4] or "").lower()
            found.update(f".{word}" for word in _WORD.findall(words))
    return found


class _Page:
    """The open elements, and the block that is being read."""

    def __init__(self) -> None:
        self.stack: list[_Element] = [_NOTHING]
        self.open: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.at = _NOTHING

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if not raw or top.silent:
            return
        raw = html.unescape(raw) if "&" in raw else raw
        if not self.parts:
            self.at = top
        elif not self.at.block or len(self.at.around) > len(top.around):
            self.at = top
        self.parts.append(raw)
        if top.link:
            self.linked.append(raw)

    def cut(self) -> None:
        """End the block."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                linked = len(" ".join("".join(self.linked).split()))
                self.blocks.append(Block(text, linked, self.at.block, self.at.around))
            self.parts, self.linked = [], []

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        inline = tag in INLINE
        if not inline:
            self.cut()
            # A block element ends a paragraph left open.
            if self.open["p"]:
                self.end("p")
            if tag in _ENDS_ITSELF:
                self._end_alike(tag)
        if tag in VOID:
            return
        top = self.stack[-1]
        traits = _traits(tag, attributes)
        around = top.around if traits <= top.around else top.around | traits
        block = top.block if inline else tag
        self.stack.append(_Element(tag, around, block, top.link or tag == "a", top.silent or tag in _SILENT))
        self.open[tag] += 1

    def _end_alike(self, tag: str) -> None:
        alike = _SAME.get(tag, (tag,))
        if not any(self.open[name] for name in alike):
            return
        for element in reversed(self.stack):
            if element.tag in alike:
                self.end(element.tag)
                return
            if element.tag in _HOLDERS:
                return

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.cut()
        if not self.open[tag]:
            return
        while True:
            gone = self.stack.pop()
            self.open[gone.tag] -= 1
            if gone.tag == tag:
                return


def _unended(match: re.Match[str]) -> bool:
    if match[1]:
        return not re.search(rf"</{match[1]}\s*>\Z", match[0], re.I)
    return match[0].startswith("<!--") and not match[0].endswith("-->")


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, none of them empty; markup may be malformed or cut off anywhere.

    Character references are decoded and white space within a block becomes one space. Scripts, styles, titles, controls
    and the like have no blocks. Work is linear in the page, whatever it holds.
    """
    state = _Page()
    whole = page.rfind(">") + 1
    at, match = 0, None
    for match in _MARKUP.finditer(page, 0, whole):
        state.text(page[at : match.start()])
        at = match.end()
        end, tag, attributes = match.group(2, 3, 4)
        if tag is None:
            end, tag, attributes = match.group(5, 6, 7)
        if tag is None:
            continue
        if end:
            state.end(tag.lower())
        else:
            state.start(tag.lower(), attributes)
    # Behind the last ">" a tag can only begin, and what is open there as a comment or raw text has no end.
    if match is None or at < whole or not _unended(match):
        rest = page[at:]
        cut = _OPEN_END.search(rest, whole - at)
        state.text(rest[: cut.start()] if cut else rest)
    state.cut()
    return state.blocks
