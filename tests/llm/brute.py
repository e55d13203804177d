"""The contracts of the operators, spelled out plainly for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def components(nodes, pairs) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text: str | None) -> frozenset:
    own = words((text or "").translate(LOWER))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4)) if len(own) >= 5 else frozenset([tuple(own)])


def near(docs: list[tuple[int, str | None]]) -> set:
    sets = {i: shingle_set(t) for i, t in docs}
    by_shingle: dict = {}
    for i, own in sets.items():
        for s in own:
            by_shingle.setdefault(s, []).append(i)
    shared: dict = {}
    for i, own in sets.items():
        counts: dict = {}
        for s in own:
            for j in by_shingle[s]:
                if j < i:
                    counts[j] = counts.get(j, 0) + 1
        shared |= {(i, j): n for j, n in counts.items()}
    linked = [p for p, n in shared.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    label = components(sets, linked)
    return {(i, len(sets[i]), label[i], label[i] == i) for i in sets}


def repeats(docs: list[tuple[int, str | None]], size: int = 50) -> set:
    first: dict = {}
    for i, text in sorted(docs):
        own = words(text)
        for k in range(len(own) - size + 1):
            first.setdefault(tuple(own[k : k + size]), i)
    out = set()
    for i, text in docs:
        own = words(text)
        gone = set()
        for k in range(len(own) - size + 1):
            if first[tuple(own[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(own) if k not in gone)
        out.add((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += (d * 2 - 9 if d > 4 else d * 2) if k % 2 else d
    return total % 10 == 0


def personal(text: str | None) -> dict[str, list[tuple[int, int]]]:
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


def personal_row(i: int, text: str | None) -> tuple:
    found = personal(text)
    listed = ",".join(f"{kind}:{a}:{b}" for kind in found for a, b in found[kind])
    return (i, *(len(found[k]) for k in found), hashlib.sha256(listed.encode()).hexdigest())


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    own = words(text)
    n = len(own)
    counts: dict = {}
    for i in range(n - 2):
        counts[tuple(own[i : i + 3])] = counts.get(tuple(own[i : i + 3]), 0) + 1
    covered = {i + k for i in range(n - 2) if counts[tuple(own[i : i + 3])] > 1 for k in range(3)}
    seen: set = set()
    again = 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return n, sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENCE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licences(text: str | None) -> tuple:
    own = LICENCE_WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in LICENCE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(own) - len(parts) + 1):
            if own[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def url(value: str | None) -> tuple:
    """Host, path, rule and the rule's verdict."""
    if value is None or "://" not in value:
        return "", "", None, None
    rest = value.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = host.translate(LOWER)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))
