"""Personal data with exact source positions, also where it is disguised.

Base identifiers are found in the text as it stands. Then three transducers rewrite the
text, each keeping for every output character the source range it came from:

1. ``fold``: look-alike letters, full-width forms and other digits become ASCII, invisible
   characters go;
2. ``digits``: runs of at least four spelled digits (``five five five one``) become digits,
   a spelled ``plus`` before them becomes ``+``; four numbers of digits or of up to three
   spelled digits with any dots between them (``one nine two dot 168 dot 1 dot 7``) close up;
3. ``addresses``: names and hosts with any mix of real, bracketed and bare at and dots
   (``name [at] host (dot) org``, ``first dot last at host dot org``) become an address.
   ``brackets`` undoes the bracketed ones before ``digits``.

The same detectors run over the rewritten text, and their spans are mapped back to code
points of the source. A mapped span is added when the rewriting touched it and every base span
that it meets lies within it, so that the part of an address or number which was plain does not
hide the disguised rest; base spans always stay.

A bare ``at`` before a host whose dots are all real is read as prose, not as an address, when
a word of ``_PROSE`` stands before it (``look at host.org``), the host begins with ``www.``, or
no label behind a dot has two or more letters of one case; an article or possessive behind any
bare ``at`` makes it prose, too.

Defined cases: a null text counts as empty and has no spans; positions are code points with
an exclusive end; equal rows give equal results; an empty table gives an empty result. All
scans take linear time, also on one endless run of letters or digits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SCHEMA = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits begins, as each part takes its whole run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = {c: None for c in range(128) if not chr(c).isdigit()}

# Letters that look like ASCII ones.
LOOK_ALIKE = dict(
    zip(
        "АВЕЗКМНОРСТУХаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαον",
        "ABE3KMHOPCTYXaeopcyxijsdhqwABEZHIKMNOPTYXaov",
        strict=True,
    )
)
INVISIBLE = "­​‌‍⁠﻿"
SPELLED = {
    word: digit
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, word in enumerate(words.split())
} | {"oh": 0}
PLUS = {"plus", "más", "mas"}
MIN_SPELLED = 4

_FOLDED = re.compile(
    f"[{''.join(LOOK_ALIKE)}{INVISIBLE}！-～٠-٩۰-۹०-९․﹒．。]"
)
_number = "|".join(sorted({*SPELLED} - {"oh"}, key=len, reverse=True))
_gap = r"(?:[\x20\t]{1,3}|-|,[\x20]?)"
# Each part ends at a word border: a run must not take the head of the word behind it ("un" of "und").
_SPELLED = re.compile(
    rf"(?<!\w)(?:(plus|más|mas){_gap})?((?:{_number})(?:{_gap}(?:{_number}|oh|[0-9]{{1,4}})(?!\w)){{{MIN_SPELLED - 1},}}+)",
    re.IGNORECASE,
)
_PART = re.compile(r"\w+")
_at = r"[\x20]?(?:\[[\x20]?at[\x20]?\]|\([\x20]?at[\x20]?\)|\{[\x20]?at[\x20]?\}|<[\x20]?at[\x20]?>)[\x20]?"
_dot = r"[\x20]?(?:\[[\x20]?(?:dot|punkt|point|punto)[\x20]?\]|\([\x20]?(?:dot|punkt|point|punto)[\x20]?\)|\{[\x20]?(?:dot|punkt|point|punto)[\x20]?\})[\x20]?"
_BRACKETED = re.compile(rf"({_at})|({_dot})", re.IGNORECASE)
_AT = re.compile(
    r"@|(?<=[A-Za-z0-9_])[\x20]at(?=[\x20](?!(?:the|an?|this|that|my|your|our|his|her|their)[\x20]))", re.IGNORECASE
)
# "point" is also an English word ("at some point it"), so that it counts before a few endings only.
_bare_dot = r"[\x20](?:dot|punkt|punto|point(?=[\x20](?:fr|be|ch|ca|lu|eu|com|org|net)(?!\w)))[\x20]"
_HOST = re.compile(rf"[A-Za-z0-9-]++(?!\w)(?:(?:\.|{_bare_dot})[A-Za-z0-9-]++(?!\w))+", re.IGNORECASE)
_BARE_DOT = re.compile(_bare_dot, re.IGNORECASE)
# Within a name only the word that no running text has: "en este punto ana@host.es" is no name of three parts.
_NAME_DOT = " dot "
_TOP = re.compile(r"\.(?:[a-z]{2,}|[A-Z]{2,})(?![A-Za-z0-9-])")
# Words before "at host.org" in running text.
_PROSE = frozenset(
    """me you him it us them here there online live now today out up page pages site website websites article blog
    visit visited look looks looked looking see seen read found find available hosted posted published based located
    information details more order buy free is are was were be been and or not only also directly work works worked
    working meet join check learn listen watch download downloaded back stay staying arrive arrived""".split()
)
_octet = rf"(?:[0-9]++|(?:{_number}|oh)(?:{_gap}(?:{_number}|oh)){{0,2}})(?!\w)"
_octet_dot = r"(?:\.|[\x20](?:dot|punkt|point|punto)[\x20])"
_SPELLED_IP = re.compile(
    rf"(?<!\w)({_octet}){_octet_dot}({_octet}){_octet_dot}({_octet}){_octet_dot}({_octet})", re.IGNORECASE
)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    total = sum(map(int, digits[-1::-2])) + sum(twice[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Each ``@`` with the longest name before and host behind it, from left to right."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield Span("email", start, host.end())
            free = host.end()
        at = text.find("@", max(free, at + 1))


def detect(text: str) -> list[Span]:
    """Base spans by start, then kind; a match that fails its test is dropped without another try."""
    spans = list(emails(text)) if "@" in text else []
    for match in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
            spans.append(Span("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = match[0].translate(_NO_DIGIT)
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append(Span("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(match[0].translate(_NO_DIGIT)) <= 15:
                spans.append(Span("phone", *match.span()))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


class Rewritten:
    """A text with, for each of its characters, the source range it stands for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1
        self.touched = np.zeros(len(text), bool)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ``text[start:end]`` by the new text; edits are ordered and do not overlap.

        All characters of a replacement stand for the whole replaced range.
        """
        if not edits:
            return
        pieces, starts, ends, touched, free = [], [], [], [], 0
        for start, end, new in edits:
            pieces += [self.text[free:start], new]
            starts += [self.starts[free:start], np.full(len(new), self.starts[start])]
            ends += [self.ends[free:start], np.full(len(new), self.ends[end - 1])]
            touched += [self.touched[free:start], np.ones(len(new), bool)]
            free = end
        self.text = "".join([*pieces, self.text[free:]])
        self.starts = np.concatenate([*starts, self.starts[free:]])
        self.ends = np.concatenate([*ends, self.ends[free:]])
        self.touched = np.concatenate([*touched, self.touched[free:]])


def fold(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), _folded(m[0])) for m in _FOLDED.finditer(text)]


def _folded(char: str) -> str:
    if char in INVISIBLE:
        return ""
    if char in LOOK_ALIKE:
        return LOOK_ALIKE[char]
    if char.isdigit():
        return str(int(char))
    if char in "․﹒。":
        return "."
    return chr(ord(char) - 0xFEE0)


def brackets(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), "@" if m[1] else ".") for m in _BRACKETED.finditer(text)]


def spelled_ips(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for match in _SPELLED_IP.finditer(text):
        free = match.start()
        for i, octet in enumerate(match.groups(), 1):
            if text[free : match.start(i)] not in ("", "."):
                edits.append((free, match.start(i), "."))
            free = match.end(i)
            if not octet.isdigit():
                number = "".join(p if p.isdigit() else str(SPELLED[p]) for p in _PART.findall(octet.lower()))
                edits.append((*match.span(i), number))
    return edits


def digits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for match in _SPELLED.finditer(text):
        begin = match.start(2)
        if match[1]:
            edits.append((match.start(), begin, "+"))
        parts = list(_PART.finditer(text, begin, match.end()))
        for i, part in enumerate(parts):
            # The gap behind a digit goes with it, so that the run closes up.
            end = parts[i + 1].start() if i + 1 < len(parts) else part.end()
            word = part[0].lower()
            edits.append((part.start(), end, str(SPELLED[word]) if word in SPELLED else word))
    return edits


def addresses(text: str) -> list[tuple[int, int, str]]:
    """Bare at and dots of each address, from left to right; a name may reach back over ``name dot name``."""
    edits, free = [], 0
    for at in _AT.finditer(text):
        bare = at[0] != "@"
        host = _HOST.match(text, at.end() + bare) if at.start() > free else None
        if not host:
            continue
        start, dots = _name(text, free, at.start())
        if start == at.start():
            continue
        behind = [m.span() for m in _BARE_DOT.finditer(text, host.start(), host.end())]
        if bare and not dots and not behind:
            word, plain = text[start : at.start()].lower(), host[0].lower()
            if word in _PROSE or plain.startswith("www.") or not _TOP.search(host[0]):
                continue
        edits += [(*dot, ".") for dot in dots]
        if bare:
            edits.append((at.start(), host.start(), "@"))
        edits += [(*dot, ".") for dot in behind]
        free = host.end()
    return edits


def _name(text: str, free: int, end: int) -> tuple[int, list[tuple[int, int]]]:
    """Where the name before ``end`` begins, and its bare dots in order."""
    start, dots = end, []
    while True:
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        width = len(_NAME_DOT)
        named = text[max(start - width, 0) : start].lower() == _NAME_DOT
        if start == end or not named or start - width <= free or text[start - width - 1] not in _LOCAL:
            return start, dots[::-1]
        dots.append((start - width, start))
        start -= width


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans of the rewritten text, mapped to the source: those that contain all base spans they meet, and more than one alone."""
    new = Rewritten(text)
    for transducer in (fold, brackets, spelled_ips, digits, addresses):
        new.apply(transducer(new.text))
    if not new.touched.any() and len(new.text) == len(text):
        return []
    kept = []
    at = 0
    taken = sorted((s.start, s.end) for s in base)
    for span in detect(new.text):
        start, end = int(new.starts[span.start]), int(new.ends[span.end - 1])
        changed = new.touched[span.start : span.end].any() or end - start != span.end - span.start
        if not changed:
            continue
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        # Base spans of different kinds may nest, hence a short look ahead.
        near = taken[max(0, at - len(KINDS)) : bisect_left(taken, (end, end))]
        met = [(s, e) for s, e in near if s < end and e > start]
        if all(start <= s and e <= end and (s, e) != (start, end) for s, e in met):
            kept.append(Span(span.kind, start, end))
    return kept


_HINT = re.compile(
    rf"{_FOLDED.pattern}|[\[({{<][\x20]?(?:at|dot|punkt|point|punto)\b|{_bare_dot}|[\x20]at[\x20][A-Za-z0-9-]+\."
    rf"|(?<!\w)(?:{_number})(?:{_gap}(?:{_number}|oh|[0-9])|{_octet_dot}(?:{_number}|oh|[0-9]))"
    rf"|(?<!\w)oh{_octet_dot}(?:{_number}|oh|[0-9])|[0-9]{_octet_dot}(?:{_number}|oh)|[0-9][\x20](?:punkt|point|punto)[\x20][0-9]",
    re.IGNORECASE,
)


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, both by start, then kind."""
    base = detect(text)
    added = disguised(text, base) if _HINT.search(text) else []
    return base, sorted([*base, *added], key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def mask(text: str, spans: list[Span]) -> str:
    """Replace each span, or union of overlapping spans, by ``[KIND]`` of its first kind."""
    pieces, free = [], 0
    for i, span in enumerate(spans):
        if span.start < free:
            free = max(free, span.end)
            continue
        pieces += [text[free : span.start], f"[{span.kind.upper()}]"]
        free = span.end
    return "".join([*pieces, text[free:]])


def report(text: str) -> tuple:
    base, every = find_spans(text)
    counts = [sum(s.kind == kind for s in base) for kind in KINDS]
    digest = hashlib.sha256(written(base).encode()).hexdigest()
    return (*counts, digest, written(every), len(every))


def _report_series(texts: pd.Series) -> pd.DataFrame:
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame([report(t or "") for t in texts], columns=columns)


def _mask_series(texts: pd.Series) -> pd.Series:
    return pd.Series([t if t is None else mask(t, find_spans(t)[1]) for t in texts], dtype=object)


def personal_data(text: Column) -> Column:
    """A struct with the fields of ``SCHEMA``; the counts and the digest are of base spans."""
    return F.pandas_udf(_report_series, SCHEMA)(text)


def masked(text: Column) -> Column:
    """The text with all spans replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``; null stays null."""
    return F.pandas_udf(_mask_series, "string")(text)
