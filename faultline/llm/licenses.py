"""Licence scan: an Aho-Corasick automaton finds notices, a shunting-yard parser evaluates expressions.

Words are runs of ASCII letters, digits and non-ASCII characters of the lower-cased
text; everything else separates them. The automaton runs over the words joined by
single blanks and finds all notice phrases and identifier tags in one pass. What
follows a tag (``SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause``) is
an expression: ``with`` binds tightest, then ``and``, then ``or``. Its names are those of ``GRADES``, alone or
with a version behind them, and ``LicenseRef-`` names. Any other name, or an operator at the end,
makes the whole expression a broken one: no labels, and less weight in the score.

Defined cases: a null text counts as empty; an empty text has no words, no places, null
``first_word`` and ``last_word``, empty labels and score 0; equal rows give equal results;
an empty table gives an empty result. Texts are read whole, in one pass each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases of the base rule and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices, found by the same automaton.
NOTICES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "dedicated to the public domain": "public-domain",
}
TAGS = ("spdx license identifier", "spdx licence identifier")

# Label and freedom of reuse (1: any use, 0: none) of an identifier, by the longest name that it equals or continues
# after a hyphen.
GRADES = {
    "mit": ("mit", 1.0),
    "apache-1.0": ("apache-1", 1.0),
    "apache-1.1": ("apache-1", 1.0),
    "apache-2.0": ("apache-2", 1.0),
    "bsd": ("bsd", 1.0),
    "0bsd": ("bsd", 1.0),
    "isc": ("isc", 1.0),
    "zlib": ("zlib", 1.0),
    "bsl-1.0": ("bsl", 1.0),
    "ncsa": ("ncsa", 1.0),
    "psf-2.0": ("psf", 1.0),
    "python-2.0": ("psf", 1.0),
    "postgresql": ("postgresql", 1.0),
    "openssl": ("openssl", 1.0),
    "unicode": ("unicode", 1.0),
    "x11": ("x11", 1.0),
    "wtfpl": ("public-domain", 1.0),
    "cc0": ("public-domain", 1.0),
    "unlicense": ("public-domain", 1.0),
    "cc-by": ("cc-by", 0.9),
    "cc-by-sa": ("cc-by-sa", 0.6),
    "cc-by-nc": ("cc-by-nc", 0.2),
    "cc-by-nd": ("cc-by-nd", 0.2),
    "artistic": ("artistic", 0.8),
    "ofl": ("ofl", 0.8),
    "ms-pl": ("ms-pl", 0.8),
    "mpl": ("mpl", 0.7),
    "epl": ("epl", 0.7),
    "cddl": ("cddl", 0.7),
    "lgpl": ("lgpl", 0.7),
    "eupl": ("eupl", 0.6),
    "odbl": ("odbl", 0.6),
    "gfdl": ("gfdl", 0.5),
    "gpl-1.0": ("gpl-1", 0.5),
    "gpl-2.0": ("gpl-2", 0.5),
    "gpl-3.0": ("gpl-3", 0.5),
    "agpl": ("agpl", 0.4),
}
OWN_NAME = "licenseref-"
UNKNOWN_GRADE = 0.3
EXCEPTION_BONUS = 0.2
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# Evidence of one finding: a valid tag, a notice, a tag whose expression cannot be read.
TAG_WEIGHT, NOTICE_WEIGHT, BROKEN_WEIGHT = 0.95, 0.6, 0.3

_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_tags long, expressions string, openness double"
)


def _separators() -> bytes:
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for code in range(128):
        if chr(code).isalnum():
            table[code] = ord(chr(code).lower())
    return bytes(table)


def postfix(tokens: Sequence[str]) -> list[str]:
    """Shunting-yard: infix tokens to postfix order. Raises ``ValueError`` on a malformed expression."""
    output: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in tokens:
        if token in PRECEDENCE:
            if operand_next:
                raise ValueError("operator without a left side")
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                output.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise ValueError("no operator before a bracket")
            waiting.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("empty bracket or trailing operator")
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                raise ValueError("closing bracket without an opening one")
            waiting.pop()
        else:
            if not operand_next:
                raise ValueError("two names without an operator")
            output.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        raise ValueError("expression ends early")
    return output + waiting[::-1]


def grade(identifier: str) -> tuple[str, float]:
    """Label and freedom of a known identifier or ``LicenseRef-`` name. Raises ``ValueError`` for other names."""
    name = identifier.removesuffix("+")
    if name.startswith(OWN_NAME) and name != OWN_NAME:
        return name, UNKNOWN_GRADE
    known = max((p for p in GRADES if name == p or name.startswith(f"{p}-")), key=len, default=None)
    if known is None:
        raise ValueError(f"not a licence: {identifier}")
    return GRADES[known]


def evaluate(tokens: Sequence[str]) -> tuple[set[str], float]:
    """Labels and freedom of an expression: ``and`` takes the stricter side, ``or`` the freer one,
    ``with`` adds an exception to the licence on its left. Raises ``ValueError`` on a malformed expression
    or an unknown name."""

    def value(side: str | tuple[set[str], float]) -> tuple[set[str], float]:
        if isinstance(side, str):
            label, free = grade(side)
            return {label}, free
        return side

    stack: list[str | tuple[set[str], float]] = []
    for token in postfix(tokens):
        if token not in PRECEDENCE:
            stack.append(token)
            continue
        right, (labels, free) = stack.pop(), value(stack.pop())
        if token == "with":
            if not isinstance(right, str):
                raise ValueError("an exception is one name")
            stack.append((labels, min(1.0, free + EXCEPTION_BONUS)))
        else:
            more, other = value(right)
            stack.append((labels | more, (min if token == "and" else max)(free, other)))
    return value(stack.pop())


def read_expression(text: str, start: int) -> list[str]:
    """Lower-case tokens from ``start`` to the first character or word that cannot belong to an expression."""
    tokens: list[str] = []
    depth, operand_next = 0, True
    while match := _TOKEN.match(text, start):
        token = match[1].lower()
        operator = token in PRECEDENCE or token == ")"
        if operator == operand_next or (token == ")" and not depth):
            break
        depth += (token == "(") - (token == ")")
        operand_next = token == "(" or token in PRECEDENCE
        tokens.append(token)
        start = match.end()
    # A full stop that ends the sentence is not part of a name.
    return [t.rstrip(".:") if t not in "()" else t for t in tokens]


def automaton() -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        built.add_word(f" {phrase} ", (len(phrase), "base", label))
    for phrase, label in NOTICES.items():
        built.add_word(f" {phrase} ", (len(phrase), "notice", label))
    for phrase in TAGS:
        built.add_word(f" {phrase} ", (len(phrase), "tag", phrase))
    built.make_automaton()
    return built


def scan(text: str, finder: ahocorasick.Automaton, table: bytes) -> tuple:
    """The result row of one text, in the order of ``SCHEMA``."""
    words = text.encode("utf-8", "surrogatepass").translate(table).split()
    joined = b" ".join(words).decode("utf-8", "surrogatepass")
    line = f" {joined} "
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    grades: list[float] = []
    expressions: set[str] = set()
    doubt, n_tags, word, seen = 1.0, 0, 0, 0
    raw_words = None
    for end, (length, kind, label) in finder.iter(line):
        start = end - length  # the first character of the phrase, after its blank
        # Matches come by their end; the word count moves on from the last start, also backwards.
        word += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
        seen = start
        if kind == "tag":
            if raw_words is None:
                raw_words = [m.end() for m in _WORD.finditer(_lower(text))]
            after = raw_words[word - 1 + label.count(" ")]
            after += len(text[after:after + 8]) - len(text[after:after + 8].lstrip(" :\t"))
            n_tags += 1
            try:
                tokens = read_expression(text, after)
                found, free = evaluate(tokens)
            except ValueError:
                doubt *= 1 - BROKEN_WEIGHT
                continue
            labels |= found
            grades.append(free)
            expressions.add(" ".join(tokens).replace("( ", "(").replace(" )", ")"))
            doubt *= 1 - TAG_WEIGHT
            continue
        if kind == "base":
            places.append(word - 1)
            base.add(label)
        labels.add(label)
        doubt *= 1 - NOTICE_WEIGHT
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1 - doubt,
        n_tags,
        "; ".join(sorted(expressions)),
        min(grades, default=None),
    )


def _lower(text: str) -> str:
    """Only A-Z become lower case, so that positions stay the same."""
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def _scan_series(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    finder, table = automaton(), _separators()
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    whole = ["first_word", "last_word"]
    for texts in batches:
        rows = pd.DataFrame([scan(t or "", finder, table) for t in texts], columns=columns)
        yield rows.astype({c: "Int64" for c in whole} | {"openness": "float64"})


def licence_scan(text: Column) -> Column:
    """A struct with the fields of ``SCHEMA`` for a text column."""
    return F.pandas_udf(_scan_series, SCHEMA)(text)
