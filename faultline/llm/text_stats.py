"""Figures of whole texts, many texts at once, by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from faultline.llm.words import BY_SPACE, word_hashes

# What a byte is. Punctuation is what running prose has between words; other ASCII signs are symbols.
_PROSE = {ord(c) for c in ".,;:'\"()-"}
KINDS = ("lower", "upper", "digit", "blank", "line", "prose", "symbol", "high")


def _kind(byte: int) -> int:
    if byte >= 128:
        return 7
    if byte == 10:
        return 4
    if byte == 32 or 9 <= byte <= 13:
        return 3
    char = chr(byte)
    return 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit() else 5 if byte in _PROSE else 6


KIND = np.array([_kind(b) for b in range(256)], np.uint8)
FEATURES = (
    "log_words",
    "mean_word",
    "short_words",
    "long_words",
    "distinct_words",
    "commonest_word",
    "same_as_before",
    "upper",
    "digit",
    "prose",
    "symbol",
    "signs_a_word",
    "high",
    "commonest_symbol",
    "stops",
    "commas",
    "words_a_line",
    "distinct_lines",
    "commonest_line",
    "word_spread",
)
SHORT, LONG = 3, 12  # bytes of a word


def _groups(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values of each owner, and how often its commonest one stands."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1]))[: len(owner)]
    starts = np.flatnonzero(new)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[starts], np.diff(np.append(starts, len(owner))))
    return np.bincount(owner[starts], minlength=n), most


def _line_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every line that is not empty."""
    n = len(bounds) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.append(starts[1:], len(data))
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    powers = np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    letters = np.where(data == 10, 0, data).astype(np.uint64)
    hashes = np.add.reduceat(powers[place] * letters, starts)
    owner = np.searchsorted(bounds, starts, "right") - 1
    full = hashes != 0
    return np.minimum(owner, n - 1)[full], hashes[full]


def text_stats(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` per text; shares are of bytes, words or lines, and 0 where there are none."""
    filled = pc.fill_null(texts, "")
    n = len(filled)
    sizes = pc.binary_length(filled).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    joined = "".join(filled.to_pylist()).encode()
    data = np.frombuffer(joined, np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * len(KINDS) + KIND[data], minlength=n * len(KINDS)).reshape(n, -1)
    count = dict(zip(KINDS, kinds.T, strict=True))

    counts, hashes = word_hashes(filled, BY_SPACE)
    inside = (KIND[data] != 3) & (KIND[data] != 4)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[bounds[:-1][sizes > 0]] = inside[bounds[:-1][sizes > 0]]
    starts = np.flatnonzero(begins)
    of = np.repeat(np.arange(n), counts)
    lengths = np.add.reduceat(inside.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    distinct, commonest = _groups(of, hashes, n)
    again = np.bincount(of[1:][(of[1:] == of[:-1]) & (hashes[1:] == hashes[:-1])], minlength=n)

    symbols = np.flatnonzero(KIND[data] == 6)
    _, top_symbol = _groups(owner[symbols], data[symbols], n)
    line_of, lines = _line_hashes(data, bounds)
    distinct_lines, commonest_line = _groups(line_of, lines, n)
    n_lines = np.bincount(line_of, minlength=n)

    def per(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    def among(flags: np.ndarray) -> np.ndarray:
        return per(np.bincount(of[flags], minlength=n), counts)

    mean = per(np.bincount(of, lengths, n), counts)
    spread = np.sqrt(np.maximum(per(np.bincount(of, lengths.astype(float) ** 2, n), counts) - mean**2, 0))
    letters = count["lower"] + count["upper"]
    signs = count["symbol"]
    table = {
        "log_words": np.log1p(counts),
        "mean_word": mean,
        "short_words": among(lengths <= SHORT),
        "long_words": among(lengths > LONG),
        "distinct_words": per(distinct, counts),
        "commonest_word": per(commonest, counts),
        "same_as_before": per(again, counts),
        "upper": per(count["upper"], letters),
        "digit": per(count["digit"], sizes),
        "prose": per(count["prose"], sizes),
        "symbol": per(signs, sizes),
        "signs_a_word": per(signs, counts),
        "high": per(count["high"], sizes),
        "commonest_symbol": per(top_symbol, counts),
        "stops": per(np.bincount(owner[data == ord(".")], minlength=n), counts),
        "commas": per(np.bincount(owner[data == ord(",")], minlength=n), counts),
        "words_a_line": np.log1p(per(counts, n_lines)),
        "distinct_lines": per(distinct_lines, n_lines),
        "commonest_line": per(commonest_line, n_lines),
        "word_spread": spread,
    }
    return np.column_stack([table[f] for f in FEATURES]).astype(float)
