"""Hashes of the words of many texts at once, by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def lowered(byte: int) -> int:
    return byte + 32 if 65 <= byte <= 90 else byte


# What each byte becomes; 0 separates words. White space alone separates, or everything but letters, digits and non-ASCII.
BY_SPACE = np.array([0 if b == 32 or 9 <= b <= 13 else lowered(b) + 1 for b in range(256)], np.uint16)
BY_LETTERS = np.array([lowered(b) + 1 if b >= 128 or chr(b).isalnum() else 0 for b in range(256)], np.uint16)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    values = values.copy()
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: pa.Array, codes: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """``counts`` of words per text, the hash of every word, and of its first ``p`` bytes for each prefix length.

    Words never cross texts; a null text has none.
    """
    filled = pc.fill_null(texts, "")
    sizes = pc.binary_length(filled).to_numpy(zero_copy_only=False).astype(np.int64)
    n = int(sizes.sum())
    if not n:
        return (np.zeros(len(sizes), np.int64), *[np.zeros(0, np.uint64)] * (1 + len(prefixes)))
    # The values of a slice begin at its offset.
    joined = pc.binary_join(pa.scalar(filled.to_pylist(), pa.list_(pa.string())), "").as_buffer()
    data = codes[np.frombuffer(joined, np.uint8, n)]
    inside = data > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = np.cumsum(sizes) - sizes
    firsts = firsts[sizes > 0]
    begins[firsts] = inside[firsts]
    letters = np.flatnonzero(inside)
    if not len(letters):
        return (np.zeros(len(sizes), np.int64), *[np.zeros(0, np.uint64)] * (1 + len(prefixes)))
    starts = np.flatnonzero(begins)
    at = np.flatnonzero(begins[letters])  # place of each word's first letter among all letters
    lengths = np.diff(np.append(at, len(letters)))
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    terms = _powers(int(lengths.max()))[place] * data[letters]
    out = [mixed(np.add.reduceat(terms, at) + lengths.astype(np.uint64))]
    for prefix in prefixes:
        out.append(mixed(np.add.reduceat(np.where(place < prefix, terms, np.uint64(0)), at) + np.uint64(prefix << 32)))
    ends = np.cumsum(sizes)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
    return counts, *out
