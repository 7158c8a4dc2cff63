"""Byte-level BPE: a segment tree over byte positions finds the leftmost pair of least rank.

A piece of text starts as its single bytes. Position ``i`` of the tree holds the rank of the
pair that begins at ``i`` and ``i`` itself, as one number ``rank * size + i``; inner nodes hold the
smaller of their two children, so the root is the leftmost pair of least rank. A merge joins
the pair at the root, unlinks its right part, and updates the leaves of the merged part, of the
unlinked one and of the live neighbour on the left, each in a logarithmic number of steps.

Short pieces are merged many at a time: the trees of a batch are the rows of one array, and
each step merges the root pair of every piece that still has one. Longer pieces
use one tree each. Equal chunks of text are encoded once per task and looked up afterwards;
when the table reaches a fixed number of entries, only those of the texts at hand are kept.

Defined cases: a null text counts as empty; an empty text has no ids; equal rows give equal
results; an empty table gives an empty result. Every byte has an id, so any text, of any
length, is encoded, and decoding returns its UTF-8 bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.llm.batches import kept

NO_PAIR = np.iinfo(np.int64).max
BATCH_WIDTHS = (4, 8, 16, 32)  # longer pieces get a tree of their own
BATCH_CELLS = 1 << 18
MAX_CHUNKS = 150_000
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"

# Between a character and the white space behind it, no piece of the pattern goes on.
_CUT = re.compile(r"(?<=\S)(?=\s)")
_DOUBLE = re.compile(r"\s[ \n]")


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Vocabulary:
    """Ranks of byte strings, and the rank of every mergeable pair of ids."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.whole = {token: rank.to_bytes(2, sys.byteorder) for token, rank in ranks.items()}
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        merges = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    merges[left << 16 | right] = rank
        self.pair_rank = merges
        keys = np.array(sorted(merges), np.int64)
        self.pair_keys = np.append(keys, NO_PAIR)
        self.pair_ranks = np.array([*(merges[int(k)] for k in keys), 0], np.int64)
        # Of two bytes, the rank of the pair that their ids are.
        self.byte_pair_rank = self.rank_of_pairs(np.repeat(self.first, 256), np.tile(self.first, 256))

    def rank_of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_PAIR`` where the two do not merge or one is missing (negative)."""
        wanted = left << 16 | right
        at = np.searchsorted(self.pair_keys[:-1], wanted)
        found = (self.pair_keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at], NO_PAIR)


def merge_one(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one piece, by a segment tree of its own."""
    n = len(piece)
    ids = [int(vocabulary.first[b]) for b in piece]
    if n < 2:
        return ids
    size = 1 << (n - 1).bit_length()
    right = list(range(1, n)) + [-1]
    left = [-1, *range(n - 1)]
    rank = vocabulary.pair_rank
    tree = [NO_PAIR] * (2 * size)

    def key(i: int) -> int:
        j = right[i]
        found = rank.get(ids[i] << 16 | ids[j]) if j >= 0 else None
        return NO_PAIR if found is None else found * size + i

    tree[size : size + n] = [key(i) for i in range(n)]
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def update(i: int, value: int) -> None:
        node = size + i
        tree[node] = value
        while node > 1:
            value = min(tree[node], tree[node ^ 1])
            node >>= 1
            if tree[node] == value:
                break
            tree[node] = value

    while tree[1] != NO_PAIR:
        merged, i = divmod(tree[1], size)
        j = right[i]
        ids[i], ids[j] = merged, -1
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        update(j, NO_PAIR)
        update(i, key(i))
        if left[i] >= 0:
            update(left[i], key(left[i]))
    return [i for i in ids if i >= 0]


def merge_batch(pieces: list[bytes], width: int, vocabulary: Vocabulary) -> list[bytes]:
    """Ids of pieces of at most ``width`` (a power of two) bytes, as packed 16-bit numbers."""
    n = len(pieces)
    lengths = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
    present = np.arange(width) < lengths[:, None]
    # One more column on both sides: the neighbour of the first and of the last part.
    ids = np.full((n, width + 2), -1, np.int64)
    ids[:, 1:-1] = np.where(present, vocabulary.first[raw], -1)
    right = np.tile(np.arange(1, width + 3), (n, 1))
    left = np.tile(np.arange(-1, width + 1), (n, 1))
    left[:, 0] = 0
    tree = np.full((n, 2 * width), NO_PAIR, np.int64)

    def key(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = vocabulary.rank_of_pairs(ids[rows, at], ids[rows, np.minimum(right[rows, at], width + 1)])
        return np.where(rank == NO_PAIR, NO_PAIR, rank * width + at - 1)

    # At first parts are single bytes, whose pairs are looked up by the two bytes.
    rank = vocabulary.byte_pair_rank[raw[:, :-1].astype(np.uint16) << 8 | raw[:, 1:]]
    tree[:, width:-1] = np.where((rank != NO_PAIR) & present[:, 1:], rank * width + np.arange(width - 1), NO_PAIR)
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    def update(rows: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
        node = width + at - 1
        tree[rows, node] = value
        while node[0] > 1:  # all leaves have the same depth
            tree[rows, node >> 1] = np.minimum(tree[rows, node], tree[rows, node ^ 1])
            node = node >> 1

    live = np.flatnonzero(tree[:, 1] != NO_PAIR)
    while len(live):
        merged, at = np.divmod(tree[live, 1], width)
        at += 1
        gone = right[live, at]
        after = right[live, gone]
        ids[live, at], ids[live, gone] = merged, -1
        right[live, at] = after
        left[live, np.minimum(after, width + 1)] = at
        update(live, gone, NO_PAIR)
        update(live, at, key(live, at))
        before = left[live, at]
        inner = before > 0
        if inner.any():
            rows, at = live[inner], before[inner]
            update(rows, at, key(rows, at))
        live = live[tree[live, 1] != NO_PAIR]
    kept = ids >= 0
    flat = ids[kept].astype(np.uint16).tobytes()
    ends = np.cumsum(kept.sum(axis=1)) * 2
    return [flat[e - c : e] for e, c in zip(ends.tolist(), (kept.sum(axis=1) * 2).tolist(), strict=True)]


def encode_pieces(pieces: Iterable[bytes], vocabulary: Vocabulary) -> dict[bytes, bytes]:
    """Packed 16-bit ids of distinct pieces; one that is a token has its id, as in the tiktoken library."""
    by_width: dict[int, list[bytes]] = {w: [] for w in BATCH_WIDTHS}
    group_of = [by_width[next(w for w in BATCH_WIDTHS if n <= w)] for n in range(BATCH_WIDTHS[-1] + 1)]
    done: dict[bytes, bytes] = {}
    whole = vocabulary.whole
    for piece in pieces:
        if piece in whole:
            done[piece] = whole[piece]
        elif len(piece) < len(group_of):
            group_of[len(piece)].append(piece)
        else:
            done[piece] = array("H", merge_one(piece, vocabulary)).tobytes()
    for width, group in by_width.items():
        step = max(1, BATCH_CELLS // width)
        for start in range(0, len(group), step):
            part = group[start : start + step]
            done.update(zip(part, merge_batch(part, width, vocabulary), strict=True))
    return done


def chunks(text: str) -> list[str]:
    """Cut a text before white space that follows another character; pieces never cross a cut."""
    if "\0" in text or _DOUBLE.search(text):
        return _CUT.split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").lstrip("\0").split("\0")


class Encoder:
    """Texts to packed ids, with a bounded table of chunks seen before."""

    def __init__(self, path: str, pattern: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.ids_of: dict[str, bytes] = {}

    def learn(self, new: Iterable[str]) -> None:
        ids_of, findall = self.ids_of, self.pattern.findall
        single: dict[str, bytes] = {}
        several: dict[str, list[bytes]] = {}
        distinct: set[bytes] = set()
        for chunk in new:
            pieces = findall(chunk)
            if len(pieces) == 1:
                single[chunk] = piece = pieces[0].encode()
                distinct.add(piece)
            else:
                several[chunk] = parts = [p.encode() for p in pieces]
                distinct.update(parts)
        known = encode_pieces(distinct, self.vocabulary)
        for chunk, piece in single.items():
            ids_of[chunk] = known[piece]
        for chunk, parts in several.items():
            ids_of[chunk] = b"".join([known[p] for p in parts])

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 16-bit numbers."""
        cut = [chunks(t) for t in texts]
        wanted = {c for parts in cut for c in parts}
        if len(self.ids_of) > MAX_CHUNKS:
            self.ids_of = {c: self.ids_of[c] for c in wanted.intersection(self.ids_of)}
        self.learn(wanted.difference(self.ids_of))
        look_up = self.ids_of.__getitem__
        return [b"".join(map(look_up, parts)) for parts in cut]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def encoder(path: str, pattern: str) -> Encoder:
    return kept(("Encoder", path, pattern), lambda: Encoder(path, pattern))


def groups(texts: Iterable[str | None], most: int = 1 << 21) -> Iterator[list[str]]:
    """Texts in lists of bounded length in all, or of one text."""
    held: list[str] = []
    total = 0
    for text in texts:
        text = text or ""
        if held and total + len(text) > most:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield held


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path, pattern)
        decimal = own.vocabulary.decimal.__getitem__
        for batch in batches:
            rows = []
            for texts in groups(batch):
                for packed in own.packed(texts):
                    ids = array("H", packed).tolist()
                    listed = ",".join(map(decimal, ids)).encode()
                    rows.append(
                        (len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest())
                    )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str, pattern: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.Series(
                [array("H", p).tolist() for texts in groups(batch) for p in own.packed(texts)], dtype=object
            )

    return run


def _texts(path: str, pattern: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.Series([own.decode([] if i is None else i) for i in batch], dtype=object)

    return run


def encode(text: Column, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Ids of a text column as an array of numbers."""
    return F.pandas_udf(_iterating(_ids(path or default_ranks(), pattern)), "array<int>")(text)


def decode(ids: Column, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Bytes of an array of ids; null counts as no ids."""
    return F.pandas_udf(_iterating(_texts(path or default_ranks(), pattern)), "binary")(ids)


def round_trip(text: Column, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """A struct with the fields of ``SCHEMA``: ids of the text, and the bytes decoded from those ids."""
    run = _digests(path or default_ranks(), pattern)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, SCHEMA)(text)


def _iterating(run):
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run
