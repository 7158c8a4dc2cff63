"""Token store: documents as ids, each compressed on its own with one shared zstandard dictionary.

A store is a folder ``shards`` of files and a folder ``dictionary`` with the trained
dictionary. Shards, and the documents in them, are in ascending order of ``doc_id``. A shard:

    header    24 bytes: magic, bytes per id, 16 bytes of the dictionary's SHA-256; then a line feed
    frames    one zstandard frame per document, each followed by a line feed
    index     per document: id (int64), offset and length of its frame (uint64), number of ids (uint64), whether it
              has an id (uint8); then a line feed
    trailer   offset of the index, documents, bytes per document in the index, magic; then a line feed

Spark's text writer lays down the bytes (a line feed closes every row), so the store can be on any
file system that Spark writes, and a task that is repeated leaves no half-written shard. The reader
checks the dictionary's hash and finds any document through the index, without touching other frames.

The dictionary is trained on whole id arrays of at most ``SAMPLE_DOCUMENTS`` documents, chosen by a hash
of their id among those of at most ``SAMPLE_CHARS`` characters; it only affects sizes, never contents.

Defined cases: a null text counts as empty and is stored as its end id alone; rows with one ``doc_id`` are
all kept, in order of a hash of their frames; documents without ``doc_id`` come first and keep none; names of special tokens
in a text are those tokens; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.batches import kept, slices
from faultline.plans.durable import durable, shared_path

MAGIC = b"TKSTORE2"
SAMPLE_DOCUMENTS = 1_000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 16 << 20
MAX_CHUNKS = 400_000
LEVEL = 3
_HEADER_BYTES = 24
_TRAILER = "<QQQ8s"
_INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u8"), ("ids", "<u8"), ("known", "u1")])
_NO_ID = -(1 << 63)  # stands for a null id, whose row is marked as not known


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class WordTable(dict):
    """A bounded table of the words seen last: when it is full it becomes the former half, and words found there move back."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.half, self.former = most // 2, {}

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.former[word]
        return found

    def unknown(self, words: set[str]) -> list[str]:
        if len(self) > self.half:
            self.former = dict(self)
            self.clear()
        return list(words.difference(self).difference(self.former))


class Tokens:
    """Packed ids of texts; equal words are encoded once and looked up in a bounded table.

    The tokenizer drops white space and never joins what it separates, so a text may be cut at blanks.
    """

    PLAIN = re.compile("[a-zß-öø-ÿ]+")
    STOP = re.compile(r"[.,](?=[ \n])(?<=[a-zß-öø-ÿ][.,])")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Names of special tokens in a text become their ids, as they do by the library's default.
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [name.lower() for name in special]
        # Found before any change of case, and parted from what surrounds them; a blank inside would forbid the cut at blanks.
        if any(re.search(r"\s", name) for name in special):
            raise ValueError("special tokens with white space cannot be told from words")
        size = self.tokenizer.get_vocab_size()
        self.code = "H" if size <= 1 << 16 else "I"
        self.closes = np.zeros(size, bool)  # ids that end a word
        for token, number in self.tokenizer.get_vocab().items():
            self.closes[number] = token.endswith("</w>")
        self.ids_of = WordTable(MAX_CHUNKS)

    def packed(self, texts: Sequence[str], end: int) -> list[bytes]:
        """Ids of each text and the end id, little-endian."""
        cut = [self._spaced(t).replace("\n", " ").split(" ") for t in texts]
        rest = []
        plain = []
        for word in self.ids_of.unknown(set().union(*cut)):
            (plain if self.PLAIN.fullmatch(word) else rest).append(word)
        for start in range(0, len(plain), 1024):
            part = plain[start : start + 1024]
            found = self._together(part)
            if found is None:
                rest += part
            else:
                self.ids_of.update(zip(part, found, strict=True))
        for start in range(0, len(rest), 4096):
            part = rest[start : start + 4096]
            for word, encoded in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.ids_of[word] = array(self.code, encoded.ids).tobytes()
        look_up, last = self.ids_of.__getitem__, array(self.code, [end]).tobytes()
        return [b"".join(map(look_up, words)) + last for words in cut]

    def _together(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of letters only, encoded as one text; null if the vocabulary does not mark where words end."""
        encoded = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, self.code)
        borders = ((np.flatnonzero(self.closes[ids]) + 1) * ids.itemsize).tolist()
        if len(borders) != len(words) or borders[-1] != ids.nbytes:
            return None
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip([0, *borders], borders)]

    def _spaced(self, text: str) -> str:
        """Lower-case texts of Latin-1 characters here, where it is one to one, and set a comma or full stop between a
        letter and white space apart; both leave the ids as they are and save table entries."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        lower = text.lower()
        # Changing the case could make a name of what is none.
        if any(name in lower for name in self.special):
            return text
        return self.STOP.sub(r" \g<0>", lower)


def tokens(path: str) -> Tokens:
    return kept(("Tokens", path), lambda: Tokens(path))


def _encoded(df: DataFrame, key: str, text: str, path: str, end: int, dictionary: bytes | None) -> DataFrame:
    """``doc_id``, ``n_ids`` and the packed ids, compressed when there is a dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path)
        pack = _compressor(dictionary)
        width = array(own.code).itemsize
        for batch in batches:
            for part in slices(batch, 1):
                packed = own.packed([t or "" for t in part.column(1).to_pylist()], end)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(p) // width for p in packed], pa.int64()),
                        pa.array([width] * len(packed), pa.int32()),
                        pa.array([pack(p) for p in packed], pa.binary()),
                    ],
                    ["doc_id", "n_ids", "width", "frame"],
                )

    chosen = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_ids long, width int, frame binary")


def _compressor(dictionary: bytes | None):
    if dictionary is None:
        return lambda ids: ids
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_dict_id=False).compress


def train_dictionary(df: DataFrame, key: str, text: str, path: str, end: int) -> bytes:
    """The shared dictionary; empty when the sample holds too little to learn from."""
    short = df.where(F.length(text) <= SAMPLE_CHARS).select(key, text)
    sample = short.orderBy(F.xxhash64(key), key, F.length(text)).limit(SAMPLE_DOCUMENTS)
    rows = _encoded(sample, key, text, path, end, None).select("frame").collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r[0]) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _shard_rows(dictionary: bytes):
    digest = hashlib.sha256(dictionary).digest()[:15]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        width = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            frames = batch.column(3).to_pylist()
            if not width:
                width = batch.column(2)[0].as_py()
                yield _bytes([MAGIC + bytes([width]) + digest])
            ids.append(batch.column(0))
            counts.append(batch.column(1).to_numpy())
            sizes.append(np.array([len(f) for f in frames], np.uint64))
            yield _bytes(frames)
        if width:
            index = np.zeros(sum(map(len, ids)), _INDEX)
            joined = pa.chunked_array(ids)
            index["doc_id"] = joined.fill_null(_NO_ID).to_numpy()
            index["known"] = joined.is_valid().to_numpy()
            index["size"] = np.concatenate(sizes)
            index["ids"] = np.concatenate(counts)
            after = np.cumsum(index["size"] + np.uint64(1))
            index["offset"] = _HEADER_BYTES + 1 + after - index["size"] - np.uint64(1)
            place = _HEADER_BYTES + 1 + int(after[-1])
            yield _bytes([index.tobytes(), struct.pack(_TRAILER, place, len(index), _INDEX.itemsize, MAGIC)])

    return run


def _bytes(rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])


def write_store(
    df: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end: int = 2,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode, compress and write all documents below ``folder``."""
    spark, path = df.sparkSession, tokenizer or default_tokenizer()
    dictionary = train_dictionary(df, key, text, path, end)
    spark.createDataFrame([(dictionary,)], "dictionary binary").write.parquet(f"{folder}/dictionary")
    # Texts are encoded once; the range borders and the order then come from the small written table.
    staged = f"{folder}/staged"
    frames = _encoded(df, key, text, path, end, dictionary).withColumn("size", F.length("frame"))
    frames.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "none").parquet(staged)
    frames = spark.read.parquet(staged)
    shards = int(frames.agg(F.sum("size")).first()[0] or 0) // shard_bytes + 1
    # The digest and the row part rows of one id, which may be more than a shard takes.
    order = ["doc_id", F.xxhash64("frame"), "row"]
    ordered = frames.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    rows = ordered.select("doc_id", "n_ids", "width", "frame").mapInArrow(_shard_rows(dictionary), "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(f"{folder}/shards")


class Shard:
    """One shard file in memory."""

    def __init__(self, content: bytes, dictionary: bytes) -> None:
        if content[:8] != MAGIC or content[-9:-1] != MAGIC:
            raise ValueError("not a shard of a token store")
        if content[9:24] != hashlib.sha256(dictionary).digest()[:15]:
            raise ValueError("the shard was written with another dictionary")
        self.content = content
        self.code = {2: "<u2", 4: "<u4"}[content[8]]
        place, count, width, _ = struct.unpack(_TRAILER, content[-1 - struct.calcsize(_TRAILER) : -1])
        if width != _INDEX.itemsize:
            raise ValueError("index of another version")
        self.index = np.frombuffer(content, _INDEX, count, place)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.unpack = zstandard.ZstdDecompressor(dict_data=shared).decompress

    def ids(self, row: int) -> np.ndarray:
        offset, size = self.index[["offset", "size"]][row].tolist()
        return np.frombuffer(self.unpack(self.content[offset : offset + size]), self.code)

    def rows_of(self, doc_id: int) -> range:
        """Rows of one document, by binary search."""
        first = int(np.searchsorted(self.index["known"], 1))
        keys = self.index["doc_id"][first:]
        return range(first + int(np.searchsorted(keys, doc_id)), first + int(np.searchsorted(keys, doc_id, "right")))


def _dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").first()[0])


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{folder}/shards")
    return files.where(F.col("length") > 0).select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    dictionary = _dictionary(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                shard = Shard(content.as_py(), dictionary)
                counts = shard.index["ids"].astype(np.int64)
                decoded = [shard.ids(i) for i in range(len(counts))]
                if [len(d) for d in decoded] != counts.tolist():
                    raise ValueError(f"{name} does not hold the ids its index lists")
                crcs = [zlib.crc32(d.astype("<u4").tobytes()) for d in decoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(counts), pa.string()),
                        pa.array(shard.index["doc_id"], mask=shard.index["known"] == 0),
                        pa.array(np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    schema = "shard string, doc_id long, inside long, n_tokens long, ids_crc32 long"
    rows = durable(_shards(spark, folder).mapInArrow(run, schema))
    # One row per shard: file names rise with the document ids.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_documents(spark: SparkSession, folder: str, wanted: Iterable[int]) -> DataFrame:
    """``doc_id`` and ``ids`` of the documents named; only their frames are decompressed."""
    dictionary, chosen = _dictionary(spark, folder), sorted(set(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                shard = Shard(content.as_py(), dictionary)
                found = [(doc, shard.ids(i)) for doc in chosen for i in shard.rows_of(doc)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc for doc, _ in found], pa.int64()),
                        pa.array([ids.tolist() for _, ids in found], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "ids"],
                )

    return _shards(spark, folder).mapInArrow(run, "doc_id long, ids array<long>")


def stored_and_read(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write a store into the shared folder and read all of it back."""
    folder = shared_path(df.sparkSession, "token-store")
    write_store(df, folder, key, text, **options)
    return read_store(df.sparkSession, folder)
