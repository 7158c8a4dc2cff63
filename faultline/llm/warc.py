"""WARC archives in which equal payloads are stored once.

Headers (page, digest) are shuffled by payload digest and reduced to the smallest page of each digest
before and after the shuffle. Pages then join these originals: the page that is the original becomes a
``response`` with its payload, every other page of the digest a ``revisit`` without one, with fresh headers
that name the original. Payloads of revisits are dropped before the records are shuffled.

Records are laid down by Spark's text writer, whose line end closes each record, so archives can be on any
file system and a repeated task leaves no half-written file. They are compressed with gzip and read back
through Spark's binary reader. The reader checks every response against its digest and length.

Defined cases: a null or empty payload has length 0 and the digest of no bytes, and takes part like
any other; a null url is left out of the record; line breaks and blanks in a url are percent-encoded; rows with
the same page id and payload: one is the response, the others are revisits of it; a page without an id is a response
of its own, to which nothing refers; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.skew import attach
from faultline.plans.durable import durable, shared_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MIN_BYTES = 0
RECORD_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_FIELD = "X-Full-Payload-Length"
PAGE_FIELD = "X-Page-Id"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32: each five hexadecimal digits are four base32 digits."""
    digest = F.sha1(payload)

    def four(i: Column) -> Column:
        bits = F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        digits = [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*digits)

    return F.concat(*[four(F.lit(i)) for i in range(8)])


def _record_id(page: Column, occurrence: Column) -> Column:
    name = F.md5(F.concat_ws("/", F.lit("page"), page.cast("string"), occurrence.cast("string")))
    parts = [F.substring(name, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload, bytes, digest, copy, refers_to``: pages with their original, if that is another row.

    ``copy`` tells rows with one page id and payload apart; the original has 0.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        text.alias("payload"),
        F.octet_length(text).cast("long").alias("bytes"),
        base32_sha1(text).alias("digest"),
        F.lit(0).cast("long").alias("row"),
    )
    takes_part = (F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull()
    counts = rows.where(takes_part).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    originals = durable(
        counts.groupBy("digest")
        .agg(F.sum("n").alias("n"), F.min(F.struct("page_id", F.col("n").alias("same"))).alias("first"))
        .where("n > 1")
        .select("digest", "n", F.col("first.page_id").alias("original"), F.col("first.same").alias("same"))
    )
    if originals.where("same > 1").head(1):
        # Rows alike in id and payload, one of which is the original: only numbers that are written down tell them apart.
        folder = shared_path(pages.sparkSession, "numbered-pages")
        rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
        rows = pages.sparkSession.read.parquet(folder)
        named = F.when(takes_part, F.col("digest")).alias("digest")
        firsts = rows.select(named, "page_id", "row").join(
            originals.select(F.col("digest").alias("of"), "original"), (F.col("digest") == F.col("of")) & (F.col("page_id") == F.col("original"))
        )
        firsts = firsts.groupBy("digest").agg(F.min("row").alias("original_row"))
        originals = durable(originals.join(firsts, "digest"))
    else:
        originals = originals.withColumn("original_row", F.lit(0).cast("long"))
    total = int(originals.agg(F.sum("n")).first()[0] or 0)
    # Small payloads, and pages without an id, never refer to another page.
    named = rows.withColumn("group", F.when(takes_part, F.col("digest"))).withColumn("deal", F.xxhash64("page_id", "url", "row"))
    groups = originals.select(F.col("digest").alias("group"), "n", "original", "original_row")
    joined = attach(named, groups, "group", "n", total, "deal")
    is_original = (F.col("page_id") == F.col("original")) & (F.col("row") == F.col("original_row"))
    again = F.col("original").isNotNull() & ~is_original
    return joined.select(
        "page_id",
        "url",
        F.when(again, "").otherwise(F.col("payload")).alias("payload"),
        "bytes",
        "digest",
        # Records of pages without an id are told apart by their url and digest.
        F.when(F.col("page_id").isNull(), F.concat_ws("/", F.xxhash64("url").cast("string"), "digest"))
        .when(again & (F.col("page_id") == F.col("original")), F.col("row").cast("string"))
        .otherwise("0")
        .alias("copy"),
        F.when(again, F.col("original")).alias("refers_to"),
    )


def record(resolved: DataFrame, date: str = RECORD_DATE) -> Column:
    """The record of each resolved page, without its last line end."""
    again = F.col("refers_to").isNotNull()
    safe_url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(again, "").otherwise(F.col("payload")))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("copy"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", safe_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(again, _record_id(F.col("refers_to"), F.lit("0")))),
        line("WARC-Profile", F.when(again, PROFILE)),
        line(PAGE_FIELD, F.col("page_id").cast("string")),
        line("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
        line(LENGTH_FIELD, F.col("bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
        F.lit("\r\n"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = MIN_BYTES,
) -> None:
    """Write deduplicated archives of all pages into ``folder``."""
    records = resolve(pages, key, url, payload, min_bytes)
    # Payloads move once, in the join; adaptive execution sizes its partitions, and so the files.
    records.select(record(records).alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(folder)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        at = start + int(fields["Content-Length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} has another length than it says")
        yield fields, data[start:at]
        at += 4


def describe(fields: dict[str, str], block: bytes) -> tuple:
    """The row of one record; a response's length and digest are those of the bytes read."""
    kind, length = fields["WARC-Type"], int(fields[LENGTH_FIELD])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, length):
            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    refers = fields.get("X-Refers-To-Page-Id")
    page = fields.get(PAGE_FIELD)
    return None if page is None else int(page), length, digest, kind, None if refers is None else int(refers), fields.get("WARC-Target-URI")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, in the fields of ``SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for content in batch.column(0):
                columns = zip(*(describe(*r) for r in parse(content.as_py())), strict=True)
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                if arrays:
                    yield pa.RecordBatch.from_arrays(arrays, names)

    files = spark.read.format("binaryFile").load(folder).where(F.col("length") > 0)
    return files.select("content").mapInArrow(run, SCHEMA)


def archived_and_read(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", **options) -> DataFrame:
    """Write archives into the shared folder and read all records back."""
    folder = shared_path(pages.sparkSession, "archives")
    write_archives(pages, folder, key, url, payload, **options)
    return read_archives(pages.sparkSession, folder)
