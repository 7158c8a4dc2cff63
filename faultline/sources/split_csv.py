"""CSV with quoted line breaks, read by several tasks a file.

A byte range may begin inside a quoted field, so where its first record starts depends on all quotes before it. The first
pass counts the quotes of every range; whether a range begins inside quotes is the parity of those before it in its file. In
the second pass each task joins its lines to records. Only what its borders cut, at most two pieces a range, is
put together afterwards; every other record stays in its task. Records are then parsed by Spark's own parser.

Quotes stand around whole fields and are doubled inside, as the writers of these files do; breaks inside them are kept as
they are. Files are in UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.plans.durable import durable
from faultline.plans.sizing import is_small

MAX_RANGES = 2_000_000  # of 17 bytes each; one is 128 MB or more of text on a cluster
QUOTE = '"'
PIECES = "file long, block long, place int, first boolean, record string"
WHOLE, HEAD, THROUGH, TAIL = 0, 1, 2, 3  # what a piece of a range is


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with the file and range they come from; those of a range are in order and in one task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    file = F.xxhash64("_metadata.file_path").alias("file")
    return lines.select(file, F.col("_metadata.file_block_start").alias("block"), F.coalesce("value", F.lit("")).alias("value"))


def _begins_inside(lines: DataFrame) -> DataFrame:
    """``of, at, inside`` of every range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2 == 1, F.lit(False))
    return durable(odd.select(F.col("file").alias("of"), F.col("block").alias("at"), inside.alias("inside")))


class _Range:
    """Records of one range, line by line."""

    def __init__(self, file: int, block: int, inside: bool) -> None:
        self.file, self.block, self.inside = file, block, inside
        self.open: list[str] = []
        self.began_inside, self.at_start = inside, True
        self.place = 0

    def _piece(self, kind: int) -> tuple:
        record = "\n".join(self.open)
        if kind in (WHOLE, HEAD):
            record = record.removesuffix("\r")
        row = (self.file, self.block, kind, self.block == 0 and self.place == 0, record)
        self.open, self.at_start = [], False
        self.place += 1
        return row

    def add(self, line: str) -> tuple | None:
        if self.block == 0 and self.place == 0 and not self.open:
            line = line.removeprefix("﻿")
        self.open.append(line)
        if line.count(QUOTE) % 2:
            self.inside = not self.inside
        if self.inside:
            return None
        return self._piece(HEAD if self.at_start and self.began_inside else WHOLE)

    def end(self) -> tuple | None:
        """The piece that goes on in the next range."""
        if not self.open:
            return None
        return self._piece(THROUGH if self.at_start and self.began_inside else TAIL)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    current: _Range | None = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for file, block, line, inside in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if current is None or (current.file, current.block) != (file, block):
                if current is not None:
                    rows.append(current.end())
                current = _Range(file, block, inside)
            rows.append(current.add(line))
        yield batch_of([r for r in rows if r is not None])
    if current is not None and (last := current.end()) is not None:
        yield batch_of([last])


def _stitched(pieces: pd.DataFrame) -> pd.DataFrame:
    """Records of one file from the pieces at the borders of its ranges."""
    out, open_piece = [], None
    for row in pieces.sort_values(["block", "place"]).itertuples(index=False):
        if row.place == TAIL:
            open_piece = (row.first, [row.record])
            continue
        first, parts = open_piece or (row.first, [])
        parts.append(row.record)
        if row.place == THROUGH:
            open_piece = (first, parts)
        else:
            out.append((first, "\n".join(parts)))
            open_piece = None
    if open_piece:  # quotes never closed: the rest of the file is the last field
        out.append((open_piece[0], "\n".join(open_piece[1])))
    return pd.DataFrame(out, columns=["first", "record"])


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``record`` and whether it is the ``first`` of its file, in no order; empty lines are left out."""
    lines = _lines(spark, path)
    begins = _begins_inside(lines)
    if not is_small(begins, MAX_RANGES):
        raise ValueError(f"more than {MAX_RANGES} ranges: read larger ones by spark.sql.files.maxPartitionBytes")
    same = (F.col("file") == F.col("of")) & (F.col("block") == F.col("at"))
    # A broadcast join keeps the lines in order.
    marked = lines.join(F.broadcast(begins), same).select("file", "block", "value", "inside")
    pieces = durable(marked.mapInArrow(_pieces, PIECES))
    whole = pieces.where(F.col("place") == WHOLE).select("first", "record")
    # A file has at most two such pieces a range.
    cut = pieces.where(F.col("place") != WHOLE).groupBy("file").applyInPandas(_stitched, "first boolean, record string")
    return whole.unionByName(cut).where("record != ''")


def read_split_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    separator: str = ",",
    header: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A CSV table, every column as text, as the reader for quoted line breaks gives it, but with several tasks a file.

    ``columns`` names the columns by position; else the header of the files does, which must be the same for all.
    """
    records = csv_records(spark, path)
    options = {"sep": separator, "quote": QUOTE, "escape": QUOTE, "maxCharsPerColumn": "-1"}
    if columns is None:
        sample = records.where("first") if header else records
        row = sample.first()
        if row is None:
            return spark.createDataFrame([], "")
        names = _fields(spark, row["record"], options)
        columns = names if header else [f"_c{i}" for i in range(len(names))]
    rows = records.where(~F.col("first")) if header else records
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    parsed = rows.select(F.from_csv("record", schema, options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])


def _fields(spark: SparkSession, record: str, options: dict[str, str]) -> list[str]:
    """The fields of one record: as many as there are separators outside quotes."""
    outside = "".join(record.split(QUOTE)[::2])
    width = outside.count(options["sep"]) + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = spark.range(1).select(F.from_csv(F.lit(record), schema, options).alias("r")).first()["r"]
    return [f"_c{i}" if v is None else v for i, v in enumerate(parsed)]
