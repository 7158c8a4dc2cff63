"""CSV dialects, the append cache, versioned outputs and file discovery."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.scalars import CSV_NULL_MARKERS
from faultline.operators.cleaning import clean_markers, convert_types, without_header_rows


@dataclass(frozen=True)
class CsvDialect:
    """Separator and quoting of a CSV family. Quoted line breaks are always read."""

    separator: str = ","
    header: bool = True
    quote_all: bool = False
    encoding: str = "UTF-8"
    byte_order_mark: bool = False  # written before the header of every part file; readers drop it

    def read_options(self) -> dict[str, object]:
        return {
            "sep": self.separator,
            "header": self.header,
            "multiLine": True,
            "quote": '"',
            "escape": '"',
            "encoding": self.encoding,
        }

    def write_options(self) -> dict[str, object]:
        return {
            "sep": self.separator,
            "header": self.header,
            "quoteAll": self.quote_all,
            # the writer would strip blanks at the ends of a field
            "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False,
            "quote": '"',
            "escape": '"',
            "encoding": self.encoding,
        }


# The file families in use.
COMMA = CsvDialect()
COMMA_QUOTED = CsvDialect(quote_all=True)
SEMICOLON = CsvDialect(separator=";")
NOT_SIGN = CsvDialect(separator="¬", byte_order_mark=True)
CATALOGUE_COLUMNS = ("ID_ERROR", "CODCAR3", "CODCAR2", "DESCFAM", "MOTIVO", "DESCRIPCION")


def read_text_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    dialect: CsvDialect = COMMA,
    columns: Sequence[str] | None = None,
    markers: Sequence[str] = CSV_NULL_MARKERS,
) -> DataFrame:
    """CSV with every column as text and null markers as null.

    ``columns`` renames by position; for a file without header it also is the schema.
    """
    reader = spark.read.options(**dialect.read_options())
    if columns is not None and not dialect.header:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    table = reader.csv(path)
    if columns is not None:
        table = table.toDF(*columns)
    return clean_markers(table, markers)


def read_typed_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    dtypes: Mapping[str, str],
    dialect: CsvDialect = COMMA,
) -> DataFrame:
    """CSV with column types from ``{column: dtype}``; unreadable values are null."""
    return convert_types(read_text_csv(spark, path, dialect), dtypes)


def read_translation_csv(
    spark: SparkSession, path: str, field: str, dialect: CsvDialect = NOT_SIGN
) -> DataFrame:
    """Translation file, without the header lines that appended batches repeat."""
    return without_header_rows(read_text_csv(spark, path, dialect), f"{field}_translated")


def read_catalogue(
    spark: SparkSession, path: str, columns: Sequence[str] = CATALOGUE_COLUMNS
) -> DataFrame:
    """Error catalogue with canonical column names, whatever its header says."""
    return read_text_csv(spark, path, SEMICOLON, columns)


def write_csv(df: DataFrame, path: str, dialect: CsvDialect = COMMA, mode: str = "error") -> None:
    """CSV part files; missing parent folders are created."""
    if dialect.byte_order_mark and dialect.header and not dialect.quote_all:
        # The header is the first thing written to a file, so the mark goes with its first name.
        df = df.toDF("\ufeff" + df.columns[0], *df.columns[1:])
    df.write.mode(mode).options(**dialect.write_options()).csv(path)


def append_cache(df: DataFrame, path: str) -> None:
    """Append a batch to a parquet cache; the first batch creates it."""
    df.write.mode("append").parquet(path)


def read_cache(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A cache that may not exist yet, then as an empty table."""
    folder = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        present = not folder.load(path).select("path").isEmpty()
    except Exception as problem:  # AnalysisException: path does not exist
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        present = False
    if present:
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def write_version(df: DataFrame, path: str, version: str, column: str = "data_version") -> None:
    """Write one version of a data set; other versions in the folder stay."""
    df.withColumn(column, F.lit(version)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(column).parquet(path)


def read_version(
    spark: SparkSession, path: str, version: str, column: str = "data_version"
) -> DataFrame:
    """One version; only its folder is read."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(version))


def find_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Files below a folder with a suffix, case-sensitive; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(path)
        .select("path", "length", "modificationTime")
    )
