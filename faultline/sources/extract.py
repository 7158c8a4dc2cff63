"""Extraction of a list of tables, each isolated from the failure of the others."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultline.sources.jdbc import projected

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableSpec:
    """A table to extract: its name, the columns in contract, and its output folder."""

    name: str
    columns: Sequence[str]
    output: str


def extract_tables(
    spark: SparkSession,
    tables: Sequence[TableSpec],
    load: Callable[[TableSpec], DataFrame],
    mode: str = "overwrite",
) -> DataFrame:
    """Write every table as parquet and report ``(table, rows, ok, error, seconds)``."""
    report = []
    for spec in tables:
        started = time.monotonic()
        rows, error = None, None
        try:
            count = Observation()
            table = projected(load(spec), spec.columns)
            table.observe(count, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(spec.output)
            rows = count.get["rows"]
        except Exception as problem:
            LOG.exception("extract of %s failed", spec.name)
            error = str(problem)
        report.append((spec.name, rows, error is None, error, time.monotonic() - started))
    return spark.createDataFrame(
        report, "table string, rows long, ok boolean, error string, seconds double"
    )
