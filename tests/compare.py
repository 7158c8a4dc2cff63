"""Run a query and its SQL check side by side and compare all values."""

from __future__ import annotations

import math
import sys
import time
import traceback
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def difference(df, connection, sql: str) -> str | None:
    """None when columns, types of values and all rows agree."""
    result = connection.execute(sql)
    wanted_columns = [c[0] for c in result.description]
    wanted = rows_of(wanted_columns, result.fetchall())
    found = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(wanted_columns):
        return f"columns {sorted(df.columns)} vs {sorted(wanted_columns)}"
    if len(found) != len(wanted):
        return f"rows {len(found)} vs {len(wanted)}"
    bad = [(a, b) for a, b in zip(found, wanted) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}"[:1500] if bad else None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as driver
    from tests.session import make_session

    spark, connection = make_session(), connect(sf_dir)
    failed = 0
    for name, query in driver.queries().items():
        if names and name not in names:
            continue
        started = time.monotonic()
        try:
            df, sql = query(spark, sf_dir), driver.oracle_sql().get(name)
            problem = difference(df, connection, sql) if sql else f"({len(df.collect())} rows)"
            if not sql:
                print(f"rows  {name} {time.monotonic() - started:.1f}s {problem}", flush=True)
                continue
        except Exception:
            problem = traceback.format_exc()[-1500:]
        failed += problem is not None
        print(f"{'ok   ' if problem is None else 'FAIL '} {name} {time.monotonic() - started:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
