"""JDBC scans: one option builder per database, with column and row pruning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

# Driver classes and URL forms of the four databases.
DRIVERS = {
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
    "clickhouse": "com.clickhouse.jdbc.ClickHouseDriver",
}
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "oracle": "jdbc:oracle:thin:@{host}:{port}/{database}",
    "clickhouse": "jdbc:clickhouse://{host}:{port}/{database}?ssl=true",
}
PORTS = {"sqlserver": 1433, "mysql": 3306, "oracle": 1521, "clickhouse": 8443}


@dataclass(frozen=True)
class Database:
    """Connection of one database; the password never shows in its text form."""

    kind: str
    host: str
    database: str
    user: str
    password: str = field(repr=False)
    port: int | None = None
    instance: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in DRIVERS:
            raise ValueError(f"unknown database kind {self.kind!r}")
        if not self.database and self.kind != "clickhouse":
            raise ValueError("a database name is required")

    @property
    def url(self) -> str:
        port = self.port or PORTS[self.kind]
        if self.kind == "sqlserver":
            name = f";instanceName={self.instance}" if self.instance else ""
            return f"jdbc:sqlserver://{self.host}:{port};databaseName={self.database}{name}"
        return URLS[self.kind].format(host=self.host, port=port, database=self.database)

    def options(
        self,
        table: str | None = None,
        query: str | None = None,
        split: tuple[str, object, object, int] | None = None,
        fetch_size: int = 10_000,
    ) -> dict[str, str]:
        """Reader options for a table or a query.

        ``split`` is ``(column, lower, upper, partitions)``. Spark splits ``dbtable``
        reads only, so a split query is passed as a derived table.
        """
        if (table is None) == (query is None):
            raise ValueError("give either a table or a query")
        options = {
            "url": self.url,
            "driver": DRIVERS[self.kind],
            "user": self.user,
            "password": self.password,
            "fetchsize": str(fetch_size),
        }
        if split is None:
            options |= {"dbtable": table} if table else {"query": query}
            return options
        column, lower, upper, partitions = split
        return options | {
            "dbtable": table or f"({query}) q",
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }


def read_query(
    spark: SparkSession, database: Database, query: str, split: tuple | None = None
) -> DataFrame:
    """Rows of a query; failures raise."""
    return spark.read.format("jdbc").options(**database.options(query=query, split=split)).load()


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    split: tuple | None = None,
) -> DataFrame:
    """Projected and filtered scan; Spark pushes both into the source."""
    rows = spark.read.format("jdbc").options(**database.options(table=table, split=split)).load()
    return projected(rows, columns, where)


def projected(
    rows: DataFrame, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Filter, then the configured columns; a missing column raises."""
    if where is not None:
        rows = rows.where(where)
    if columns is None:
        return rows
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows.select(*columns)


def parse_dates(rows: DataFrame, formats: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Read date columns of a query result; a mapping names the format per column."""
    from pyspark.sql import functions as F

    from faultline.functions.scalars import to_timestamp

    if isinstance(formats, Mapping):
        dates = {c: F.try_to_timestamp(F.col(c), F.lit(f)) for c, f in formats.items()}
    else:
        dates = {c: to_timestamp(c) for c in formats}
    return rows.withColumns(dates)
