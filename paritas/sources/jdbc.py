"""JDBC source (A1, A2): table scans, split into parallel range reads when a numeric
partition column is given, and pushed-down queries.

Credentials are plain reader options supplied by the caller; nothing is looked up here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    fetch_size: int = 10000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "fetchsize": str(self.fetch_size)}
        if self.driver:
            opts["driver"] = self.driver
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        opts.update(self.extra)
        return opts

    def table_options(self, table: str, partition_column: str | None = None, lower_bound: int | None = None,
                      upper_bound: int | None = None, num_partitions: int | None = None) -> dict[str, str]:
        """Options for a scan of ``table``; with a partition column the scan becomes
        ``num_partitions`` parallel range queries instead of one task."""
        opts = self.options() | {"dbtable": table}
        if partition_column:
            if lower_bound is None or upper_bound is None or not num_partitions:
                raise ValueError("a partitioned JDBC scan needs lower_bound, upper_bound and num_partitions")
            opts |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
        return opts

    def query_options(self, sql: str) -> dict[str, str]:
        """Options that ship a whole SELECT to the database (A2)."""
        return self.options() | {"query": sql}

    def table(self, spark: SparkSession, table: str, spread: int | None = None, split_column: str | None = None,
              split_bounds: Sequence[object] | None = None, parts: int | None = None, **partitioning) -> DataFrame:
        """Scan ``table``. Without partition options the read is one task; ``spread`` deals its rows
        round-robin to so many partitions. ``split_column`` makes one range query per part: between
        ``split_bounds``, or, with ``parts``, between quantiles that the database finds, so that a
        column with gaps or hot stretches still gives parts of equal size."""
        if split_column:
            bounds = split_bounds if split_bounds is not None else self.quantiles(spark, table, split_column, parts or 1)
            rest = {k: v for k, v in self.options().items() if k != "url"}
            return spark.read.jdbc(self.url, table, predicates=predicates(split_column, bounds), properties=rest)
        df = spark.read.format("jdbc").options(**self.table_options(table, **partitioning)).load()
        return df.repartition(spread) if spread else df

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.query_options(sql)).load()


    def quantiles(self, spark: SparkSession, table: str, column: str, parts: int) -> list:
        """Bounds between ``parts`` parts of equal size, from one grouped query in the database."""
        return inner_bounds([r[0] for r in self.query(spark, quantile_sql(table, column, parts)).orderBy("bound").collect()])


def quantile_sql(table: str, column: str, parts: int) -> str:
    """The least value of each of ``parts`` equal parts of a column, NULLs left out."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    return (f"SELECT MIN({column}) AS bound FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {table} "
            f"WHERE {column} IS NOT NULL) AS tiles GROUP BY part")


def inner_bounds(least: Sequence[object]) -> list:
    """Bounds between parts from the least value of each part: the first part has none, equal ones count once."""
    return sorted(set(least))[1:]


def _literal(value: object) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError("a bound is a number, a text or a time")
    return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Range conditions that cover every row once: NULLs go with the first part, each bound opens a part."""
    cuts = [_literal(b) for b in bounds]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    return [first, *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])], f"{column} >= {cuts[-1]}"]


def sqlserver_url(host: str, database: str, encrypt: bool = True, trust_server_certificate: bool = True) -> str:
    """``jdbc:sqlserver://host;databaseName=db;…``; options are URL properties, never an interpolated dict."""
    return (f"jdbc:sqlserver://{host};databaseName={database};encrypt={str(encrypt).lower()};"
            f"trustServerCertificate={str(trust_server_certificate).lower()};")
