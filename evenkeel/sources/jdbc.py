"""Databases over JDBC: windowed, counted and partitioned reads, bulk writes.

The option builders are plain functions, so what is sent to the database can be checked without one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from evenkeel.errors import ConfigError
from evenkeel.functions.names import qualified, safe_name
from evenkeel.operators.columns import coerce_complex_to_json
from evenkeel.sources.window import fill_template, is_expression, iso_utc
from evenkeel.spec import FETCH_SIZE, JDBC_PARTITIONS, WRITE_BATCH_SIZE


@dataclass(frozen=True)
class JdbcSource:
    """A database. ``options`` holds user, password, driver and whatever else its driver wants; the
    session of the database should run in UTC. ``time_literal`` is how it writes an instant."""

    url: str
    options: dict[str, str] = field(default_factory=dict)
    time_literal: str = "TIMESTAMPTZ '{}'"
    fetch_size: int = FETCH_SIZE

    def read_options(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": str(self.fetch_size), **self.options}


def quoted(column: str, kind: str) -> str:
    """A column as the database reads it, so that upper and lower case stay apart."""
    return f'"{safe_name(column, kind)}"'


def where_clause(source: JdbcSource, filter_column: str | None, start: datetime, end: datetime, trusted: bool = False) -> str:
    """The window as SQL for the database."""
    if filter_column is None:
        return "1 = 1"
    if is_expression(filter_column):
        if not trusted:
            raise ConfigError(f"filter expression is not marked as trusted: {filter_column!r}")
        return fill_template(filter_column, start, end)
    column = quoted(filter_column, "filter column")
    low, high = (source.time_literal.format(iso_utc(ts)) for ts in (start, end))
    return f"{column} >= {low} AND {column} < {high}"


def windowed_query(source: JdbcSource, schema: str, table: str, filter_column: str | None,
                   start: datetime, end: datetime, trusted: bool = False) -> str:
    return f"SELECT * FROM {qualified(schema, table)} WHERE {where_clause(source, filter_column, start, end, trusted)}"


def read_windowed(spark: SparkSession, source: JdbcSource, schema: str, table: str, filter_column: str | None,
                  start: datetime, end: datetime, trusted: bool = False) -> DataFrame:
    """The rows of the window; the database applies it."""
    query = windowed_query(source, schema, table, filter_column, start, end, trusted)
    return spark.read.format("jdbc").options(**source.read_options()).option("dbtable", f"({query}) windowed").load()


def read_windowed_count(spark: SparkSession, source: JdbcSource, schema: str, table: str, filter_column: str | None,
                        start: datetime, end: datetime, trusted: bool = False) -> DataFrame:
    """The number of rows of the window; the database counts them."""
    where = where_clause(source, filter_column, start, end, trusted)
    query = f"(SELECT COUNT(*) AS n FROM {qualified(schema, table)} WHERE {where}) counted"
    return spark.read.format("jdbc").options(**source.read_options()).option("dbtable", query).load()


def windowed_split_options(source: JdbcSource, schema: str, table: str, filter_column: str | None, start: datetime, end: datetime,
                           column: str, low, high, num_partitions: int = JDBC_PARTITIONS, trusted: bool = False) -> dict[str, str]:
    """Options of a read that takes the window in ranges of a column, each by a connection of its own."""
    query = windowed_query(source, schema, table, filter_column, start, end, trusted)
    return {"dbtable": f"({query}) windowed", **partition_options(column, low, high, num_partitions)}


def bounds_query(source: JdbcSource, schema: str, table: str, filter_column: str | None, start: datetime, end: datetime,
                 column: str, trusted: bool = False) -> str:
    split, where = quoted(column, "partition column"), where_clause(source, filter_column, start, end, trusted)
    return f"(SELECT MIN({split}) AS lo, MAX({split}) AS hi FROM {qualified(schema, table)} WHERE {where}) bounds"


def read_windowed_split(spark: SparkSession, source: JdbcSource, schema: str, table: str, filter_column: str | None, start: datetime,
                        end: datetime, column: str, num_partitions: int = JDBC_PARTITIONS, trusted: bool = False) -> DataFrame:
    """The rows of the window, read in ``num_partitions`` ranges of a column between its bounds in the window."""
    query = bounds_query(source, schema, table, filter_column, start, end, column, trusted)
    low, high = spark.read.format("jdbc").options(**source.read_options()).option("dbtable", query).load().first()
    options = windowed_split_options(source, schema, table, filter_column, start, end, column, low, high, num_partitions, trusted)
    return spark.read.format("jdbc").options(**source.read_options()).options(**options).load()


def partition_options(column: str, low, high, num_partitions: int = JDBC_PARTITIONS) -> dict[str, str]:
    """Options for a split read; none if the table is empty or the column holds only nulls."""
    if low is None or high is None:
        return {}
    return {
        "partitionColumn": quoted(column, "partition column"),
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(num_partitions),
    }


def read_partitioned(spark: SparkSession, source: JdbcSource, schema: str, table: str, column: str,
                     num_partitions: int = JDBC_PARTITIONS) -> DataFrame:
    """A whole table, read in ``num_partitions`` ranges between the column's smallest and largest value."""
    name, split = qualified(schema, table), quoted(column, "partition column")
    reader = spark.read.format("jdbc").options(**source.read_options())
    bounds = reader.option("dbtable", f"(SELECT MIN({split}) AS lo, MAX({split}) AS hi FROM {name}) bounds").load().first()
    reader = spark.read.format("jdbc").options(**source.read_options()).option("dbtable", name)
    return reader.options(**partition_options(column, bounds[0], bounds[1], num_partitions)).load()


def discover_tables(spark: SparkSession, source: JdbcSource, schema: str) -> DataFrame:
    """Names of the base tables of a schema."""
    query = (
        "(SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{safe_name(schema, 'schema')}' AND table_type = 'BASE TABLE') found"
    )
    return spark.read.format("jdbc").options(**source.read_options()).option("dbtable", query).load().orderBy("table_name")


def write_options(source: JdbcSource, table: str, mode: str, batch_size: int = WRITE_BATCH_SIZE) -> dict[str, str]:
    if mode not in ("overwrite", "append"):
        raise ConfigError(f"unknown write mode {mode!r}; known: overwrite, append")
    options = {"url": source.url, "dbtable": table, "batchsize": str(batch_size), **source.options}
    if mode == "overwrite":
        options["truncate"] = "false"
    return options


def write_table(df: DataFrame, source: JdbcSource, schema: str, table: str, mode: str = "overwrite",
                batch_size: int = WRITE_BATCH_SIZE) -> None:
    """Bulk-write a frame; arrays, maps and structs go out as JSON text."""
    options = write_options(source, qualified(schema, table), mode, batch_size)
    coerce_complex_to_json(df).write.format("jdbc").options(**options).mode(mode).save()
