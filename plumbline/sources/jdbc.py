"""Relational tables over JDBC, read in parallel ranges of a key column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.contract import normalise_nulls

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Partitioning:
    """Parallel ranges of a numeric key; the bounds shape the ranges and drop no row."""

    column: str
    lower: int
    upper: int
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower),
                "upperBound": str(self.upper), "numPartitions": str(self.partitions)}


def qualified(table: str, schema: str | None) -> str:
    """``schema.table``; the schema is a name of its own, not part of the table name."""
    return f"{schema}.{table}" if schema else table


def clean_url(url: str) -> str:
    """The URL without blanks around it and without the pair of quotes that a settings file puts there.

    A quote without its partner belongs to the URL and stays.
    """
    url = url.strip()
    quoted = len(url) > 1 and url[0] == url[-1] and url[0] in "'\""
    return clean_url(url[1:-1]) if quoted else url


def read_options(
    url: str, table: str, schema: str | None = None, partitioning: Partitioning | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {"url": clean_url(url), "dbtable": qualified(table, schema), "fetchsize": str(FETCH_ROWS)}
    if partitioning:
        options.update(partitioning.options())
    options.update(properties or {})
    return options


def read_table(
    spark: SparkSession, url: str, table: str, schema: str | None = None,
    partitioning: Partitioning | None = None, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table; filters and column choice of later steps run in the database. NaN becomes null.

    Without ``partitioning`` one task reads everything, which suits small tables only.
    """
    return normalise_nulls(spark.read.format("jdbc").options(
        **read_options(url, table, schema, partitioning, properties)).load())


def key_range(
    spark: SparkSession, url: str, table: str, key: str, schema: str | None = None,
    partitions: int = 64, properties: Mapping[str, str] | None = None,
) -> Partitioning:
    """Ask the database for the ends of the key and cut them into ranges."""
    query = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {qualified(table, schema)}"
    row = spark.read.format("jdbc").options(url=clean_url(url), query=query, **(properties or {})).load().first()
    lo, hi = row[0] or 0, row[1] or 0
    return Partitioning(key, lo, hi + 1, partitions)


def write_table(
    df: DataFrame, url: str, table: str, schema: str | None = None, mode: str = "replace",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write rows with mode ``replace``, ``append`` or ``fail``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    df.write.jdbc(clean_url(url), qualified(table, schema), mode=MODES[mode], properties=dict(properties or {}))


def list_tables(
    spark: SparkSession, url: str, schema: str = "public", properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table names of a schema, filtered by the database."""
    return (read_table(spark, url, "tables", "information_schema", properties=properties)
            .filter(F.col("table_schema") == F.lit(schema)).select("table_name"))


def list_catalog_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables and views that the Spark catalog knows."""
    return sorted(table.name for table in spark.catalog.listTables(database))
