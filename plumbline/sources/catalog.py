"""Tables of the session's catalog as source and sink, with the modes of the JDBC sink and no database of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.contract import normalise_nulls
from plumbline.shared import literal_rows
from plumbline.sources.jdbc import MODES, qualified


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """A whole table or view; filters and column choice of later steps reach its files. NaN becomes null."""
    return normalise_nulls(spark.read.table(qualified(table, schema)))


def write_table(df: DataFrame, table: str, schema: str | None = None, mode: str = "replace", path: str | None = None) -> None:
    """Write rows with mode ``replace``, ``append`` or ``fail``; ``path`` keeps a new table outside of the warehouse.

    Appended rows are matched by column name, and other columns than those of the table are an error.
    Replacing a table that is read in the same plan is refused by Spark.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    spark, name = df.sparkSession, qualified(table, schema)
    if mode == "append" and spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if sorted(columns) != sorted(df.columns):
            raise ValueError(f"table {name!r} has the columns {columns}, not {df.columns}")
        df.select(*columns).write.insertInto(name)
        return
    writer = df.write.format("parquet").mode(MODES[mode])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """``(table_name, temporary)`` of the tables and views of a schema, by default the current one."""
    found = spark.catalog.listTables(schema)
    return literal_rows(spark, "table_name string, temporary boolean", [(t.name, t.isTemporary) for t in found])


def describe_columns(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """``(position, column_name, data_type)`` of a table, from 1."""
    fields = spark.table(qualified(table, schema)).schema.fields
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields, 1)]
    return literal_rows(spark, "position bigint, column_name string, data_type string", rows)


def row_counts(spark: SparkSession, tables: list[str], schema: str | None = None) -> DataFrame:
    """``(table_name, n)`` for several tables in one job."""
    counts = [read_table(spark, t, schema).groupBy(F.lit(t).alias("table_name")).agg(F.count(F.lit(1)).alias("n")) for t in tables]
    found = spark.createDataFrame([], StructType.fromDDL("table_name string, n bigint"))
    for one in counts:
        found = found.unionByName(one)
    return found
