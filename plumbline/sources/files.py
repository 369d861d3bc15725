"""CSV, parquet and JSON forms of tables, matrices, models and reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import whole_number
from plumbline.sources import csv_records, ledger

# Texts that stand for a missing cell in a CSV file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
OBJECT_STORE_TOKENS = [*NULL_TOKENS, "na"]


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
    null_tokens: Sequence[str] = NULL_TOKENS, strict: bool = True, multi_line: bool = True,
) -> DataFrame:
    """CSV with a header and a declared schema; ``path`` may be a glob or an ``s3a://`` prefix.

    Columns are found by name: further ones stay as text behind the declared ones, for checks
    to report, and a missing one is an error. Quotes inside a cell are doubled. Cells may hold line
    breaks: a look at all lines tells whether any does, and either way several tasks read a
    file. Switch ``multi_line`` off for files known to hold one record per line, to spare that look.

    Spark's reader knows one null text, so cells are read as text and cast here. Whole numbers may
    be written with a zero fraction or an exponent. A cell that is neither a null text nor of its
    type is an error, or null if not ``strict``; no number that is none comes out.
    """
    raw = _text_cells(spark, path, multi_line)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    declared = {f.name for f in schema.fields}
    further = [F.col(f"`{name}`") for name in raw.columns if name not in declared]
    return raw.select(*[_cell(f, null_tokens, strict) for f in schema.fields], *further)


#: Quotes are doubled inside cells, and blanks belong to them.
CELLS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _text_cells(spark: SparkSession, path: str | Sequence[str], multi_line: bool) -> DataFrame:
    """All cells as text."""
    def reader(whole_files: bool) -> DataFrame:
        return spark.read.options(**CELLS).csv(path, header=True, inferSchema=False, multiLine=whole_files)

    if not multi_line:
        return reader(False)
    lines = csv_records.lines_of(spark, path)
    if not csv_records.needs_joining(lines):
        return reader(False)
    whole = reader(True)  # of this only the header is read, unless there are too many splits
    records = csv_records.records_of(lines)
    if records is None or not whole.columns:
        return whole
    names = ", ".join("`" + name.replace("`", "``") + "` STRING" for name in whole.columns)
    return records.select(F.from_csv("record", names, CELLS).alias("cells")).select("cells.*")


def _cell(f: T.StructField, null_tokens: Sequence[str], strict: bool) -> Column:
    """A text cell as a value of the field's type."""
    cell = F.when(~F.col(f.name).isin(list(null_tokens)), F.col(f.name))
    if isinstance(f.dataType, T.IntegralType):
        value = whole_number(cell, f.dataType.simpleString())
    else:
        value = cell.try_cast(f.dataType)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    if strict:
        no_number = F.lower(F.trim(cell)).isin("nan", "+nan", "-nan")
        bad = F.raise_error(F.concat(F.lit(f"column {f.name}: not of type {f.dataType.simpleString()}: "), cell))
        value = F.when(cell.isNotNull() & value.isNull() & ~no_number, bad.cast(f.dataType)).otherwise(value)
    return value.alias(f.name)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV part files with a header; nulls as empty cells, blanks and line breaks kept."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def snapshot(df: DataFrame, base: str, run_id: str) -> str:
    """Store a raw table under its run; returns the path of this run's rows.

    A run writes only its own folder, so a repeated attempt replaces its own rows, and only once it has them all.
    """
    path = f"{base}/run_id={run_id}"
    draft = f"{base}/.draft-{uuid.uuid4().hex}"
    df.write.parquet(draft)
    ledger.replace_folder(df.sparkSession, draft, path)
    return path


def read_snapshot(spark: SparkSession, base: str, run_id: str | None = None) -> DataFrame:
    """All runs with their ``run_id``, or one run through partition pruning."""
    # The run id is text even where it looks like a number: "01" must not become 1.
    found = spark.read.parquet(base).schema
    schema = T.StructType([T.StructField("run_id", T.StringType()) if f.name == "run_id" else f
                           for f in found.fields])
    runs = spark.read.schema(schema).parquet(base)
    return runs if run_id is None else runs.filter(F.col("run_id") == run_id)


def write_matrix(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature vector and label (and key) as parquet."""
    df.write.mode(mode).parquet(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def named_matrix(df: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """A vector column spread into named doubles."""
    rest = [F.col(name) for name in df.columns if name != vector]
    cells = F.col("__cells")
    spread = df.withColumn("__cells", vector_to_array(vector))
    return spread.select(*rest, *[cells[i].alias(name) for i, name in enumerate(names)])


def write_report(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Report rows as JSON lines (or parquet)."""
    df.write.mode(mode).format(fmt).save(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


#: A report as one document: sections, in them columns, in them metrics. Rows without a column stand under the empty name.
DOCUMENT = "map<string,map<string,map<string,struct<value:double,text:string>>>>"


def nested(report: DataFrame) -> DataFrame:
    """Report rows ``(section, column_name, metric, value, text)`` as one row with a ``document`` of nested maps.

    A report has a few rows per column of the table it is about, whatever the size of the table. A metric that stands
    twice in one place is an error.
    """
    def folded(df: DataFrame, keys: list[str], name: str, value: Column) -> DataFrame:
        return df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(name), value))).alias("inner"))

    rows = report.withColumn("column_name", F.coalesce("column_name", F.lit("")))
    rows = folded(rows, ["section", "column_name"], "metric", F.struct(F.col("value"), F.col("text")).alias("inner"))
    rows = folded(rows, ["section"], "column_name", F.col("inner"))
    return folded(rows, [], "section", F.col("inner")).select(F.col("inner").alias("document"))


def flattened(documents: DataFrame) -> DataFrame:
    """The rows of ``nested`` documents again."""
    rows = documents.select(F.explode("document").alias("section", "columns"))
    rows = rows.select("section", F.explode("columns").alias("column_name", "metrics"))
    rows = rows.select("section", F.when(F.col("column_name") != "", F.col("column_name")).alias("column_name"),
                       F.explode("metrics").alias("metric", "cell"))
    return rows.select("section", "column_name", "metric", "cell.value", "cell.text")


def write_document(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report rows as one nested JSON document in one file."""
    document = nested(report).select(F.to_json("document", {"pretty": "true"}).alias("value"))
    document.coalesce(1).write.mode(mode).text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a nested report document."""
    return flattened(spark.read.text(path, wholetext=True).select(F.from_json("value", DOCUMENT).alias("document")))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
