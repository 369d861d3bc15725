"""Folders and literal rows that several modules need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_folder: dict[str, str] = {}
#: Scratch paths that this process has handed out, by application.
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="plumbline-")
    return _local_folder[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never the same one twice."""
    path = f"{shared_dir(spark)}/plumbline/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete what this session has written below its scratch paths; results read from them end with it.

    For the owner of a session to call once the results are used; returns the number of paths.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name in paths:
        path = hadoop.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``checkpoint()`` and the boosted trees cut their lineage."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def literal_rows(spark: SparkSession, schema: str, rows: Iterable[Sequence]) -> DataFrame:
    """A few driver-side rows (statistics, settings) as a DataFrame."""
    fields = StructType.fromDDL(schema).fields
    rows = list(rows)
    arrow = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "boolean": pa.bool_()}
    columns = [
        pa.array([row[i] for row in rows], type=arrow[field.dataType.simpleString()])
        for i, field in enumerate(fields)
    ]
    return spark.createDataFrame(pa.table(columns, names=[field.name for field in fields]))


def melt(one_row: DataFrame, names: Sequence[str], entries: Iterable[Sequence]) -> DataFrame:
    """Turn a one-row DataFrame into long rows.

    Each entry gives one output row; strings are literals, columns are expressions.
    """
    structs = []
    for entry in entries:
        cells = [cell if isinstance(cell, Column) else F.lit(cell) for cell in entry]
        structs.append(F.struct(*[cell.alias(name) for cell, name in zip(cells, names)]))
    return one_row.select(F.inline(F.array(*structs)))


def tall(df: DataFrame, cols: Sequence[str], as_type: str = "string") -> DataFrame:
    """One ``(column_name, value)`` row per cell, nulls kept, in the same stage as the scan."""
    cells = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast(as_type).alias("value"))
        for name in cols
    ]
    return df.select(F.inline(F.array(*cells)))


def chunks(items: Sequence, size: int) -> list:
    """Consecutive slices, to keep generated code of wide aggregates small."""
    return [items[i:i + size] for i in range(0, len(items), size)]
