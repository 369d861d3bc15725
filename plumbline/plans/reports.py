"""Reports that span both samples of a run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.contract import INSURED, Contract
from plumbline.operators.outliers import count_beyond, fence, winsorise
from plumbline.operators.profile import (
    REPORT, REPORT_SCHEMA, correlation_with, describe_values, quality_counts, shape, value_counts,
)
from plumbline.shared import literal_rows, melt

# The columns that the analysis winsorises.
WINSORISED = ("bmi", "charges")


def _as_report(df: DataFrame, section: str, column: str | None, metric, value: str, text=None) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return df.select(
        F.lit(section).alias("section"),
        (F.col(column) if column else nothing).alias("column_name"),
        (metric if not isinstance(metric, str) else F.lit(metric)).alias("metric"),
        F.col(value).cast("double").alias("value"),
        (text if text is not None else nothing).alias("text"))


def analysis_report(
    train: DataFrame, test: DataFrame, contract: Contract = INSURED, exact: bool = True,
) -> DataFrame:
    """Shapes, outliers, correlations of the cleaned data, missing cells, duplicates,
    statistics and category counts of a split, as report rows."""
    numeric = list(contract.numeric)
    parts = []
    for side, df in (("train", train), ("test", test)):
        nothing = F.lit(None).cast("string")
        entries = []
        # Winsorising changes values only, so the cleaned shape is the shape.
        for name in (f"original_{side}_shape", f"cleaned_{side}_shape"):
            entries += [(name, nothing, "rows", F.col("n").cast("double"), nothing),
                        (name, nothing, "columns", F.lit(float(len(df.columns))), nothing)]
        entries.append((f"{side}_duplicates", nothing, "duplicate_rows", F.col("dup").cast("double"), nothing))
        entries += [(f"{side}_missing", name, "missing_count", F.col(f"m{i}").cast("double"), nothing)
                    for i, name in enumerate(df.columns)]
        parts.append(melt(quality_counts(df), REPORT, entries))
        stats = describe_values(df, numeric, exact)
        parts.append(literal_rows(df.sparkSession, REPORT_SCHEMA, [
            (f"{side}_descriptive", col, metric, value, None) for (col, metric), value in stats.items()]))
        # The quartiles of the statistics are the ones that the fences need.
        found = {col: fence(*(stats[col, q] for q in ("25%", "50%", "75%"))) for col in numeric}
        parts.append(_as_report(count_beyond(df, found), f"{side}_outliers",
                                "column_name", "outlier_count", "outlier_count"))
    cleaned = winsorise(train, WINSORISED)
    parts.append(_as_report(correlation_with(cleaned, numeric, contract.target),
                            "correlation_with_target", "column_name", "corr", "corr"))
    counts = value_counts(train, contract.categorical)
    parts.append(_as_report(counts, "categorical_summary", "column_name", "n", "n", F.col("value")))
    return reduce(DataFrame.unionByName, parts).select(*REPORT)


def stage_metrics(stage: str, numbers: dict[str, float], spark, texts: dict[str, str] | None = None) -> DataFrame:
    """Metrics of one stage as rows ``(stage, metric, value, text)``."""
    rows = [(stage, name, float(value), None) for name, value in numbers.items()]
    rows += [(stage, name, None, text) for name, text in (texts or {}).items()]
    return literal_rows(spark, "stage string, metric string, value double, text string", rows)


def sample_metrics(samples: Sequence[tuple[str, DataFrame]], stage: str = "ingest") -> DataFrame:
    """Row and column counts of the samples of a stage, counted by Spark."""
    parts = []
    for name, df in samples:
        parts.append(melt(shape(df), ["stage", "metric", "value", "text"], [
            (stage, f"{name}_samples", F.col("n_rows").cast("double"), F.lit(None).cast("string")),
            (stage, f"{name}_columns", F.col("n_columns").cast("double"), F.lit(",".join(df.columns)))]))
    return reduce(DataFrame.unionByName, parts)
