"""Drift between a reference and a current sample by means and category shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import ratio
from plumbline.operators.contract import Contract
from plumbline.shared import melt, tall

MEAN_THRESHOLD = 0.2
CATEGORY_THRESHOLD = 0.1


def both_sides(ref: DataFrame, cur: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """Cells of both samples as ``(column_name, value, is_ref)``.

    Stacking the samples lets one grouping align them, where joining two grouped
    tables would shuffle twice.
    """
    return (tall(ref, cols, kind).withColumn("is_ref", F.lit(True))
            .unionAll(tall(cur, cols, kind).withColumn("is_ref", F.lit(False))))


def side_counts(ref: DataFrame, cur: DataFrame, cols: Sequence[str], kind: str = "string") -> DataFrame:
    """``(column_name, value, n_ref, n_cur)`` over the union of values; absent counts as 0."""
    return (both_sides(ref, cur, cols, kind).groupBy("column_name", "value")
            .agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur")))


def _shared(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> list[str]:
    return [col for col in cols if col in ref.columns and col in cur.columns]


def _difference(ref_mean: Column, cur_mean: Column, denominator: str) -> Column:
    if denominator not in ("signed", "abs"):
        raise ValueError(f"unknown denominator {denominator!r}")
    below = F.abs(ref_mean) if denominator == "abs" else ref_mean
    gap = F.abs(ref_mean - cur_mean)
    return F.when(ref_mean != 0, gap / F.nullif(below, F.lit(0.0))).otherwise(gap)


def mean_drift(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = MEAN_THRESHOLD,
    denominator: str = "signed",
) -> DataFrame:
    """Relative change of each mean. With the signed denominator a negative reference mean
    gives a negative score, which never drifts; ``abs`` mends that."""
    cols = _shared(ref, cur, cols)
    as_double = [F.col(col).cast("double").alias(col) for col in cols]
    stacked = (ref.select(*as_double, F.lit(True).alias("is_ref"))
               .unionAll(cur.select(*as_double, F.lit(False).alias("is_ref"))))
    paired = stacked.agg(
        *[F.avg(F.when(F.col("is_ref"), F.col(col))).alias(f"r{i}") for i, col in enumerate(cols)],
        *[F.avg(F.when(~F.col("is_ref"), F.col(col))).alias(f"c{i}") for i, col in enumerate(cols)])
    entries = []
    for i, col in enumerate(cols):
        score = _difference(F.col(f"r{i}"), F.col(f"c{i}"), denominator)
        entries.append((col, F.col(f"r{i}"), F.col(f"c{i}"), score,
                        F.coalesce((score > F.lit(threshold)) & ~F.isnan(score), F.lit(False))))
    return melt(paired, ["column_name", "reference_mean", "current_mean", "score", "drifted"], entries)


def category_shares(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, value, ref_share, cur_share)`` of the non-null values.

    A column without any value on a side has share 0 everywhere on that side. Null
    cells give one row per column with share 0, so that no column goes missing.
    """
    counted = side_counts(ref, cur, _shared(ref, cur, cols))
    known = F.col("value").isNotNull()
    totals = counted.groupBy("column_name").agg(
        F.sum(F.when(known, F.col("n_ref"))).alias("t_ref"),
        F.sum(F.when(known, F.col("n_cur"))).alias("t_cur"))

    def share(n: str, total: str) -> Column:
        return F.when(known, F.coalesce(ratio(F.col(n), F.col(total)), F.lit(0.0))).otherwise(F.lit(0.0))

    # The totals have one row per compared column.
    return counted.join(F.broadcast(totals), "column_name").select(
        "column_name", "value",
        share("n_ref", "t_ref").alias("ref_share"), share("n_cur", "t_cur").alias("cur_share"))


def category_drift(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = CATEGORY_THRESHOLD,
) -> DataFrame:
    """Total variation distance of the category shares of each column."""
    return (category_shares(ref, cur, cols).groupBy("column_name")
            .agg((F.lit(0.5) * F.sum(F.abs(F.col("ref_share") - F.col("cur_share")))).alias("score"))
            .withColumn("drifted", F.col("score") > F.lit(threshold)))


def category_distributions(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    return category_shares(ref, cur, cols).filter(F.col("value").isNotNull())


def basic_drift(
    ref: DataFrame, cur: DataFrame, contract: Contract, mean_threshold: float = MEAN_THRESHOLD,
    category_threshold: float = CATEGORY_THRESHOLD, denominator: str = "signed",
) -> DataFrame:
    """One row per column with its score; ``dataset_drift`` is true if any column drifted.

    An error is raised as such: it never turns into a "no drift" answer.
    """
    numeric = (mean_drift(ref, cur, contract.numeric, mean_threshold, denominator)
               .select("column_name", F.lit("mean_difference").alias("method"), "score", "drifted"))
    categorical = (category_drift(ref, cur, contract.categorical, category_threshold)
                   .select("column_name", F.lit("total_variation").alias("method"), "score", "drifted"))
    rows = numeric.unionAll(categorical)
    # The window holds one row per column of the contract, whatever the size of the data.
    return rows.withColumn("dataset_drift", F.bool_or("drifted").over(Window.partitionBy(F.lit(1))))
