"""Outlier fences, winsorising and the tables behind histograms, densities and box plots."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.quantiles import (
    TASK_VALUES, first_look, interpolated, order_statistics,
)
from plumbline.shared import literal_rows, melt

FENCE_WIDTH = 1.5
BOX_QUARTILES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class Fence:
    """Quartiles of a column and the fences around them; all null when undefined."""

    q1: float | None
    median: float | None
    q3: float | None
    low: float | None
    high: float | None


def fences(
    df: DataFrame, cols: Sequence[str], k: float = FENCE_WIDTH, null_policy: str = "skip",
    exact: bool = True, task_values: int = TASK_VALUES,
) -> dict[str, Fence]:
    """Fences at ``k`` interquartile ranges. ``propagate`` gives a column with nulls none."""
    if null_policy not in ("skip", "propagate"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    look = first_look(df, cols, BOX_QUARTILES, [F.count(F.lit(1)).alias("n")])
    usable = [col for col in cols
              if look.counts[col] > 0 and (null_policy == "skip" or look.counts[col] == look.extra["n"])]
    values = interpolated(df, look, usable, BOX_QUARTILES, exact, task_values)
    return {col: fence(*(values[col, p] if col in usable else None for p in BOX_QUARTILES), k) for col in cols}


def fence(q1: float | None, median: float | None, q3: float | None, k: float = FENCE_WIDTH) -> Fence:
    """The fence that follows from the quartiles."""
    if q1 is None or q3 is None:
        return Fence(None, None, None, None, None)
    reach = k * (q3 - q1)
    return Fence(q1, median, q3, q1 - reach, q3 + reach)


def _beyond(col: str, fence: Fence):
    if fence.low is None:
        return F.lit(False)
    x = F.col(col)
    return F.coalesce((x < F.lit(fence.low)) | (x > F.lit(fence.high)), F.lit(False))


def iqr_outliers(
    df: DataFrame, key: str, cols: Sequence[str], k: float = FENCE_WIDTH,
    null_policy: str = "skip", exact: bool = True, task_values: int = TASK_VALUES,
) -> DataFrame:
    """Rows beyond a fence in any column: the key, and one flag per column.

    The fences are literals, so the filter is a plain range predicate over one scan.
    """
    found = fences(df, cols, k, null_policy, exact, task_values)
    hits = [_beyond(col, found[col]) for col in cols]
    return (df.filter(reduce(lambda a, b: a | b, hits))
            .select(key, *[hit.alias(f"{col}_outlier") for col, hit in zip(cols, hits)]))


def outlier_counts(
    df: DataFrame, cols: Sequence[str], k: float = FENCE_WIDTH, null_policy: str = "skip",
    exact: bool = True, task_values: int = TASK_VALUES,
) -> DataFrame:
    """Outliers per column, and under the name ``any`` the rows with at least one."""
    return count_beyond(df, fences(df, cols, k, null_policy, exact, task_values))


def count_beyond(df: DataFrame, found: Mapping[str, Fence]) -> DataFrame:
    """Outlier counts for known fences, from one scan."""
    cols = list(found)
    hits = [_beyond(col, found[col]) for col in cols]
    counted = df.agg(
        F.count_if(reduce(lambda a, b: a | b, hits)).alias("any"),
        *[F.count_if(hit).alias(f"o{i}") for i, hit in enumerate(hits)])
    entries = [(col, F.col(f"o{i}")) for i, col in enumerate(cols)] + [("any", F.col("any"))]
    return melt(counted, ["column_name", "outlier_count"], entries)


def winsorise(
    df: DataFrame, cols: Sequence[str], lower: float = 0.05, upper: float = 0.05,
    task_values: int = TASK_VALUES,
) -> DataFrame:
    """Pull the ``int(lower * n)`` lowest and ``int(upper * n)`` highest values of each
    column to the nearest remaining value. Nulls stay null and are not counted."""
    cols = [col for col in cols if col in df.columns]
    look = first_look(df, cols, (lower, 1.0 - upper))
    counts = look.counts
    filled = [col for col in cols if counts[col] > 0]
    ends = {col: (int(lower * counts[col]), counts[col] - 1 - int(upper * counts[col])) for col in filled}
    near = {(col, rank): look.ends[col, p]
            for col in filled for rank, p in zip(ends[col], (lower, 1.0 - upper))}
    values = order_statistics(
        df, {col: list(pair) for col, pair in ends.items()}, counts, task_values, near)
    clipped = {}
    for col in filled:
        lo, hi = (F.lit(values[col, rank]) for rank in ends[col])
        x = F.col(col)
        kind = df.schema[col].dataType
        # greatest/least skip nulls, so a null must be kept by hand.
        clipped[col] = F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi)).cast(kind)
    return df.withColumns(clipped) if clipped else df


def automatic_bins(df: DataFrame, col: str, task_values: int = TASK_VALUES) -> int:
    """Bin count of numpy's ``auto`` rule: the narrower of the Freedman-Diaconis width
    (at least half the square-root width) and the Sturges width."""
    x = F.col(col).cast("double")
    look = first_look(df, [col], (0.25, 0.75), [(F.max(x) - F.min(x)).alias("span")])
    n, span = look.counts[col], look.extra["span"]
    if not n or not span:
        return 1
    q = interpolated(df, look, [col], (0.25, 0.75), task_values=task_values)
    by_spread = 2.0 * (q[col, 0.75] - q[col, 0.25]) * n ** (-1.0 / 3.0)
    by_size = span / (math.log2(n) + 1.0)
    width = min(max(by_spread, span / math.sqrt(n) / 2.0), by_size)
    if df.schema[col].dataType.typeName() in ("byte", "short", "integer", "long"):
        width = max(width, 1.0)
    return max(math.ceil(span / width), 1)


def histogram(
    df: DataFrame, col: str, bins: int | None = None, task_values: int = TASK_VALUES,
) -> DataFrame:
    """``(bin, lo, hi, n)`` with equal widths, the last bin closed, empty bins kept."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        return literal_rows(df.sparkSession, "bin bigint, lo double, hi double, n bigint", [])
    bins = bins or automatic_bins(df, col, task_values)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    at = F.floor((x - F.lit(lo)) / F.lit(width))
    counted = (df.filter(F.col(col).isNotNull())
               .groupBy(F.least(at, F.lit(bins - 1)).cast("bigint").alias("bin"))
               .agg(F.count(F.lit(1)).alias("n")))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"))


# exp(-x) is exactly 0.0 in double precision from this exponent on.
EXP_UNDERFLOW = 746.0


# Cells per bandwidth, and powers summed in each. The truncated series is off by at most
# 1.1 * sum((1/16)^k / sqrt(k!), k >= 8), that is 2e-12 of the kernel's peak, for any data.
CELLS_PER_BANDWIDTH, POWERS = 8, 8


def density(
    df: DataFrame, col: str, grid: int = 200, bandwidth: float | None = None,
) -> DataFrame:
    """Gaussian kernel density on an even grid from the smallest to the largest value.

    The bandwidth follows Scott's rule unless given. Values are counted in cells of an eighth of a
    bandwidth, as sums of powers of their distance from the middle, combined in the map task. Each cell then
    adds its Hermite series to the grid points that the kernel reaches before it underflows to zero: the
    work is rows plus cells times points, and the result differs from the exact sum by 2e-12 of a kernel's peak at most.
    """
    schema = "x double, density double"
    x = F.col(col).cast("double")
    stats = df.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                   F.stddev_samp(x).alias("std")).first()
    if stats["n"] < 2 or not stats["std"]:
        return literal_rows(df.sparkSession, schema, [])
    n, lo, hi = stats["n"], stats["lo"], stats["hi"]
    h = bandwidth or stats["std"] * n ** (-1.0 / 5.0)
    step, width = (hi - lo) / (grid - 1), h / CELLS_PER_BANDWIDTH
    reach = h * math.sqrt(2.0 * EXP_UNDERFLOW) + width
    cells = df.select(x.alias("x")).filter(F.col("x").isNotNull()).withColumn(
        "cell", F.floor((F.col("x") - F.lit(lo)) / F.lit(width)))
    middle = F.lit(lo) + (F.col("cell") + F.lit(0.5)) * F.lit(width)
    cells = cells.withColumn("s", (F.col("x") - middle) / F.lit(h))
    power, sums = F.lit(1.0), []
    for k in range(POWERS):
        sums.append((F.sum(power) / F.lit(float(math.factorial(k)))).alias(f"m{k}"))
        power = power * F.col("s")
    cells = cells.groupBy("cell").agg(*sums).withColumn("middle", middle)
    first = F.greatest(F.lit(0), F.ceil((F.col("middle") - F.lit(lo + reach)) / F.lit(step)))
    last = F.least(F.lit(grid - 1), F.floor((F.col("middle") - F.lit(lo - reach)) / F.lit(step)))
    points = cells.filter(last >= first).select("*", F.explode(F.sequence(first, last)).alias("i"))
    at = F.lit(lo) + F.col("i") * F.lit(step)
    points = points.withColumn("u", (at - F.col("middle")) / F.lit(h))
    u = F.col("u")
    before, now, series = F.lit(0.0), F.lit(1.0), F.col("m0")
    for k in range(1, POWERS):
        before, now = now, u * now - F.lit(float(k - 1)) * before
        points = points.withColumn(f"h{k}", now)
        now, before = F.col(f"h{k}"), (F.lit(1.0) if k == 1 else F.col(f"h{k - 1}"))
        series = series + now * F.col(f"m{k}")
    summed = points.groupBy("i").agg(F.sum(series * F.exp(u * u * F.lit(-0.5))).alias("s"))
    every = df.sparkSession.range(grid).withColumnRenamed("id", "i")
    return every.join(summed, "i", "left").select(
        at.alias("x"),
        (F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) / F.lit(n * h * math.sqrt(2.0 * math.pi))).alias("density"))


def box_stats(
    df: DataFrame, cols: Sequence[str], k: float = FENCE_WIDTH, exact: bool = True,
    task_values: int = TASK_VALUES,
) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and flier count per column."""
    found = fences(df, cols, k, "skip", exact, task_values)
    aggs = []
    for i, col in enumerate(cols):
        x = F.col(col).cast("double")
        inside = F.when(~_beyond(col, found[col]), x)
        aggs += [F.min(inside).alias(f"l{i}"), F.max(inside).alias(f"h{i}"),
                 F.count_if(_beyond(col, found[col])).alias(f"f{i}")]
    names = ["column_name", "q1", "median", "q3", "whisker_low", "whisker_high", "flier_count"]
    entries = []
    for i, col in enumerate(cols):
        fence = found[col]
        quartiles = [F.lit(v).cast("double") for v in (fence.q1, fence.median, fence.q3)]
        entries.append((col, *quartiles, F.col(f"l{i}"), F.col(f"h{i}"), F.col(f"f{i}")))
    return melt(df.agg(*aggs), names, entries)
