"""Profiling: shape, missing values, duplicates, describe, counts, correlations, quality."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import percent, ratio
from plumbline.operators.contract import columns_by_type, outside
from plumbline.operators.quantiles import TASK_VALUES, first_look, interpolated
from plumbline.shared import chunks, literal_rows, melt, tall

REPORT = ["section", "column_name", "metric", "value", "text"]
REPORT_SCHEMA = "section string, column_name string, metric string, value double, text string"

HIGH_MISSING_PERCENT = 5
MISSING_PENALTY_CAP = 30
DUPLICATE_PENALTY_CAP = 20


def _null_text() -> Column:
    return F.lit(None).cast("string")


# Pairs of columns in one aggregate, which keeps its generated code small.
PAIRS_PER_SCAN = 120
# Columns on either side of one scan for masked sums; a task holds six numbers per pair.
WIDEST = 1000


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage of every column, from one scan."""
    cols = list(cols or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(name).isNull()).alias(f"m{i}") for i, name in enumerate(cols)])
    return melt(counted, ["column_name", "missing_count", "missing_pct"], [
        (name, F.col(f"m{i}"), percent(F.col(f"m{i}"), F.col("n"))) for i, name in enumerate(cols)])


def high_missing(df: DataFrame, pct: float = HIGH_MISSING_PERCENT) -> DataFrame:
    return missing(df).filter(F.col("missing_pct") > pct)


def _copies(df: DataFrame) -> DataFrame:
    """One row per distinct row with its number of copies (nulls equal).

    Copies meet inside each map task first, so a row repeated everywhere is cheap.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))


def duplicates(df: DataFrame, method: str = "rows") -> DataFrame:
    """Rows after the first equal one: ``n_rows``, ``duplicate_count``, ``duplicate_pct``.

    ``rows`` shuffles each distinct row once and is exact. ``hash`` is for wide rows: it reads the
    table once and shuffles two independent 64-bit hashes per distinct row, with copies combined in the map
    tasks; different rows are taken for equal only if both hashes agree (odds of n^2 / 2^129).
    """
    if method == "rows":
        counted = _copies(df).agg(
            F.coalesce(F.sum("__copies"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_count"))
    elif method == "hash":
        keys = [F.xxhash64(F.lit(salt), *df.columns).alias(f"__h{salt}") for salt in (0, 1)]
        counted = (df.select(*keys).groupBy("__h0", "__h1").agg(F.count(F.lit(1)).alias("__copies"))
                   .agg(F.coalesce(F.sum("__copies"), F.lit(0)).alias("n_rows"),
                        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_count")))
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.withColumn("duplicate_pct", percent(F.col("duplicate_count"), F.col("n_rows")))


QUARTILES = (0.25, 0.5, 0.75)


def describe_values(
    df: DataFrame, cols: Sequence[str], exact: bool = True, task_values: int = TASK_VALUES,
) -> dict[tuple[str, str], float | None]:
    """count, mean, sample std, min, quartiles and max of each column, on the driver."""
    found: dict[tuple[str, str], float | None] = {}
    for group in chunks(list(cols), 50):
        extra = []
        for i, col in enumerate(group):
            x = F.col(col).cast("double")
            extra += [F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                      F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
        look = first_look(df, group, QUARTILES, extra)
        quartiles = interpolated(df, look, group, QUARTILES, exact, task_values)
        for i, col in enumerate(group):
            row = look.extra
            found[col, "count"] = float(look.counts[col])
            found[col, "mean"], found[col, "std"] = row[f"a{i}"], row[f"s{i}"]
            found[col, "min"] = row[f"l{i}"]
            for p, name in zip(QUARTILES, ("25%", "50%", "75%")):
                found[col, name] = quartiles[col, p]
            found[col, "max"] = row[f"h{i}"]
    return found


def describe(
    df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
    task_values: int = TASK_VALUES,
) -> DataFrame:
    """``(column_name, metric, value)`` rows of the numeric columns."""
    cols = list(cols or columns_by_type(df, "numeric"))
    values = describe_values(df, cols, exact, task_values)
    return literal_rows(
        df.sparkSession, "column_name string, metric string, value double",
        [(col, metric, value) for (col, metric), value in values.items()])


def means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    averaged = df.agg(*[F.avg(F.col(col)).alias(f"a{i}") for i, col in enumerate(cols)])
    return melt(averaged, ["column_name", "mean"], [(col, F.col(f"a{i}")) for i, col in enumerate(cols)])


def value_counts(df: DataFrame, cols: Sequence[str] | str, normalise: bool = False) -> DataFrame:
    """Count (and share of the non-null values) of each value, nulls dropped.

    All columns share one scan and one shuffle of partial counts.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    counted = (tall(df, cols).filter(F.col("value").isNotNull())
               .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    if not normalise:
        return counted
    totals = counted.groupBy("column_name").agg(F.sum("n").alias("total"))
    # One row per profiled column, so its size is the length of an argument.
    return (counted.join(F.broadcast(totals), "column_name")
            .select("column_name", "value", "n", ratio(F.col("n"), F.col("total")).alias("share")))


def distinct_values(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Distinct values per column, a missing one kept as null."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return tall(df, cols).distinct()


def unexpected_values(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values outside the allowed lists; null is never allowed.

    The filter runs before the shuffle, so only unexpected cells travel.
    """
    cols = [name for name in allowed if name in df.columns]
    known = reduce(
        lambda expr, name: expr | ((F.col("column_name") == name) & F.col("value").isin(list(allowed[name]))),
        cols, F.lit(False))
    return tall(df, cols).filter(F.col("value").isNull() | ~known).distinct()


def range_violations(df: DataFrame, rules: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Number of values outside each rule's closed range, all rules in one scan."""
    rules = {name: bounds for name, bounds in rules.items() if name in df.columns}
    counted = df.agg(*[
        F.count_if(outside(F.col(name), lo, hi)).alias(name) for name, (lo, hi) in rules.items()])
    return melt(counted, ["column_name", "invalid_count", "min_allowed", "max_allowed"], [
        (name, F.col(name), F.lit(float(lo)), F.lit(float(hi))) for name, (lo, hi) in rules.items()])


def type_profile(df: DataFrame) -> DataFrame:
    return literal_rows(df.sparkSession, "column_name string, data_type string", df.dtypes)


def _pearson(x: str, y: str) -> Column:
    """Pairwise complete correlation, null when either side is constant."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


def correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_x, column_y, corr)`` for every ordered pair, over the rows that have both values.

    Up to ``PAIRS_PER_SCAN`` pairs take one scan. More columns take two: one to see whether a cell is missing, and one for
    their covariance matrix, or with missing cells for masked sums of products of up to ``WIDEST`` columns with as many
    others, which each task adds up for its rows.
    """
    cols = list(cols or columns_by_type(df, "numeric"))
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    if len(pairs) > PAIRS_PER_SCAN:
        rows, holes, means = _first_scan(df, cols)
        if rows > 1 and not holes:
            return _correlation_matrix(df, cols)
        blocks = list(chunks(cols, WIDEST))
        return reduce(DataFrame.unionByName, [
            _masked_correlation(df, left, right, means) for left in blocks for right in blocks])
    parts = []
    for group in chunks(pairs, PAIRS_PER_SCAN):
        one = df.agg(*[_pearson(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in group])
        entries = []
        for i, j in group:
            entries.append((cols[i], cols[j], F.col(f"c{i}_{j}")))
            if i != j:
                entries.append((cols[j], cols[i], F.col(f"c{i}_{j}")))
        parts.append(melt(one, ["column_x", "column_y", "corr"], entries))
    return reduce(DataFrame.unionByName, parts)


def _numbers(cols: Sequence[str]) -> Column:
    """The cells of a row as an array of doubles, missing ones null."""
    cells = [F.col(col).cast("double") for col in cols]
    return F.array(*[F.when(~F.isnan(cell), cell) for cell in cells])


def _first_scan(df: DataFrame, cols: Sequence[str]) -> tuple[int, bool, dict[str, float]]:
    """Number of rows, whether a cell is missing, and the mean of each column."""
    cells = F.col("cells")
    row = df.select(_numbers(cols).alias("cells")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or(F.exists(cells, F.isnull)), F.lit(False)).alias("holes"),
        F.array(*[F.avg(cells[i]) for i in range(len(cols))]).alias("means")).first()
    return row["n"], row["holes"], {col: mean or 0.0 for col, mean in zip(cols, row["means"])}


def _masked_sums(left: int, shift: np.ndarray):
    """Sums over a task's rows for each column on the left with each on the right, over the rows that have both: how many,
    the sums of either, of their squares, and of their products; one output row per column on the left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, left, len(shift) - left))
        for batch in batches:
            cells = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(shift)) - shift
            there = ~np.isnan(cells)
            cells[~there] = 0.0
            mask = there.astype(float)
            (x, y), (m, k) = np.split(cells, [left], axis=1), np.split(mask, [left], axis=1)
            for at, (a, b) in enumerate(((m, k), (x, k), (m, y), (x * x, k), (m, y * y), (x, y))):
                total[at] += a.T @ b
        sums = pa.array(list(total.transpose(1, 0, 2).reshape(left, -1)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(left), pa.int32()), sums], names=["at", "sums"])
    return run


def _masked_correlation(df: DataFrame, left: Sequence[str], right: Sequence[str], means: Mapping[str, float]) -> DataFrame:
    """Correlation of each column on the left with each on the right in one scan, shifted by their means.

    Values whose spread in the common rows is below a millionth of their distance from the mean count as constant.
    """
    cols = [*left, *right]
    shift = np.array([means[col] for col in cols])
    parts = df.select(_numbers(cols).alias("cells")).mapInArrow(_masked_sums(len(left), shift), "at int, sums array<double>")
    summed = parts.groupBy("at").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    names = F.array(*[F.lit(col) for col in right])
    kinds = [F.slice("sums", 1 + i * len(right), len(right)) for i in range(6)]
    cells = F.arrays_zip(names.alias("column_y"), *[kind.alias(name) for kind, name in zip(kinds, ("n", "x", "y", "xx", "yy", "xy"))])
    rows = summed.select(F.element_at(F.array(*[F.lit(col) for col in left]), F.col("at") + 1).alias("column_x"), F.inline(cells))
    spreads = []
    for one, square in (("x", "xx"), ("y", "yy")):
        spread = F.col("n") * F.col(square) - F.col(one) * F.col(one)
        spreads.append(F.when(spread > F.col("n") * F.col(square) * 1e-12, spread))
    same = F.col("column_x") == F.col("column_y")
    together = (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spreads[0]) / F.sqrt(spreads[1])
    return rows.select("column_x", "column_y", F.when(same & spreads[0].isNotNull(), 1.0).otherwise(together).alias("corr"))


def _correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.col(col).cast("double") for col in cols])
    matrix = Correlation.corr(df.select(array_to_vector(cells).alias("v")), "v").first()[0].toArray()
    rows = [(x, y, None if math.isnan(matrix[i, j]) or (i == j and _flat(matrix, i)) else float(matrix[i, j]))
            for i, x in enumerate(cols) for j, y in enumerate(cols)]
    return literal_rows(df.sparkSession, "column_x string, column_y string, corr double", rows)


def _flat(matrix, i: int) -> bool:
    """A constant column correlates with no other, not even with itself."""
    return all(math.isnan(matrix[i, j]) for j in range(len(matrix)) if j != i)


def correlation_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, highest first, target included."""
    names = list(dict.fromkeys([*cols, target]))
    one = df.agg(*[_pearson(name, target).alias(f"c{i}") for i, name in enumerate(names)])
    rows = melt(one, ["column_name", "corr"], [(name, F.col(f"c{i}")) for i, name in enumerate(names)])
    return rows.orderBy(F.col("corr").desc_nulls_last(), "column_name")


def quality_counts(df: DataFrame) -> DataFrame:
    """``n`` rows, ``dup`` duplicates and ``m<i>`` missing cells of column i, out of one
    grouping of the rows."""
    return _copies(df).agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("dup"),
        *[F.coalesce(F.sum(F.when(F.col(name).isNull(), F.col("__copies"))), F.lit(0)).alias(f"m{i}")
          for i, name in enumerate(df.columns)])


def quality_score(df: DataFrame) -> DataFrame:
    """100 less capped penalties for missing cells and duplicate rows, never below 0."""
    cells = reduce(lambda total, i: total + F.col(f"m{i}"), range(len(df.columns)), F.lit(0))
    counted = quality_counts(df).select("n", "dup", cells.alias("missing_cells"))
    missing_penalty = F.least(percent(F.col("missing_cells"), F.col("n")), F.lit(float(MISSING_PENALTY_CAP)))
    duplicate_penalty = F.least(percent(F.col("dup"), F.col("n")), F.lit(float(DUPLICATE_PENALTY_CAP)))
    # least() skips nulls; an empty table has no ratio and so no score.
    score = F.when(F.col("n") > 0, F.greatest(F.lit(0.0), F.lit(100.0) - missing_penalty - duplicate_penalty))
    return counted.select(
        F.col("n").alias("n_rows"), "missing_cells", F.col("dup").alias("duplicate_count"),
        score.alias("quality_score"))


def quality_report(df: DataFrame, name: str, exact: bool = True) -> DataFrame:
    """Shape, missing values, duplicates, types and basic statistics as report rows."""
    spark = df.sparkSession
    entries = [
        ("shape", _null_text(), "rows", F.col("n").cast("double"), _null_text()),
        ("shape", _null_text(), "columns", F.lit(float(len(df.columns))), _null_text()),
        ("duplicates", _null_text(), "duplicate_rows", F.col("dup").cast("double"), _null_text()),
    ]
    for i, col in enumerate(df.columns):
        entries.append(("missing", F.lit(col), "missing_count", F.col(f"m{i}").cast("double"), _null_text()))
    counted = melt(quality_counts(df), REPORT, entries)
    rows = [("types", col, "data_type", None, kind) for col, kind in df.dtypes]
    numeric = columns_by_type(df, "numeric")
    if numeric:
        rows += [("stats", col, metric, value, None)
                 for (col, metric), value in describe_values(df, numeric, exact).items()]
    report = counted.unionByName(literal_rows(spark, REPORT_SCHEMA, rows))
    return report.select(F.lit(name).alias("dataset"), *REPORT)
