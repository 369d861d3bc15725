"""Statistical drift tests on running sums of value counts.

The empirical distribution functions are needed at every distinct value, in order. The
values are cut into buckets at sketched quantiles; a window runs inside each bucket and
starts from the exact total of the buckets before it, so no task sees more than a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import ratio
from plumbline.operators.contract import Contract
from plumbline.operators.drift import category_shares, side_counts
from plumbline.shared import literal_rows, melt, tall

# Published defaults of dataset drift checks; every one is an argument below.
SMALL_SAMPLE = 1000
FEW_VALUES = 5
P_VALUE = 0.05
#: Values of the larger sample up to which the p-value of the Kolmogorov-Smirnov test is exact.
EXACT_SIZE = 1000
DISTANCE = 0.1
DRIFT_SHARE = 0.5
STD_FLOOR = 0.001

# Distinct values that one window task may order, and the most buckets of a pass. Beyond
# their product (a billion distinct values) a column's buckets grow, as its edges must fit a task.
BUCKET_VALUES = 50_000
MAX_BUCKETS = 20_000
# Buckets per column of the inexact form.
SKETCH_BUCKETS = 2_000


def distinct_counts(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], few_values: int = FEW_VALUES,
) -> tuple[int, dict[str, int]]:
    """Rows of the reference, and how many distinct values each column has in both samples: exact where
    they could be ``few_values`` or fewer (the estimate's error is far below a factor of two), else an estimate."""
    stacked = (ref.select(*cols, F.lit(1).alias("__ref"))
               .unionAll(cur.select(*cols, F.lit(0).alias("__ref"))))
    row = stacked.agg(
        F.sum("__ref").alias("rows"),
        *[F.approx_count_distinct(col).alias(f"d{i}") for i, col in enumerate(cols)]).first()
    distinct = {col: row[f"d{i}"] for i, col in enumerate(cols)}
    few = [col for col in cols if distinct[col] <= 2 * few_values + 40]
    if few:
        values = tall(stacked, few).filter(F.col("value").isNotNull()).distinct()
        exact = values.groupBy("column_name").count().collect()
        distinct.update({col: 0 for col in few})
        distinct.update({r["column_name"]: r["count"] for r in exact})
    return row["rows"] or 0, distinct


def _bucket_edges(stacked: DataFrame, buckets: Mapping[str, int]) -> dict[str, list[float]]:
    """Bucket edges per column: sketched quantiles, as many as the column needs."""
    split = [col for col, number in buckets.items() if number > 1]
    sketch = stacked.agg(*[
        F.percentile_approx(col, [b / buckets[col] for b in range(1, buckets[col])], 10 * buckets[col])
        .alias(f"q{i}") for i, col in enumerate(split)]).first()
    # The cutter wants three edges at least.
    edges = {col: [-math.inf, 0.0, math.inf] for col in buckets}
    for i, col in enumerate(split):
        edges[col] = [-math.inf, *sorted(set(sketch[f"q{i}"])), math.inf]
    return edges


def running_counts(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], bucket_values: int = BUCKET_VALUES,
    distinct: Mapping[str, int] | None = None, exact: bool = True,
) -> DataFrame:
    """``(column_name, value, cum_ref, cum_cur, n_ref, n_cur, next_value)`` at each distinct
    value: counts up to it, sample sizes, and the distinct value after it.

    With ``exact`` off there is one such row per bucket, at its largest value. The counts in
    it are exact, only the course inside a bucket is unknown: a gap between the curves can
    be missed by at most the share of one bucket. That shuffles bucket totals instead of
    distinct values.
    """
    as_double = [F.col(col).cast("double").alias(col) for col in cols]
    ref, cur = ref.select(*as_double), cur.select(*as_double)
    if distinct is None:
        stacked = ref.unionAll(cur)
        distinct = stacked.agg(*[F.approx_count_distinct(col).alias(col) for col in cols]).first().asDict()
    buckets = {col: min(math.ceil(1.1 * distinct[col] / bucket_values), MAX_BUCKETS) for col in cols}
    if not exact:
        buckets = {col: max(min(distinct[col], SKETCH_BUCKETS), 2) for col in cols}
    groups = _together(buckets)
    if len(groups) > 1:
        return reduce(DataFrame.unionAll, [
            running_counts(ref, cur, group, bucket_values, distinct, exact) for group in groups])
    if max(buckets.values()) <= 1:
        return _running_counts_whole(ref, cur, cols)
    edges = _bucket_edges(ref.unionAll(cur), buckets)
    return (_running_counts_bucketed if exact else _running_counts_of_buckets)(ref, cur, edges)


def _together(buckets: Mapping[str, int]) -> list[list[str]]:
    """Columns in groups of at most ``MAX_BUCKETS`` buckets; each group is a pass of its own."""
    groups: list[list[str]] = []
    room = 0
    for col, number in buckets.items():
        if not groups or number > room:
            groups.append([])
            room = MAX_BUCKETS
        groups[-1].append(col)
        room -= number
    return groups


def _running_counts_whole(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For columns whose distinct values fit a bucket each: one window per column."""
    counted = side_counts(ref, cur, cols, "double").filter(F.col("value").isNotNull())
    whole = Window.partitionBy("column_name")
    ordered = whole.orderBy("value")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        "column_name", "value",
        F.sum("n_ref").over(so_far).alias("cum_ref"), F.sum("n_cur").over(so_far).alias("cum_cur"),
        F.sum("n_ref").over(whole).alias("n_ref"), F.sum("n_cur").over(whole).alias("n_cur"),
        F.lead("value").over(ordered).alias("next_value"))


def _bucket_cells(ref: DataFrame, cur: DataFrame, edges: Mapping[str, list[float]]) -> DataFrame:
    """``(column_name, bucket, value, is_ref)`` of every non-null cell of both samples."""
    bucketed = [f"__bucket_{i}" for i in range(len(edges))]
    cutter = Bucketizer(inputCols=list(edges), outputCols=bucketed,
                        splitsArray=list(edges.values()), handleInvalid="keep")
    structs = [F.struct(F.lit(col).alias("column_name"), F.col(bucket).cast("int").alias("bucket"),
                        F.col(col).alias("value")) for col, bucket in zip(edges, bucketed)]

    def cells(df: DataFrame, is_ref: bool) -> DataFrame:
        return (cutter.transform(df).select(F.inline(F.array(*structs)))
                .filter(F.col("value").isNotNull() & F.col("bucket").isNotNull())
                .withColumn("is_ref", F.lit(is_ref)))

    return cells(ref, True).unionAll(cells(cur, False))


COUNT_REF, COUNT_CUR = "count_if(is_ref)", "count_if(NOT is_ref)"


def _running_counts_of_buckets(ref: DataFrame, cur: DataFrame, edges: Mapping[str, list[float]]) -> DataFrame:
    totals = _bucket_cells(ref, cur, edges).groupBy("column_name", "bucket").agg(
        F.expr(COUNT_REF).alias("n_ref"), F.expr(COUNT_CUR).alias("n_cur"), F.max("value").alias("value"))
    # At most SKETCH_BUCKETS rows per column.
    whole = Window.partitionBy("column_name")
    ordered = whole.orderBy("bucket")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return totals.select(
        "column_name", "value",
        F.sum("n_ref").over(so_far).alias("cum_ref"), F.sum("n_cur").over(so_far).alias("cum_cur"),
        F.sum("n_ref").over(whole).alias("n_ref"), F.sum("n_cur").over(whole).alias("n_cur"),
        F.lead("value").over(ordered).alias("next_value"))


def _running_counts_bucketed(ref: DataFrame, cur: DataFrame, edges: Mapping[str, list[float]]) -> DataFrame:
    # Both uses of these counts below share one shuffle, as long as their plans stay equal.
    counted = _bucket_cells(ref, cur, edges).groupBy("column_name", "bucket", "value").agg(
        F.expr(COUNT_REF).alias("n_ref"), F.expr(COUNT_CUR).alias("n_cur"))
    # At most MAX_BUCKETS rows in all: small enough to order in one task and to broadcast.
    totals = counted.groupBy("column_name", "bucket").agg(
        F.sum("n_ref").alias("b_ref"), F.sum("n_cur").alias("b_cur"), F.min("value").alias("b_min"))
    whole = Window.partitionBy("column_name")
    by_bucket = whole.orderBy("bucket")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "column_name", "bucket",
        F.coalesce(F.sum("b_ref").over(before), F.lit(0)).alias("s_ref"),
        F.coalesce(F.sum("b_cur").over(before), F.lit(0)).alias("s_cur"),
        F.sum("b_ref").over(whole).alias("t_ref"), F.sum("b_cur").over(whole).alias("t_cur"),
        F.lead("b_min").over(by_bucket).alias("next_min"))
    inside = Window.partitionBy("column_name", "bucket").orderBy("value")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    return counted.join(F.broadcast(starts), ["column_name", "bucket"]).select(
        "column_name", "value",
        (F.col("s_ref") + F.sum("n_ref").over(so_far)).alias("cum_ref"),
        (F.col("s_cur") + F.sum("n_cur").over(so_far)).alias("cum_cur"),
        F.col("t_ref").alias("n_ref"), F.col("t_cur").alias("n_cur"),
        F.coalesce(F.lead("value").over(inside), F.col("next_min")).alias("next_value"))


def _curve_scores(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], bucket_values: int,
    distinct: Mapping[str, int] | None = None, exact: bool = True,
) -> DataFrame:
    """Largest gap and area between the two distribution functions, with sample sizes."""
    gap = F.abs(ratio(F.col("cum_ref"), F.col("n_ref")) - ratio(F.col("cum_cur"), F.col("n_cur")))
    return running_counts(ref, cur, cols, bucket_values, distinct, exact).groupBy("column_name").agg(
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max(gap).alias("ks"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("area"))


def ks_statistic(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], bucket_values: int = BUCKET_VALUES,
    exact: bool = True,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per numeric column, with the sample sizes."""
    return _curve_scores(ref, cur, cols, bucket_values, None, exact).select(
        "column_name", "n_ref", "n_cur", F.col("ks").alias("statistic"))


def ks(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], p_value: float = P_VALUE,
    bucket_values: int = BUCKET_VALUES, exact_size: int = EXACT_SIZE,
) -> DataFrame:
    """Kolmogorov-Smirnov test; the p-value is exact where neither sample has more than ``exact_size`` values, and
    asymptotic beyond. As for any test of this kind ties make the p-value too large."""
    def tail(r) -> float:
        small = r["statistic"] is not None and 0 < min(r["n_ref"], r["n_cur"]) and max(r["n_ref"], r["n_cur"]) <= exact_size
        return (smirnov_sf if small else kolmogorov_sf)(r["statistic"], r["n_ref"], r["n_cur"])

    rows = [(r["column_name"], r["statistic"], tail(r)) for r in ks_statistic(ref, cur, cols, bucket_values).collect()]
    return literal_rows(
        ref.sparkSession, "column_name string, statistic double, p_value double, drifted boolean",
        [(col, d, p, p < p_value) for col, d, p in rows])


def wasserstein(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = DISTANCE,
    bucket_values: int = BUCKET_VALUES, distinct: Mapping[str, int] | None = None, exact: bool = True,
) -> DataFrame:
    """First Wasserstein distance, also in units of the reference's population deviation."""
    spread = ref.agg(*[F.stddev_pop(F.col(col).cast("double")).alias(f"s{i}") for i, col in enumerate(cols)])
    spread = melt(spread, ["column_name", "std"], [(col, F.col(f"s{i}")) for i, col in enumerate(cols)])
    score = F.col("area") / F.greatest(F.col("std"), F.lit(STD_FLOOR))
    return (_curve_scores(ref, cur, cols, bucket_values, distinct, exact).join(F.broadcast(spread), "column_name")
            .select("column_name", F.col("area").alias("distance"), score.alias("score"),
                    F.coalesce((score >= F.lit(threshold)) & ~F.isnan(score), F.lit(False)).alias("drifted")))


def jensen_shannon(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = DISTANCE,
) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm, square root) of the value shares."""
    p, q = F.col("ref_share"), F.col("cur_share")
    middle = (p + q) / F.lit(2.0)

    def part(x):
        return F.when(x > 0, x * F.ln(x / F.nullif(middle, F.lit(0.0)))).otherwise(F.lit(0.0))

    score = F.sqrt(F.greatest(F.sum(part(p) + part(q)) / F.lit(2.0), F.lit(0.0)))
    return (category_shares(ref, cur, cols).groupBy("column_name").agg(score.alias("score"))
            .withColumn("drifted", F.col("score") >= F.lit(threshold)))


def chi_square_statistic(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square of the current counts against the reference shares, with its freedom.

    A value that the reference never shows makes the statistic infinite.
    """
    counted = side_counts(ref, cur, cols).filter(F.col("value").isNotNull())
    totals = counted.groupBy("column_name").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    expected = F.col("n_ref") * ratio(F.col("t_cur"), F.col("t_ref"))
    term = F.when(F.col("n_ref") > 0, F.pow(F.col("n_cur") - expected, 2) / F.nullif(expected, F.lit(0.0)))
    return (counted.join(F.broadcast(totals), "column_name").groupBy("column_name")
            .agg(F.sum(F.coalesce(term, F.lit(math.inf))).alias("statistic"),
                 (F.count(F.lit(1)) - 1).alias("freedom")))


def chi_square(ref: DataFrame, cur: DataFrame, cols: Sequence[str], p_value: float = P_VALUE) -> DataFrame:
    rows = []
    for r in chi_square_statistic(ref, cur, cols).collect():
        p = chi_square_sf(r["statistic"], r["freedom"])
        rows.append((r["column_name"], r["statistic"], r["freedom"], p, p < p_value))
    return literal_rows(
        ref.sparkSession,
        "column_name string, statistic double, freedom bigint, p_value double, drifted boolean", rows)


def proportion_statistic(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pooled z of the share of the smallest value of a two-value column."""
    counted = side_counts(ref, cur, cols).filter(F.col("value").isNotNull())
    summed = counted.groupBy("column_name").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"),
        F.min_by("n_ref", "value").alias("h_ref"), F.min_by("n_cur", "value").alias("h_cur"))
    pooled = ratio(F.col("h_ref") + F.col("h_cur"), F.col("t_ref") + F.col("t_cur"))
    spread = F.sqrt(pooled * (F.lit(1.0) - pooled)
                    * (ratio(F.lit(1), F.col("t_ref")) + ratio(F.lit(1), F.col("t_cur"))))
    gap = ratio(F.col("h_ref"), F.col("t_ref")) - ratio(F.col("h_cur"), F.col("t_cur"))
    return summed.select("column_name", F.try_divide(gap, spread).alias("statistic"))


def proportion_z(ref: DataFrame, cur: DataFrame, cols: Sequence[str], p_value: float = P_VALUE) -> DataFrame:
    rows = []
    for r in proportion_statistic(ref, cur, cols).collect():
        # No spread means that both samples hold the same single value.
        p = 1.0 if r["statistic"] is None else math.erfc(abs(r["statistic"]) / math.sqrt(2.0))
        rows.append((r["column_name"], r["statistic"], p, p < p_value))
    return literal_rows(
        ref.sparkSession, "column_name string, statistic double, p_value double, drifted boolean", rows)


@dataclass(frozen=True)
class DriftRules:
    """Which test a column gets, and when it counts as drifted."""

    #: With this on, up to ``small_sample`` reference rows get the tests with p-values. Off, a column's
    #: test depends on its kind alone, so more rows never swap it.
    by_sample_size: bool = False
    small_sample: int = SMALL_SAMPLE
    few_values: int = FEW_VALUES
    p_value: float = P_VALUE
    distance: float = DISTANCE
    drift_share: float = DRIFT_SHARE
    exact: bool = True


def choose_tests(
    rows: int, distinct: Mapping[str, int], contract: Contract, rules: DriftRules,
) -> dict[str, list[str]]:
    """Test name to columns, by the kind of column and, if the rules say so, the reference's rows."""
    tests: dict[str, list[str]] = {}
    for name, number in distinct.items():
        counted = name in contract.categorical or number <= rules.few_values
        if not rules.by_sample_size or rows > rules.small_sample:
            test = "jensen_shannon" if counted else "wasserstein"
        elif counted:
            test = "chi_square" if number > 2 else "proportion_z"
        else:
            test = "ks"
        tests.setdefault(test, []).append(name)
    return tests


def dataset_drift(
    ref: DataFrame, cur: DataFrame, contract: Contract, rules: DriftRules = DriftRules(),
    bucket_values: int = BUCKET_VALUES, tests: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per column: test, score, flag; and on every row the number and share of drifted
    columns and the dataset flag (share at or above ``drift_share``). ``tests`` names the test of
    single columns; the rules choose for the others."""
    names = [name for name in contract.names if name in ref.columns and name in cur.columns]
    ref, cur = ref.select(*names), cur.select(*names)
    rows, distinct = distinct_counts(ref, cur, names, rules.few_values)
    chosen = choose_tests(rows, {name: n for name, n in distinct.items() if name not in (tests or {})}, contract, rules)
    for name, test in (tests or {}).items():
        chosen.setdefault(test, []).append(name)
    parts = []
    for test, cols in chosen.items():
        if test == "wasserstein":
            scored = wasserstein(ref, cur, cols, rules.distance, bucket_values, distinct, rules.exact)
        elif test == "jensen_shannon":
            scored = jensen_shannon(ref, cur, cols, rules.distance)
        elif test == "ks":
            scored = ks(ref, cur, cols, rules.p_value, bucket_values).withColumnRenamed("p_value", "score")
        elif test == "chi_square":
            scored = chi_square(ref, cur, cols, rules.p_value).withColumnRenamed("p_value", "score")
        else:
            scored = proportion_z(ref, cur, cols, rules.p_value).withColumnRenamed("p_value", "score")
        parts.append(scored.select("column_name", F.lit(test).alias("test"), "score", "drifted"))
    rows = reduce(DataFrame.unionAll, parts)
    # The window holds one row per column of the contract, whatever the size of the data.
    every = Window.partitionBy(F.lit(1))
    share = ratio(F.col("drifted_columns"), F.col("n_columns"))
    return rows.withColumns({
        "drifted_columns": F.count_if("drifted").over(every),
        "n_columns": F.count(F.lit(1)).over(every),
    }).withColumns({"drift_share": share, "dataset_drift": share >= F.lit(rules.drift_share)})


def kolmogorov_sf(statistic: float, n_ref: int, n_cur: int) -> float:
    """Asymptotic tail probability of the two-sample statistic; 1 when a sample is empty."""
    if statistic is None:
        return 1.0
    z = statistic * math.sqrt(n_ref * n_cur / (n_ref + n_cur))
    if z < 0.2:
        return 1.0
    tail = 2.0 * sum((-1) ** (k - 1) * math.exp(-2.0 * (k * z) ** 2) for k in range(1, 101))
    return min(max(tail, 0.0), 1.0)


def smirnov_sf(statistic: float, n_ref: int, n_cur: int) -> float:
    """Exact tail probability of the two-sample statistic without ties.

    Each order of all values is a lattice path from (0, 0) to (n_ref, n_cur). Of the paths to a point, the
    share that has been ``statistic`` away from the diagonal follows from the two points before it; the
    points with one sum of coordinates are worked out together. Only shares are added, so small tails keep their digits.
    """
    far = round(statistic * n_ref * n_cur)  # gaps are whole multiples of 1 / (n_ref * n_cur)
    i = np.arange(n_ref + 1)
    share = np.zeros(n_ref + 1)
    for both in range(n_ref + n_cur + 1):
        j = both - i
        if both:
            last = np.r_[0.0, share[:-1]]  # the last value came from the reference
            share = (last * i + share * np.maximum(j, 0)) / both
        inside = (j >= 0) & (j <= n_cur)
        share = np.where(inside & (np.abs(i * n_cur - j * n_ref) >= far), 1.0, np.where(inside, share, 0.0))
    return float(min(max(share[n_ref], 0.0), 1.0))


def chi_square_sf(statistic: float, freedom: int) -> float:
    """Tail probability of the chi-square distribution: the upper incomplete gamma function, by its
    series below the mean and by its continued fraction above; the steps don't grow with the categories."""
    if freedom <= 0 or statistic <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    a, x = freedom / 2.0, statistic / 2.0
    if a > 1e6:  # Wilson-Hilferty: exact to about 1 / a here
        z = ((x / a) ** (1 / 3) - (1 - 1 / (9 * a))) * math.sqrt(9 * a)
        return math.erfc(z / math.sqrt(2.0)) / 2.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return min(max(1.0 - total * scale, 0.0), 1.0)
    b, tiny = x + 1 - a, 1e-300
    c, d = 1 / tiny, 1 / b
    h, step, i = d, 0.0, 0
    while abs(step - 1.0) > 1e-15 and i < 100_000:
        i += 1
        b += 2.0
        an = -i * (i - a)
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = c * d
        h *= step
    return min(max(h * scale, 0.0), 1.0)
