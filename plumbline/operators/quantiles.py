"""Exact order statistics that never gather a column in one task.

Spark's exact ``percentile`` keeps one entry per distinct value in a single reducer.
Here it only ever sees a checked number of values. A larger column is narrowed
first: a mergeable sketch proposes an interval around each wanted rank, one counting
pass proves which side of the interval the rank is on, and the interval shrinks until
few enough values are left. A value that many rows share is its own interval end, so
the counting pass settles it: hot values and columns of few values are the cheap case.
Each pass returns one row, so only counts and interval ends reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from plumbline.shared import literal_rows

# Values that one task may hold for all columns of a call together.
TASK_VALUES = 100_000
# Relative rank error of the sketch is 1 / ACCURACY.
ACCURACY = 5_000
# Half the width, in ranks, of the interval that a sketch pass proposes.
MARGIN = 2.0 / ACCURACY


@dataclass
class _Search:
    """A wanted rank and the open interval that must hold its value."""

    col: str
    rank: int
    below: int
    inside: int
    lo: float | None = None
    hi: float | None = None
    value: float | None = None

    @property
    def interval(self) -> tuple:
        return self.col, self.lo, self.hi


def _inside(col: str, lo, hi) -> Column:
    """The column where it is strictly inside the interval, else null."""
    value = F.col(col)
    if lo is None and hi is None:
        return value
    if lo is None:
        return F.when(value < F.lit(hi), value)
    if hi is None:
        return F.when(value > F.lit(lo), value)
    return F.when((value > F.lit(lo)) & (value < F.lit(hi)), value)


def _by_interval(searches: Sequence[_Search]) -> dict[tuple, list[_Search]]:
    groups: dict[tuple, list[_Search]] = {}
    for search in searches:
        groups.setdefault(search.interval, []).append(search)
    return groups


def _read_exactly(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Pick the ranks with Spark's discrete percentile; sizes were checked before."""
    groups = list(_by_interval(searches).items())
    if not groups:
        return
    aggs = []
    for i, ((col, lo, hi), members) in enumerate(groups):
        points = ", ".join(f"{(s.rank - s.below + 0.5) / s.inside!r}D" for s in members)
        name = f"__v{i}"
        df = df.withColumn(name, _inside(col, lo, hi).cast("double"))
        aggs.append(F.expr(
            f"percentile_disc(array({points})) WITHIN GROUP (ORDER BY {name})").alias(f"p{i}"))
    row = df.agg(*aggs).first()
    for i, (_, members) in enumerate(groups):
        for search, value in zip(members, row[f"p{i}"]):
            search.value = value


def _propose(df: DataFrame, searches: Sequence[_Search]) -> dict[int, tuple[float, float]]:
    """Sketch pass: interval ends for each search."""
    groups = list(_by_interval(searches).items())
    aggs = []
    for i, ((col, lo, hi), members) in enumerate(groups):
        points = []
        for search in members:
            at = (search.rank - search.below) / max(search.inside - 1, 1)
            points += [max(0.0, at - MARGIN), min(1.0, at + MARGIN)]
        aggs.append(F.percentile_approx(_inside(col, lo, hi), points, ACCURACY).alias(f"q{i}"))
    row = df.agg(*aggs).first()
    return {id(search): (row[f"q{i}"][2 * j], row[f"q{i}"][2 * j + 1])
            for i, (_, members) in enumerate(groups) for j, search in enumerate(members)}


def _count_around(df: DataFrame, points: Sequence[tuple[str, float]]) -> dict[tuple, tuple[int, int]]:
    """For each ``(column, value)``: how many are below it, and how many are not above it."""
    aggs = []
    for i, (col, value) in enumerate(points):
        aggs.append(F.count_if(F.col(col) < F.lit(value)).alias(f"lt{i}"))
        aggs.append(F.count_if(F.col(col) <= F.lit(value)).alias(f"le{i}"))
    row = df.agg(*aggs).first()
    return {point: (row[f"lt{i}"], row[f"le{i}"]) for i, point in enumerate(points)}


def _narrow(search: _Search, lo: float, hi: float, counts: Mapping) -> None:
    """Use exact counts at the proposed ends to shrink the interval or settle the value."""
    lt_lo, le_lo = counts[search.col, lo]
    lt_hi, le_hi = counts[search.col, hi]
    rank = search.rank
    if lt_lo <= rank < le_lo:
        search.value = lo
    elif lt_hi <= rank < le_hi:
        search.value = hi
    elif rank < lt_lo:
        search.inside, search.hi = lt_lo - search.below, lo
    elif rank >= le_hi:
        search.inside -= le_hi - search.below
        search.below, search.lo = le_hi, hi
    else:
        search.below, search.inside = le_lo, lt_hi - le_lo
        search.lo, search.hi = lo, hi


@dataclass(frozen=True)
class FirstLook:
    """What one scan tells about columns: counts, an interval around each wanted quantile,
    and whatever else was asked for."""

    counts: dict[str, int]
    ends: dict[tuple[str, float], tuple[float, float]]
    extra: Row


def first_look(
    df: DataFrame, cols: Sequence[str], ps: Sequence[float], extra: Sequence[Column] = (),
) -> FirstLook:
    """Counts, sketches and further aggregates of the columns, in one job."""
    aggs, points = [], []
    for p in ps:
        points += [max(0.0, p - MARGIN), min(1.0, p + MARGIN)]
    for i, col in enumerate(cols):
        x = F.col(col).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.percentile_approx(x, points, ACCURACY).alias(f"q{i}")]
    row = df.agg(*aggs, *extra).first()
    ends = {(col, p): tuple(row[f"q{i}"][2 * j:2 * j + 2])
            for i, col in enumerate(cols) if row[f"n{i}"] for j, p in enumerate(ps)}
    return FirstLook({col: row[f"n{i}"] for i, col in enumerate(cols)}, ends, row)


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Sequence[int]], counts: Mapping[str, int],
    task_values: int = TASK_VALUES,
    proposals: Mapping[tuple[str, int], tuple[float, float]] | None = None,
) -> dict[tuple[str, int], float]:
    """Value at each 0-based rank among the non-null values of each column.

    ``counts`` holds the number of non-null values per column. ``proposals`` (interval
    ends per column and rank) save the first sketch pass where they are known; a poor
    proposal costs a pass, never the result. Values are compared as doubles, so whole
    numbers beyond 2**53 lose their last digits.
    """
    searches = [
        _Search(col, rank, 0, counts[col])
        for col, wanted in ranks.items() for rank in sorted(set(wanted))
    ]
    df = df.select(*[F.col(col).cast("double").alias(col) for col in ranks])
    while True:
        open_ = [s for s in searches if s.value is None]
        share = task_values // max(len(_by_interval(open_)), 1)
        big = [s for s in open_ if s.inside > share]
        if not big:
            _read_exactly(df, open_)
            break
        ends = {id(s): proposals[s.col, s.rank] for s in big} if proposals else _propose(df, big)
        proposals = None
        points = sorted({(s.col, end) for s in big for end in ends[id(s)]})
        exact = _count_around(df, points)
        for search in big:
            _narrow(search, *ends[id(search)], exact)
    return {(s.col, s.rank): s.value for s in searches}


def linear_position(p: float, n: int) -> tuple[int, int, float]:
    """Lower rank, upper rank and weight of the linearly interpolated quantile."""
    at = p * (n - 1)
    lower = math.floor(at)
    return lower, min(lower + 1, n - 1), at - lower


def interpolated(
    df: DataFrame, look: FirstLook, cols: Sequence[str], ps: Sequence[float],
    exact: bool = True, task_values: int = TASK_VALUES,
) -> dict[tuple[str, float], float | None]:
    """Linearly interpolated quantiles; the middle of the sketched interval, without a
    further scan, when ``exact`` is off."""
    filled = [col for col in cols if look.counts[col] > 0]
    result: dict[tuple[str, float], float | None] = {(col, p): None for col in cols for p in ps}
    if not exact:
        result.update({(col, p): sum(look.ends[col, p]) / 2.0 for col in filled for p in ps})
    if not exact or not filled:
        return result
    positions = {(col, p): linear_position(p, look.counts[col]) for col in filled for p in ps}
    ranks: dict[str, list[int]] = {col: [] for col in filled}
    proposals = {}
    for (col, p), (lower, upper, weight) in positions.items():
        for rank in ([lower, upper] if weight > 0 else [lower]):
            ranks[col].append(rank)
            proposals[col, rank] = look.ends[col, p]
    values = order_statistics(df, ranks, look.counts, task_values, proposals)
    for (col, p), (lower, upper, weight) in positions.items():
        at = values[col, lower]
        result[col, p] = at + weight * (values[col, upper] - at) if weight > 0 else at
    return result


def percentiles(
    df: DataFrame, cols: Sequence[str], ps: Sequence[float], exact: bool = True,
    task_values: int = TASK_VALUES,
) -> DataFrame:
    """``(column_name, p, value)`` for each column and each quantile."""
    values = interpolated(df, first_look(df, cols, ps), cols, ps, exact, task_values)
    return literal_rows(
        df.sparkSession, "column_name string, p double, value double",
        [(col, float(p), values[col, p]) for col in cols for p in ps])
