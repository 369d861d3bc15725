"""Scalar expressions: dictionary maps, binning, flags, text and ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_values(col: Column, mapping: Mapping[str, float], strict: bool = False) -> Column:
    """Look up each value; an unknown one gives null, or an error when ``strict``."""
    expr = None
    for key, value in mapping.items():
        hit = col == F.lit(key)
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    if not strict:
        return expr
    message = F.concat(F.lit("no entry for value "), F.coalesce(col.cast("string"), F.lit("null")))
    return expr.otherwise(F.raise_error(message).cast("double"))


def bin_right_closed(col: Column, edges: Sequence[float], bounds: str = "closed") -> Column:
    """Number of the interval ``(lo, hi]`` that holds the value, counted from 1.

    ``closed``: outside the outer edges gives null. ``open``: the first and the last
    interval reach to infinity. Null stays null in both.
    """
    if bounds not in ("closed", "open"):
        raise ValueError(f"bounds must be 'closed' or 'open', not {bounds!r}")
    last = len(edges) - 1
    expr = F.when(col.isNull() | F.isnan(col.cast("double")), F.lit(None).cast("int"))
    for number in range(1, last + 1):
        lo, hi = F.lit(float(edges[number - 1])), F.lit(float(edges[number]))
        if bounds == "closed":
            hit = (col > lo) & (col <= hi)
        elif number < last:
            hit = col <= hi
        else:
            hit = F.lit(True)
        expr = expr.when(hit, F.lit(number))
    return expr


def positive_flag(col: Column) -> Column:
    """1 where the value is above zero, else 0 (missing counts as 0)."""
    return F.when(col > 0, F.lit(1)).otherwise(F.lit(0))


def currency(col: Column) -> Column:
    """Dollar text with thousands separators and cents."""
    return F.concat(F.lit("$"), F.format_number(col, 2))


#: Plain decimal notation; Java's own endings and hexadecimal forms are no numbers here.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_long(col: Column) -> Column:
    """Whole number from text, null when it does not parse."""
    return F.trim(col).try_cast("bigint")


def to_double(col: Column) -> Column:
    """Number from text in decimal notation, null when it is none or too large."""
    number = F.when(col.rlike(DECIMAL), F.trim(col).try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def whole_number(col: Column, kind: str = "bigint") -> Column:
    """Whole number from text, also written as ``2.0`` or ``1e2``; null when it has a fraction."""
    exact = F.when(col.rlike(DECIMAL), F.trim(col).try_cast("decimal(38,10)"))
    by_exponent = F.trim(col).try_cast("double")
    spelled = F.when(by_exponent == F.floor(by_exponent), by_exponent.try_cast(kind))
    return F.when(exact.isNotNull(), F.when(exact == F.floor(exact), exact.try_cast(kind))).when(col.rlike(DECIMAL), spelled)


def unquote(col: Column) -> Column:
    """Strip blanks, then double quotes, then single quotes from both ends."""
    return F.btrim(F.btrim(F.trim(col), F.lit('"')), F.lit("'"))


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives null on a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def iso_stamp() -> Column:
    """Current time as ISO text, for report rows only."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
