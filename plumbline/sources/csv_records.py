"""CSV files whose cells hold line breaks, read by as many tasks as the files have splits.

A first pass tells, for every split, whether it ends inside a quoted cell if it starts outside of one, and if it
starts inside. Put together in order these answers give the state in which each split starts. With it the second
pass joins lines to records inside its split; only records that cross a split's edge are put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A quoted cell ends at the first quote that is not doubled; what follows it up to the comma is
# not quoted. A quote inside a cell that does not start with one means nothing.
_QUOTED = r'"[^"]*(?:""[^"]*)*'
_CELL = rf'(?:{_QUOTED}"(?:[^",][^,]*)?|[^",][^,]*)?'
#: A line that ends inside a quoted cell: if it starts outside of one, and if it starts inside.
OPENED = rf'^(?:{_CELL},)*{_QUOTED}$'
STAYS_OPEN = rf'^[^"]*(?:""[^"]*)*(?:"(?:[^",][^,]*)?,(?:{_CELL},)*{_QUOTED})?$'
#: A whole quoted cell, once doubled quotes are taken out.
WHOLE_CELL_SQL = r'(^|,)"[^"]*+"(?=,|\r?$)'

#: Splits that start inside a cell, or belong to a file with ``\r\n``, are named to every task; with more of
#: them than this, each file is read by one task instead.
MOST_NAMED_SPLITS = 1_000_000


def lines_of(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, start, value)``: lines up to ``\\n`` as they stand, with what names their split."""
    lines = spark.read.text(path, lineSep="\n")
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def needs_joining(lines: DataFrame) -> bool:
    """Whether a reader that takes every line for a record could read something else.

    Without doubled quotes and whole quoted cells a line must have no quote left; if every line is like that,
    none ends inside a cell. Lines of blanks alone and scattered ``\\r`` are read differently too.
    """
    value = F.col("value")
    left = F.regexp_replace(F.replace(value, F.lit('""'), F.lit("")), WHOLE_CELL_SQL, "$1")
    opened = F.contains(value, F.lit('"')) & F.contains(left, F.lit('"'))
    inner = F.contains(F.regexp_replace(value, "\r$", ""), F.lit("\r"))
    blank = (F.length(F.trim(value)) == 0) & (F.length(value) > 0)
    seen = lines.agg(F.coalesce(F.bool_or(opened | inner | blank), F.lit(False)).alias("odd"),
                     F.count_if(value.endswith("\r")).alias("ends"), F.count("*").alias("n")).first()
    return seen.odd or seen.ends not in (0, seen.n)


def _open_at_end(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per line, whether it ends inside a quoted cell: after a start outside, and after a start inside."""
    quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
    outside, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    if quoted.any():
        some = lines.filter(pa.array(quoted))
        outside[quoted] = pc.match_substring_regex(some, f"(?s){OPENED}").to_numpy(zero_copy_only=False)
        inside[quoted] = pc.match_substring_regex(some, f"(?s){STAYS_OPEN}").to_numpy(zero_copy_only=False)
    return outside, inside


def _states(outside: np.ndarray, inside: np.ndarray, state: bool) -> np.ndarray:
    """The state before each line and after the last: the last line that leaves no choice decides, and each line
    that changes whatever state there was turns it."""
    fixed, turned = outside == inside, np.cumsum(outside & ~inside)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    since = turned - np.where(last >= 0, turned[last], 0)
    after = np.where(last >= 0, outside[last], state) ^ (since % 2 == 1)
    return np.r_[state, after]


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, pa.Array]]:
    """``(split, whether it begins here, lines)`` for runs of lines of one split."""
    before = None
    for batch in batches:
        files, starts = (batch.column(i).to_numpy() for i in range(2))
        edges = np.flatnonzero(np.r_[True, (files[1:] != files[:-1]) | (starts[1:] != starts[:-1])]) if len(files) else []
        for low, high in zip(edges, [*edges[1:], len(files)]):
            split = int(files[low]), int(starts[low])
            yield split, split != before, batch.column(2).slice(low, high - low)
            before = split


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the state at its end for either state at its start, and whether its first line ends with ``\\r``."""
    def rows():
        for split, runs in groupby(_by_split(batches), key=lambda run: run[0]):
            ends, crlf = [False, True], None
            for _, _, lines in runs:
                crlf = lines[0].as_py().endswith("\r") if crlf is None else crlf
                outside, inside = _open_at_end(lines)
                ends = [bool(_states(outside, inside, state)[-1]) for state in ends]
            yield (*split, *ends, crlf)

    found = list(rows())
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    names = ["file", "start", "after_outside", "after_inside", "crlf"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 5, kinds)], names=names)


def split_starts(lines: DataFrame) -> DataFrame:
    """``(file, start, inside, crlf)`` of every split: whether it starts inside a cell, and how its file ends lines.

    One row per split goes through a window over its file.
    """
    answers = lines.mapInArrow(_answers, "file long, start long, after_outside boolean, after_inside boolean, crlf boolean")
    order = Window.partitionBy("file").orderBy("start")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    # The last split before that leaves no choice, and the splits since then that turn the state.
    fixed = F.when(F.col("after_outside") == F.col("after_inside"), F.col("start"))
    turns = (F.col("after_outside") & ~F.col("after_inside")).cast("int")
    told = answers.withColumns({"turned": F.sum(turns).over(order), "fixed": fixed})
    mark = F.last(F.when(F.col("fixed").isNotNull(), F.struct("after_outside", "turned")), ignorenulls=True).over(upto)
    told = told.withColumns({"mark": mark, "before": F.coalesce(F.lag("turned").over(order), F.lit(0)),
                             "file_crlf": F.first("crlf").over(order)})
    since = F.col("before") - F.coalesce("mark.turned", F.lit(0))
    inside = F.coalesce("mark.after_outside", F.lit(False)) != (since % 2 == 1)
    return told.select("file", "start", inside.alias("inside"), F.col("file_crlf").alias("crlf"))


def _joiner(named: dict[tuple[int, int], tuple[bool, bool]]):
    """Records of each split; ``piece`` is 0 for whole ones, 1 where one begins that the split does not end, and 2 for the
    rest of one that began before."""
    kinds = [pa.int64(), pa.int64(), pa.int8(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, runs in groupby(_by_split(batches), key=lambda run: run[0]):
            state, crlf = named.get(split, (False, False))
            held: list[str] = []
            continued, first = state, split[1] == 0
            for _, _, lines in runs:
                if crlf:
                    lines = pc.replace_substring_regex(lines, "\r$", "")
                before = _states(*_open_at_end(lines), state)
                state = bool(before[-1])
                whole = ~before[:-1] & ~before[1:]
                out: list[tuple[int, bool, str]] = []
                if whole.all() and not held and not first:
                    texts = lines.filter(pc.not_equal(lines, ""))
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, split[0])), pa.array(np.full(n, split[1])), pa.array(np.zeros(n, np.int8)),
                         pa.array(np.zeros(n, bool)), texts.cast(pa.string())], names=_RECORD)
                    continue
                for line, open_after in zip(lines.to_pylist(), before[1:].tolist()):
                    held.append(line)
                    if open_after:
                        continue
                    if held != [""] or continued:
                        out.append((2 if continued else 0, first, "\n".join(held)))
                        first = False if not continued else first
                    held, continued = [], False
                yield _records(split, out, kinds)
            if held:
                yield _records(split, [(2 if continued else 1, first, "\n".join(held))], kinds)
    return run


_RECORD = ["file", "start", "piece", "first", "record"]


def _records(split, rows, kinds) -> pa.RecordBatch:
    cells = [[split[0]] * len(rows), [split[1]] * len(rows), *([row[i] for row in rows] for i in range(3))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=_RECORD)


def records_of(lines: DataFrame) -> DataFrame | None:
    """``record``: every record behind the headers as one text, or nothing where too many splits would have to be named."""
    starts = split_starts(lines).where("inside OR crlf").limit(MOST_NAMED_SPLITS + 1)
    named = {(r.file, r.start): (r.inside, r.crlf) for r in starts.toLocalIterator()}
    if len(named) > MOST_NAMED_SPLITS:
        return None
    rows = lines.mapInArrow(_joiner(named), "file long, start long, piece byte, first boolean, record string")
    if not any(inside for inside, _ in named.values()):
        # No split starts inside a cell, so no record crosses an edge; one may stay open at the end of a file.
        return rows.where("NOT first").select("record")
    whole = rows.where("piece = 0 AND NOT first").select("record")
    # Pieces of a record: the one that begins it, and all up to the next one that begins another.
    order = Window.partitionBy("file").orderBy("start", F.col("piece") == 1)
    opener = F.sum(F.when(F.col("piece") == 1, 1).otherwise(0)).over(order)
    pieces = rows.where("piece <> 0").withColumn("opener", opener)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "piece", "record"))), lambda s: s["record"])
    crossing = pieces.groupBy("file", "opener").agg(F.array_join(texts, "\n").alias("record"), F.bool_or("first").alias("first"))
    return whole.unionByName(crossing.where("NOT first").select("record"))
