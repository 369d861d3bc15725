"""Substring dedup by hashing lines and the sentences in them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import join_groups, quoted, store, without

#: Repeated units that stand side by side go if they hold so many words together.
LEAST_WORDS = 20
#: Units of fewer words count for ``LEAST_WORDS`` only where that many words repeat side by side, in this order.
UNIT_WORDS = 4
#: Letters of scripts without blanks between words; so many of them count as a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
LETTERS_PER_WORD = 2
UNIT = re.compile(r"[^\n.!?。！？]+[.!?。！？]*|[.!?。！？]+")
UNITS = "array<struct<start:int,end:int,words:int,high:long,low:long>>"
WINDOWS = "array<struct<first:int,last:int,high:long,low:long>>"


def units_of(text: str) -> tuple[list[int], list[int], list[int], bytes]:
    """Starts, ends and word counts of the units of a text, and their digests one after another.

    A unit is a line, or one sentence of it; blanks around it don't belong to it. Units compare
    without case and with single blanks.
    """
    starts, ends, words, digests = [], [], [], []
    for match in UNIT.finditer(text):
        piece = match.group()
        parts = piece.lower().split()
        if parts:
            start = match.start() + len(piece) - len(piece.lstrip())
            starts.append(start)
            ends.append(start + len(piece.strip()))
            words.append(len(parts) if piece.isascii() else _words(piece, parts))
            digests.append(xxhash.xxh3_128_digest(" ".join(parts).encode("utf-8", "surrogatepass")))
    return starts, ends, words, b"".join(digests)


def _words(piece: str, parts: list[str]) -> int:
    """Words between blanks, and words of scripts without blanks by their letters."""
    letters = len(UNSPACED.findall(piece))
    if not letters:
        return len(parts)
    return len(UNSPACED.sub(" ", piece).split()) + -(-letters // LETTERS_PER_WORD)


def windows_of(words: list[int], digests: bytes) -> tuple[list[int], list[int], bytes]:
    """First and last units of the windows with short units, and the windows' digests.

    From each unit on, and up to each unit, the fewest neighbours that hold ``LEAST_WORDS`` words. A shared
    stretch of so many words is the union of its windows. Windows whose other units hold
    enough words need none.
    """
    if not words or min(words) >= UNIT_WORDS:
        return [], [], b""
    total, counted = [0], [0]
    for n in words:
        total.append(total[-1] + n)
        counted.append(counted[-1] + (n if n >= UNIT_WORDS else 0))
    found, last, first = set(), 0, 0
    for at in range(len(words)):
        while last < len(words) and total[last] - total[at] < LEAST_WORDS:
            last += 1
        if total[last] - total[at] >= LEAST_WORDS > counted[last] - counted[at]:
            found.add((at, last - 1))
        while total[at + 1] - total[first + 1] >= LEAST_WORDS:
            first += 1
        if total[at + 1] - total[first] >= LEAST_WORDS > counted[at + 1] - counted[first]:
            found.add((first, at))
    pairs = sorted(found)
    each = [xxhash.xxh3_128_digest(digests[16 * i:16 * j + 16]) for i, j in pairs]
    return [i for i, _ in pairs], [j for _, j in pairs], b"".join(each)


def _lists(counts: list[int], ints: list[list[int]], digests: list[bytes], kind: pa.DataType) -> pa.Array:
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    cells = pa.StructArray.from_arrays(
        [*[pa.array(values, pa.int32()) for values in ints], pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
        fields=[kind.value_type.field(i) for i in range(len(ints) + 2)])
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), cells).cast(kind)


def _add_units(text_at: int):
    """Replace the last two columns, of nulls, by the units and the windows of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, starts, ends, words, digests = [0], [], [], [], []
            sizes, firsts, lasts, wide = [0], [], [], []
            for text in batch.column(text_at).to_pylist():
                s, e, w, d = units_of(text or "")
                starts += s
                ends += e
                words += w
                digests.append(d)
                counts.append(len(starts))
                i, j, d = windows_of(w, d)
                firsts += i
                lasts += j
                wide.append(d)
                sizes.append(len(firsts))
            units, windows = (batch.schema.field(batch.num_columns - n).type for n in (2, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], _lists(counts, [starts, ends, words], digests, units),
                 _lists(sizes, [firsts, lasts], wide, windows)], schema=batch.schema)
    return run


def _with_units(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows with ``_units``, ``_windows`` and a number ``_row``, written down so that numbers stay."""
    frame = (docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_units", F.lit(None).cast(UNITS))
             .withColumn("_windows", F.lit(None).cast(WINDOWS)))
    return frame.mapInArrow(_add_units(frame.columns.index(text_col)), frame.schema)


def _removed(units: DataFrame) -> DataFrame:
    """``(_row, spans)``: what goes of each row, from rows ``(_row, _id, unit, last, start, end, words, high, low)``.

    Rows with ``last`` are windows from ``unit`` to it, the others units.
    """
    place = F.struct("_id", "_row", "unit")
    first = units.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    first = store(first, "first")
    again = (join_groups(units, first, ["high", "low"], "n", units.count()).where(place != F.col("first"))
             .select("_row", "unit", "last", "start", "end", "words", F.col("first._id").alias("of")))
    # windows come before the unit that they start with; a repeated window's units are all repeats
    order = Window.partitionBy("_row").orderBy("unit", F.col("last").isNull(), "last").rowsBetween(Window.unboundedPreceding, 0)
    again = (again.withColumn("reach", F.max("last").over(order))
             .withColumn("run", F.col("unit") - F.sum(F.col("last").isNull().cast("int")).over(order)).where("last IS NULL"))
    counted = F.sum(F.when(F.col("words") >= UNIT_WORDS, F.col("words"))).over(Window.partitionBy("_row", "run"))
    gone = again.withColumn("counted", counted).where((F.col("counted") >= LEAST_WORDS) | (F.col("reach") >= F.col("unit")))
    beside = F.row_number().over(Window.partitionBy("_row").orderBy("unit"))
    runs = (gone.withColumn("run", F.col("unit") - beside).groupBy("_row", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"),
                 F.count("*").alias("units"), F.collect_set("of").alias("of")))
    spans = F.sort_array(F.collect_list(F.struct("start", "end", "words", "units", F.array_sort("of").alias("of"))))
    return runs.groupBy("_row").agg(spans.alias("spans"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_units, spans)``: code points of each text that repeat an earlier passage.

    Units are lines and the sentences in them. All units with one digest are counted together, the one of
    the smallest id (then reading order, then place in the text) stays, the others are
    repeats. Neighbouring repeats make a span if they hold ``LEAST_WORDS`` words together, units under ``UNIT_WORDS``
    not counted. Shorter units count where ``LEAST_WORDS`` words, of units of any length, stand side by side in an earlier place too: a common short
    line stays, and so do chance runs of such lines; a shared passage goes whatever stands around it. In scripts
    without blanks ``LETTERS_PER_WORD`` letters are a word. Copies of a hot unit are combined in
    the map tasks and joined by key; no group is gathered.

    A span's ``of`` lists the ids of the documents that keep its units. Null and empty texts have no units. A repeated row repeats all of its twin. Null ids rank first. An empty
    table gives no rows; other columns don't matter.
    """
    rows = docs.select(quoted(id_col).alias("_id"), quoted(text_col).cast("string").alias("text"))
    rows = store(_with_units(rows, "text").drop("text"), "units")
    counts = rows.select("_row", F.col("_id").alias(id_col), F.size("_units").cast("long").alias("n_units"))
    return counts.join(_removed(_exploded(rows)), "_row", "left").select(id_col, "n_units", _or_none("spans"))


def _exploded(rows: DataFrame) -> DataFrame:
    none = F.lit(None).cast("int")
    units = (rows.select("_row", "_id", F.posexplode("_units").alias("unit", "u"))
             .select("_row", "_id", "unit", none.alias("last"), "u.*"))
    windows = rows.select("_row", "_id", F.explode("_windows").alias("w"))
    return units.unionByName(windows.select(
        "_row", "_id", F.col("w.first").alias("unit"), F.col("w.last").alias("last"), none.alias("start"), none.alias("end"),
        none.alias("words"), F.col("w.high").alias("high"), F.col("w.low").alias("low")))


def _or_none(name: str):
    return F.coalesce(name, F.array()).alias(name)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, repeated spans cut out, and the spans in ``removed``.

    Offsets refer to the text before the cuts. A column called ``removed`` is replaced, any other name is kept. Rows are cut as
    ``repeated_spans`` tells: of repeated rows the first stays whole, null and empty texts stay as they are, and
    an empty table gives no rows.
    """
    docs = without(docs, "removed")
    names = docs.columns
    frame = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no name can clash
    of_id, of_text = (f"c{names.index(name)}" for name in (id_col, text_col))
    frame = frame.withColumn(of_text, F.col(of_text).cast("string"))
    rows = store(_with_units(frame, of_text).withColumn("_id", F.col(of_id)), "units")
    rows = rows.drop("_units", "_windows").join(_removed(_exploded(rows)), "_row", "left").withColumn("spans", _or_none("spans"))
    text = F.col(of_text)
    pieces = F.zip_with(F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"])),
                        F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(text))),
                        lambda start, end: F.substring(text, start + 1, end - start))
    cut = F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(text)
    return rows.withColumn(of_text, cut).select(*frame.columns, F.col("spans").alias("removed")).toDF(*names, "removed")
