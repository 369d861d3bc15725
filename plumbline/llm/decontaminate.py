"""Benchmark decontamination: an FM-index per training shard, searched for every test phrase."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from plumbline.llm.common import quoted, without
from plumbline.llm.fmindex import FMIndex

WINDOW = 10
#: Bytes of text in one shard; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
#: Benchmark words that one broadcast holds; more of them are searched block after block.
BLOCK_WORDS = 300_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
RESULT = StructType([
    StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("items", ArrayType(StringType())),
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()),
                                               StructField("end", IntegerType())])))])


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; ``lower`` on bytes changes A-Z only."""
    return WORD.findall(text.lower())


@dataclass
class Phrases:
    """Distinct windows of a block of benchmark items, as numbers."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # right-aligned, one row per window
    lengths: np.ndarray
    item_starts: np.ndarray  # items of window w: item_of[item_starts[w]:item_starts[w + 1]]
    item_of: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, rows: list[tuple[str, str | None]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[int]] = {}
        names = sorted({name for name, _ in rows})
        number = {name: i for i, name in enumerate(names)}
        for name, text in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of((text or "").encode())]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                seen.setdefault(tuple(ids[at:at + window]), set()).add(number[name])
        keys = list(seen)
        windows = np.zeros((len(keys), window), np.int64)
        for row, key in enumerate(keys):
            windows[row, window - len(key):] = key
        items = [sorted(seen[key]) for key in keys]
        return cls(vocabulary, windows, np.array([len(k) for k in keys], np.int64),
                   np.r_[0, np.cumsum([len(i) for i in items])].astype(np.int64),
                   np.array([i for some in items for i in some], np.int64), names)


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``[start, start + count)``, one range after another."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def _indexed_runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of known words that are long enough for a window, each closed by 0, and their places."""
    known = np.r_[False, ids != 0, False]
    change = np.flatnonzero(known[1:] != known[:-1])
    starts, stops = change[::2], change[1::2]
    enough = stops - starts >= shortest
    starts, stops = starts[enough], stops[enough]
    lengths = stops - starts
    places = np.full(int((lengths + 1).sum()) + 1, -1, np.int64)
    slots = _expand(1 + np.cumsum(lengths + 1) - lengths - 1, lengths)
    places[slots] = _expand(starts, lengths)
    symbols = np.zeros(len(places), np.int64)
    symbols[slots] = ids[places[slots]]
    return symbols, places


def search_shard(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text: number of words, merged ranges of hit words, names of the items found."""
    get = phrases.vocabulary.get
    counts, numbers = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        numbers.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        numbers.append(np.zeros(1, np.int64))  # no window spans two texts
    base = np.r_[0, np.cumsum(np.array(counts, np.int64) + 1)]
    out = [(count, [], []) for count in counts]
    if not len(phrases.lengths):
        return out
    symbols, places = _indexed_runs(np.concatenate(numbers) if numbers else np.zeros(0, np.int64),
                                    int(phrases.lengths.min()))
    del numbers
    if len(symbols) < 2:
        return out
    index = FMIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.windows, phrases.lengths)
    found = np.flatnonzero(high > low)
    if not len(found):
        return out
    times = (high - low)[found]
    at = places[index.locate(_expand(low[found], times))]
    window = np.repeat(found, times)
    edge = np.zeros(base[-1] + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + phrases.lengths[window], -1)
    hit = np.r_[False, np.cumsum(edge) > 0, False]
    change = np.flatnonzero(hit[1:] != hit[:-1])
    starts, stops = change[::2], change[1::2]
    for text, start, stop in zip((np.searchsorted(base, starts, "right") - 1).tolist(),
                                 starts.tolist(), stops.tolist()):
        out[text][1].append((start - int(base[text]), stop - int(base[text])))
    text_of = np.searchsorted(base, at, "right") - 1
    pairs = np.unique(text_of * len(phrases.lengths) + window)
    text_of, window = pairs // len(phrases.lengths), pairs % len(phrases.lengths)
    many = phrases.item_starts[window + 1] - phrases.item_starts[window]
    items = phrases.item_of[_expand(phrases.item_starts[window], many)]
    for pair in np.unique(np.repeat(text_of, many) * len(phrases.names) + items).tolist():
        out[pair // len(phrases.names)][2].append(phrases.names[pair % len(phrases.names)])
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(span) for span in out]


def _characters(text: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Ranges of words as half-open ranges of code points, from the first word to the last."""
    if not ranges:
        return []
    edges = [match.span() for match in WORD.finditer(text.lower())]
    lead = np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)  # code points up to and with a byte
    return [{"start": int(lead[edges[a][0]]) - 1, "end": int(lead[edges[b - 1][1] - 1])} for a, b in ranges]


def _slices(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about one shard each."""
    sizes = np.cumsum(np.r_[0, [len(t.as_buffer()) if t.is_valid else 0 for t in texts]])
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(sizes, sizes[start] + SHARD_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield start, stop
        start = stop


def _searcher(shared, text_at: int, schema: StructType):
    """A pass over the rows that adds what one block of phrases finds to the last four columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            for start, stop in _slices(batch, texts):
                rows = batch.slice(start, stop - start)
                raw = [t or b"" for t in texts.slice(start, stop - start).to_pylist()]
                words, _, items, ranges = (rows.column(i - 4 + rows.num_columns).to_pylist() for i in range(4))
                for i, (count, found, names) in enumerate(search_shard(raw, phrases)):
                    words[i] = count
                    ranges[i] = _merged([(r["start"], r["end"]) for r in ranges[i]] + found)
                    items[i] = sorted({*items[i], *names})
                hits = [sum(b - a for a, b in some) for some in ranges]
                spans = [[{"start": a, "end": b} for a, b in some] for some in ranges]
                kinds = [rows.schema.field(i - 4 + rows.num_columns).type for i in range(4)]
                new = [pa.array(v, k) for v, k in zip((words, hits, items, spans), kinds)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-4], *new], schema=rows.schema)
    return run


def _to_characters(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            spans = [_characters(texts[i].as_py(), [(r["start"], r["end"]) for r in ranges]) if ranges else []
                     for i, ranges in enumerate(batch.column(batch.num_columns - 1).to_pylist())]
            last = pa.array(spans, batch.schema.field(batch.num_columns - 1).type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], schema=batch.schema)
    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words; an item is never cut."""
    rows = benchmark.select(quoted(id_col).cast("string").alias("name"), quoted(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("name").isNotNull())
    size = F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1  # at most so many words
    total = rows.agg(F.sum(size)).first()[0] or 0
    parts = int(total // BLOCK_WORDS) + 1
    for part in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(parts)) == part)
        yield [(r.name, r.text) for r in mine.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with ``n_words``, ``n_hit``, ``items`` and ``spans`` added.

    Each task reads its rows shard by shard (``SHARD_BYTES``), numbers the words by the
    benchmark's vocabulary, indexes the runs of known words that could hold a window, searches
    all windows backwards and locates every occurrence. A word inside an occurrence is hit; touching
    occurrences make one span of code points. No row is shuffled. The benchmark is held in
    blocks of bounded size; more than one block means one more pass over the rows each.

    Null and empty texts have no words. Items without words or without id are left out, and
    repeated ids count as one item. Repeated rows are searched row by row. An empty benchmark
    hits nothing; an empty table gives no rows. Input columns that have a result's name are replaced.
    """
    names = RESULT.names
    if text_col.lower() in names:
        raise ValueError(f"the text column cannot be called {text_col!r}")
    frame = without(docs, *names)
    empty = ["cast(0 as long)", "cast(0 as long)", "cast(array() as array<string>)",
             "cast(array() as array<struct<start:int,end:int>>)"]
    frame = frame.select("*", *[F.expr(e).alias(n) for e, n in zip(empty, names)])
    text_at = frame.columns.index(text_col)
    frame = frame.withColumn(text_col, quoted(text_col).cast("string"))
    schema = StructType([StructField(f.name, f.dataType) for f in frame.schema])
    for rows in _blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Phrases.of(rows, window))
        frame = frame.mapInArrow(_searcher(shared, text_at, schema), schema)
    return frame.mapInArrow(_to_characters(text_at), schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents with all their columns, those that hold a test phrase left out."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no name can clash
    found = find_leaks(plain, benchmark, f"c{docs.columns.index(text_col)}", **options)
    return found.where(F.col("n_hit") == 0).select(*plain.columns).toDF(*docs.columns)
