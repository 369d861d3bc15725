"""Ranked lexical search: posting lists cut into blocks of similar documents, with exact maximum summaries."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, store

BEST = 20
#: Part of the saturation that follows a document's length, in hundredths, and the saturation itself times ten.
LENGTH_SHARE, SATURATION = 25, 12
SCALE = 1_000_000_000
#: Postings and documents that a task indexes at once.
SHARD_POSTINGS, SHARD_DOCS = 2_000_000, 16_384
#: Documents of one block, on average.
BLOCK_DOCS = 16
#: Numbers that stand for a document while a posting list is clustered.
SKETCH = 16
#: Terms of the items that are broadcast at once, about; more items are further passes over the documents.
ITEM_TERMS = 1_000_000

#: Bytes of a term as they are, A to Z in lower case, all others a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


@dataclass
class Items:
    """The items of one pass: their ids, and each one's terms with their repeats."""

    ids: list
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    terms: list[np.ndarray] = field(default_factory=list)
    repeats: list[np.ndarray] = field(default_factory=list)
    holders: list[list[int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        items = cls([i for i, _ in rows])
        for _, text in rows:
            counts = Counter(terms_of(text))
            items.terms.append(np.array([items.vocabulary.setdefault(t, len(items.vocabulary)) for t in counts], np.int64))
            items.repeats.append(np.array(list(counts.values()), np.int64))
        items.holders = [[] for _ in items.vocabulary]
        for at, terms in enumerate(items.terms):
            for term in terms.tolist():
                items.holders[term].append(at)
        return items

    def company(self, term: int) -> np.ndarray:
        """All terms of the items that hold a term."""
        return np.concatenate([self.terms[at] for at in self.holders[term]])


def _counted(shared):
    """Documents with their number of terms, and how often they hold each term of the items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, terms, times = batch.column(0), [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                found = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
                kinds, counts = np.unique(found[found >= 0], return_counts=True)
                sizes.append(len(words))
                terms.append(kinds)
                times.append(counts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "times"])
    return run


def _joined(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + sizes[i] - 1`` of all i in turn."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Shard:
    """Some documents: their terms by document, and the posting list of each term in blocks."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray, n: np.ndarray, items: Items):
        width = len(items.vocabulary)
        saturation = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * items.documents) // items.length
        impact = (SCALE * times) // (1000 * times + SATURATION * np.repeat(saturation, sizes))
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.terms, self.values = terms, items.weights[terms] * impact
        order = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.edges = np.r_[0, np.cumsum(np.bincount(terms, minlength=width))]
        self.most = np.zeros(width, np.int64)
        held = np.flatnonzero(np.diff(self.edges))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.values[order], self.edges[held])
        self.asked, self.items, self._wanted = np.zeros(width, np.int64), items, np.zeros(width, bool)
        self.width, self._sketches, self._blocks = width, None, {}

    def _sketch(self) -> np.ndarray:
        """Each document as a short vector of length one; similar documents have a large product."""
        if self._sketches is None:
            sign = np.random.default_rng(13).choice(np.array([-1.0, 1.0]), (SKETCH, self.width))
            where, values = np.repeat(np.arange(len(self.sizes)), self.sizes), np.sqrt(self.values)
            found = np.stack([np.bincount(where, values * sign[i][self.terms], len(self.sizes)) for i in range(SKETCH)], axis=1)
            self._sketches = (found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        return self._sketches

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A posting list by blocks: its documents, the blocks' edges, and the greatest value of each term in each block.

        The documents go to the most similar of some documents of the list. The summary has the terms of all items that
        hold the list's term, as no other item reads the list; it is sparse and sorted by ``term * blocks + block``. A list
        is cut when it is first asked for.
        """
        if term not in self._blocks:
            docs = self.docs[self.edges[term]:self.edges[term + 1]]
            count = -(-len(docs) // BLOCK_DOCS)
            if count > 1:
                sketch = self._sketch()
                centres = docs[np.linspace(0, len(docs) - 1, count).astype(np.int64)]
                label = np.argmax(sketch[docs] @ sketch[centres].T, axis=1)
                by_label = np.argsort(label, kind="stable")
                docs, label = docs[by_label], label[by_label]
                edges = np.flatnonzero(np.r_[True, label[1:] != label[:-1], True])
            else:
                edges = np.array([0, len(docs)])
            count = len(edges) - 1
            block = np.repeat(np.arange(count), np.diff(edges))
            places = _joined(self.starts[docs], self.sizes[docs])
            company = self.items.company(term)
            self._wanted[company] = True
            wanted = self._wanted[self.terms[places]]
            self._wanted[company] = False
            places = places[wanted]
            code = self.terms[places] * count + np.repeat(block, self.sizes[docs])[wanted]
            order = np.argsort(code, kind="stable")
            code, values = code[order], self.values[places][order]
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            self._blocks[term] = docs, edges, code[first], np.maximum.reduceat(values, first)
        return self._blocks[term]

    def bounds(self, term: int, terms: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """What a document of each block of a list can score at most."""
        _, edges, code, most = self.blocks(term)
        count = len(edges) - 1
        low, high = np.searchsorted(code, terms * count), np.searchsorted(code, (terms + 1) * count)
        places = _joined(low, high - low)
        found = np.zeros(count, np.int64)
        np.add.at(found, code[places] - np.repeat(terms * count, high - low), most[places] * np.repeat(repeats, high - low))
        return found

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Exact scores of documents under the item in ``asked``; each has a term at least."""
        sizes = self.sizes[docs]
        places = _joined(self.starts[docs], sizes)
        return np.add.reduceat(self.values[places] * self.asked[self.terms[places]], np.cumsum(sizes) - sizes)


@dataclass
class Top:
    """The best documents that a task has found for an item; null ids come last among equal scores."""

    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    unnamed: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    def least(self) -> int:
        """A document below this score cannot enter."""
        return max(1, int(self.scores[-1])) if len(self.scores) == BEST else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            scores, ids, unnamed = (np.r_[a, b[good]] for a, b in zip((self.scores, self.ids, self.unnamed), (scores, ids, unnamed)))
            order = np.lexsort((ids, unnamed, -scores))[:BEST]
            self.scores, self.ids, self.unnamed = scores[order], ids[order], unnamed[order]


def search(shard: Shard, ids: np.ndarray, unnamed: np.ndarray, items: Items, tops: list[Top], work: Counter | None = None) -> None:
    """Bring the best documents of each item up to date with one shard.

    An item's lists are read from the one that can give most on. What the remaining lists can give
    together bounds every document that is in none of the lists read, and what a block's summary gives bounds its
    documents; only where such a bound is below the least score that may enter, lists and blocks are skipped.
    """
    work = Counter() if work is None else work
    seen = np.full(len(ids), -1)
    for at, (terms, repeats, top) in enumerate(zip(items.terms, items.repeats, tops)):
        held = shard.most[terms] > 0
        terms, repeats = terms[held], repeats[held]
        most = shard.most[terms] * repeats
        order = np.argsort(-most, kind="stable")
        rest = np.cumsum(most[order][::-1])[::-1]
        shard.asked[terms] = repeats
        for term, left in zip(terms[order], rest):
            if left < top.least():
                break
            docs, edges, _, _ = shard.blocks(term)
            bounds = shard.bounds(term, terms, repeats)
            waiting = np.argsort(-bounds, kind="stable")
            work["blocks"] += len(waiting)
            step = 4
            while len(waiting):
                waiting = waiting[bounds[waiting] >= top.least()]
                some, waiting = waiting[:step], waiting[step:]
                chosen = docs[_joined(edges[some], edges[some + 1] - edges[some])]
                chosen = chosen[seen[chosen] != at]
                work["read"] += len(some)
                step *= 2
                if len(chosen):
                    seen[chosen] = at
                    work["scored"] += len(chosen)
                    top.add(shard.scores(chosen), ids[chosen], unnamed[chosen])
        shard.asked[terms] = 0


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, postings, rows = [], 0, 0
    for batch in batches:
        for start in range(0, batch.num_rows, SHARD_DOCS // 4):
            part = batch.slice(start, SHARD_DOCS // 4)
            size = len(part.column(2).flatten())
            if held and (postings + size > SHARD_POSTINGS or rows + part.num_rows > SHARD_DOCS):
                yield pa.Table.from_batches(held)
                held, postings, rows = [], 0, 0
            held.append(part)
            postings, rows = postings + size, rows + part.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        tops = [Top() for _ in items.ids]
        for table in _shards(batches):
            ids, n, terms, times = (column.combine_chunks() for column in table.columns)
            shard = Shard(terms.value_lengths().to_numpy().astype(np.int64), terms.flatten().to_numpy().astype(np.int64),
                          times.flatten().to_numpy(), n.to_numpy(), items)
            search(shard, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), items, tops)
        for at, top in enumerate(tops):
            if len(top.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top.ids), at, np.int32)), pa.array(top.ids, mask=top.unnamed), pa.array(top.scores)],
                    names=["item", "doc_id", "score"])
    return run


def _passes(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The distinct items in parts of about ``ITEM_TERMS`` terms; an item is never cut."""
    rows = items.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text")).distinct()
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1)).first()[0] or 0
    parts = int(total // ITEM_TERMS) + 1
    for part in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        if found := [(r.id, r.text) for r in mine.collect()]:
            yield found


def best_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``BEST`` documents of each item: ``item_id``, ``rank`` from 1, ``doc_id`` and ``score``.

    The first scan counts, the counts are stored, and a task searches them shard by shard without a
    shuffle: posting lists are cut into blocks of similar documents, a block keeps the greatest value of every term,
    and it is skipped only when this shows that none of its documents can enter. What a task returns is bounded by the
    number of items. Items are broadcast in parts of bounded size, each part a pass of its own.

    Document ids are whole numbers; a null one comes after all others of its score. Null and empty texts have no terms and
    never appear. Repeated rows are documents of their own. Items of one id and text count once, items of one id with
    different texts are ranked each by itself. Empty tables, and items without any known term, give no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    kind = items.select(quoted(item_id).alias("item_id")).schema["item_id"].dataType
    results = []
    for rows in _passes(items, item_id, item_text):
        asked = Items.of(rows)
        words = spark.sparkContext.broadcast(asked.vocabulary)
        counted = store(plain.mapInArrow(_counted(words), "doc_id long, n long, terms array<int>, times array<long>").where("n > 0"),
                        "counted")
        asked.documents, asked.length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
        holding = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        asked.weights = np.array([math.floor(1000 * math.log((2 * asked.documents + 2) / (2 * holding.get(t, 0) + 1)))
                                  for t in range(len(asked.vocabulary))], np.int64)
        shared = spark.sparkContext.broadcast(asked)
        found = counted.where(F.size("terms") > 0).mapInArrow(_searcher(shared), "item int, doc_id long, score long")
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= BEST)
        names = spark.createDataFrame([(i, name) for i, name in enumerate(asked.ids)],
                                      f"item int, item_id {kind.simpleString()}")
        results.append(store(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
        words.unpersist()
        shared.unpersist()
    empty = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for result in results:
        empty = empty.unionByName(result)
    return empty
