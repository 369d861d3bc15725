"""SimHash near-duplicates: fingerprints, a self-join of binary tries, and groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_groups, quoted, row_key, store
from plumbline.llm.components import components

WORDS_PER_SHINGLE = 4
HASH_SEED = 42
MAX_DIFFERENCE = 4
BITS = 64
#: A node pair with at most this many leaf pairs is compared leaf by leaf.
LEAF_PAIRS = 64
#: Node pairs or leaf pairs held at once by a task.
PAIRS_AT_ONCE = 1 << 20
#: Rows of whole groups that a task joins at once, beyond the rows of one group.
ROWS_AT_ONCE = 200_000
#: A group of more rows than this, and than four usual groups, is cut into blocks.
BLOCK_ROWS = 2048


def fingerprint(text: str | None, words_per_shingle: int = WORDS_PER_SHINGLE) -> int:
    """SimHash of one text as a signed 64-bit number; no words give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(words_per_shingle, len(words))
    digest, seed = xxhash.xxh64_digest, HASH_SEED
    hashes = b"".join([digest(joined[s:e], seed) for s, e in
                       zip(starts[:len(words) - span + 1].tolist(), ends[span - 1:].tolist())])
    count = len(words) - span + 1
    ones = np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(count, 8)
    for at in range(0, count, 4096):
        ones += np.unpackbits(rows[at:at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">i8")[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(text) for text in texts], dtype="int64")


def fingerprints(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "long")(text)


def segments(bits: int = BITS, parts: int = MAX_DIFFERENCE + 1) -> list[tuple[int, int]]:
    """``(shift, width)`` of the parts that a fingerprint is cut into, highest bits first."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(bits - high, high - low) for low, high in zip(edges, edges[1:])]


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    """Bits in the order in which this trie reads them: those from ``by`` on first."""
    if by == 0:
        return values
    return (values << np.uint64(by)) | (values >> np.uint64(BITS - by))


def _forest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of linked rows; a label is a row no larger than its own."""
    while len(a):
        low, high = labels[a], labels[b]
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        if not len(a):
            return
        np.minimum.at(labels, np.maximum(low, high), np.minimum(low, high))
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def trie_links(groups: np.ndarray, sides: np.ndarray, values: np.ndarray,
               budget: int = MAX_DIFFERENCE) -> np.ndarray:
    """Self-join of one binary trie per group; returns for each row the first row of its tree.

    ``values`` must be sorted inside ``(group, side)``. A node is a range of rows that share
    their leading bits, its children are the rows with a 0 and with a 1 in the next bit. Pairs
    of nodes go down together; a pair whose paths differ in more bits than the budget is
    dropped with all below it. A group with two sides is joined across its sides only.
    """
    n = len(values)
    labels = np.arange(n)
    if n < 2:
        return labels
    edge = np.flatnonzero((groups[1:] != groups[:-1]) | (sides[1:] != sides[:-1])) + 1
    starts, stops = np.r_[0, edge], np.r_[edge, n]
    again = np.r_[False, groups[starts[1:]] == groups[starts[:-1]]]
    second = np.flatnonzero(again)
    alone = np.flatnonzero(~again & ~np.r_[again[1:], False])
    first = np.r_[alone, second - 1]
    other = np.r_[alone, second]
    stack = [(0, starts[first], stops[first], starts[other], stops[other],
              np.zeros(len(first), np.int64))]
    ones: dict[int, np.ndarray] = {}

    def ones_before(depth: int) -> np.ndarray:
        if depth not in ones:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(bit.astype(np.int32))].astype(np.int32)
        return ones[depth]

    def compare(al, ah, bl, bh):
        count = (ah - al) * (bh - bl)
        at = 0
        while at < len(count):
            upto = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), PAIRS_AT_ONCE, "right")) + at)
            some = slice(at, upto)
            sizes = count[some]
            which = np.repeat(np.arange(at, upto), sizes)
            step = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            width = (bh - bl)[which]
            i, j = al[which] + step // width, bl[which] + step % width
            near = (np.bitwise_count(values[i] ^ values[j]) <= budget) & (i != j)
            _forest(labels, i[near], j[near])
            at = upto

    while stack:
        depth, al, ah, bl, bh, used = stack.pop()
        if len(al) > PAIRS_AT_ONCE:
            half = len(al) // 2
            for some in (slice(0, half), slice(half, None)):
                stack.append((depth, al[some], ah[some], bl[some], bh[some], used[some]))
            continue
        leaf = ((ah - al) * (bh - bl) <= LEAF_PAIRS) | (depth == BITS)
        if leaf.any():
            compare(al[leaf], ah[leaf], bl[leaf], bh[leaf])
            rest = ~leaf
            al, ah, bl, bh, used = al[rest], ah[rest], bl[rest], bh[rest], used[rest]
        if not len(al):
            continue
        before = ones_before(depth)
        am, bm = ah - (before[ah] - before[al]), bh - (before[bh] - before[bl])
        itself = (al == bl) & (ah == bh)
        children = [(al, am, bl, bm, used), (am, ah, bm, bh, used), (al, am, bm, bh, used + 1),
                    (am[~itself], ah[~itself], bl[~itself], bm[~itself], used[~itself] + 1)]
        al, ah, bl, bh, used = (np.concatenate(part) for part in zip(*children))
        live = (ah > al) & (bh > bl) & (used <= budget)
        stack.append((depth + 1, al[live], ah[live], bl[live], bh[live], used[live]))
    return labels


def _joined(rows: pa.Table) -> pa.RecordBatch:
    """Links of whole groups: each row with the first row of its tree, in fingerprints."""
    names = ("part", "segment", "first", "second", "side")
    keys = [rows.column(name).to_numpy().astype(np.int64) for name in names]
    prints = rows.column("fp").to_numpy().view(np.uint64)
    values = np.empty_like(prints)
    for part, (shift, width) in enumerate(segments()):
        mine = keys[0] == part
        values[mine] = _rotated(prints[mine], BITS - shift - width)
    order = np.lexsort((values, *keys[::-1]))
    keys, values, prints = [key[order] for key in keys], values[order], prints[order]
    change = np.zeros(len(values), bool)
    for key in keys[:4]:
        change[1:] |= key[1:] != key[:-1]
    labels = trie_links(np.cumsum(change), keys[4], values)
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    signed = prints.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[labels[moved]])],
                                      names=["fp_a", "fp_b"])


def _join_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups arrive one after another; join them some at a time, never cutting one."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS_AT_ONCE:
            continue
        table = pa.Table.from_batches(held)
        names = ("part", "segment", "first", "second")
        same = np.ones(rows, bool)
        for name in names:
            key = table.column(name).to_numpy()
            same &= key == key[-1]
        cut = rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield _joined(table.slice(0, cut))
            table = table.slice(cut)
        held, rows = table.to_batches(), table.num_rows
    if rows:
        yield _joined(pa.Table.from_batches(held))


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``(fp_a, fp_b)`` that connect all distinct fingerprints ``fp`` in reach of each other.

    Two fingerprints within the budget agree in at least one of ``budget + 1`` parts. So a trie
    is read once from each part on, its top levels without any differing bit: these levels are
    the key by which Spark deals the rows, and the pairs of nodes below go down in the tasks.
    A group that is far larger than usual is cut into blocks by a hash, and each pair of its
    blocks is a task of its own. Only a spanning forest of each task's links is returned.
    """
    parts = F.array(*[
        F.struct(F.lit(part).cast("byte").alias("part"),
                 F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).cast("int").alias("segment"))
        for part, (shift, width) in enumerate(segments())])
    dealt = prints.select("fp", F.inline(parts))
    sizes = dealt.groupBy("part", "segment").count()
    total, groups = prints.count(), sum(1 << width for _, width in segments())
    block = max(BLOCK_ROWS, 4 * total * (MAX_DIFFERENCE + 1) // groups)
    large = store(sizes.where(F.col("count") > block)
                  .select("part", "segment", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
                  "large-groups")
    dealt = dealt.join(large, ["part", "segment"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.select("fp", "part", "segment", "own",
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("fp", "part", "segment", F.least("own", "other").alias("first"),
                         F.greatest("own", "other").alias("second"),
                         (F.col("own") > F.col("other")).cast("byte").alias("side"))
    keys = ["part", "segment", "first", "second"]
    return (dealt.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_join_partition, "fp_a long, fp_b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``row_key``, ``fingerprint``, ``group``, ``component_id``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most
    ``MAX_DIFFERENCE`` bits, the document's own included; ``group`` names the same group by a
    fingerprint. Null and empty texts have fingerprint zero and link like any other. Repeated
    rows and ids are rows of the same group; null ids never name a group unless all are null.
    An empty table gives no rows. Other columns of the input don't matter.
    """
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    rows = store(rows.select("doc_id", row_key("doc_id", "text").alias("row_key"),
                             fingerprints(F.col("text")).alias("fp")), "fingerprints")
    classes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies")), "classes")
    roots = components(near_links(classes.select("fp")), "fp_a", "fp_b")
    classes = (classes.join(roots, classes.fp == roots.node, "left")
               .select("fp", "least_id", "copies", F.coalesce("root", "fp").alias("group")))
    classes = store(classes, "grouped")
    total = classes.agg(F.coalesce(F.sum("copies"), F.lit(1))).first()[0]
    named = classes.groupBy("group").agg(F.min("least_id").alias("component_id"), F.count("*").alias("size"))
    classes = store(join_groups(classes, named, ["group"], "size", total).select("fp", "copies", "group", "component_id"), "named")
    return (join_groups(rows, classes, ["fp"], "copies", total)
            .select(F.col("doc_id").alias(id_col), "row_key", F.col("fp").alias("fingerprint"),
                    "group", "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, one of each group of near-duplicates.

    The smallest id stays (a null id only where all are null), among equal ids the smallest
    row key; one of repeated rows.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no name can clash
    of_id, of_text = (f"c{docs.columns.index(name)}" for name in (id_col, text_col))
    found = near_duplicates(plain, of_id, of_text)
    order = F.struct(F.col(of_id).isNull(), of_id, "row_key")
    kept = found.groupBy("group").agg(F.min_by("row_key", order).alias("row_key")).select("row_key")
    keyed = plain.withColumn("row_key", row_key(F.col(of_id), F.col(of_text).cast("string")))
    one = keyed.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"])
    return one.select(*plain.columns).toDF(*docs.columns)
