"""MinHash near-duplicates: one-permutation hashing, optimal densification, bands, and stars of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_groups, quoted, row_key, store
from plumbline.llm.components import components

WORDS_PER_SHINGLE = 5
#: Least similarity of a link, in hundredths.
SIMILARITY = 85
#: Bands of a signature and bins in each. Two sets at the least similarity share no band with odds of 1e-10.
BANDS, BINS_PER_BAND = 48, 6
BINS = BANDS * BINS_PER_BAND
#: Probes that an empty bin makes one by one before the rest of its order is looked at as a whole.
PROBES = 6
#: Edges of one centre that are confirmed with one copy of its set.
EDGES_PER_COPY = 1000
#: Groups that are broadcast to join them; with more of them the rows are shuffled, but for those of hot groups.
MOST_BROADCAST = 1_000_000
#: Bits of a set's parities, rows of a bucket that one task compares with as many others, and of those at once.
PARITIES, BLOCK_ROWS, ROWS_AT_ONCE = 2048, 2048, 32
#: Word hashes that a task remembers.
REMEMBERED_WORDS = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_EDGES = np.array([(i << 64) // BINS for i in range(BINS)], np.uint64)
#: For every bin, the rank of each other bin as its donor while it is empty; the same for all sets.
_RANK = np.argsort(np.random.default_rng(12).random((BINS, BINS)), axis=1).argsort(axis=1).astype(np.int16)
_ORDER = np.argsort(_RANK, axis=1)


def _scrambled(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others, so that ranges of the value are bins of equal odds."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, known: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; no words give none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = {} if known is None else known
    if len(known) > REMEMBERED_WORDS:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh64_intdigest(word, 12)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    span = min(WORDS_PER_SHINGLE, len(words))
    count = len(words) - span + 1
    joined = np.full(count, span, np.uint64)
    for i in range(span):
        joined = joined * _MULTIPLIER + each[i:i + count]
    return np.unique(_scrambled(joined))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin; an empty bin takes that of the first filled bin in its own order."""
    first = np.searchsorted(hashes, _EDGES)
    filled = first < np.r_[first[1:], len(hashes)]
    donors = np.arange(BINS)
    empty = np.flatnonzero(~filled)
    for step in range(PROBES):
        if not len(empty):
            break
        tried = _ORDER[empty, step]
        good = filled[tried]
        donors[empty[good]] = tried[good]
        empty = empty[~good]
    if len(empty):
        places = np.flatnonzero(filled)
        donors[empty] = places[np.argmin(_RANK[np.ix_(empty, places)], axis=1)]
    return hashes[first[donors]]


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One signed 64-bit bucket per band."""
    rows = signature(hashes).reshape(BANDS, BINS_PER_BAND)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BINS_PER_BAND):
        key = _scrambled(key * _MULTIPLIER + rows[:, i])
    return key.view(np.int64)


def parities(hashes: np.ndarray) -> bytes:
    """Whether each of ``PARITIES`` parts of a set has an odd number of hashes. Where two sets differ in this, they
    differ in a hash at least: so the differing bits are never more than the differing hashes."""
    counts = np.bincount((hashes & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits(counts.astype(np.uint8) & 1).tobytes()


def _sketched(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("row_key", pa.binary()), ("n", pa.int64()), ("class", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            counts, classes, bands = [], [], []
            for text in batch.column(2):
                hashes = shingles(text.as_py(), known)
                counts.append(len(hashes))
                classes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                bands.append(band_keys(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], schema=schema)
    return run


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for batch in batches:
        sets = [shingles(text.as_py(), known) for text in batch.column(1)]
        bits = pa.array([parities(s) for s in sets], pa.binary())
        full = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), full, bits], names=["node", "set", "parity"])


def _join_stored(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join with a stored table of groups of small rows, by broadcast up to a number of them."""
    if groups.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(groups), keys)
    return join_groups(rows, groups, keys, count, total)


def confirmed(edges: DataFrame, sets: DataFrame, total: int) -> DataFrame:
    """The edges ``(a, b)`` whose full sets are similar enough; ``sets`` has ``(node, set)``.

    A centre with many edges is confirmed in parts: its set is copied once per part, each part of bounded size.
    """
    fans = edges.groupBy("a").agg(F.count("*").alias("fan"))
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("fan") / EDGES_PER_COPY)).cast("int")
    dealt = join_groups(edges, fans, ["a"], "fan", total).select("a", "b", part.alias("part"))
    parts = F.explode(F.sequence(F.lit(0), F.ceil(F.col("fan") / EDGES_PER_COPY).cast("int") - 1))
    centres = (sets.join(fans, sets.node == fans.a)
               .select("a", F.col("set").alias("set_a"), parts.alias("part")))
    members = dealt.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return members.join(centres, ["a", "part"]).where(100 * common >= SIMILARITY * union).select("a", "b")


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open(rows: DataFrame) -> DataFrame:
    """Buckets ``(bucket, count)`` whose nodes are not all connected."""
    ends = F.count("*").alias("count"), F.min("root").alias("low"), F.max("root").alias("high")
    return rows.groupBy("bucket").agg(*ends).where("low <> high").select("bucket", "count")


def _fitting(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def first_stars(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links ``(a, b)`` of one star per bucket. Its centre is the node that has most company in all its
    buckets, for around a text that others were made from it is the one that most of them are similar to."""
    company = members.groupBy("node").agg(F.sum("count").alias("company"))
    rows = store(members.join(company, "node"), "company")
    best = F.max_by(F.struct("node", "n"), F.struct("company", -F.col("node"))).alias("c")
    centres = store(rows.groupBy("bucket").agg(best, F.count("*").alias("times")), "centres")
    edges = (_join_stored(rows.drop("count"), centres, ["bucket"], "times", max(1, rows.count()))
             .where((F.col("c.node") != F.col("node")) & _fitting("n", "c.n"))
             .select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct())
    edges = store(edges, "edges")
    return store(confirmed(edges, sets, max(1, edges.count())), "links")


def _pairs(group: pa.Table, best_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of two components in one bucket that can be similar enough by their sizes and parities.

    The largest component is not compared with itself. With ``best_only`` a node keeps one node of each other component,
    the one that differs least.
    """
    node, n, root, side = (group.column(c).to_numpy() for c in ("node", "n", "root", "side"))
    bits = np.frombuffer(b"".join(group.column("parity").to_pylist()), np.uint64).reshape(len(node), -1)
    kinds, which, sizes = np.unique(root, return_inverse=True, return_counts=True)
    others = np.flatnonzero(which != np.argmax(sizes))
    place = np.full(len(node), -1)
    place[others] = np.arange(len(others))
    across = side.max() > 0
    left, right = [], []
    for at in range(0, len(others), ROWS_AT_ONCE):
        some = others[at:at + ROWS_AT_ONCE]
        fits = which[some, None] != which
        fits &= 100 * np.minimum(n[some, None], n) >= SIMILARITY * np.maximum(n[some, None], n)
        fits &= side[some, None] != side if across else place[some, None] > place
        a, b = np.nonzero(fits)
        apart = np.bitwise_count(bits[some[a]] ^ bits[b]).sum(axis=1, dtype=np.int64)
        # Of sets at the least similarity s, at most (1 - s) / (1 + s) of all their hashes differ.
        good = (100 + SIMILARITY) * apart <= (100 - SIMILARITY) * (n[some[a]] + n[b])
        a, b, apart = some[a[good]], b[good], apart[good]
        if best_only and len(a):
            order = np.lexsort((b, apart, which[b], a))
            a, b = a[order], b[order]
            first = np.r_[True, (a[1:] != a[:-1]) | (which[b[1:]] != which[b[:-1]])]
            a, b = a[first], b[first]
        left.append(node[a])
        right.append(node[b])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _comparer(best_only: bool):
    keys = ["bucket", "first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(parts):
            a, b = _pairs(pa.Table.from_batches(parts), best_only)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        held, last = [], None
        for batch in batches:
            values = np.stack([batch.column(c).to_numpy() for c in keys])
            edges = np.flatnonzero(np.r_[True, (values[:, 1:] != values[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for low, high in zip(edges, [*edges[1:], batch.num_rows]):
                key = tuple(values[:, low])
                if held and key != last:
                    yield compared(held)
                    held = []
                held.append(batch.slice(low, high - low))
                last = key
        if held:
            yield compared(held)
    return run


def possible_edges(rows: DataFrame, bits: DataFrame, best_only: bool) -> DataFrame:
    """Distinct pairs ``(a, b)`` of ``rows`` ``(bucket, node, n, root)`` that share a bucket, belong to different
    components, and may be similar enough by ``bits`` ``(node, parity)``. A bucket of many rows is cut into blocks, and each pair of blocks is a group of
    its own, so that a task never holds more than two blocks of one bucket."""
    still = store(_open(rows), "open")
    total = still.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    blocks = F.ceil(F.col("count") / BLOCK_ROWS).cast("int")
    dealt = _join_stored(rows, still, ["bucket"], "count", max(1, total))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                         (F.col("own") > F.col("other")).cast("byte").alias("side"), "node", "n", "root").join(bits, "node")
    keys = ["bucket", "first", "second"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_comparer(best_only), "a long, b long").distinct()


def connected(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links ``(a, b)`` that connect all nodes with a common bucket and similar sets, and each node's ``root``.

    ``members`` holds ``(bucket, node, n, count)``, the count of the bucket; ``sets`` has ``(node, set, parity)``. The first
    edges make one star per bucket. In buckets that are not connected then, nodes of different components are compared by
    their parities inside the tasks: first each node is linked with the nearest of every other component if that
    is confirmed, then all pairs that are left and possible are confirmed. So no pair of a bucket
    stays untested unless its two nodes already belong together, or parities show that they are not similar.
    """
    links = first_stars(members, sets)
    roots = components(links, "a", "b")
    bits = sets.select("node", "parity")
    for best_only in (True, False):
        rows = _labelled(members.drop("count"), roots)
        rows = store(rows.join(_open(rows).drop("count"), "bucket", "left_semi").select("bucket", "node", "n", "root"), "unsettled")
        edges = store(possible_edges(rows, bits, best_only), "edges")
        count = edges.count()
        if not count:
            break
        found = store(confirmed(edges, sets, count), "links")
        if not found.isEmpty():
            links = store(links.union(found), "links")
            roots = components(links, "a", "b")
    return links, roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id`` and ``kept``.

    Words are what ASCII blanks separate, A to Z in lower case; a document's set has its distinct five-word
    shingles, or the whole sequence of fewer words. Documents link where the intersection is at least 85 hundredths
    of the union, and ``component_id`` is the smallest id that a document reaches. Equal sets are one
    node from the start, so copies make no pairs.

    Null and empty texts have an empty set and link with nothing, not even each other: their ``component_id`` is
    their own id. Repeated rows and ids are rows of the same class; null ids name a class only where all are null, and
    ``kept`` is false for them. An empty table gives no rows. Other columns of the input don't matter.
    """
    plain = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    keyed = plain.select("doc_id", row_key("doc_id", "text").alias("row_key"), "text")
    id_type = pa.field("doc_id", plain.limit(0).toArrow().schema.field("doc_id").type).type
    rows = store(keyed.mapInArrow(_sketched(id_type), f"doc_id {kind}, row_key binary, n long, class binary, bands array<long>"),
                 "shingled")
    classes = (rows.where("n > 0").groupBy("class")
               .agg(F.min("doc_id").alias("least_id"), F.min("row_key").alias("row_key"), F.first("n").alias("n"),
                    F.first("bands").alias("bands"), F.count("*").alias("copies")))
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = classes.select("node", "n", F.explode("bands").alias("bucket"))
    total = max(1, classes.count())
    shared = store(members.groupBy("bucket").agg(F.count("*").alias("count")).where("count > 1"), "shared")
    members = store(_join_stored(members, shared, ["bucket"], "count", total * BANDS), "buckets")
    # The texts of nodes in a bucket with others are read again for their full sets; repeated rows give one.
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("row_key", "node", "copies")
    wanted = store(wanted, "wanted")
    texts = _join_stored(keyed.select("row_key", "text"), wanted, ["row_key"], "copies", total)
    sets = texts.select("node", "text").mapInArrow(_full_sets, "node long, set array<long>, parity binary").dropDuplicates(["node"])
    _, roots = connected(members, store(sets, "sets"))
    named = (classes.join(roots, "node", "left")
             .select("class", "copies", "least_id", F.coalesce("root", "node").alias("group")))
    named = store(named, "named")
    least = named.groupBy("group").agg(F.min("least_id").alias("component_id"), F.count("*").alias("size"))
    classed = join_groups(named, least, ["group"], "size", total).select("class", "copies", "component_id")
    slim = rows.select("doc_id", "n", "class")
    found = join_groups(slim.where("n > 0"), classed, ["class"], "copies", total)
    alone = slim.where("n = 0").withColumn("component_id", F.col("doc_id"))
    both = found.select("doc_id", "n", "component_id").union(alone.select("doc_id", "n", "component_id"))
    return both.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                       F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
