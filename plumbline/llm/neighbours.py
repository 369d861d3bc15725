"""Approximate nearest neighbours by counting collisions in query-centred windows."""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, store

#: Random projections, each with one sorted array per shard.
PROJECTIONS = 96
#: Half a window is so many times the search radius.
HALF_WIDTH = 1.0
#: Share of the vectors at exactly the search radius that must pass the collision threshold.
CAUGHT = 0.95
#: First radius as a share of the usual distance, and its growth from round to round.
FIRST_RADIUS, GROWTH = 0.3, 1.2
SHARD_ROWS = 16_384
#: Queries that one broadcast holds, and collision counts that a task holds at once.
BLOCK_QUERIES = 20_000
COUNTS_AT_ONCE = 1 << 20
SEED = 17
#: Standard score that 95 % of a normal distribution stays under.
_SCORE = 1.645


def threshold() -> int:
    """Collisions out of ``PROJECTIONS`` that a vector at the search radius reaches with chance ``CAUGHT``."""
    p = erf(HALF_WIDTH / sqrt(2))
    return max(1, int(PROJECTIONS * p - _SCORE * sqrt(PROJECTIONS * p * (1 - p))))


class Shard:
    """The vectors of a shard and, for each projection, their values in order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.n = ids, vectors, len(ids)
        directions = np.random.default_rng(SEED).normal(size=(vectors.shape[1], PROJECTIONS))
        self.directions = directions
        values = vectors @ directions
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        ordered = np.take_along_axis(values.T, self.order, axis=1)
        self.low = float(values.min())
        self.span = float(values.max()) - self.low + 1.0
        # one array for all projections: each has a stretch of its own, two spans apart
        self.flat = (ordered - self.low + 2 * self.span * np.arange(PROJECTIONS)[:, None]).ravel()
        self.order = self.order.ravel()
        self.usual = float(values.std(axis=0).mean()) * sqrt(2)

    def _edges(self, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the flat array where each query's window begins and ends, per projection."""
        base = 2 * self.span * np.arange(PROJECTIONS)
        half = HALF_WIDTH * radius[:, None]
        low = np.clip(centres - half - self.low, -0.5, self.span) + base
        high = np.clip(centres + half - self.low, -0.5, self.span) + base
        return np.searchsorted(self.flat, low, "left"), np.searchsorted(self.flat, high, "right")

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and distances of up to ``k`` nearest rows for each query; ``own`` ids are left out.

        The radius grows; windows widen by what is new on either side. Vectors that collide often
        enough are verified by their distance. A query ends when its k-th best lies within the radius,
        or when every row was verified.
        """
        count = len(queries)
        centres = queries @ self.directions
        hits = np.zeros((count, self.n), np.int16)
        distance = np.full((count, self.n), np.inf)
        seen = self.ids[None, :] == own[:, None]
        left = None
        radius = np.full(count, max(self.usual * FIRST_RADIUS, 1e-9))
        live, enough = np.arange(count), threshold()
        while len(live):
            low, high = self._edges(centres[live], radius[live])
            if left is None:
                left, right = low.copy(), low.copy()
            new = [(low, left[live]), (right[live], high)]
            left[live], right[live] = low, high
            for start, stop in new:
                size = np.maximum(stop - start, 0).ravel()
                total = np.cumsum(size)
                slots = np.arange(total[-1]) + np.repeat(start.ravel() - total + size, size)
                row = np.repeat(np.repeat(np.arange(len(live)), PROJECTIONS), size)
                added = np.bincount(row * self.n + self.order[slots], minlength=len(live) * self.n)
                hits[live] += added.reshape(len(live), self.n).astype(np.int16)
            row, rows = np.nonzero((hits[live] >= enough) & ~seen[live])
            which = live[row]
            seen[which, rows] = True
            for at in range(0, len(rows), COUNTS_AT_ONCE // 16):
                some = slice(at, at + COUNTS_AT_ONCE // 16)
                gap = self.vectors[rows[some]] - queries[which[some]]
                distance[which[some], rows[some]] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            if self.n > k:
                kth = np.partition(distance[live], k - 1, axis=1)[:, k - 1]
            else:
                kth = np.full(len(live), np.inf)
            open_ = (kth > radius[live]) & ~seen[live].all(axis=1)
            live = live[open_]
            radius[live] *= GROWTH
        out = []
        for i in range(count):
            found = np.flatnonzero(np.isfinite(distance[i]))
            best = found[np.lexsort((self.ids[found], distance[i, found]))[:k]]
            out.append((self.ids[best], distance[i, best]))
        return out


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], type=column.type.value_type)
    return flat.to_numpy().astype(np.float64).reshape(-1, dim)


def _search_shard(shared, dim: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        names, ids, queries = shared.value
        shard = Shard(table.column("id").to_numpy(), _matrix(table.column("vector"), dim))
        some = max(1, COUNTS_AT_ONCE // shard.n)
        key, near, gap = [], [], []
        for at in range(0, len(names), some):
            for i, (found, far) in enumerate(shard.search(ids[at:at + some], queries[at:at + some], k), at):
                key.append(np.full(len(found), names[i]))
                near.append(found)
                gap.append(far)
        return pa.table({"query": np.concatenate(key) if key else np.zeros(0, np.int64),
                         "id": np.concatenate(near) if near else np.zeros(0, np.int64),
                         "score": np.concatenate(gap) if gap else np.zeros(0)})
    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(id, vector)`` of the rows that take part, and their dimension.

    Rows without id are left out, and vectors that are null, zero, or hold nulls or non-finite
    numbers; of several dimensions the most frequent one counts (the larger of equals).
    """
    vector = quoted(vector_col).cast("array<double>")
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes.dim if sizes else 0
    return rows.where(F.size("vector") == dim), dim


def nearest(vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            every: int = 100) -> DataFrame:
    """``(query_id, rank, id_col, score)``: up to ``k`` nearest rows of each query row.

    Queries are the rows whose id ``every`` divides, candidates all rows but those with the query's id; the score
    is the Euclidean distance. All rows are dealt by a hash of the id to shards of about ``SHARD_ROWS``
    and indexed there; queries are broadcast in blocks of bounded size, one pass each. Every shard
    answers with its own ``k`` best, of which the ``k`` best stay; ties go to the smaller id.

    Equal copies of a query row are answered once, rows with one id and other vectors each for itself.
    Repeated candidates count each. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows, dim = usable(vectors, id_col, vector_col)
    rows = store(rows, "vectors")
    total = rows.count()
    queries = store(rows.where(F.col("id") % every == 0).distinct()
                    .withColumn("query", F.monotonically_increasing_id()), "queries")
    shards = max(1, -(-total // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    found = None
    for block in range(blocks):
        mine = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        table = mine.select("query", "id", "vector").toArrow()
        shared = spark.sparkContext.broadcast(
            (table.column("query").to_numpy(), table.column("id").to_numpy(), _matrix(table.column("vector"), max(1, dim))))
        part = (dealt.groupBy("shard").applyInArrow(_search_shard(shared, dim, k), "query long, id long, score double"))
        found = part if found is None else found.union(part)
    best = Window.partitionBy("query").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = queries.select("query", F.col("id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"),
                                              F.col("id").alias(id_col), "score")
