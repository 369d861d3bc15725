"""Mixing sources to target weights by pivotal dependent rounding, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, row_key, store, uniform

#: Weights of the sources in the order of their names, repeating. A null source comes last.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, and how often a document may be taken at most.
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
#: Documents whose probabilities are rounded together at one node of the tree.
FAN_IN = 128
#: Repeated rows that a task writes out at once.
TWINS_AT_ONCE = 1000
SEED = 20_240_601


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 by name, null last, without gathering the names in one task."""
    order = F.col("source").asc_nulls_last()
    dealt = store(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return dealt.join(offsets, "part").withColumn("rank", F.col("before") + inside - 1).drop("part", "before")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
                   most: float = MOST_COPIES) -> DataFrame:
    """``(source, source_size, documents, target)`` from rows ``(source, size)``.

    Each source gets its share by weight. What exceeds ``most`` times its size is shared anew by
    weight among the sources below, until none is above: every round is one sum over the table.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                          F.count(F.when(F.col("size") > 0, 1)).alias("documents"))
    by_rank = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = store(_ranked(sources).withColumn("weight", by_rank).drop("rank"), "weights")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    cap, level, full = F.col("source_size") * F.lit(most), None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        taken, left, count = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))),
                                         F.count(F.when(above, 1))).first()
        if not left or count == full:
            break
        level, full = (total - float(taken or 0)) / float(left), count
    share = F.least(cap, F.col("weight") * F.lit(level or 0.0))
    return sources.select("source", "source_size", "documents", share.alias("target"))


def _node_steps(cells: Column, level: int) -> Column:
    """Round the documents of one node in turn; ``(done, rest)``: those decided and the one left.

    The carried document and the next one exchange words: the probability of one rises, that of
    the other falls by as many expected words, until one of the two is 0 or 1. Which way is drawn
    with odds that keep each document's expected number of copies.
    """
    def step(state: Column, doc: Column) -> Column:
        held = state["rest"]
        a, b, p, q = held["size"], doc["size"], held["p"], doc["p"]
        to_doc, to_held = F.least(p * a, (1 - q) * b), F.least((1 - p) * a, q * b)
        drawn = uniform(F.lit(SEED), F.lit(level), held["row_key"], doc["row_key"])
        forward = drawn * (to_doc + to_held) < to_held
        held_ends = F.when(forward, p * a <= (1 - q) * b).otherwise((1 - p) * a <= q * b)
        value = F.when(held_ends, F.when(forward, 0).otherwise(1)).otherwise(F.when(forward, 1).otherwise(0))
        left = F.when(held_ends, F.when(forward, q + p * a / b).otherwise(q - (1 - p) * a / b)) \
            .otherwise(F.when(forward, p - (1 - q) * b / a).otherwise(p + q * b / a))
        ended, goes_on = F.when(held_ends, held).otherwise(doc), F.when(held_ends, doc).otherwise(held)
        return F.struct(
            F.concat(state["done"], F.array(ended.withField("p", value.cast("double")))).alias("done"),
            goes_on.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), left))).alias("rest"))

    first = F.element_at(cells, 1)
    start = F.struct(F.slice(cells, 1, 0).alias("done"), first.alias("rest"))
    return F.aggregate(F.slice(cells, 2, F.size(cells)), start, step)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``(id_col, row_key, size, source_size, target, copies, taken)``, one row per document.

    Each document of a source is wanted ``target / source_size`` times. The whole part is taken;
    the fractions are rounded by a reduction tree: a source's documents are dealt by a hash to
    nodes of about ``FAN_IN``, each node rounds all but one of its documents, largest first, and
    hands that one on to the next level. Sums of words are kept but for the last document, so a source misses its
    target by less than the size of one document. All draws depend on ids and texts only, so reruns agree.

    A null text has size 0 and is never taken; a null source is a source. Repeated rows of a source are one entry, counted
    before the shuffle: rounded against each other, all but one of them end at 0 or 1, and that one goes through the tree.
    Sources without words have target 0. An empty table gives no rows. Other columns don't matter.
    """
    text = quoted(text_col).cast("string")
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(source_col).cast("string").alias("source"),
                       word_count(text).alias("size"), row_key(quoted(id_col), text).alias("row_key"))
    rows = store(rows, "sizes")
    targets = source_targets(rows.select("source", "size"), weights, total_share, most)
    targets = store(targets.withColumnRenamed("source", "of_source"), "targets")
    rows = rows.groupBy("source", "row_key", "doc_id", "size").agg(F.count("*").alias("twins"))
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    rate = F.col("target") / F.nullif("source_size", F.lit(0))
    whole = F.least(F.floor(rate), F.lit(int(most) - 1))
    rows = (rows.withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(0))
            .withColumn("all", F.when(F.col("size") > 0, F.col("twins") * (rate - whole)).otherwise(0.0))
            .withColumn("ones", F.floor("all")).withColumn("p", F.col("all") - F.col("ones"))
            .withColumn("node", F.pmod(F.xxhash64(F.lit(SEED), "row_key"), F.greatest(F.lit(1), F.ceil(F.col("documents") / FAN_IN))))
            .drop("of_source", "all"))
    fields = ["size", "row_key", "p", "doc_id", "whole", "source_size", "target", "twins", "ones"]
    done = [rows.where("size = 0").select("source", *fields)]
    nodes = rows.where("size > 0").select("source", "node", F.struct(*fields).alias("cell"))
    widest = targets.agg(F.max("documents")).first()[0] or 0
    width, level = -(-widest // FAN_IN), 0
    while widest:
        cells = F.sort_array(F.collect_list("cell"), asc=False)
        nodes = nodes.groupBy("source", "node").agg(cells.alias("cells"))
        nodes = store(nodes.select("source", "node", _node_steps(F.col("cells"), level).alias("s")), f"level{level}")
        done.append(nodes.select("source", F.explode("s.done").alias("c")).select("source", "c.*"))
        if width == 1:
            break
        nodes = nodes.select("source", F.floor(F.col("node") / FAN_IN).alias("node"), F.col("s.rest").alias("cell"))
        width, level = -(-width // FAN_IN), level + 1
    if widest:
        last = nodes.select("source", "s.rest.*")
        drawn = uniform(F.lit(SEED), F.lit("last"), F.col("row_key")) < F.col("p")
        done.append(last.withColumn("p", drawn.cast("double")).select("source", *fields))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = _each_twin(out)
    extra = F.when(F.col("twin") <= F.col("ones"), 1).when(F.col("twin") == F.col("ones") + 1, F.round("p")).otherwise(0)
    copies = (F.col("whole") + extra).cast("long")
    return out.select(F.col("doc_id").alias(id_col), "row_key", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _each_twin(rows: DataFrame) -> DataFrame:
    """One row per repeated row, numbered by ``twin`` from 1; many of them are dealt out in parts."""
    single = rows.where("twins = 1").withColumn("twin", F.lit(1).cast("long"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("twins") - 1, F.lit(TWINS_AT_ONCE).cast("long")))
    parts = rows.where("twins > 1").withColumn("start", starts).repartition("row_key", "start")
    twins = F.sequence(F.col("start") + 1, F.least(F.col("twins"), F.col("start") + TWINS_AT_ONCE))
    return single.unionByName(parts.withColumn("twin", F.explode(twins)).drop("start"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents that the mix takes, with all their columns, ``copies`` and ``taken``."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no name can clash
    at = {name: f"c{docs.columns.index(name)}" for name in (id_col, text_col, source_col)}
    found = mix(plain, at[id_col], at[text_col], at[source_col]).where("copies > 0")
    taken = (found.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("copies", "taken"))).alias("each")))
    keyed = plain.withColumn("row_key", row_key(F.col(at[id_col]), F.col(at[text_col]).cast("string")))
    again = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    out = (keyed.join(taken, "row_key").withColumn("i", again).where(F.col("i") <= F.size("each"))
           .withColumn("mine", F.element_at("each", F.col("i"))))
    names = [c for c in docs.columns if c.lower() not in ("copies", "taken")]
    return out.select(*[F.col(f"c{docs.columns.index(c)}").alias(c) for c in names],
                      F.col("mine.copies").alias("copies"), F.col("mine.taken").alias("taken"))
