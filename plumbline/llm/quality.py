"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, store

FEATURES = 256
RIDGE = 1e-3
SEED = 11
THRESHOLD = 0.7
#: Steps in which calibration counts raw scores between 0 and 1.
SCORE_STEPS = 200
#: Sums that one task adds up on a level of the reduction.
FAN_IN = 32
#: Of the four remainders of a row's hash: kept out of all learning, and used to calibrate.
HELD_OUT, CALIBRATED = 2, 3
STATISTICS = (
    "words", "word_length", "word_length_spread", "letters", "capitals", "digits", "end_marks", "commas", "bars",
    "signs", "blanks", "non_ascii", "distinct_words", "top_word", "repeated_neighbours", "repeated_pairs",
    "words_with_signs", "sentence_length", "line_length", "repeated_lines")
_SIGNS = re.compile(rb"[^0-9A-Za-z\x80-\xff.,;:!?'\"()\s-]")


def statistics(text: str | None) -> list[float]:
    """Numbers in the order of ``STATISTICS``; a text without words has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), np.float64, n)
    counted = Counter(words)
    capitals, small = kinds[65:91].sum(), kinds[97:123].sum()
    letters = capitals + small + kinds[128:].sum()
    ends = kinds[[33, 46, 63]].sum()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    signs = size - letters - kinds[48:58].sum() - kinds[[9, 10, 13, 32, 33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    pairs = len(set(zip(words, words[1:])))
    return [float(x) for x in (
        np.log1p(n), min(lengths.mean(), 50), min(lengths.std(), 50), letters / size, capitals / max(1, capitals + small),
        kinds[48:58].sum() / size, ends / n, kinds[44] / n, kinds[124] / n, signs / size, kinds[[9, 10, 13, 32]].sum() / size,
        kinds[128:].sum() / size, len(counted) / n ** 0.9, counted.most_common(1)[0][1] / n, same / n,
        1 - pairs / max(1, n - 1), (sum(1 for w in counted if _SIGNS.search(w)) / len(counted)),
        np.log1p(n / (ends + 1)), np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)))]


def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(text) for text in texts])


def statistics_of(text: Column) -> Column:
    return F.pandas_udf(_statistics, "array<double>")(text)


def remainder(doc_id: Column) -> Column:
    """Which of four parts a row belongs to, by its id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


@dataclass
class Model:
    """A fitted classifier; a few hundred numbers whatever the size of the input."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw scores, rising
    values: np.ndarray  # calibrated share of label 1 at each of them
    prior: float

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines at random frequencies: their products approximate a Gaussian kernel."""
        rng = np.random.default_rng(SEED)
        wide = rng.normal(size=(len(STATISTICS), FEATURES)) / np.sqrt(len(STATISTICS))
        phase = rng.uniform(0, 2 * np.pi, FEATURES)
        scaled = np.clip((stats - self.mean) / self.spread, -8, 8)
        return np.c_[np.cos(scaled @ wide + phase) * np.sqrt(2 / FEATURES), np.ones(len(stats))]

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights, 0, 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.full(len(stats), self.prior)
        return np.interp(self.raw(stats), self.steps, self.values)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _partial_sums(model: Model):
    """Normal equations of a partition's rows, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(_matrix(batch))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            total += z.T @ np.c_[z, y]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, some = np.zeros((FEATURES + 1) * (FEATURES + 2)), False
    for batch in batches:
        for cell in batch.column(0):
            total += np.frombuffer(cell.as_py())
            some = True
    if some:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """Sums over all partitions; levels of ``FAN_IN`` keep what any task or the driver adds small."""
    sums = store(rows.mapInArrow(_partial_sums(model), "sums binary"), "sums")
    count = sums.count()
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        sums = store(sums.repartition(count).mapInArrow(_added, "sums binary"), "sums")
        count = sums.count()
    total = np.zeros((FEATURES + 1) * (FEATURES + 2))
    for row in sums.collect():
        total += np.frombuffer(row.sums)
    return total.reshape(FEATURES + 1, FEATURES + 2)


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic regression: the closest values that never fall (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (a, v, i), (b, w, j) = blocks[-2:]
            blocks[-2:] = [[(a * v + b * w) / (v + w), v + w, i + j]]
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Learn from all labelled rows whose id's remainder is not ``HELD_OUT``.

    Two remainders give the ridge its normal equations, summed per partition; ``CALIBRATED`` gives the counts
    per raw score that calibration needs. Labels other than 0 and 1, null ids and labels without a document
    are left out; an id with several labels or documents counts as often. Without any label
    every document scores 1, so that nothing is thrown away unlearned; with one kind of label the score is that label.
    """
    part = remainder(F.col("id"))
    known = (labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("double").alias("label"))
             .where(F.col("label").isin(0.0, 1.0) & (part != HELD_OUT)))
    stats = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text")).where(part != HELD_OUT)
    stats = stats.select("id", statistics_of(F.col("text")).alias("stats"))
    rows = store(stats.join(known, "id").select("label", "stats", part.alias("part")), "labelled")
    at = [F.col("stats")[i] for i in range(len(STATISTICS))]
    sums = rows.agg(F.count("*"), F.avg("label"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    d, none = len(STATISTICS), np.zeros(0)
    if not sums[0]:
        return Model(np.zeros(d), np.ones(d), none, none, none, 1.0)
    mean, spread = np.array(sums[2:2 + d]), np.array(sums[2 + d:])
    model = Model(mean, np.where(spread > 1e-12, spread, 1.0), none, none, none, float(sums[1]))
    if model.prior in (0.0, 1.0):
        return model
    learned = rows.where(F.col("part") != CALIBRATED)
    total = _normal_equations(learned, model)
    count = max(1.0, total[FEATURES, FEATURES])
    model.weights = np.linalg.solve(total[:, :-1] + RIDGE * count / FEATURES * np.eye(FEATURES + 1), total[:, -1])
    step = F.round(_raw(model, F.col("stats")) * SCORE_STEPS)
    counts = (rows.where(F.col("part") == CALIBRATED).groupBy(step.alias("step"))
              .agg(F.avg("label").alias("share"), F.count("*").alias("n")).orderBy("step").collect())
    if not counts:  # few labels: the raw score stays as it is
        model.steps, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    model.steps = np.array([r.step for r in counts]) / SCORE_STEPS
    model.values = rising(np.array([r.share for r in counts]), np.array([float(r.n) for r in counts]))
    return model


def _raw(model: Model, stats: Column) -> Column:
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")
    return F.pandas_udf(run, "double")(stats)


def score_of(model: Model, text: Column) -> Column:
    """Chance of label 1 for a text; null counts as empty."""
    def run(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(text) for text in texts]).reshape(-1, len(STATISTICS))
        return pd.Series(model.score(rows), dtype="float64")
    return F.pandas_udf(run, "double")(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)``, one row per document, repeated rows included.

    The score rests on the text alone. An empty table gives no rows; null ids are scored and, as
    they have no label, never learned from.
    """
    model = fit(docs, labels, id_col, text_col)
    scored = docs.select(quoted(id_col).alias("id"), score_of(model, quoted(text_col)).alias("score"))
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id")) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns that score ``THRESHOLD`` or more."""
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score_of(model, quoted(text_col)) >= THRESHOLD)
