"""Held-out accuracy, the parts of the fit against plain numpy, and the edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import quality


def auc(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2)


def test_held_out_accuracy_of_the_query(spark, sf_dir):
    from plumbline.llm.queries import QUERIES

    folder = sf_dir.replace("0.001", "0.01")
    rows = QUERIES["op10_quality"](spark, folder).toPandas()
    assert list(rows.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.7).astype(int) == rows.predicted).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(rows.doc_id, rows.held_out))
    known = rows.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() >= 0.95
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) >= 0.98


def test_held_out_labels_play_no_part(spark):
    docs = spark.createDataFrame([(i, ("word here. " * (i % 9 + 1)) if i % 2 else "A!! " * (i % 7 + 2)) for i in range(300)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    hidden = quality.remainder(F.col("doc_id")) == quality.HELD_OUT
    flipped = labels.withColumn("quality", F.when(hidden, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.fit(docs, lab) for lab in (labels, flipped))
    assert np.allclose(one.weights, two.weights) and np.allclose(one.values, two.values)
    scores = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert all((scores[i] >= 0.7) == (i % 2 == 1) for i in range(300))
    kept = quality.keep_good(docs.withColumn("score", F.lit("clash")), labels)
    assert kept.columns == ["doc_id", "text", "score"] and {r.doc_id % 2 for r in kept.collect()} == {1}


def test_normal_equations_are_summed_over_levels(spark, monkeypatch):
    monkeypatch.setattr(quality, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    stats, label = rng.normal(size=(90, len(quality.STATISTICS))), rng.integers(0, 2, 90).astype(float)
    none = np.zeros(0)
    model = quality.Model(np.zeros(stats.shape[1]), np.ones(stats.shape[1]), none, none, none, 0.5)
    rows = spark.createDataFrame([(float(y), x.tolist()) for x, y in zip(stats, label)], "label double, stats array<double>")
    z = model.features(stats)
    assert np.allclose(quality._normal_equations(rows.repartition(7), model), z.T @ np.c_[z, label])


def test_isotonic_values_never_fall_and_keep_the_mean():
    values, weights = np.array([0.1, 0.5, 0.3, 0.2, 0.9, 0.8]), np.array([1.0, 2, 1, 1, 3, 1])
    out = quality.rising(values, weights)
    assert (np.diff(out) >= 0).all() and np.isclose((out * weights).sum(), (values * weights).sum())
    assert np.allclose(out, [0.1, 0.375, 0.375, 0.375, 0.875, 0.875])


@pytest.mark.parametrize("labels, want", [([], 1.0), ([(1, 1), (3, 1), (0, 1)], 1.0), ([(1, 0), (3, 0), (0, 0)], 0.0), ([(1, None), (None, 1), (99, 0)], 1.0)])
def test_missing_or_uniform_labels(spark, labels, want):
    docs = spark.createDataFrame([(0, "a b"), (1, None), (3, ""), (None, "x " * 50_000), (3, "")], "doc_id long, text string")
    got = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == 5 and {r.score for r in got} == {want}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.classify(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n", "a", "!!!", "é", "x" * 100_000, "w " * 50_000, "\n\n1\n"])
def test_statistics_are_finite(text):
    values = quality.statistics(text)
    assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()
