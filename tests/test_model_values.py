"""The figures of fitted models against plain versions, and the stream that follows the registry."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators.training import families
from plumbline.shared import literal_rows, scratch_path
from plumbline.sources import registry
from plumbline.streaming.scorer import follow_registry, read_answers, request_stream
from plumbline.workload import modelling
from plumbline.workload.catalogue import QUERIES
from plumbline.workload.fixtures import requests


def r2(rows):
    y, p = (np.array([r[i] for r in rows], float) for i in range(2))
    return 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)


@pytest.fixture(scope="module")
def matrices(spark, sf_dir):
    train, test, encoder, raw = modelling._matrices(spark, sf_dir)
    return train.cache(), test.cache()


def fitted(train, family, **values):
    learner = next(f for f in families(modelling.TRIAL) if f.name == family).estimator.copy()
    return learner.copy({learner.getParam(k): v for k, v in values.items()}).fit(train)


def test_fold_scores_are_those_of_separate_fits(spark, sf_dir, matrices):
    from plumbline.operators.split import add_fold

    train = add_fold(matrices[0], "id", 3).cache()
    got = {r.settings: r for r in QUERIES["grid_search_values"](spark, sf_dir).collect()}
    for depth in (4, 6):
        scores = []
        for fold in range(3):
            model = fitted(train.filter(F.col("fold") != fold), "random_forest", numTrees=5, maxDepth=depth)
            scores.append(r2(model.transform(train.filter(F.col("fold") == fold)).select("label", "prediction").collect()))
        row = got[f"maxDepth={depth}, numTrees=5"]
        assert row.cv_r2 == pytest.approx(np.mean(scores), abs=1e-6)
    sizes = [train.filter(F.col("fold") == fold).count() for fold in range(3)]
    assert all(r.fold_rows == sizes for r in got.values()) and sum(sizes) == matrices[0].count()


def test_the_leaderboard_holds_the_scores_of_its_settings(spark, sf_dir, matrices):
    rows = QUERIES["leaderboard_values"](spark, sf_dir).collect()
    kinds = {"maxDepth": int, "numTrees": int, "maxIter": int, "stepSize": float, "subsamplingRate": float}
    for row in rows:
        values = {k: kinds[k](v) for k, v in (cell.split("=") for cell in row.settings.split(", "))}
        found = fitted(matrices[0], row.family, **values).transform(matrices[1]).select("label", "prediction").collect()
        y, p = (np.array([r[i] for r in found]) for i in range(2))
        assert (row.test_r2, row.test_rmse, row.test_mae) == pytest.approx(
            (r2(found), np.sqrt(np.mean((y - p) ** 2)), np.mean(np.abs(y - p))), rel=1e-6)
    assert [r.chosen for r in rows] == [r.test_r2 == max(x.test_r2 for x in rows) for r in rows]


def test_the_whole_job_reports_the_best_of_the_board(spark, sf_dir):
    board = QUERIES["leaderboard_values"](spark, sf_dir).filter("chosen").first()
    found = {(r.stage, r.metric): r.text if r.value is None else r.value for r in QUERIES["training_values"](spark, sf_dir).collect()}
    assert (found["train", "best_model"], found["train", "best_params"]) == (board.family, board.settings)
    assert [found["train", m] for m in ("r2_score", "rmse", "mae", "cv_r2")] == pytest.approx(
        [board.test_r2, board.test_rmse, board.test_mae, board.cv_r2], rel=1e-5)
    assert found["evaluate", "changed_accuracy"] == pytest.approx(board.test_r2, rel=1e-5) and found["promote", "promoted"] == 1.0


def test_predictions_of_a_fitted_forest(spark, sf_dir, matrices):
    rows = {r.id: r for r in QUERIES["fitted_predictions"](spark, sf_dir).collect()}
    again = fitted(matrices[0], "random_forest", numTrees=10, maxDepth=6).transform(matrices[1]).select("id", "label", "prediction").collect()
    assert len(rows) == len(again)
    for r in again:
        assert (rows[r.id].charges, rows[r.id].prediction) == pytest.approx((r.label, r.prediction))
        assert float(rows[r.id].display.strip("$").replace(",", "")) == pytest.approx(r.prediction, abs=0.00501)


@pytest.fixture
def streams(spark, sf_dir):
    base, arrived, done, offsets = (scratch_path(spark, n) for n in ("registry", "requests", "answers", "offsets"))
    requests(spark, sf_dir).repartition(3).write.parquet(arrived)
    return base, arrived, done, offsets


def test_a_champion_published_midway_answers_the_next_batch(spark, sf_dir, streams, monkeypatch):
    base, arrived, done, offsets = streams
    registry.publish(spark, base, modelling.served("1D * age"), 0.5, 9.0, 8.0, version="first")
    from plumbline.streaming import scorer

    replace = scorer.ledger.replace_folder

    def finished(session, draft, path):
        replace(session, draft, path)
        if path.endswith("batch=0"):
            registry.publish(session, base, modelling.served("2D * age"), 0.6, 9.0, 8.0, version="second")

    monkeypatch.setattr(scorer.ledger, "replace_folder", finished)
    follow_registry(request_stream(spark, arrived, files_per_trigger=1), base, done, offsets).awaitTermination()
    rows = read_answers(spark, done).select("batch", "version").distinct().orderBy("batch").collect()
    assert [tuple(r) for r in rows] == [(0, "first"), (1, "second"), (2, "second")]
    assert read_answers(spark, done).select("id").distinct().count() == read_answers(spark, done).count() == requests(spark, sf_dir).count()


def test_a_batch_that_is_run_again_writes_no_row_twice(spark, sf_dir, streams):
    base, arrived, done, offsets = streams
    registry.publish(spark, base, modelling.served("1D * age"), 0.5, 9.0, 8.0, version="first")
    for _ in range(2):
        follow_registry(request_stream(spark, arrived, files_per_trigger=2), base, done, offsets).awaitTermination()
        # The query died behind its last write: its batch counts as not done and runs again.
        last = max(int(name) for name in os.listdir(f"{offsets}/commits") if name.isdigit())
        for name in (f"{last}", f".{last}.crc"):
            if os.path.exists(f"{offsets}/commits/{name}"):
                os.remove(f"{offsets}/commits/{name}")
    assert read_answers(spark, done).count() == requests(spark, sf_dir).count()


def test_without_a_champion_nothing_is_answered_and_nothing_is_lost(spark, sf_dir, streams):
    base, arrived, done, offsets = streams
    with pytest.raises(Exception, match="no champion"):
        follow_registry(request_stream(spark, arrived), base, done, offsets).awaitTermination()
    registry.publish(spark, base, modelling.served("1D * age"), 0.5, 9.0, 8.0, version="late")
    follow_registry(request_stream(spark, arrived), base, done, offsets).awaitTermination()
    assert read_answers(spark, done).count() == requests(spark, sf_dir).count()


def test_catalog_modes_and_columns(spark):
    import uuid

    from pyspark.errors import AnalysisException

    from plumbline.sources import catalog

    name, path = f"plumbline_{uuid.uuid4().hex}", scratch_path(spark, "table")
    rows = literal_rows(spark, "id bigint, x double", [(1, 0.5), (2, float("nan"))])
    catalog.write_table(rows, name, mode="append", path=path)
    catalog.write_table(rows.select("x", "id"), name, mode="append")
    assert sorted((r.id, r.x) for r in catalog.read_table(spark, name).filter("x IS NOT NULL").collect()) == [(1, 0.5)] * 2
    with pytest.raises(ValueError):
        catalog.write_table(rows.withColumn("more", F.lit(1)), name, mode="append")
    with pytest.raises(AnalysisException):
        catalog.write_table(rows, name, mode="fail")
    with pytest.raises(ValueError):
        catalog.write_table(rows, name, mode="upsert")
    catalog.write_table(rows.limit(1), name, mode="replace", path=path)
    assert catalog.row_counts(spark, [name]).first().n == 1
    assert [tuple(r) for r in catalog.describe_columns(spark, name).collect()] == [(1, "id", "bigint"), (2, "x", "double")]


def test_a_metric_that_stands_twice_is_an_error(spark):
    from plumbline.operators.profile import REPORT_SCHEMA
    from plumbline.sources import files

    rows = [("a", None, "m", 1.0, None), ("a", "c", "m", None, "t"), ("b", "c", "n", 2.5, None)]
    path = scratch_path(spark, "document")
    files.write_document(literal_rows(spark, REPORT_SCHEMA, rows), path)
    assert sorted(map(tuple, files.read_document(spark, path).collect()), key=repr) == sorted(rows, key=repr)
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        files.write_document(literal_rows(spark, REPORT_SCHEMA, [*rows, rows[0]]), path)
