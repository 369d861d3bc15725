import pytest
from pyspark.sql import functions as F

from plumbline.operators import training
from plumbline.operators.encode import build_matrices
from plumbline.operators.scoring import bundle, compare, evaluate, score
from plumbline.operators.split import train_test
from plumbline.plans.stages import STAGES, Settings, read_metrics, run_full, run_stage
from plumbline.shared import literal_rows, scratch_path
from plumbline.sources import registry
from plumbline.sources.files import read_matrix, write_matrix
from plumbline.streaming.scorer import request_stream, score_stream, write_available
from plumbline.workload.fixtures import requests

GRID = {"random_forest": {"numTrees": [5], "maxDepth": [3, 6]},
        "gradient_boosting": {"maxIter": [5], "stepSize": [0.3], "maxDepth": [3]}}


@pytest.fixture(scope="module")
def split(insured):
    return train_test(insured, "id", exact=True)


@pytest.fixture(scope="module")
def matrices(spark, split):
    train, test, encoder = build_matrices(*split, "charges", "id")
    base = scratch_path(spark, "matrices")
    for name, df in (("train", train), ("test", test)):
        write_matrix(df, f"{base}/{name}")
    return read_matrix(spark, f"{base}/train"), read_matrix(spark, f"{base}/test"), encoder


@pytest.fixture(scope="module")
def chosen(matrices):
    train, test, _ = matrices
    return training.select_best(train, test, training.families(GRID), "id", folds=3)


@pytest.fixture(scope="module")
def model(matrices, chosen):
    return bundle(matrices[2], chosen[0].model)


def test_full_grid_sizes():
    assert {f.name: len(f.grid) for f in training.families("full")} == {
        "random_forest": 27, "xgboost": 81, "gradient_boosting": 36}


def test_r2_is_not_the_squared_correlation(spark):
    df = literal_rows(spark, "label double, prediction double", [(1.0, 11.0), (2.0, 12.0), (3.0, 13.0)])
    row = training.regression_metrics(df).first()
    assert row.r2 == pytest.approx(-149.0) and row.rmse == 10.0 and row.mae == 10.0


def test_best_is_the_top_of_the_board(chosen):
    best, board = chosen
    assert best.test_r2 == max(e.test_r2 for e in board) and len(board) == 2
    training.require_score(best)
    with pytest.raises(ValueError):
        training.require_score(best, 1.0)


def test_metrics_agree_with_the_evaluator(matrices, chosen):
    from pyspark.ml.evaluation import RegressionEvaluator

    scored = chosen[0].model.transform(matrices[1])
    assert chosen[0].test_r2 == pytest.approx(RegressionEvaluator(metricName="r2").evaluate(scored))
    rows = training.residuals(scored)
    assert rows.columns == ["id", "actual", "predicted", "residual"]
    assert rows.filter(F.abs(F.col("actual") - F.col("predicted") - F.col("residual")) > 1e-9).isEmpty()


def test_failing_family_is_skipped(matrices):
    train, test, _ = matrices
    broken = training.Family("broken", training.families(GRID)[0].estimator.copy().setFeaturesCol("none"), [{}])
    best, board = training.select_best(train, test, [broken, training.families(GRID)[1]], "id", folds=2)
    assert [e.family for e in board] == ["gradient_boosting"]
    with pytest.raises(RuntimeError):
        training.select_best(train, test, [broken], "id", folds=2)


def metrics(spark, r2):
    return literal_rows(spark, "n bigint, r2 double, rmse double, mae double", [(10, r2, 1.0, 1.0)])


@pytest.mark.parametrize("ours, theirs, accepted", [
    (0.8, None, True), (-0.1, None, False), (0.8, 0.8, False), (0.81, 0.8, True)])
def test_acceptance(spark, ours, theirs, accepted):
    row = compare(metrics(spark, ours), None if theirs is None else metrics(spark, theirs)).first()
    assert row.accepted is accepted and row.difference == pytest.approx(ours - (theirs or 0))


def test_registry_keeps_exact_versions(spark, model, split):
    base = scratch_path(spark, "registry")
    assert registry.load_champion(spark, base) is None and registry.current(spark, base).isEmpty()
    registry.publish(spark, base, model, 0.7, 1.0, 1.0, version="v1")
    registry.publish(spark, base, model, 0.9, 1.0, 1.0, accepted=False, version="v2")
    assert registry.current(spark, base).first().version == "v1"
    registry.publish(spark, base, model, 0.6, 1.0, 1.0, version="v1.bak")
    assert registry.current(spark, base).first().version == "v1.bak"
    assert registry.is_present(spark, base, "v1") and not registry.is_present(spark, base, "v")
    with pytest.raises(ValueError):
        registry.publish(spark, base, model, 0.6, 1.0, 1.0, version="v1")
    again = registry.load_champion(spark, base)
    assert evaluate(again, split[1], "charges").first().r2 == pytest.approx(
        evaluate(model, split[1], "charges").first().r2)


def test_evaluation_matches_training_metrics(model, chosen, split):
    assert evaluate(model, split[1], "charges").first().r2 == pytest.approx(chosen[0].test_r2)


def test_scores_are_shown_as_money(model, split):
    rows = score(model, split[1].drop("charges")).limit(20).collect()
    assert all(r.display == f"${r.prediction:,.2f}" for r in rows)


def test_stream_and_batch_score_the_same(spark, sf_dir, model):
    from plumbline.operators.contract import parse_requests

    arrived, done, offsets = (scratch_path(spark, n) for n in ("requests", "scored", "offsets"))
    asked = requests(spark, sf_dir)
    asked.repartition(3).write.parquet(arrived)
    for _ in range(2):  # the second run finds nothing new
        stream = request_stream(spark, arrived, files_per_trigger=1)
        write_available(score_stream(model, stream), done, offsets).awaitTermination()
    streamed = {r.id: r.display for r in spark.read.parquet(done).collect()}
    batch = {r.id: r.display for r in score(model, parse_requests(asked)[0]).collect()}
    assert streamed == batch and spark.read.parquet(done).count() == len(batch)


@pytest.mark.parametrize("wrong", [{"test_ratio": 0.0}, {"test_ratio": 1.0}, {"expected_score": 1.5}, {"run_id": ""}])
def test_settings_are_checked(wrong):
    values = {"base": "b", "run_id": "r", "registry": "g", "source": lambda s: None, **wrong}
    with pytest.raises(ValueError):
        Settings(**values)


def test_full_run_promotes_and_resumes(spark, insured):
    base = scratch_path(spark, "runs")
    reads = []

    def source(session):
        reads.append(1)
        return insured

    def settings(run):
        return Settings(base=base, run_id=run, registry=f"{base}/registry", source=source, grid=GRID, folds=2)

    rows = run_full(spark, settings("one"))
    assert {r.stage for r in rows.select("stage").distinct().collect()} == set(STAGES)
    assert read_metrics(spark, settings("one"), "evaluate")["is_model_accepted"] == 1.0
    assert registry.current(spark, f"{base}/registry").first().version == "one"
    run_full(spark, settings("one"), resume=True)
    assert len(reads) == 1
    run_full(spark, settings("two"))
    # The same model again is no improvement, so the first stays.
    assert read_metrics(spark, settings("two"), "evaluate")["is_model_accepted"] == 0.0
    assert registry.current(spark, f"{base}/registry").first().version == "one"


def test_stage_runs_its_missing_inputs(spark, insured):
    base = scratch_path(spark, "runs")
    settings = Settings(base=base, run_id="x", registry=f"{base}/registry", source=lambda s: insured)
    run_stage(spark, "transform", settings)
    assert read_metrics(spark, settings, "transform")["features_count"] == 13.0
    assert read_metrics(spark, settings, "ingest")["train_samples"] > 0


def test_invalid_data_stops_before_features(spark, insured):
    base = scratch_path(spark, "runs")
    settings = Settings(base=base, run_id="bad", registry=f"{base}/registry", source=lambda s: insured.drop("bmi"))
    with pytest.raises(ValueError, match="data validation failed: train: wrong number of columns"):
        run_stage(spark, "transform", settings)
    assert read_metrics(spark, settings, "validate")["validation_status"] == 0.0


def test_extra_column_fails_the_checks(spark, insured):
    base = scratch_path(spark, "runs")
    settings = Settings(base=base, run_id="wide", registry=f"{base}/registry",
                        source=lambda s: insured.selectExpr("*", "1 AS extra"))
    assert {r.metric: r.value for r in run_stage(spark, "validate", settings).collect()}["validation_status"] == 0.0


def test_rounds_of_boosting_are_scored_from_one_fit(matrices, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor

    from plumbline.operators.split import add_fold

    grid = {"gradient_boosting": {"maxIter": [2, 6, 4], "stepSize": [0.3, 0.1], "maxDepth": [3], "subsamplingRate": [0.8]}}
    family = training.families(grid)[0]
    fits, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df, params=None: fits.append(1) or fit(self, df, params))
    search = training.grid_search(matrices[0], family, "id", folds=3)
    assert len(fits) == 2 * 3 + 1  # two step sizes in three folds, and the best on all rows
    train = add_fold(matrices[0], "id", 3)
    assert [name for name, _ in search.scores] == [training.settings_of(setting) for setting in family.grid]
    for setting, (_, got) in zip(family.grid, search.scores):
        if setting[family.estimator.maxIter] == 4:
            alone = [RegressionEvaluator(metricName="r2").evaluate(
                fit(family.estimator, train.filter(F.col("fold") != k), setting).transform(train.filter(F.col("fold") == k))) for k in range(3)]
            assert got == pytest.approx(sum(alone) / 3, rel=1e-9)
    assert search.cv_r2 == max(score for _, score in search.scores) and dict(search.scores)[search.best] == search.cv_r2
    assert search.model.getNumTrees == int(search.best.split("maxIter=")[1].split(",")[0])
