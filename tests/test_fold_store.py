"""The rows of the folds are stored once, and the scores are those of a fit in each fold."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from plumbline.operators import training
from plumbline.operators.split import add_fold

GRID = {"random_forest": {"numTrees": [3], "maxDepth": [2, 4]}}


@pytest.fixture(scope="module")
def rows(spark):
    from pyspark.ml.feature import VectorAssembler

    plain = spark.range(0, 900, 1, 4).selectExpr("id", "CAST(id * 7 % 31 AS DOUBLE) AS a", "CAST(id * 13 % 17 AS DOUBLE) AS b")
    made = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(plain)
    return made.select("id", "features", (F.col("a") * 3 + F.col("b") * F.col("b") + F.col("id") % 5).alias("label")).cache()


def test_the_fold_of_a_row_is_worked_out_once(spark, rows, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def fold(key):
        calls.add(1)
        return key % 3

    monkeypatch.setattr(training, "add_fold", lambda df, key, k: df.withColumn("fold", fold(F.col(key))))
    search = training.grid_search(rows, training.families(GRID)[0], "id", folds=3)
    assert len(search.scores) == 2 and calls.value == rows.count()


def test_scores_are_those_of_a_fit_in_each_fold(rows):
    family = training.families(GRID)[0]
    search = training.grid_search(rows, family, "id", folds=3)
    folded = add_fold(rows, "id", 3)
    for setting, (name, got) in zip(family.grid, search.scores):
        alone = [RegressionEvaluator(metricName="r2").evaluate(
            family.estimator.fit(folded.filter(F.col("fold") != k), setting).transform(folded.filter(F.col("fold") == k))) for k in range(3)]
        assert name == training.settings_of(setting) and got == pytest.approx(sum(alone) / 3, rel=1e-9)
    assert search.cv_r2 == max(score for _, score in search.scores) and dict(search.scores)[search.best] == search.cv_r2
    assert search.model.getNumTrees == 3


def test_depths_are_scored_from_one_fit(rows, monkeypatch):
    fits, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, df, params=None: fits.append(1) or fit(self, df, params))
    search = training.grid_search(rows, training.families({"random_forest": {"numTrees": [3, 2], "maxDepth": [2, 1, 4]}})[0], "id", folds=3)
    assert len(fits) == 2 * 3 + 1  # two numbers of trees in three folds, and the best on all rows
    assert [name for name, _ in search.scores] == [f"maxDepth={d}, numTrees={n}" for n in (3, 2) for d in (2, 1, 4)]


def test_large_upper_parts_and_drawn_features_are_fitted_themselves():
    family = training.families({"random_forest": {"numTrees": [100], "maxDepth": [20, 5, 30]}})[0]
    assert training.shared_depths(family.estimator, family.grid) == [(0, []), (2, [1])]
    drawn = family.estimator.copy().setFeatureSubsetStrategy("sqrt")
    assert training.shared_depths(drawn, family.grid) == [(0, []), (1, []), (2, [])]


def test_a_fold_without_rows_is_an_error(rows):
    few = rows.filter("id < 2")
    with pytest.raises(ValueError, match="fold"):
        training.grid_search(few, training.families(GRID)[0], "id", folds=8)
