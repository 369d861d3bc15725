"""Regressor families, grid search, metrics, selection and the score gate."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import ratio
from plumbline.operators.split import add_fold
from plumbline.shared import ensure_checkpoint_dir, literal_rows

log = logging.getLogger(__name__)

SEED = 42
MAX_BINS = 128
DEEPEST = 30  # Spark's limit, in place of "no limit"
MINIMUM_SCORE = 0.6
MAX_NODES = 65_536  # of a forest's upper part that is read from a deeper one

# The searched settings of each family. Spark's trees have no minimum
# number of rows to split a node, so that setting of the forest has no counterpart.
FULL_GRIDS = {
    "random_forest": {
        "numTrees": [100, 200, 300], "maxDepth": [10, 20, DEEPEST], "minInstancesPerNode": [1, 2, 4]},
    "xgboost": {
        "maxIter": [100, 200, 300], "maxDepth": [3, 6, 9],
        "stepSize": [0.01, 0.1, 0.3], "subsamplingRate": [0.8, 0.9, 1.0]},
    "gradient_boosting": {
        "maxIter": [100, 200], "stepSize": [0.05, 0.1, 0.2],
        "maxDepth": [3, 4, 5], "subsamplingRate": [0.8, 0.9]},
}
SMALL_GRIDS = {
    "random_forest": {"numTrees": [10], "maxDepth": [5, 8]},
    "xgboost": {"maxIter": [10], "maxDepth": [4], "stepSize": [0.3], "subsamplingRate": [1.0]},
    "gradient_boosting": {"maxIter": [10], "stepSize": [0.2], "maxDepth": [3], "subsamplingRate": [0.9]},
}


@dataclass(frozen=True)
class Family:
    """A learner and the settings to try."""

    name: str
    estimator: object
    grid: list = field(default_factory=list)


def families(grid: str | dict = "small") -> list[Family]:
    """The three regressor families with the ``small``, ``full`` or a given grid."""
    grids = {"small": SMALL_GRIDS, "full": FULL_GRIDS}[grid] if isinstance(grid, str) else grid
    built = []
    for name, settings in grids.items():
        if name == "random_forest":
            learner = RandomForestRegressor(featureSubsetStrategy="all", seed=SEED, maxBins=MAX_BINS)
        else:
            learner = GBTRegressor(featureSubsetStrategy="all", seed=SEED, maxBins=MAX_BINS)
        builder = ParamGridBuilder()
        for param, values in settings.items():
            builder = builder.addGrid(learner.getParam(param), values)
        built.append(Family(name, learner, builder.build()))
    return built


def settings_of(param_map: dict) -> str:
    """A setting as sorted ``name=value`` text."""
    return ", ".join(sorted(f"{param.name}={value}" for param, value in param_map.items()))


@dataclass(frozen=True)
class Search:
    """Result of one grid search: the refitted best model and every mean fold score."""

    family: str
    model: Model
    best: str
    cv_r2: float
    scores: list[tuple[str, float]]


def grid_search(train: DataFrame, family: Family, key: str, folds: int = 5, parallelism: int = 4) -> Search:
    """Cross-validated R2 of each setting, then a refit of the best on all rows.

    Boosting adds trees one by one, so a model with fewer rounds is the beginning of one with more: settings that
    differ in their rounds alone are fitted once, with the most rounds, and scored after each of their numbers of rounds.
    A forest draws its rows for all trees together, and a smaller one is not part of a larger; but settings that differ
    in their depth alone are fitted once, with the greatest, and scored at each of their depths.
    """
    ensure_checkpoint_dir(train.sparkSession)
    folded = add_fold(train, key, folds).select("features", "label", "fold").persist()
    search = _boosted_search if isinstance(family.estimator, GBTRegressor) else _plain_search
    try:
        return search(folded, family, folds, parallelism)
    finally:
        folded.unpersist()


def _plain_search(folded: DataFrame, family: Family, folds: int, parallelism: int) -> Search:
    """Every setting scored in every fold, as ``CrossValidator`` does.

    That one works out the folds of all rows again, and stores the rows anew, for both sides of every fold; here all
    fits read the rows as they are persisted once, with their folds.
    """
    estimator, evaluator = family.estimator, RegressionEvaluator(metricName="r2")
    # Counting also brings the rows into the store, in all tasks at once.
    sizes = {row["fold"]: row["count"] for row in folded.groupBy("fold").count().collect()}
    for fold in range(folds):
        if not 0 < sizes.get(fold, 0) < sum(sizes.values()):
            raise ValueError(f"fold {fold} has no rows to fit on or to score")
    fits = [(group, fold) for fold in range(folds) for group in shared_depths(estimator, family.grid)]

    def scored(fit) -> dict[int, float]:
        (deepest, shallower), fold = fit
        fitted, held_out = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        model = estimator.fit(fitted, family.grid[deepest])
        found = {deepest: evaluator.evaluate(model.transform(held_out))}
        for i in shallower:
            nodes = upper_nodes(model, depth_of(estimator, family.grid[i]))
            answers = estimator.fit(fitted, family.grid[i]).transform(held_out) if nodes is None else \
                held_out.select(vector_to_array("features"), "label").mapInArrow(_descent(nodes), "label double, prediction double")
            found[i] = evaluator.evaluate(answers)
        return found

    scores = dict.fromkeys(range(len(family.grid)), 0.0)
    # Each running fit keeps its own binned rows: no more at once than there are settings.
    with ThreadPool(min(parallelism, len(family.grid))) as pool:
        for part in pool.map(inheritable_thread_target(folded.sparkSession)(scored), fits, chunksize=1):
            for i, r2 in part.items():
                scores[i] += r2 / folds
    named = [(settings_of(setting), scores[i]) for i, setting in enumerate(family.grid)]
    # The first setting wins a tie, as in the search itself.
    chosen = max(scores, key=scores.get)
    return Search(family.name, estimator.fit(folded, family.grid[chosen]), *named[chosen], named)


def depth_of(estimator, setting: dict) -> int:
    return setting.get(estimator.maxDepth, estimator.getMaxDepth())


def shared_depths(estimator, grid: Sequence[dict]) -> list[tuple[int, list[int]]]:
    """The settings to fit, by their place in the grid, each with the settings of smaller depth that its trees answer too.

    A forest that may use every feature at every node splits a node by its rows alone, so trees of less depth are the
    upper part of deeper ones. If features are drawn, or the upper part has too many nodes, a setting is fitted itself.
    """
    groups: dict[object, list[int]] = {}
    alone = []
    for i, setting in enumerate(grid):
        if isinstance(estimator, RandomForestRegressor) and setting.get(
                estimator.featureSubsetStrategy, estimator.getFeatureSubsetStrategy()) == "all":
            rest = settings_of({param: value for param, value in setting.items() if param != estimator.maxDepth})
            groups.setdefault(rest, []).append(i)
        else:
            alone.append((i, []))
    for members in groups.values():
        deepest = max(members, key=lambda i: depth_of(estimator, grid[i]))
        trees = grid[deepest].get(estimator.numTrees, estimator.getNumTrees())
        rest = [i for i in members if i != deepest]
        small = [i for i in rest if trees * 2 ** (depth_of(estimator, grid[i]) + 1) <= MAX_NODES]
        alone += [(deepest, small)] + [(i, []) for i in rest if i not in small]
    return sorted(alone)


def upper_nodes(model, depth: int) -> list[np.ndarray] | None:
    """For each tree its nodes down to a depth, with their feature, threshold, left and right node, and mean.

    A node that ends there has itself on both sides. None, if a split is by categories.
    """
    trees = []
    for tree in model.trees:
        root = tree._call_java("rootNode")
        rows, level = [[0, 0.0, 0, 0, root.prediction()]], [(0, root)]
        for _ in range(depth):
            below = []
            for at, node in level:
                if node.getClass().getSimpleName() != "InternalNode":
                    continue
                split = node.split()
                if split.getClass().getSimpleName() != "ContinuousSplit":
                    return None
                rows[at][:4] = split.featureIndex(), split.threshold(), len(rows), len(rows) + 1
                for child in (node.leftChild(), node.rightChild()):
                    below.append((len(rows), child))
                    rows.append([0, 0.0, len(rows), len(rows), child.prediction()])
            level = below
        trees.append(np.array(rows))
    return trees


def _descent(trees: list[np.ndarray]):
    """Label and mean answer of the trees for each row of features and label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            total, each = np.zeros(batch.num_rows), np.arange(batch.num_rows)
            for tree in trees:
                feature, left, right = (tree[:, k].astype(np.int64) for k in (0, 2, 3))
                at = np.zeros(batch.num_rows, np.int64)
                while True:
                    there = np.where(cells[each, feature[at]] <= tree[at, 1], left[at], right[at])
                    if (there == at).all():
                        break
                    at = there
                total += tree[at, 4]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(total / len(trees))], names=["label", "prediction"])
    return run


def longest_rounds(estimator: GBTRegressor, grid: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """Settings without their rounds, each with the numbers of rounds that the grid asks for."""
    groups: dict[str, tuple[dict, list[int]]] = {}
    for setting in grid:
        rest = {param: value for param, value in setting.items() if param != estimator.maxIter}
        groups.setdefault(settings_of(rest), (rest, []))[1].append(setting.get(estimator.maxIter, estimator.getMaxIter()))
    return list(groups.values())


def _boosted_search(folded: DataFrame, family: Family, folds: int, parallelism: int) -> Search:
    estimator = family.estimator
    fits = [(rest, rounds, fold) for rest, rounds in longest_rounds(estimator, family.grid) for fold in range(folds)]

    def scored(fit) -> dict[str, float]:
        rest, rounds, fold = fit
        model = estimator.fit(folded.filter(F.col("fold") != fold), {**rest, estimator.maxIter: max(rounds)})
        held_out = folded.filter(F.col("fold") == fold)
        errors = model.evaluateEachIteration(held_out, "squared")
        spread = held_out.agg(F.var_pop("label")).first()[0]
        return {settings_of({**rest, estimator.maxIter: n}): 1.0 - errors[n - 1] / spread for n in rounds}

    with ThreadPool(parallelism) as pool:
        parts = pool.map(inheritable_thread_target(folded.sparkSession)(scored), fits)
    found: dict[str, float] = {}
    for part in parts:
        for setting, r2 in part.items():
            found[setting] = found.get(setting, 0.0) + r2 / folds
    scores = [(settings_of({estimator.maxIter: estimator.getMaxIter(), **setting}), setting) for setting in family.grid]
    # The first setting wins a tie.
    top, chosen = max(scores, key=lambda pair: found[pair[0]])
    model = estimator.fit(folded, chosen)
    names = {settings_of({estimator.maxIter: estimator.getMaxIter(), **setting}): settings_of(setting) for setting in family.grid}
    return Search(family.name, model, names[top], found[top], [(names[name], found[name]) for name, _ in scores])


def search_rows(spark, searches: Sequence[Search]) -> DataFrame:
    return literal_rows(spark, "family string, settings string, cv_r2 double", [
        (search.family, setting, score) for search in searches for setting, score in search.scores])


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``(n, r2, rmse, mae)`` from one aggregate. R2 is 1 - residual / total sum of
    squares, which differs from the squared correlation; of a constant label it is 1 if every prediction is
    exact and 0 otherwise. A labelled row without a prediction is an error: leaving it out would flatter the model."""
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    r2 = F.when(F.col("spread") > 0, F.lit(1.0) - ratio(F.col("mse"), F.col("spread"))) \
        .when(F.col("mse") == 0, F.lit(1.0)).when(F.col("mse") > 0, F.lit(0.0))
    bad = F.raise_error(F.concat(F.col("unscored").cast("string"), F.lit(" rows have a label but no prediction"))).cast("bigint")
    unscored = y.isNotNull() & (F.col(prediction).isNull() | F.isnan(F.col(prediction).cast("double")))
    return df.agg(
        F.count(y).alias("n"), F.var_pop(y).alias("spread"), F.count_if(unscored).alias("unscored"),
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
    ).select(F.when(F.col("unscored") > 0, bad).otherwise(F.col("n")).alias("n"), r2.alias("r2"),
             F.sqrt("mse").alias("rmse"), "mae")


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Actual, predicted and their difference, with the other plain columns kept."""
    rest = [name for name in df.columns if name not in (label, prediction, "features")]
    return df.select(*rest, F.col(label).alias("actual"), F.col(prediction).alias("predicted"),
                     (F.col(label) - F.col(prediction)).alias("residual"))


@dataclass(frozen=True)
class Entry:
    """A line of the leaderboard."""

    family: str
    settings: str
    cv_r2: float
    test_r2: float
    test_rmse: float
    test_mae: float
    model: Model


def select_best(
    train: DataFrame, test: DataFrame, candidates: Sequence[Family], key: str,
    folds: int = 5, select_by: str = "test", parallelism: int = 4,
) -> tuple[Entry, list[Entry]]:
    """Search every family and pick the best by ``test`` or ``cv`` R2; the first wins ties.

    A family that fails is left out; if all fail, that is an error.
    """
    if select_by not in ("test", "cv"):
        raise ValueError(f"unknown select_by {select_by!r}")
    board = []
    for family in candidates:
        try:
            search = grid_search(train, family, key, folds, parallelism)
            scored = regression_metrics(search.model.transform(test)).first()
            if scored["r2"] is None or math.isnan(search.cv_r2):
                raise ValueError("no test row to score")
        except Exception as error:  # noqa: BLE001 - one family must not end the search
            log.warning("family %s failed: %s", family.name, error)
            continue
        board.append(Entry(family.name, search.best, search.cv_r2, scored["r2"], scored["rmse"],
                           scored["mae"], search.model))
    if not board:
        raise RuntimeError("no model could be trained")
    return max(board, key=lambda e: e.test_r2 if select_by == "test" else e.cv_r2), board


def leaderboard(spark, board: Sequence[Entry]) -> DataFrame:
    return literal_rows(
        spark, "family string, settings string, cv_r2 double, test_r2 double, test_rmse double, test_mae double",
        [(e.family, e.settings, e.cv_r2, e.test_r2, e.test_rmse, e.test_mae) for e in board])


def require_score(best: Entry, minimum: float = MINIMUM_SCORE) -> None:
    """Fail when even the best model is below the minimum test R2."""
    if best.test_r2 < minimum:
        raise ValueError(f"best test R2 {best.test_r2:.4f} is below {minimum}")
