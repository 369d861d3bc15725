"""Queries of training, selection, evaluation, the registry and scoring.

Learners differ from engine to engine. Where a formula takes the place of a model, its figures
check against SQL; served as a pipeline of one SQL stage it goes through the registry, batch and stream like a
fitted model, and SQL checks each prediction. Of a fitted model's run, SQL checks what is the same for any
learner: which rows it read and answered, what it refused and why, and which flags it set; the figures themselves are
registered without SQL, and the tests hold them against plain versions.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from plumbline.operators.contract import accepted_requests, judge_requests
from plumbline.operators.encode import ColumnTransformer, build_matrices
from plumbline.operators.scoring import bundle, compare, evaluate, score
from plumbline.operators.split import add_fold, in_test_sample, train_test
from plumbline.operators.training import (
    families, grid_search, leaderboard, regression_metrics, residuals, search_rows, select_best,
)
from plumbline.plans.stages import Settings, run_full, run_stage
from plumbline.shared import scratch_path
from plumbline.sources import registry
from plumbline.sources.files import read_matrix, write_matrix
from plumbline.streaming.scorer import answer_stream, follow_registry, read_answers, request_stream, write_available
from plumbline.workload.conformance import PARSED, REASON
from plumbline.workload.fixtures import insured, insured_shifted, requests, rounded, sql
from plumbline.workload.profiling import stored_split
from plumbline.workload.registry import query

GUESS = "250D * age + 320D * bmi + 400D * children + IF(smoker = 'yes', 690D * bmi, 0D) + 900D"
GUESS_SQL = "250 * age + 320 * bmi + 400 * children + CASE WHEN smoker = 'yes' THEN 690 * bmi ELSE 0 END + 900"
ROUGH = "300D * age + 1500D * children + IF(smoker = 'yes', 800D * bmi, 7000D)"
ROUGH_SQL = "300 * age + 1500 * children + CASE WHEN smoker = 'yes' THEN 800 * bmi ELSE 7000 END"


def predicted(df, formula: str):
    """Predictions of a formula instead of a fitted model."""
    return df.select("id", F.col("charges").alias("label"), F.expr(formula).alias("prediction"))


def metrics_sql(formula: str, source: str = "insured") -> str:
    return f"""SELECT count(*) AS n, 1 - avg(pow(charges - p, 2)) / var_pop(charges) AS r2,
  sqrt(avg(pow(charges - p, 2))) AS rmse, avg(abs(charges - p)) AS mae
FROM (SELECT charges, ({formula})::DOUBLE AS p FROM {source}) q"""


ROUND_METRICS = "SELECT n, round(r2, 6) AS r2, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM ({}) m"


@query(sql(ROUND_METRICS.format(metrics_sql(GUESS_SQL))))
def regression_scores(spark, sf_dir):
    return rounded(regression_metrics(predicted(insured(spark, sf_dir), GUESS)))


@query(sql(f"""SELECT id, round(charges, 4) AS actual, round(({GUESS_SQL})::DOUBLE, 4) AS predicted,
  round(charges - ({GUESS_SQL}), 4) + 0.0::DOUBLE AS residual FROM insured"""))
def residual_table(spark, sf_dir):
    return rounded(residuals(predicted(insured(spark, sf_dir), GUESS)), 4)


@query(sql(f"""SELECT round(c.r2, 6) AS challenger_r2, round(c.rmse, 6) AS challenger_rmse,
  round(c.mae, 6) AS challenger_mae, round(k.r2, 6) AS champion_r2, round(k.rmse, 6) AS champion_rmse,
  round(k.mae, 6) AS champion_mae, round(c.r2 - k.r2, 6) AS difference, c.r2 - k.r2 > 0 AS accepted,
  CASE WHEN c.r2 - k.r2 > 0 THEN 'New model performs better' ELSE 'Existing model performs better' END AS reason,
  0.02::DOUBLE AS reported_threshold
FROM ({metrics_sql(GUESS_SQL)}) c, ({metrics_sql(ROUGH_SQL)}) k"""))
def champion_comparison(spark, sf_dir):
    df = insured(spark, sf_dir)
    return rounded(compare(regression_metrics(predicted(df, GUESS)), regression_metrics(predicted(df, ROUGH))))


@query(sql(f"""SELECT round(r2, 6) AS challenger_r2, round(r2, 6) AS difference, r2 > 0 AS accepted
FROM ({metrics_sql(GUESS_SQL)}) c"""))
def first_champion(spark, sf_dir):
    metrics = regression_metrics(predicted(insured(spark, sf_dir), GUESS))
    return rounded(compare(metrics).select("challenger_r2", "difference", "accepted"))


@query(sql("""SELECT id, age, sex, smoker FROM insured ORDER BY id LIMIT 1"""))
def first_row_preview(spark, sf_dir):
    return insured(spark, sf_dir).orderBy("id").select("id", "age", "sex", "smoker").limit(1)


@query(sql(f"""SELECT CASE WHEN g.r2 > greatest(r.r2, 0) THEN 'second' WHEN r.r2 > 0 THEN 'first' END AS version,
  round(CASE WHEN g.r2 > greatest(r.r2, 0) THEN g.r2 ELSE r.r2 END, 6) AS r2,
  round(CASE WHEN g.r2 > greatest(r.r2, 0) THEN g.rmse ELSE r.rmse END, 6) AS rmse,
  round(CASE WHEN g.r2 > greatest(r.r2, 0) THEN g.mae ELSE r.mae END, 6) AS mae
FROM ({metrics_sql(GUESS_SQL)}) g, ({metrics_sql(ROUGH_SQL)}) r
WHERE g.r2 > 0 OR r.r2 > 0"""))
def registry_champion(spark, sf_dir):
    """Three challengers in turn, each promoted only if it beats the champion so far."""
    df = insured(spark, sf_dir)
    served = PipelineModel(stages=[ColumnTransformer(numeric=["age", "bmi"], categorical=["smoker"]).fit(df)])
    base = scratch_path(spark, "registry")
    for version, formula in (("first", ROUGH), ("second", GUESS), ("third", ROUGH)):
        champion = registry.current(spark, base)
        decision = compare(regression_metrics(predicted(df, formula)), champion)
        registry.promote_if_accepted(spark, base, decision, served, version)
    return rounded(registry.current(spark, base).select("version", "r2", "rmse", "mae"))


# The smallest settings that still let one family win by merit.
TRIAL = {
    "random_forest": {"numTrees": [5], "maxDepth": [4, 6]},
    "xgboost": {"maxIter": [4], "stepSize": [0.3], "maxDepth": [4], "subsamplingRate": [1.0]},
    "gradient_boosting": {"maxIter": [5], "stepSize": [0.3], "maxDepth": [3]},
}


def _matrices(spark, sf_dir):
    """Stored train and test matrices, their encoder, and the stored raw test rows."""
    train, test = stored_split(spark, sf_dir)
    train_matrix, test_matrix, encoder = build_matrices(train, test, "charges", "id")
    base = scratch_path(spark, "matrices")
    for name, matrix in (("train", train_matrix), ("test", test_matrix)):
        write_matrix(matrix, f"{base}/{name}")
    return read_matrix(spark, f"{base}/train"), read_matrix(spark, f"{base}/test"), encoder, test


def _fitted(spark, sf_dir):
    """One fitted forest with its encoder, and the raw test rows."""
    train, _, encoder, raw_test = _matrices(spark, sf_dir)
    forest = families({"random_forest": {"numTrees": [10], "maxDepth": [6]}})[0].estimator
    return bundle(encoder, forest.setNumTrees(10).setMaxDepth(6).fit(train)), raw_test


@query(sql("""SELECT 'random_forest' AS family, u.settings, true AS scored, (SELECT count(*) FROM train) AS train_rows
FROM (SELECT unnest(['maxDepth=4, numTrees=5', 'maxDepth=6, numTrees=5']) AS settings) u"""))
def grid_search_scores(spark, sf_dir):
    train, _, _, _ = _matrices(spark, sf_dir)
    found = grid_search(train, families(TRIAL)[0], "id", folds=3)
    rows = search_rows(spark, [found])
    return rows.select("family", "settings", F.col("cv_r2").between(0.5, 1.0).alias("scored"),
                       F.lit(train.count()).alias("train_rows"))


@query(sql("""SELECT u.family, true AS beats_the_mean, 1::BIGINT AS selected, true AS best_selected, (SELECT count(*) FROM test) AS test_rows
FROM (SELECT unnest(['random_forest', 'xgboost', 'gradient_boosting']) AS family) u"""))
def model_leaderboard(spark, sf_dir):
    train, test, _, _ = _matrices(spark, sf_dir)
    best, board = select_best(train, test, families(TRIAL), "id", folds=3)
    rows = leaderboard(spark, board).withColumn("chosen", F.col("family") == best.family)
    top = rows.agg(F.max("test_r2"), F.max(F.when(F.col("chosen"), F.col("test_r2"))), F.count_if("chosen")).first()
    scored = best.model.transform(test).filter("prediction IS NOT NULL").count()
    return rows.select("family", (F.col("test_r2") > 0).alias("beats_the_mean"), F.lit(top[2]).alias("selected"),
                       F.lit(top[0] == top[1]).alias("best_selected"), F.lit(scored).alias("test_rows"))


def _answers(scored):
    """What any model's answer must hold: a positive amount, shown to the cent as it was predicted."""
    shown = F.regexp_replace("display", "[$,]", "").cast("double")
    return [(F.col("prediction") > 0).alias("answered"),
            (F.abs(shown - F.col("prediction")) <= 0.005001).alias("shown_right")]


@query(sql("SELECT id, true AS answered, true AS shown_right FROM test"))
def batch_scoring(spark, sf_dir):
    model, test = _fitted(spark, sf_dir)
    scored = score(model, test.drop("charges"))
    return scored.select("id", *_answers(scored))


@query(sql(f"SELECT id, true AS answered, true AS shown_right FROM {PARSED} WHERE ({REASON}) IS NULL"))
def request_scoring(spark, sf_dir):
    model, _ = _fitted(spark, sf_dir)
    scored = score(model, accepted_requests(judge_requests(requests(spark, sf_dir))))
    return scored.select("id", *_answers(scored))


@query()
def champion_reload(spark, sf_dir):
    """Publish two accepted versions and a refused one; score the test rows with the champion."""
    model, test = _fitted(spark, sf_dir)
    base = scratch_path(spark, "registry")
    registry.publish(spark, base, model, 0.5, 9.0, 8.0, version="first")
    scored = evaluate(model, test, "charges").first()
    registry.publish(spark, base, model, scored["r2"], scored["rmse"], scored["mae"], version="second")
    registry.publish(spark, base, model, 0.1, 99.0, 88.0, accepted=False, version="refused")
    again = evaluate(registry.load_champion(spark, base), test, "charges").first()
    return rounded(registry.current(spark, base).select(
        "version", "r2", "rmse", "mae", F.lit(again["n"]).alias("n"), F.lit(again["r2"]).alias("test_r2")))


@query(sql(f"""SELECT id, {REASON} AS reason, CASE WHEN ({REASON}) IS NULL THEN true END AS answered,
  CASE WHEN ({REASON}) IS NULL THEN true END AS shown_right FROM {PARSED}"""))
def stream_scoring(spark, sf_dir):
    """One answer per request on the stream: a prediction or the reason for its refusal."""
    model, _ = _fitted(spark, sf_dir)
    arrived, done = scratch_path(spark, "requests"), scratch_path(spark, "scored")
    requests(spark, sf_dir).write.parquet(arrived)
    scored = answer_stream(model, request_stream(spark, arrived))
    write_available(scored, done, scratch_path(spark, "offsets")).awaitTermination()
    answers = spark.read.parquet(done)
    return answers.select("id", "reason", *_answers(answers))


def served(formula: str) -> PipelineModel:
    """A formula as the model that is saved and served."""
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {formula} AS prediction FROM __THIS__")])


SHOWN = "round(prediction, 6) AS prediction, format('${:,.2f}', round(prediction, 2)) AS display"


def shown(df):
    return df.select("id", F.round("prediction", 6).alias("prediction"), "display")


@query(sql(f"SELECT id, {SHOWN} FROM (SELECT id, ({GUESS_SQL})::DOUBLE AS prediction FROM test) p"))
def predictions(spark, sf_dir):
    """What a served model predicts for the test rows, and how it is shown."""
    _, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return shown(score(served(GUESS), test.drop("charges")))


@query(sql(f"""SELECT p.id, reason, version, CASE WHEN reason IS NULL THEN round(prediction, 6) END AS prediction,
  CASE WHEN reason IS NULL THEN format('${{:,.2f}}', round(prediction, 2)) END AS display
FROM (SELECT id, {REASON} AS reason FROM {PARSED}) p JOIN (SELECT id, CASE WHEN smoker = 'yes' THEN 'second' ELSE 'first' END AS version,
  (CASE WHEN smoker = 'yes' THEN {GUESS_SQL} ELSE {ROUGH_SQL} END)::DOUBLE AS prediction FROM insured) i ON p.id = i.id"""))
def stream_by_champion(spark, sf_dir):
    """A stream whose batches are answered by the champion of the hour: a second one is published between two of them."""
    base, arrived, done = (scratch_path(spark, name) for name in ("registry", "requests", "answers"))
    offsets, asked = scratch_path(spark, "offsets"), requests(spark, sf_dir)
    smokers = insured(spark, sf_dir).filter("smoker = 'yes'").select("id")
    for version, formula, how in (("first", ROUGH, "left_anti"), ("second", GUESS, "left_semi")):
        registry.publish(spark, base, served(formula), 0.5, 9.0, 8.0, version=version)
        asked.join(smokers, "id", how).write.mode("append").parquet(arrived)
        follow_registry(request_stream(spark, arrived), base, done, offsets).awaitTermination()
    return read_answers(spark, done).select("id", "reason", "version", F.round("prediction", 6).alias("prediction"), "display")


@query(sql(f"""SELECT 'second' AS version, round(c.r2, 6) AS champion_r2, round(g.r2, 6) AS challenger_r2, round(g.rmse, 6) AS challenger_rmse,
  round(g.mae, 6) AS challenger_mae, round(g.r2 - c.r2, 6) AS difference, g.r2 > c.r2 AS accepted, c.n AS n
FROM ({metrics_sql(ROUGH_SQL, 'test')}) c, ({metrics_sql(GUESS_SQL, 'test')}) g"""))
def champion_evaluation(spark, sf_dir):
    """A challenger held against the reloaded champion on the same test rows, as the evaluation stage does."""
    base = scratch_path(spark, "registry")
    _, test = train_test(insured(spark, sf_dir), "id", exact=True)
    for version, formula, accepted in (("first", GUESS, True), ("second", ROUGH, True), ("refused", GUESS, False)):
        registry.publish(spark, base, served(formula), 0.5, 9.0, 8.0, accepted=accepted, version=version)
    champion = evaluate(registry.load_champion(spark, base), test, "charges")
    decision = compare(evaluate(served(GUESS), test, "charges"), champion)
    rows = decision.crossJoin(champion.select("n")).crossJoin(registry.current(spark, base).select("version"))  # one row each
    return rounded(rows.select("version", "champion_r2", "challenger_r2", "challenger_rmse", "challenger_mae", "difference", "accepted", "n"))


@query()
def grid_search_values(spark, sf_dir):
    """Mean fold score of each setting, and the rows of each fold as the folds hold them."""
    train, _, _, _ = _matrices(spark, sf_dir)
    scores = search_rows(spark, [grid_search(train, families(TRIAL)[0], "id", folds=3)])
    sizes = add_fold(train, "id", 3).groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    folds = sizes.agg(F.transform(F.array_sort(F.collect_list(F.struct("fold", "rows"))), lambda s: s["rows"]).alias("fold_rows"))
    return rounded(scores.join(F.broadcast(folds)))


@query()
def leaderboard_values(spark, sf_dir):
    """Scores of the best setting of every family, and which family is chosen."""
    train, test, _, _ = _matrices(spark, sf_dir)
    best, board = select_best(train, test, families(TRIAL), "id", folds=3)
    return rounded(leaderboard(spark, board).withColumn("chosen", F.col("family") == best.family))


@query()
def fitted_predictions(spark, sf_dir):
    """What a fitted forest predicts for the test rows, beside what they really cost."""
    model, test = _fitted(spark, sf_dir)
    return score(model, test).select("id", "charges", "prediction", "display")


@query()
def training_values(spark, sf_dir):
    """All metrics of the whole job, with those of the learned models."""
    base = scratch_path(spark, "runs")
    settings = Settings(base=base, run_id="values", registry=f"{base}/registry", grid=TRIAL, folds=3, source=lambda s: insured(s, sf_dir))
    return rounded(run_full(spark, settings).select("stage", "metric", "value", "text"))


@query(sql("""SELECT 'ingest' AS stage, 'train_samples' AS metric, count(*)::DOUBLE AS value FROM train
UNION ALL SELECT 'ingest', 'test_samples', count(*) FROM test
UNION ALL SELECT 'ingest', side || '_columns', 8 FROM (SELECT unnest(['train', 'test']) AS side) s
UNION ALL SELECT 'analyse', 'completed', 1
UNION ALL SELECT 'validate', 'validation_status', 1
UNION ALL SELECT 'validate', 'drift_detected', (abs(a.charges - b.charges) / a.charges > 0.2 OR abs(a.age - b.age) / a.age > 0.2
  OR abs(a.bmi - b.bmi) / a.bmi > 0.2 OR abs(a.children - b.children) / a.children > 0.2)::INT FROM
  (SELECT avg(charges) AS charges, avg(age) AS age, avg(bmi) AS bmi, avg(children) AS children FROM train) a,
  (SELECT avg(charges) AS charges, avg(age) AS age, avg(bmi) AS bmi, avg(children) AS children FROM test) b
UNION ALL SELECT 'transform', 'features_count', 13
UNION ALL SELECT 'transform', 'train_rows', count(*) FROM train
UNION ALL SELECT 'transform', 'test_rows', count(*) FROM test
UNION ALL SELECT 'train', 'feature_count', 13
UNION ALL SELECT 'evaluate', 'is_model_accepted', 1
UNION ALL SELECT 'promote', 'promoted', 1"""))
def training_run(spark, sf_dir):
    """The whole job over the base table: of every stage, the metrics that any learner must give."""
    base = scratch_path(spark, "runs")
    settings = Settings(base=base, run_id="trial", registry=f"{base}/registry", grid=TRIAL, folds=3,
                        source=lambda s: insured(s, sf_dir))
    rows = run_full(spark, settings)
    learned = ["r2_score", "rmse", "mae", "cv_r2", "best_model", "best_params", "message", "reason", "changed_accuracy"]
    return rows.filter(~F.col("metric").isin(learned)).select("stage", "metric", "value")


@query(sql("""SELECT 'validate' AS stage, 'validation_status' AS metric, 1::DOUBLE AS value, NULL::VARCHAR AS text
UNION ALL SELECT 'validate', 'message', NULL, 'Data drift detected between train and test sets'
UNION ALL SELECT 'validate', 'drift_detected', (abs(a.age - b.age * 1.5) / a.sd_age >= 0.1 AND abs(a.bmi - b.bmi * 1.5) / a.sd_bmi >= 0.1
  AND abs(a.children - (b.children + 3)) / a.sd_children >= 0.1 AND abs(a.charges - b.charges * 1.5) / a.sd_charges >= 0.1)::INT, NULL FROM
  (SELECT avg(age) AS age, avg(bmi) AS bmi, avg(children) AS children, avg(charges) AS charges, stddev_pop(age) AS sd_age, stddev_pop(bmi) AS sd_bmi,
    stddev_pop(children) AS sd_children, stddev_pop(charges) AS sd_charges FROM train) a,
  (SELECT avg(age) AS age, avg(bmi) AS bmi, avg(children) AS children, avg(charges) AS charges FROM test) b"""))
def drifted_training_run(spark, sf_dir):
    """The stages up to the checks on data whose later part, the test side, has moved: four of seven columns drift.

    A shift of all values moves the Wasserstein distance by at least the shift of the mean, which is what SQL compares.
    """
    base = scratch_path(spark, "runs")

    def source(session):
        df = insured(session, sf_dir)
        moved = in_test_sample(df, "id", exact=True)
        return df.withColumns({
            "age": F.when(moved, (F.col("age") * 1.5).cast("bigint")).otherwise(F.col("age")),
            "bmi": F.when(moved, F.col("bmi") * 1.5).otherwise(F.col("bmi")),
            "children": F.when(moved, F.col("children") + 3).otherwise(F.col("children")),
            "charges": F.when(moved, F.col("charges") * 1.5).otherwise(F.col("charges"))})

    settings = Settings(base=base, run_id="moved", registry=f"{base}/registry", drift_method="tests", source=source)
    return run_stage(spark, "validate", settings).select("stage", "metric", "value", "text")
