"""The training job as stages that exchange stored tables.

Every stage reads what earlier stages wrote and writes its own result below the run's
folder, so a stage can run alone, a lost job resumes at the last stored result, and no
stage depends on another's lineage. Each attempt of a stage has a folder of its own, and a ledger says which
attempts began and which were finished: a reader finds the newest finished one whole, whatever runs or dies meanwhile.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import iso_stamp
from plumbline.operators.contract import (
    INSURED, Contract, Validation, coerce, coercion_losses, normalise_nulls, validate, validation_rows,
)
from plumbline.operators.drift import basic_drift
from plumbline.operators.drift_tests import DriftRules, dataset_drift
from plumbline.operators.encode import ColumnTransformerModel, build_matrices
from plumbline.operators.outliers import winsorise
from plumbline.operators.scoring import bundle, compare, evaluate
from plumbline.operators.split import in_test_sample, read_side, write_sides
from plumbline.operators.training import (
    MINIMUM_SCORE, families, leaderboard, require_score, residuals, select_best,
)
from plumbline.plans.reports import WINSORISED, analysis_report, sample_metrics, stage_metrics
from plumbline.sources import ledger, registry
from plumbline.sources.files import (
    load_model, read_matrix, save_model, snapshot, write_csv, write_matrix, write_report,
)

log = logging.getLogger(__name__)

STAGES = ("ingest", "analyse", "validate", "transform", "train", "evaluate", "promote")
REQUIRES = {
    "ingest": (), "analyse": ("ingest",), "validate": ("ingest",), "transform": ("ingest", "validate"),
    "train": ("transform",), "evaluate": ("ingest", "train"), "promote": ("evaluate",),
}


@dataclass(frozen=True)
class Settings:
    """Where a run stores its results, and its choices; checked on creation."""

    base: str
    run_id: str
    registry: str
    source: Callable[[SparkSession], DataFrame]
    contract: Contract = INSURED
    key: str = "id"
    test_ratio: float = 0.2
    seed: int = 42
    exact_split: bool = True
    expected_score: float = MINIMUM_SCORE
    min_gain: float = 0.0
    grid: str | dict = "small"
    folds: int = 5
    select_by: str = "test"
    drift_method: str = "basic"
    drift_rules: DriftRules = field(default_factory=DriftRules)

    def __post_init__(self):
        if not 0 < self.test_ratio < 1:
            raise ValueError("test_ratio must be between 0 and 1")
        if not 0 <= self.expected_score <= 1:
            raise ValueError("expected_score must be from 0 to 1")
        if self.drift_method not in ("basic", "tests"):
            raise ValueError("drift_method must be 'basic' or 'tests'")
        if not (self.base and self.run_id and self.registry):
            raise ValueError("base, run_id and registry must be given")

    def log(self, stage: str) -> str:
        """The ledger of a stage's attempts."""
        return f"{self.base}/runs/{self.run_id}/log/{stage}"

    def folder(self, stage: str, attempt: str) -> str:
        return f"{self.base}/runs/{self.run_id}/{stage}/{attempt}"


#: Settings that a stage's result depends on, besides its inputs.
DEPENDS_ON = {
    "ingest": ("contract", "key", "test_ratio", "seed", "exact_split"), "analyse": ("contract",),
    "validate": ("contract", "key", "drift_method", "drift_rules"), "transform": ("contract", "key"),
    "train": ("key", "expected_score", "grid", "folds", "select_by"),
    "evaluate": ("contract", "registry", "min_gain"), "promote": ("registry",),
}
METRIC_ROWS = "stage string, metric string, value double, text string"
BEGUN, DONE = "begun", "done"
#: The stage that writes each stored result.
WRITTEN_BY = {
    "lost_values": "ingest", "samples": "ingest", "analysis_report": "analyse", "train_cleaned": "analyse",
    "test_cleaned": "analyse", "drift_report": "validate", "validation_report": "validate", "train_matrix": "transform",
    "test_matrix": "transform", "encoder": "transform", "leaderboard": "train", "model": "train", "predictions": "train",
    "decision": "evaluate",
}


@dataclass(frozen=True)
class Attempt:
    """One attempt of a stage: the folder it writes to, and the finished attempts that it reads from."""

    spark: SparkSession
    settings: Settings
    stage: str
    name: str
    reads: dict[str, str]

    def path(self, result: str) -> str:
        return f"{self.settings.folder(self.stage, self.name)}/{result}"

    def input(self, result: str) -> str:
        """Where an earlier stage's result is; the same attempt's throughout."""
        stage = WRITTEN_BY.get(result, result)
        return f"{self.settings.folder(stage, self.reads[stage])}/{result if result in WRITTEN_BY else 'metrics'}"

    def sample(self, side: str) -> DataFrame:
        own = self.stage == WRITTEN_BY["samples"]
        return read_side(self.spark, self.path("samples") if own else self.input("samples"), side)


def _log(spark: SparkSession, settings: Settings, stage: str) -> list[dict]:
    return [json.loads(text) for text in ledger.entries(spark, settings.log(stage))]


def _finished(log: list[dict]) -> dict | None:
    """The newest finished attempt."""
    return next((entry for entry in reversed(log) if entry["state"] == DONE), None)


def _finished_attempt(spark: SparkSession, settings: Settings, stage: str) -> str | None:
    found = _finished(_log(spark, settings, stage))
    return found and found["attempt"]


def result_path(spark: SparkSession, settings: Settings, result: str) -> str:
    """Where the newest finished attempt has stored a result, or ``metrics/<stage>``."""
    stage = WRITTEN_BY.get(result) or result.removeprefix("metrics/")
    attempt = _finished_attempt(spark, settings, stage)
    if attempt is None:
        raise FileNotFoundError(f"stage {stage!r} of run {settings.run_id!r} never finished")
    return f"{settings.folder(stage, attempt)}/{result if result in WRITTEN_BY else 'metrics'}"


def _read_metrics(spark: SparkSession, path: str) -> dict[str, float | str]:
    rows = spark.read.schema(METRIC_ROWS).json(path).collect()
    return {r["metric"]: r["text"] if r["value"] is None else r["value"] for r in rows}


def read_metrics(spark: SparkSession, settings: Settings, stage: str) -> dict[str, float | str]:
    """Stored metrics of the newest finished attempt of a stage; none if there is none."""
    if _finished_attempt(spark, settings, stage) is None:
        return {}
    return _read_metrics(spark, result_path(spark, settings, f"metrics/{stage}"))


def _inputs(settings: Settings, stage: str, reads: dict[str, str | None]) -> str:
    """Stands for the attempts whose results a stage reads, and for its settings."""
    attempts = [str(reads[needed]) for needed in REQUIRES[stage]]
    chosen = [f"{name}={getattr(settings, name)!r}" for name in DEPENDS_ON[stage]]
    return hashlib.sha256("\n".join([*attempts, *chosen]).encode()).hexdigest()


def _is_done(spark: SparkSession, settings: Settings, stage: str) -> bool:
    """Whether the stage's last attempt finished and is still stored, on the results that are valid now, all of them
    done themselves."""
    log = _log(spark, settings, stage)
    if not log or log[-1]["state"] != DONE or not ledger.exists(spark, settings.folder(stage, log[-1]["attempt"])):
        return False
    if not all(_is_done(spark, settings, needed) for needed in REQUIRES[stage]):
        return False
    reads = {needed: _finished_attempt(spark, settings, needed) for needed in REQUIRES[stage]}
    return log[-1]["inputs"] == _inputs(settings, stage, reads)


def release_attempts(spark: SparkSession, settings: Settings) -> int:
    """Delete what older and unfinished attempts of the run stored; for its owner, while no stage runs."""
    gone = 0
    for stage in STAGES:
        log = _log(spark, settings, stage)
        valid = (_finished(log) or {}).get("attempt")
        for attempt in {entry["attempt"] for entry in log} - {valid}:
            gone += ledger.delete_folder(spark, settings.folder(stage, attempt))
    return gone


def _ingest(spark: SparkSession, at: Attempt) -> DataFrame:
    settings = at.settings
    raw = settings.source(spark)
    stored = spark.read.parquet(snapshot(raw, f"{settings.base}/feature_store", settings.run_id))
    # Columns that do not belong stay in, for the checks of the next stage to report.
    raw = stored.drop("run_id")
    write_report(coercion_losses(raw, settings.contract, settings.key), at.path("lost_values"))
    typed = normalise_nulls(coerce(raw, settings.contract))
    is_test = in_test_sample(typed, settings.key, settings.test_ratio, settings.seed, settings.exact_split)
    write_sides(typed, is_test, at.path("samples"))
    return sample_metrics([(side, at.sample(side)) for side in ("train", "test")])


def _analyse(spark: SparkSession, at: Attempt) -> DataFrame:
    contract = at.settings.contract
    train, test = (at.sample(side).select(*contract.names) for side in ("train", "test"))
    write_report(analysis_report(train, test, contract), at.path("analysis_report"))
    for side, df in (("train", train), ("test", test)):
        write_csv(winsorise(df, WINSORISED), at.path(f"{side}_cleaned"))
    return stage_metrics("analyse", {"completed": 1.0}, spark)


def _validate(spark: SparkSession, at: Attempt) -> DataFrame:
    settings = at.settings
    train, test = (at.sample(side).drop(settings.key) for side in ("train", "test"))

    def drifted(ref: DataFrame, cur: DataFrame) -> bool:
        if settings.drift_method == "basic":
            rows = basic_drift(ref, cur, settings.contract)
        else:
            rows = dataset_drift(ref, cur, settings.contract, settings.drift_rules)
        write_report(rows, at.path("drift_report"))
        stored = spark.read.schema(rows.schema).json(at.path("drift_report"))
        return stored.first()["dataset_drift"]

    result = validate(train, test, settings.contract, drifted)
    write_report(validation_rows(result, train, test), at.path("validation_report"))
    numbers = {"validation_status": result.status}
    if result.drift_detected is not None:
        numbers["drift_detected"] = result.drift_detected
    return stage_metrics("validate", numbers, spark, {"message": result.message})


def _transform(spark: SparkSession, at: Attempt) -> DataFrame:
    settings = at.settings
    stored = _read_metrics(spark, at.input("validate"))
    outcome = Validation(stored["validation_status"] == 1.0, stored["message"], {})
    train, test = (at.sample(side) for side in ("train", "test"))
    train_matrix, test_matrix, encoder = build_matrices(
        train, test, settings.contract.target, settings.key, outcome)
    write_matrix(train_matrix, at.path("train_matrix"))
    write_matrix(test_matrix, at.path("test_matrix"))
    encoder.write().overwrite().save(at.path("encoder"))
    numbers = {"features_count": len(encoder.feature_names())}
    for side in ("train", "test"):
        numbers[f"{side}_rows"] = read_matrix(spark, at.path(f"{side}_matrix")).count()
    return stage_metrics("transform", numbers, spark)


def _train(spark: SparkSession, at: Attempt) -> DataFrame:
    settings = at.settings
    train, test = (read_matrix(spark, at.input(f"{side}_matrix")) for side in ("train", "test"))
    best, board = select_best(train, test, families(settings.grid), settings.key, settings.folds,
                              settings.select_by)
    write_report(leaderboard(spark, board), at.path("leaderboard"))
    require_score(best, settings.expected_score)
    encoder = ColumnTransformerModel.load(at.input("encoder"))
    save_model(bundle(encoder, best.model), at.path("model"))
    write_csv(residuals(best.model.transform(test)), at.path("predictions"))
    numbers = {"r2_score": best.test_r2, "rmse": best.test_rmse, "mae": best.test_mae,
               "cv_r2": best.cv_r2, "feature_count": len(encoder.feature_names())}
    return stage_metrics("train", numbers, spark, {"best_model": best.family, "best_params": best.settings})


def _evaluate(spark: SparkSession, at: Attempt) -> DataFrame:
    settings = at.settings
    test = at.sample("test")
    challenger = evaluate(load_model(at.input("model")), test, settings.contract.target)
    champion = registry.load_champion(spark, settings.registry)
    theirs = None if champion is None else evaluate(champion, test, settings.contract.target)
    compare(challenger, theirs, settings.min_gain).write.parquet(at.path("decision"))
    row = spark.read.parquet(at.path("decision")).first()
    numbers = {"is_model_accepted": row["accepted"], "changed_accuracy": row["difference"]}
    return stage_metrics("evaluate", numbers, spark, {"reason": row["reason"]})


def _promote(spark: SparkSession, at: Attempt) -> DataFrame:
    settings = at.settings
    decision = spark.read.parquet(at.input("decision"))
    accepted = decision.first()["accepted"]
    # The run id is the version, so a repeated attempt does not publish twice.
    if accepted and not registry.is_present(spark, settings.registry, settings.run_id):
        registry.promote_if_accepted(
            spark, settings.registry, decision, load_model(at.input("model")), settings.run_id)
    return stage_metrics("promote", {"promoted": accepted}, spark)


_RUN = {"ingest": _ingest, "analyse": _analyse, "validate": _validate, "transform": _transform,
        "train": _train, "evaluate": _evaluate, "promote": _promote}


def run_stage(spark: SparkSession, name: str, settings: Settings, force: bool = True) -> DataFrame:
    """Run one stage, first running whichever of its inputs are not stored or out of date.

    With ``force`` off a stage that is stored, and was made from what is stored now, is left as it is.
    A stage that runs again makes all that read its results out of date. An attempt that dies leaves the
    results of the one before it in place, but the stage counts as not done.
    """
    for needed in REQUIRES[name]:
        run_stage(spark, needed, settings, force=False)
    if force or not _is_done(spark, settings, name):
        # The promotion also reads the model that was evaluated.
        reads = {stage: _finished_attempt(spark, settings, stage) for stage in STAGES if _reads(name, stage)}
        at = Attempt(spark, settings, name, uuid.uuid4().hex, reads)
        entry = {"attempt": at.name, "inputs": _inputs(settings, name, reads)}
        ledger.append(spark, settings.log(name), lambda _: json.dumps({"state": BEGUN, **entry}))
        metrics = _RUN[name](spark, at)
        write_report(metrics.withColumn("stamped_at", iso_stamp()), at.path("metrics"))
        ledger.append(spark, settings.log(name), lambda _: json.dumps({"state": DONE, **entry}))
    return _metric_rows(spark, [result_path(spark, settings, f"metrics/{name}")])


def _reads(stage: str, other: str) -> bool:
    return any(needed == other or _reads(needed, other) for needed in REQUIRES[stage])


def _metric_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(METRIC_ROWS).json(paths)


def check_settings(spark: SparkSession, settings: Settings) -> list[str]:
    """What of a run's surroundings is missing or wrong, before any stage begins: its folders, the searched grid, and the
    columns that the contract names."""
    wrong = []
    for name in ("base", "registry"):
        try:
            ledger.exists(spark, getattr(settings, name))
        except Exception as error:  # noqa: BLE001 - a file system may fail in any way
            wrong.append(f"{name}: {str(error).splitlines()[0]}")
    try:
        empty = [family.name for family in families(settings.grid) if not family.grid]
        wrong += [f"grid: no setting of {name}" for name in empty]
    except (KeyError, AttributeError, TypeError) as error:
        wrong.append(f"grid: {error}")
    names = settings.contract.names
    used = [settings.contract.target, *settings.contract.numeric, *settings.contract.categorical]
    wrong += [f"contract: no column {name!r}" for name in used if name not in names]
    if settings.key in names:
        wrong.append(f"contract: the key {settings.key!r} is one of its columns")
    return wrong


def run_full(spark: SparkSession, settings: Settings, resume: bool = False) -> DataFrame:
    """All stages in order; returns the metrics of every stage.

    What is missing around the run is an error before its first stage. A failing analysis is logged and
    tolerated, any other failure ends the run.
    """
    wrong = check_settings(spark, settings)
    if wrong:
        raise ValueError("the run cannot start: " + "; ".join(wrong))
    for name in STAGES:
        try:
            run_stage(spark, name, settings, force=not resume)
        except Exception as error:  # noqa: BLE001
            if name != "analyse":
                raise
            log.warning("analysis failed: %s", error)
    done = [result_path(spark, settings, f"metrics/{name}") for name in STAGES if _is_done(spark, settings, name)]
    return _metric_rows(spark, done)
