"""Append-only model registry; the champion is the newest accepted version.

Every version is an entry of a ledger, so of publishers at one time each gets a position of its own, and a
version becomes visible at once with its model complete.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.shared import literal_rows
from plumbline.sources import ledger
from plumbline.sources.files import load_model, save_model

SCHEMA = ("version string, path string, r2 double, rmse double, mae double, accepted boolean, "
          "position bigint")


def versions(spark: SparkSession, base: str) -> DataFrame:
    """All registered versions; none when nothing was published yet."""
    try:
        return spark.read.schema(SCHEMA).json(f"{base}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_rows(spark, SCHEMA, [])


def current(spark: SparkSession, base: str) -> DataFrame:
    """The champion as one row, or no row."""
    accepted = versions(spark, base).filter("accepted")
    columns = ["version", "path", "r2", "rmse", "mae"]
    latest = accepted.agg(F.max_by(F.struct(*columns), "position").alias("top"))
    return latest.filter(F.col("top").isNotNull()).select("top.*")


def is_present(spark: SparkSession, base: str, version: str) -> bool:
    """Whether exactly this version was published."""
    return not versions(spark, base).filter(F.col("version") == version).isEmpty()


def publish(
    spark: SparkSession, base: str, model: PipelineModel, r2: float, rmse: float, mae: float,
    accepted: bool = True, version: str | None = None,
) -> str:
    """Save the model in a folder of its own, then append the entry that makes it visible.

    A version that is already published is an error, also when somebody else publishes it at the same time.
    """
    version = version or uuid.uuid4().hex
    path = f"{base}/models/{version}-{uuid.uuid4().hex}"
    numbers = {"r2": float(r2), "rmse": float(rmse), "mae": float(mae)}

    def entry(before: list[str]) -> str:
        if any(json.loads(text)["version"] == version for text in before):
            raise ValueError(f"version {version!r} is already published")
        return json.dumps({"version": version, "path": path, **numbers, "accepted": accepted, "position": len(before) + 1})

    entry(ledger.entries(spark, f"{base}/versions"))
    save_model(model, path)
    try:
        ledger.append(spark, f"{base}/versions", entry)
    except ValueError:
        ledger.delete_folder(spark, path)
        raise
    return version


def promote_if_accepted(
    spark: SparkSession, base: str, decision: DataFrame, model: PipelineModel,
    version: str | None = None,
) -> str | None:
    """Publish the challenger when the decision row accepts it; else keep the champion."""
    row = decision.first()
    if not row["accepted"]:
        return None
    return publish(spark, base, model, row["challenger_r2"], row["challenger_rmse"],
                   row["challenger_mae"], version=version)


def load_champion(spark: SparkSession, base: str) -> PipelineModel | None:
    row = current(spark, base).first()
    return None if row is None else load_model(row["path"])
