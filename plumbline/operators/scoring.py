"""Batch scoring and the challenger-champion decision."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.derived import add_features
from plumbline.functions.scalars import currency
from plumbline.operators.training import regression_metrics

REPORTED_THRESHOLD = 0.02


def bundle(encoder: Model, learner: Model) -> PipelineModel:
    """Encoder and learner as the one model that is saved and served."""
    return PipelineModel(stages=[encoder, learner])


def score(model: Model, df: DataFrame, bounds: str = "open") -> DataFrame:
    """Build the features, predict, and show the prediction as money text."""
    scored = model.transform(add_features(df, bounds))
    kept = [F.col(name) for name in df.columns]
    return scored.select(*kept, "prediction", currency(F.col("prediction")).alias("display"))


def evaluate(model: Model, test: DataFrame, target: str) -> DataFrame:
    """Metrics of a served model on raw test rows, features built the training way."""
    scored = model.transform(add_features(test)).withColumn("label", F.col(target).cast("double"))
    return regression_metrics(scored)


def compare(challenger: DataFrame, champion: DataFrame | None = None, min_gain: float = 0.0) -> DataFrame:
    """Accept the challenger if its R2 beats the champion's (0 when there is none).

    Both inputs are one metrics row. The reported threshold takes no part in the decision.
    """
    sides = [("challenger", challenger)] + ([] if champion is None else [("champion", champion)])
    stacked = reduce(DataFrame.unionByName, [
        df.select(F.lit(side).alias("side"), "r2", "rmse", "mae") for side, df in sides])
    paired = stacked.agg(*[
        F.max(F.when(F.col("side") == side, F.col(name))).alias(f"{side}_{name}")
        for side in ("challenger", "champion") for name in ("r2", "rmse", "mae")])
    gain = F.col("challenger_r2") - F.coalesce(F.col("champion_r2"), F.lit(0.0))
    accepted = gain > F.lit(min_gain)
    return paired.withColumns({
        "difference": gain,
        "accepted": accepted,
        "reason": F.when(accepted, "New model performs better").otherwise("Existing model performs better"),
        "reported_threshold": F.lit(REPORTED_THRESHOLD),
    })
