"""The engineered feature columns of the insured table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import bin_right_closed, map_values, positive_flag

# Weights, bin edges and column order of the feature table.
SMOKER_WEIGHT = {"yes": 3, "no": 1}
AGE_EDGES = [0, 30, 40, 50, 60, 100]
BMI_EDGES = [0, 18.5, 25, 30, 35, 40, 100]
NUMERIC_FEATURES = [
    "age", "bmi", "children", "risk_score", "children_flag",
    "smoker_bmi_interaction", "age_category", "bmi_category",
]
CATEGORICAL_FEATURES = ["sex", "smoker", "region"]


def add_features(df: DataFrame, bounds: str = "closed", strict: bool = False) -> DataFrame:
    """Append the five engineered columns.

    ``bounds="closed"`` is the training rule (out-of-range bins are null), ``"open"``
    the serving rule. ``strict`` raises on a smoker value without a weight.
    """
    weight = map_values(F.col("smoker"), SMOKER_WEIGHT, strict)
    age, bmi = F.col("age"), F.col("bmi")
    return df.withColumns({
        "risk_score": (age / F.lit(10.0)) * (bmi / F.lit(25.0)) * weight,
        "children_flag": positive_flag(F.col("children")),
        "smoker_bmi_interaction": bmi * weight,
        "age_category": bin_right_closed(age, AGE_EDGES, bounds),
        "bmi_category": bin_right_closed(bmi, BMI_EDGES, bounds),
    })


def log_target(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.log1p(col))


def unlog(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.expm1(col))
