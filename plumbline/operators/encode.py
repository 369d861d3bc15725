"""Scaler and one-hot encoder as one ``pyspark.ml`` estimator over column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.derived import CATEGORICAL_FEATURES, NUMERIC_FEATURES, add_features
from plumbline.operators.contract import Validation, require_valid
from plumbline.shared import tall

MAX_CATEGORIES = 1_000


class _EncoderParams(HasOutputCol):
    numeric = Param(Params._dummy(), "numeric", "columns to scale", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "columns to encode", TypeConverters.toListString)

    maxCategories = Param(Params._dummy(), "maxCategories", "most categories per column, on average",
                          TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(outputCol="features", maxCategories=MAX_CATEGORIES)

    def getNumeric(self) -> list[str]:
        return self.getOrDefault(self.numeric)

    def getCategorical(self) -> list[str]:
        return self.getOrDefault(self.categorical)


class ColumnTransformer(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Scales numeric columns by mean and population deviation and one-hot encodes
    categorical ones with sorted categories and the first dropped.

    Columns that the data lacks are skipped, others of the data are left alone. Fitting
    takes one aggregate for the numbers and one distinct for the categories.
    """

    @keyword_only
    def __init__(self, *, numeric: Sequence[str] = NUMERIC_FEATURES,
                 categorical: Sequence[str] = CATEGORICAL_FEATURES, outputCol: str = "features",
                 maxCategories: int = MAX_CATEGORIES):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(numeric=list(numeric), categorical=list(categorical))

    def _fit(self, df: DataFrame) -> "ColumnTransformerModel":
        numeric = [name for name in self.getNumeric() if name in df.columns]
        categorical = [name for name in self.getCategorical() if name in df.columns]
        means, scales = fit_scaler(df, numeric)
        model = ColumnTransformerModel(
            numeric=numeric, categorical=categorical, means=means, scales=scales,
            categories=fit_categories(df, categorical, self.getOrDefault(self.maxCategories)))
        return self._copyValues(model, {self.numeric: numeric, self.categorical: categorical})


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    """Mean and population deviation per column; a constant column gets scale 1."""
    if not cols:
        return [], []
    aggs = []
    for i, col in enumerate(cols):
        x = F.col(col).cast("double")
        aggs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"s{i}"),
                 (F.min(x) == F.max(x)).alias(f"c{i}")]
    row = df.agg(*aggs).first()
    means, scales = [], []
    for i, col in enumerate(cols):
        if row[f"a{i}"] is None:
            raise ValueError(f"column {col!r} has no values to fit a scale on")
        means.append(row[f"a{i}"])
        scales.append(1.0 if row[f"c{i}"] or row[f"s{i}"] == 0 else row[f"s{i}"])
    return means, scales


def fit_categories(
    df: DataFrame, cols: Sequence[str], max_categories: int = MAX_CATEGORIES,
) -> list[list[str]]:
    """Sorted distinct values per column. More than the limit in total is an error, as
    every category becomes a slot of the feature vector."""
    if not cols:
        return []
    limit = max_categories * len(cols)
    found = (tall(df, cols).filter(F.col("value").isNotNull()).distinct().limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"more than {limit} categories in {list(cols)}")
    by_col: dict[str, list[str]] = {col: [] for col in cols}
    for row in found:
        by_col[row["column_name"]].append(row["value"])
    return [sorted(by_col[col]) for col in cols]


class ColumnTransformerModel(Model, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted values of :class:`ColumnTransformer`; missing and unseen categories give zeros."""

    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted scales", TypeConverters.toListFloat)
    categories = Param(Params._dummy(), "categories", "sorted categories per column")

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, means=None, scales=None, categories=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        names = list(self.getNumeric())
        for col, values in zip(self.getCategorical(), self.getOrDefault(self.categories)):
            names += [f"{col}_{value}" for value in values[1:]]
        return names

    def feature_columns(self) -> list[Column]:
        """The features as named double columns, in output order."""
        exprs = []
        fitted = zip(self.getNumeric(), self.getOrDefault(self.means), self.getOrDefault(self.scales))
        for col, mean, scale in fitted:
            exprs.append((F.col(col).cast("double") - F.lit(mean)) / F.lit(scale))
        for col, values in zip(self.getCategorical(), self.getOrDefault(self.categories)):
            exprs += [F.when(F.col(col) == F.lit(value), F.lit(1.0)).otherwise(F.lit(0.0))
                      for value in values[1:]]
        return [expr.alias(name) for expr, name in zip(exprs, self.feature_names())]

    def _transform(self, df: DataFrame) -> DataFrame:
        # A learner cannot take a hole in the vector; it fails loudly instead of losing rows.
        cells = [F.coalesce(expr, F.raise_error(F.lit(f"missing value in feature {name}")).cast("double"))
                 for expr, name in zip(self.feature_columns(), self.feature_names())]
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*cells)))


def unprocessed_columns(df: DataFrame, model: ColumnTransformerModel, target: str | None = None) -> list[str]:
    """Columns that the fitted transformer leaves out of the feature vector."""
    used = {*model.getNumeric(), *model.getCategorical(), target}
    return [name for name in df.columns if name not in used]


def build_matrices(
    train: DataFrame, test: DataFrame, target: str, key: str | None = None,
    validation: Validation | None = None,
) -> tuple[DataFrame, DataFrame, ColumnTransformerModel]:
    """Feature vector and ``label`` of both samples; the encoder is fitted on train only."""
    if validation is not None:
        require_valid(validation)
    train, test = add_features(train), add_features(test)
    model = ColumnTransformer().fit(train)
    keep = [key] if key else []

    def matrix(df: DataFrame) -> DataFrame:
        return model.transform(df).select(
            *keep, model.getOutputCol(), F.col(target).cast("double").alias("label"))

    return matrix(train), matrix(test), model
