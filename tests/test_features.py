import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import scalars
from plumbline.functions.derived import AGE_EDGES, BMI_EDGES, add_features
from plumbline.operators.encode import (
    ColumnTransformer, ColumnTransformerModel, build_matrices, fit_categories, fit_scaler, unprocessed_columns,
)
from plumbline.operators.split import add_contiguous_fold, add_fold, train_test
from plumbline.shared import literal_rows, scratch_path


def binned(spark, values, edges, bounds):
    df = literal_rows(spark, "x double", [(v,) for v in values])
    return [r[0] for r in df.select(scalars.bin_right_closed(F.col("x"), edges, bounds)).collect()]


def test_bins_are_right_closed(spark):
    ages = [0.0, 18.0, 30.0, 31.0, 40.0, 50.0, 60.0, 100.0, 101.0, None]
    assert binned(spark, ages, AGE_EDGES, "closed") == [None, 1, 1, 2, 2, 3, 4, 5, None, None]
    assert binned(spark, ages, AGE_EDGES, "open") == [1, 1, 1, 2, 2, 3, 4, 5, 5, None]
    bmi = [18.5, 25.0, 30.0, 35.0, 40.0, 100.0, 100.1]
    assert binned(spark, bmi, BMI_EDGES, "closed") == [1, 2, 3, 4, 5, 6, None]
    assert binned(spark, bmi, BMI_EDGES, "open") == [1, 2, 3, 4, 5, 6, 6]


def test_map_values_strict_raises(spark):
    df = literal_rows(spark, "s string", [("yes",), ("maybe",)])
    loose = df.select(scalars.map_values(F.col("s"), {"yes": 3, "no": 1})).collect()
    assert [r[0] for r in loose] == [3, None]
    with pytest.raises(Exception, match="no entry for value maybe"):
        df.select(scalars.map_values(F.col("s"), {"yes": 3, "no": 1}, strict=True)).collect()


def test_scalar_edges(spark):
    df = literal_rows(spark, "x double, s string", [(1234.5, ' "a b" '), (-5.0, "'q'"), (None, None)])
    rows = df.select(scalars.currency(F.col("x")), scalars.unquote(F.col("s")),
                     scalars.positive_flag(F.col("x")), scalars.ratio(F.col("x"), F.lit(0))).collect()
    assert [tuple(r) for r in rows] == [("$1,234.50", "a b", 1, None), ("$-5.00", "q", 0, None), (None, None, 0, None)]


def test_scaler_centres_and_scales(spark, insured):
    cols = ["age", "bmi", "charges"]
    fitted = list(zip(cols, *fit_scaler(insured, cols)))
    scaled = insured.select(*[((F.col(c) - m) / s).alias(c) for c, m, s in fitted])
    row = scaled.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    for c in cols:
        assert row[f"m_{c}"] == pytest.approx(0, abs=1e-9) and row[f"s_{c}"] == pytest.approx(1)


def test_constant_column_has_scale_one(spark):
    df = literal_rows(spark, "x double", [(0.1,)] * 5 + [(None,)])
    assert fit_scaler(df, ["x"])[1] == [1.0]


def test_encoder_drops_first_and_zeroes_unseen(spark):
    train = literal_rows(spark, "n double, r string", [(1.0, "b"), (3.0, "a"), (2.0, "c"), (2.0, None)])
    model = ColumnTransformer(numeric=["n", "absent"], categorical=["r"]).fit(train)
    assert model.feature_names() == ["n", "r_b", "r_c"]
    other = literal_rows(spark, "n double, r string, z string", [(2.0, "unknown", "q"), (2.0, None, "q"), (2.0, "c", "q")])
    assert [list(r.features) for r in model.transform(other).collect()] == [[0, 0, 0], [0, 0, 0], [0, 0, 1]]
    assert unprocessed_columns(other, model) == ["z"]
    path = scratch_path(spark, "encoder")
    model.write().save(path)
    again = ColumnTransformerModel.load(path)
    assert again.feature_names() == model.feature_names()
    assert [list(r.features) for r in again.transform(other).collect()] == [[0, 0, 0], [0, 0, 0], [0, 0, 1]]


def test_missing_number_fails_loudly(spark):
    train = literal_rows(spark, "n double", [(1.0,), (3.0,)])
    model = ColumnTransformer(numeric=["n"], categorical=[]).fit(train)
    with pytest.raises(Exception, match="missing value in feature n"):
        model.transform(literal_rows(spark, "n double", [(None,)])).collect()


def test_too_many_categories_is_an_error(spark):
    df = spark.range(30).selectExpr("CAST(id AS STRING) AS c")
    with pytest.raises(ValueError):
        fit_categories(df, ["c"], max_categories=10)


def test_matrices_have_thirteen_features(insured):
    train, test = train_test(insured, "id", exact=True)
    matrix, other, encoder = build_matrices(train, test, "charges", "id")
    assert len(encoder.feature_names()) == 13
    assert matrix.columns == ["id", "features", "label"] and other.count() == test.count()


def test_features_of_a_known_row(spark):
    df = literal_rows(spark, "age bigint, bmi double, children bigint, smoker string", [(40, 50.0, 0, "yes")])
    row = add_features(df).first()
    assert (row.risk_score, row.children_flag, row.smoker_bmi_interaction, row.age_category, row.bmi_category) == (
        24.0, 0, 150.0, 2, 6)


@pytest.mark.parametrize("task_values", [50, 100_000])
def test_exact_split_is_complete_and_sized(insured, task_values):
    n = insured.count()
    train, test = train_test(insured, "id", exact=True, task_values=task_values)
    assert test.count() == math.ceil(0.2 * n) and train.count() == n - test.count()
    assert train.select("id").intersect(test.select("id")).count() == 0


def test_split_does_not_depend_on_partitions(insured):
    one = {r.id for r in train_test(insured.coalesce(1), "id")[1].collect()}
    many = {r.id for r in train_test(insured.repartition(13), "id")[1].collect()}
    assert one == many and 0.15 < len(one) / insured.count() < 0.25


def test_repeated_key_is_refused(spark):
    df = literal_rows(spark, "id bigint", [(1,)] * 10)
    with pytest.raises(ValueError):
        train_test(df, "id", exact=True)


def test_folds_cover_every_row(insured):
    counts = add_fold(insured, "id").groupBy("fold").count().collect()
    assert {r.fold for r in counts} == set(range(5)) and sum(r["count"] for r in counts) == insured.count()


@pytest.mark.parametrize("n, k", [(0, 5), (3, 5), (5, 5), (101, 5), (1000, 7)])
def test_contiguous_folds_follow_the_order_of_the_key(spark, n, k):
    rows = spark.range(n).selectExpr("id * 3 - 20 AS id").repartition(3)
    folded = add_contiguous_fold(rows, "id", k, task_values=50)
    assert not any(word in folded._jdf.queryExecution().executedPlan().toString() for word in ("Window", "Sort"))
    got = [r.fold for r in folded.orderBy("id").collect()]
    assert got == sorted(got)
    assert [got.count(f) for f in range(k)] == [n // k + (f < n % k) for f in range(k)]


def test_contiguous_folds_need_unique_keys(spark):
    for values in ([1, 2, 2, 3], [1, None, 3, 4]):
        rows = spark.createDataFrame([(v,) for v in values], "id long")
        with pytest.raises(ValueError):
            add_contiguous_fold(rows, "id", 2)


@pytest.mark.parametrize("n, ratio", [(1, 0.2), (7, 0.5), (1000, 0.2), (5000, 0.33)])
def test_the_exact_split_looks_twice(spark, n, ratio, monkeypatch):
    from plumbline.operators import split

    def unused(*_):
        raise AssertionError("a third look")

    rows = spark.range(n).repartition(3)
    want = sorted(r.id for r in rows.filter(split.exact_test_side(rows, "id", ratio, 5, task_values=0)).collect())
    monkeypatch.setattr(split, "order_statistics", unused)
    got = sorted(r.id for r in rows.filter(split.exact_test_side(rows, "id", ratio, 5)).collect())
    assert got == want and len(got) == math.ceil(ratio * n)


def test_the_exact_split_refuses_a_key_that_is_not_unique(spark):
    from plumbline.operators import split

    with pytest.raises(ValueError):
        split.exact_test_side(spark.range(40).selectExpr("id % 4 AS id"), "id", 0.3, 5)
