import pytest

from plumbline.operators import contract as c
from plumbline.shared import literal_rows

ROW = "age bigint, sex string, bmi double, children bigint, smoker string, region string, charges double"


@pytest.fixture(scope="module")
def good(spark):
    return literal_rows(spark, ROW, [(30, "male", 25.0, 1, "no", "northwest", 10.0)])


def test_nan_and_none_are_both_missing(spark):
    from plumbline.operators.profile import missing

    df = c.normalise_nulls(literal_rows(spark, "x double, s string", [(1.0, "a"), (None, "b"), (float("nan"), None)]))
    assert {r.column_name: r.missing_count for r in missing(df).collect()} == {"x": 2, "s": 1}


def test_unknown_names_are_errors(good):
    with pytest.raises(ValueError):
        c.drop_columns(good, ["nothing"])
    with pytest.raises(ValueError):
        c.project(good, ["age", "nothing"])
    assert c.drop_columns(good, ["age"]).columns == good.columns[1:]


def test_column_checks(good):
    assert c.check_column_count(good, c.INSURED).first().passed
    extra = good.selectExpr("*", "1 AS extra")
    assert not c.check_column_count(extra, c.INSURED).first().passed
    lacking = good.drop("bmi", "smoker")
    assert c.missing_columns(lacking.columns, c.INSURED) == {"numeric": ["bmi"], "categorical": ["smoker"]}
    assert {r.column_name for r in c.check_columns(lacking, c.INSURED).filter("NOT present").collect()} == {"bmi", "smoker"}


def test_type_check_lists_mismatches(good):
    assert c.check_types(good, c.INSURED).count() == 0
    wrong = good.selectExpr("CAST(age AS STRING) AS age", "bmi", "CAST(children AS DOUBLE) AS children")
    assert c.type_mismatches(wrong, c.INSURED) == [("age", "int", "string"), ("children", "int", "double")]


def test_coerce_makes_bad_numbers_null(spark):
    df = literal_rows(spark, "age string, bmi string, sex string", [("12", "1.5", "male"), ("x", "NaN", "female")])
    rows = c.coerce(df, c.INSURED).collect()
    assert [(r.age, r.bmi) for r in rows] == [(12, 1.5), (None, None)]
    assert dict(c.coerce(df, c.INSURED).dtypes)["age"] == "bigint"


def test_coerce_does_not_cut_fractions(spark):
    df = literal_rows(spark, "age double", [(31.0,), (31.5,), (float("nan"),), (None,)])
    assert [r.age for r in c.coerce(df, c.INSURED).collect()] == [31, None, None, None]


def test_columns_by_type(good):
    assert c.columns_by_type(good, "numeric") == ["age", "bmi", "children", "charges"]
    assert c.columns_by_type(good, "text") == ["sex", "smoker", "region"]


@pytest.mark.parametrize("fields, reason", [
    (("30", "male", "25.5", "1", "no", "northwest"), None),
    ((" 42 ", "male", "25", "0", "yes", "southeast"), None),
    (("", "male", "25.5", "1", "no", "northwest"), c.MISSING_FIELD),
    ((None, "male", "25.5", "1", "no", "northwest"), c.MISSING_FIELD),
    (("12x", "male", "25.5", "1", "no", "northwest"), "Invalid input data: age is not a whole number"),
    (("31.5", "male", "25.5", "1", "no", "northwest"), "Invalid input data: age is not a whole number"),
    (("30", "male", "heavy", "1", "no", "northwest"), "Invalid input data: bmi is not a number"),
    (("17", "male", "25.5", "1", "no", "northwest"), "Invalid input data: age is out of range"),
    (("30", "male", "50.1", "1", "no", "northwest"), "Invalid input data: bmi is out of range"),
    (("30", "male", "25.5", "11", "no", "northwest"), "Invalid input data: children is out of range"),
    (("30", "male", "25.5", "1", "maybe", "northwest"), "Invalid input data: smoker is not a known choice"),
])
def test_requests(spark, fields, reason):
    df = literal_rows(spark, "age string, sex string, bmi string, children string, smoker string, region string", [fields])
    accepted, rejected = c.parse_requests(df)
    assert accepted.count() == (reason is None)
    assert [r.reason for r in rejected.collect()] == ([] if reason is None else [reason])


def test_drift_changes_the_message_only(good):
    drifting = c.validate(good, good, c.INSURED, lambda a, b: True)
    assert drifting.status and "drift detected" in drifting.message and drifting.drift_detected
    called = []
    bad = c.validate(good.drop("age"), good, c.INSURED, lambda a, b: called.append(1))
    assert not bad.status and not called
    with pytest.raises(ValueError):
        c.require_valid(bad)
