"""Stages that die or get other data, refused requests on the stream, odd CSV files, and metrics of odd predictions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators import contract as c
from plumbline.operators.training import regression_metrics
from plumbline.plans import stages
from plumbline.plans.stages import Settings, read_metrics, run_stage
from plumbline.shared import literal_rows, scratch_path
from plumbline.sources import files, jdbc


def settings(spark, given, **more):
    base = scratch_path(spark, "runs")
    return Settings(base=base, run_id="r", registry=f"{base}/registry", source=lambda s: given[0], exact_split=False, **more)


def numbers(spark, run, stage):
    return {k: v for k, v in read_metrics(spark, run, stage).items() if not isinstance(v, str)}


def test_a_stage_that_dies_midway_is_not_done(spark, insured, monkeypatch):
    given = [insured]
    run = settings(spark, given)
    run_stage(spark, "transform", run)
    wanted = numbers(spark, run, "transform")
    write = stages.write_matrix

    def dies(df, path, *rest):
        if path.endswith("test_matrix"):
            raise OSError("lost")
        write(df.limit(5), path, *rest)

    monkeypatch.setattr(stages, "write_matrix", dies)
    with pytest.raises(OSError):
        run_stage(spark, "transform", run)
    # Readers keep the whole result of the attempt before, and the next run does the stage again.
    assert not stages._is_done(spark, run, "transform") and numbers(spark, run, "transform") == wanted
    assert spark.read.parquet(stages.result_path(spark, run, "train_matrix")).count() == wanted["train_rows"]
    monkeypatch.setattr(stages, "write_matrix", write)
    run_stage(spark, "transform", run, force=False)
    assert numbers(spark, run, "transform") == wanted


def test_new_data_makes_later_stages_out_of_date(spark, sf_dir, insured):
    given = [insured.filter("id % 2 = 0")]
    run = settings(spark, given)
    run_stage(spark, "transform", run)
    given[0] = insured
    run_stage(spark, "ingest", run)
    assert stages._is_done(spark, run, "ingest") and not stages._is_done(spark, run, "validate")
    run_stage(spark, "transform", run, force=False)
    fresh = settings(spark, [insured])
    run_stage(spark, "transform", fresh)
    for stage in ("ingest", "validate", "transform"):
        assert numbers(spark, run, stage) == numbers(spark, fresh, stage)


def test_other_settings_make_a_stage_out_of_date(spark, insured):
    from dataclasses import replace

    run = settings(spark, [insured])
    run_stage(spark, "validate", run)
    assert stages._is_done(spark, run, "validate")
    assert not stages._is_done(spark, replace(run, drift_method="tests"), "validate")
    assert stages._is_done(spark, replace(run, drift_method="tests"), "ingest")
    assert not stages._is_done(spark, replace(run, seed=7), "validate")


def test_lost_values_are_reported(spark, insured):
    odd = insured.withColumn("age", F.when(F.col("id") % 100 == 0, F.lit("31.5")).otherwise(F.col("age").cast("string")))
    run = settings(spark, [odd])
    run_stage(spark, "ingest", run)
    lost = spark.read.json(stages.result_path(spark, run, "lost_values"))
    assert lost.count() == odd.filter("id % 100 = 0").count() and {r.value for r in lost.collect()} == {"31.5"}


@pytest.mark.parametrize("text, whole, number", [
    ("42", 42, 42.0), ("42.0", 42, 42.0), ("31.5", None, 31.5), ("1e2", 100, 100.0), (" 7 ", 7, 7.0), ("25.5d", None, None), ("2f", None, None),
    ("0x1p5", None, None), ("x", None, None), ("", None, None), ("NaN", None, None), ("Infinity", None, None), ("1e999", None, None),
    ("9007199254740993", 9007199254740993, 9007199254740992.0), (".5", None, 0.5), ("-3.", -3, -3.0)])
def test_spellings_of_numbers(spark, text, whole, number):
    row = c.coerce(literal_rows(spark, "age string, bmi string", [(text, text)]), c.INSURED).first()
    assert (row.age, row.bmi) == (whole, number)


def test_csv_columns_by_name_and_further_ones(spark):
    path = scratch_path(spark, "csv")
    literal_rows(spark, "b string, x string, a string", [("NAN", "more", "1.0"), ("2.5", None, "")]).write.option("header", True).csv(path)
    schema = StructType.fromDDL("a BIGINT, b DOUBLE")
    read = files.read_csv(spark, path, schema)
    assert read.columns == ["a", "b", "x"]
    assert sorted(map(str, (tuple(r) for r in read.collect()))) == sorted(map(str, [(1, None, "more"), (None, 2.5, None)]))
    assert not c.check_column_count(read, c.INSURED).first().passed
    with pytest.raises(ValueError):
        files.read_csv(spark, path, StructType.fromDDL("a BIGINT, missing STRING"))


def test_one_line_records_can_be_split(spark):
    path = scratch_path(spark, "csv")
    files.write_csv(literal_rows(spark, "x string", [('a "b", c',), ("d",)]), path)
    assert {r.x for r in files.read_csv(spark, path, StructType.fromDDL("x STRING"), multi_line=False).collect()} == {'a "b", c', "d"}


@pytest.mark.parametrize("rows, want", [
    ([(1.0, 1.0), (2.0, 2.0)], 1.0), ([(5.0, 5.0), (5.0, 5.0)], 1.0), ([(5.0, 4.0), (5.0, 5.0)], 0.0), ([], None), ([(None, None), (1.0, 1.0)], 1.0)])
def test_r2_of_constant_and_empty_labels(spark, rows, want):
    assert regression_metrics(literal_rows(spark, "label double, prediction double", rows)).first().r2 == want


def test_a_missing_prediction_is_an_error(spark):
    for hole in (None, float("nan")):
        with pytest.raises(Exception, match="no prediction"):
            regression_metrics(literal_rows(spark, "label double, prediction double", [(1.0, 1.0), (30.0, hole)])).collect()


def test_quotes_around_a_url():
    assert jdbc.clean_url(" 'jdbc:x' ") == "jdbc:x" == jdbc.clean_url('"jdbc:x"') and jdbc.clean_url("jdbc:x?p='") == "jdbc:x?p='"


def test_requests_follow_their_contract(spark):
    other = c.Contract(columns=(("weight", "int"), ("kind", "category"), ("price", "float")), numeric=("weight", "price"),
                       categorical=("kind",), target="price", form_bounds={"weight": (1, 9)}, choices={"kind": ["a", "b"]})
    asked = literal_rows(spark, "id bigint, weight string, kind string", [(1, "5", "a"), (2, "50", "a"), (3, "5", "z")])
    reasons = {r.id: r.reason for r in c.judge_requests(asked, other).collect()}
    assert reasons[1] is None and "weight" in reasons[2] and "kind" in reasons[3]
