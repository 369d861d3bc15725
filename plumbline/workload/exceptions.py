"""Queries on what goes wrong: rough cells, odd spellings, failing checks, refused requests, resumed runs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators import contract as c
from plumbline.operators.encode import build_matrices, unprocessed_columns
from plumbline.operators.split import train_test
from plumbline.plans.stages import Settings, read_metrics, run_stage
from plumbline.shared import literal_rows, scratch_path
from plumbline.sources.files import read_csv, write_csv
from plumbline.workload.fixtures import insured, insured_shifted, requests, rounded, sql
from plumbline.workload.registry import query

# The same expression for Spark and DuckDB: cells with breaks, quotes, commas, blanks and backslashes.
ROUGH = """CASE id % 8 WHEN 0 THEN 'line1' || chr(10) || 'line2' WHEN 1 THEN 'say "hi", ok' WHEN 2 THEN '  lead'
  WHEN 3 THEN 'trail  ' WHEN 4 THEN 'back' || chr(92) || 'slash' WHEN 5 THEN '"' WHEN 6 THEN ',' || chr(13) || chr(10) ELSE region END"""


@query(sql(f"SELECT id, {ROUGH} AS note, CASE WHEN id % 10 = 0 THEN NULL ELSE smoker END AS smoker FROM insured"))
def csv_rough_cells(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(insured(spark, sf_dir).selectExpr("id", f"{ROUGH} AS note", "IF(id % 10 = 0, NULL, smoker) AS smoker"), path)
    return read_csv(spark, path, StructType.fromDDL("id BIGINT, note STRING, smoker STRING"))


@query(sql("""SELECT id, CASE WHEN id % 6 = 0 THEN NULL ELSE age END AS age, CASE WHEN id % 9 = 0 THEN NULL ELSE round(bmi, 6) END AS bmi,
  region AS extra FROM insured"""))
def csv_gapped_numbers(spark, sf_dir):
    """Whole numbers as a table with gaps gives them (``31.0``, ``3.1e1``), NaN cells, columns in another order."""
    path = scratch_path(spark, "csv")
    write_csv(insured(spark, sf_dir).selectExpr(
        "region AS extra", "IF(id % 9 = 0, 'NAN', CAST(bmi AS STRING)) AS bmi",
        "CASE WHEN id % 6 = 0 THEN '' WHEN id % 6 = 1 THEN CONCAT(CAST(age / 10D AS STRING), 'e1') "
        "ELSE CONCAT(CAST(age AS STRING), '.0') END AS age", "id"), path)
    return rounded(read_csv(spark, path, StructType.fromDDL("id BIGINT, age BIGINT, bmi DOUBLE")))


SPELLED = """CASE id % 7 WHEN 0 THEN age || '.0' WHEN 1 THEN age || '.5' WHEN 2 THEN '1e2' WHEN 3 THEN age || 'd' WHEN 4 THEN '0x20'
  WHEN 5 THEN ' ' || age || ' ' ELSE CAST(age AS {text}) END"""


@query(sql(f"""SELECT id, CASE WHEN s % 1 = 0 THEN s::BIGINT END AS age FROM (
  SELECT id, CASE WHEN id % 7 IN (3, 4) THEN NULL ELSE TRY_CAST(trim({SPELLED.format(text='VARCHAR')}) AS DOUBLE) END AS s FROM insured) q"""))
def coerced_spellings(spark, sf_dir):
    spelled = insured(spark, sf_dir).selectExpr("id", f"{SPELLED.format(text='STRING')} AS age")
    return c.coerce(spelled, c.INSURED)


@query(sql(f"""SELECT id AS key, 'age' AS column_name, {SPELLED.format(text='VARCHAR')} AS value FROM insured WHERE id % 7 IN (1, 3, 4)"""))
def coercion_losses(spark, sf_dir):
    spelled = insured(spark, sf_dir).selectExpr("id", f"{SPELLED.format(text='STRING')} AS age")
    return c.coercion_losses(spelled, c.INSURED, "id")


BMI = "CASE id % 5 WHEN 0 THEN bmi || 'd' WHEN 1 THEN bmi || 'f' WHEN 2 THEN '0x1p5' WHEN 3 THEN '+' || bmi ELSE bmi END"


@query(sql(f"""SELECT id, CASE WHEN age = '' OR bmi = '' THEN 'Please fill all fields!'
    WHEN TRY_CAST(trim(age) AS BIGINT) IS NULL THEN 'Invalid input data: age is not a whole number'
    WHEN id % 5 IN (0, 1, 2) OR bmi LIKE '%n/a%' THEN 'Invalid input data: bmi is not a number'
    WHEN b < 15 OR b > 50 THEN 'Invalid input data: bmi is out of range'
    WHEN smoker = 'maybe' THEN 'Invalid input data: smoker is not a known choice' END AS reason
  FROM (SELECT *, TRY_CAST(bmi AS DOUBLE) AS b FROM requests) q"""))
def spelled_requests(spark, sf_dir):
    spelled = requests(spark, sf_dir).withColumn("bmi", F.expr(BMI))
    return c.judge_requests(spelled, c.INSURED).select("id", "reason")


@query(sql(f"""SELECT 'column_count' AS check_name, 'expected 7' AS subject, 9 = 7 AS passed, count(*) AS n FROM insured
UNION ALL SELECT 'columns', 'bmi', false, count(*) FROM insured
UNION ALL SELECT 'columns', u.name, true, n FROM (SELECT count(*) AS n FROM insured) q,
  unnest(['age', 'children', 'charges', 'sex', 'smoker', 'region']) AS u(name)
UNION ALL SELECT 'types', 'age int string', false, count(*) FROM insured
UNION ALL SELECT 'types', 'children int double', false, count(*) FROM insured
UNION ALL SELECT 'unprocessed', 'extra', false, count(*) FROM insured"""))
def failing_checks(spark, sf_dir):
    """Column count, presence and type checks on a table that fails them, and the columns no encoder uses."""
    df = insured(spark, sf_dir)
    wide = df.selectExpr("*", "1 AS extra")
    counted = c.check_column_count(wide, c.INSURED).selectExpr(
        "check_name", "CONCAT('expected ', expected) AS subject", "passed")
    present = c.check_columns(wide.drop("bmi"), c.INSURED).selectExpr("'columns' AS check_name", "column_name AS subject", "present AS passed")
    wrong = df.selectExpr("CAST(age AS STRING) AS age", "bmi", "CAST(children AS DOUBLE) AS children")
    types = c.check_types(wrong, c.INSURED).selectExpr(
        "'types' AS check_name", "CONCAT_WS(' ', column_name, declared, actual) AS subject", "false AS passed")
    train, test = train_test(df, "id")
    _, _, encoder = build_matrices(train, test, "charges", "id")
    left = [name for name in unprocessed_columns(wide, encoder, "charges") if name not in ("id", "age", "bmi", "children", "smoker", "sex", "region")]
    rest = literal_rows(spark, "check_name string, subject string, passed boolean", [("unprocessed", name, False) for name in left])
    rows = counted.unionByName(present).unionByName(types).unionByName(rest)
    return rows.withColumn("n", F.lit(df.count()))


@query(sql("""SELECT m.metric, CASE m.metric WHEN 'train_rows' THEN (SELECT count(*) FROM train)
    WHEN 'test_rows' THEN (SELECT count(*) FROM test) ELSE 13 END::DOUBLE AS value
  FROM (SELECT unnest(['train_rows', 'test_rows', 'features_count']) AS metric) m
UNION ALL SELECT 'ingest_' || side || '_samples', n::DOUBLE FROM (SELECT 'train' AS side, count(*) AS n FROM train
  UNION ALL SELECT 'test', count(*) FROM test) s
UNION ALL SELECT 'validation_status', 1.0::DOUBLE FROM (SELECT count(*) FROM insured) q"""))
def resumed_run(spark, sf_dir):
    """Ingest, validate and transform other data, ingest the base table, resume: all results follow the new data."""
    base, given = scratch_path(spark, "runs"), [insured_shifted(spark, sf_dir).union(insured_shifted(spark, sf_dir).selectExpr(
        "-id AS id", "age", "sex", "bmi", "children", "smoker", "region", "charges"))]
    settings = Settings(base=base, run_id="resumed", registry=f"{base}/registry", source=lambda s: given[0])
    run_stage(spark, "transform", settings)
    given[0] = insured(spark, sf_dir)
    run_stage(spark, "ingest", settings)
    run_stage(spark, "transform", settings, force=False)
    rows = [(name, value) for name, value in read_metrics(spark, settings, "transform").items()]
    rows += [(f"ingest_{name}", value) for name, value in read_metrics(spark, settings, "ingest").items() if name.endswith("_samples")]
    rows.append(("validation_status", read_metrics(spark, settings, "validate")["validation_status"]))
    return literal_rows(spark, "metric string, value double", rows)
