"""Queries of the contract checks, requests, features, encoding and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scalars
from plumbline.functions.derived import add_features, log_target, unlog
from plumbline.operators import contract as c
from plumbline.operators.drift import basic_drift
from plumbline.operators.encode import ColumnTransformer, build_matrices, fit_scaler
from plumbline.operators.split import add_contiguous_fold, add_fold, train_test
from plumbline.sources.files import named_matrix
from plumbline.workload.fixtures import NAMES, insured, insured_dirty, insured_shifted, requests, rounded, sql, table
from plumbline.workload.profiling import missing_report_sql, shape_report_sql
from plumbline.workload.registry import query

FORM = ["age", "sex", "bmi", "children", "smoker", "region"]


@query("SELECT l_shipdate, l_orderkey, l_quantity FROM lineitem")
def projection(spark, sf_dir):
    return c.project(table(spark, sf_dir, "lineitem"), ["l_shipdate", "l_orderkey", "l_quantity"])


@query("SELECT event_id, ts, user_id, event_type FROM events")
def dropped_columns(spark, sf_dir):
    return c.drop_columns(table(spark, sf_dir, "events"), ["value", "props"])


@query(sql("SELECT id, round(charges, 6) AS charges FROM insured"))
def target_column(spark, sf_dir):
    df = insured(spark, sf_dir)
    _, target = c.split_target(df, "charges")
    return rounded(df.select("id", *[df[name] for name in target.columns]))


@query(sql("SELECT id, age FROM insured_dirty WHERE age < 18 OR age > 100"))
def out_of_range(spark, sf_dir):
    return c.out_of_range(insured_dirty(spark, sf_dir), "age", 18, 100).select("id", "age")


@query(sql("""SELECT id, TRY_CAST(age AS BIGINT) AS age, sex, TRY_CAST(bmi AS DOUBLE) AS bmi,
  TRY_CAST(children AS BIGINT) AS children, smoker, region FROM requests"""))
def coerced(spark, sf_dir):
    return c.coerce(requests(spark, sf_dir), c.INSURED)


PARSED = """(SELECT *, TRY_CAST(trim(age) AS BIGINT) AS a, TRY_CAST(trim(bmi) AS DOUBLE) AS b,
  TRY_CAST(trim(children) AS BIGINT) AS k FROM requests) p"""
REASON = """CASE WHEN age = '' OR sex = '' OR bmi = '' OR children = '' OR smoker = '' OR region = ''
    THEN 'Please fill all fields!'
  WHEN a IS NULL THEN 'Invalid input data: age is not a whole number'
  WHEN b IS NULL THEN 'Invalid input data: bmi is not a number'
  WHEN k IS NULL THEN 'Invalid input data: children is not a whole number'
  WHEN a < 18 OR a > 100 THEN 'Invalid input data: age is out of range'
  WHEN b < 15 OR b > 50 THEN 'Invalid input data: bmi is out of range'
  WHEN k < 0 OR k > 10 THEN 'Invalid input data: children is out of range'
  WHEN sex NOT IN ('male', 'female') THEN 'Invalid input data: sex is not a known choice'
  WHEN smoker NOT IN ('yes', 'no') THEN 'Invalid input data: smoker is not a known choice'
  WHEN region NOT IN ('southwest', 'southeast', 'northwest', 'northeast')
    THEN 'Invalid input data: region is not a known choice' END"""
ACCEPTED_SQL = sql(f"""SELECT id, a AS age, sex, b AS bmi, k AS children, smoker, region
FROM {PARSED} WHERE ({REASON}) IS NULL""")
REASONS_SQL = sql(f"SELECT {REASON} AS reason, count(*) AS n FROM {PARSED} GROUP BY 1")


@query(ACCEPTED_SQL)
def accepted_requests(spark, sf_dir):
    return c.parse_requests(requests(spark, sf_dir))[0]


@query(sql(f"SELECT id, age, sex, bmi, children, smoker, region, {REASON} AS reason FROM {PARSED} "
           f"WHERE ({REASON}) IS NOT NULL"))
def rejected_requests(spark, sf_dir):
    return c.parse_requests(requests(spark, sf_dir))[1]


FLAGS = ["train_columns_valid", "test_columns_valid", "train_columns_exist", "test_columns_exist"]


@query(sql("\nUNION ALL\n".join([
    *[f"SELECT 'checks' AS section, NULL::VARCHAR AS column_name, '{flag}' AS metric, 1.0::DOUBLE AS value, "
      "NULL::VARCHAR AS text FROM (SELECT count(*) FROM insured) q" for flag in FLAGS],
    """SELECT 'checks', NULL, 'validation_status', 1.0, CASE WHEN drifted
       THEN 'Data drift detected between train and test sets' ELSE 'No data drift detected' END
       FROM (SELECT (SELECT abs(avg(charges) - (SELECT avg(charges) FROM insured_shifted)) / avg(charges)
       FROM insured) > 0.2 AS drifted) d""",
    """SELECT 'checks', NULL, 'drift_detected', (drifted)::INT::DOUBLE, NULL
       FROM (SELECT (SELECT abs(avg(charges) - (SELECT avg(charges) FROM insured_shifted)) / avg(charges)
       FROM insured) > 0.2 AS drifted) d""",
    *[shape_report_sql(source, section).replace("7.0::DOUBLE, NULL", f"7.0::DOUBLE, '{','.join(NAMES)}'")
      for source, section in (("insured", "train_shape"), ("insured_shifted", "test_shape"))],
    missing_report_sql("insured", "train_missing"), missing_report_sql("insured_shifted", "test_missing")])))
def validation_summary(spark, sf_dir):
    def drifted(ref, cur):
        return basic_drift(ref, cur, c.INSURED).first()["dataset_drift"]

    train, test = insured(spark, sf_dir).select(*NAMES), insured_shifted(spark, sf_dir).select(*NAMES)
    return c.validation_rows(c.validate(train, test, c.INSURED, drifted), train, test)


FEATURES = """round(risk_score, 6) AS risk_score, children_flag,
  round(smoker_bmi_interaction, 6) AS smoker_bmi_interaction"""


@query(sql(f"SELECT id, {FEATURES}, age_category, bmi_category FROM featured"))
def features(spark, sf_dir):
    return rounded(add_features(insured_dirty(spark, sf_dir)).select(
        "id", "risk_score", "children_flag", "smoker_bmi_interaction", "age_category", "bmi_category"))


@query(sql(f"""SELECT id, {FEATURES},
  CASE WHEN age IS NULL THEN NULL WHEN age <= 30 THEN 1 WHEN age <= 40 THEN 2 WHEN age <= 50 THEN 3
    WHEN age <= 60 THEN 4 ELSE 5 END AS age_category,
  CASE WHEN bmi IS NULL THEN NULL WHEN bmi <= 18.5 THEN 1 WHEN bmi <= 25 THEN 2 WHEN bmi <= 30 THEN 3
    WHEN bmi <= 35 THEN 4 WHEN bmi <= 40 THEN 5 ELSE 6 END AS bmi_category FROM featured"""))
def serving_features(spark, sf_dir):
    return rounded(add_features(insured_dirty(spark, sf_dir), "open", strict=True).select(
        "id", "risk_score", "children_flag", "smoker_bmi_interaction", "age_category", "bmi_category"))


@query(sql("""SELECT id, '$' || format('{:,.2f}', round(charges, 4)) AS money, region AS plain,
  round(ln(1 + charges), 6) AS log_charges, round(charges, 4) AS back,
  CASE WHEN children > 0 THEN 1 ELSE 0 END AS flag,
  round(CASE WHEN children = 0 THEN NULL ELSE age / children::DOUBLE END, 6) AS per_child,
  round(CASE WHEN children = 0 THEN NULL ELSE age / children::DOUBLE * 100 END, 6) AS per_child_pct
FROM insured"""))
def scalar_functions(spark, sf_dir):
    df = insured(spark, sf_dir)
    logged = log_target(df, "charges").withColumn("log_charges", F.col("charges"))
    back = unlog(logged, "charges").withColumn("back", F.round("charges", 4)).drop("charges")
    joined = back.withColumn("charges", F.col("back"))
    return rounded(joined.select(
        "id", scalars.currency(F.col("charges")).alias("money"),
        scalars.unquote(F.concat(F.lit(' "'), F.col("region"), F.lit('" '))).alias("plain"),
        F.round("log_charges", 6).alias("log_charges"), "back",
        scalars.positive_flag(F.col("children")).alias("flag"),
        scalars.ratio(F.col("age"), F.col("children")).alias("per_child"),
        scalars.percent(F.col("age"), F.col("children")).alias("per_child_pct")))


NUMBERS = ["age", "bmi", "children", "charges"]


@query(sql("SELECT id, " + ", ".join(
    f"round(({n} - (SELECT avg({n}) FROM insured)) / (SELECT stddev_pop({n}) FROM insured), 6) + 0.0::DOUBLE AS {n}"
    for n in NUMBERS) + " FROM insured"))
def standard_scaled(spark, sf_dir):
    df = insured(spark, sf_dir)
    fitted = zip(NUMBERS, *fit_scaler(df, NUMBERS))
    return rounded(df.select("id", *[((F.col(n) - F.lit(m)) / F.lit(s)).alias(n) for n, m, s in fitted]))


# 'unknown' regions exist only in the dirty table: unseen at fit time, so all zero.
@query(sql("""SELECT id, (sex = 'male')::INT::DOUBLE AS sex_male, (smoker = 'yes')::INT::DOUBLE AS smoker_yes,
  (region = 'northwest')::INT::DOUBLE AS region_northwest, (region = 'southeast')::INT::DOUBLE AS region_southeast,
  (region = 'southwest')::INT::DOUBLE AS region_southwest FROM insured_dirty"""))
def one_hot(spark, sf_dir):
    fitted = ColumnTransformer(numeric=[], categorical=["sex", "smoker", "region"]).fit(insured(spark, sf_dir))
    return insured_dirty(spark, sf_dir).select("id", *fitted.feature_columns())


SCALED = ["age", "bmi", "children", "risk_score", "children_flag", "smoker_bmi_interaction",
          "age_category", "bmi_category"]


def matrix_sql(side: str) -> str:
    numbers = ", ".join(
        f"round(({n} - (SELECT avg({n}) FROM f_train)) / (SELECT stddev_pop({n}) FROM f_train), 6) "
        f"+ 0.0::DOUBLE AS {n}" for n in SCALED)
    built = """SELECT *, (age / 10.0::DOUBLE) * (bmi / 25.0::DOUBLE) * w AS risk_score,
      CASE WHEN children > 0 THEN 1 ELSE 0 END AS children_flag, bmi * w AS smoker_bmi_interaction,
      CASE WHEN age <= 30 THEN 1 WHEN age <= 40 THEN 2 WHEN age <= 50 THEN 3 WHEN age <= 60 THEN 4 ELSE 5 END
        AS age_category,
      CASE WHEN bmi <= 18.5 THEN 1 WHEN bmi <= 25 THEN 2 WHEN bmi <= 30 THEN 3 WHEN bmi <= 35 THEN 4
        WHEN bmi <= 40 THEN 5 ELSE 6 END AS bmi_category
      FROM (SELECT *, CASE smoker WHEN 'yes' THEN 3 ELSE 1 END AS w FROM {s}) q"""
    return (f"SELECT * FROM (WITH f_train AS ({built.format(s='train')}), f_side AS ({built.format(s=side)}) "
            f"SELECT id, round(charges, 6) AS label, {numbers}, "
            "(sex = 'male')::INT::DOUBLE AS sex_male, (smoker = 'yes')::INT::DOUBLE AS smoker_yes, "
            "(region = 'northwest')::INT::DOUBLE AS region_northwest, "
            "(region = 'southeast')::INT::DOUBLE AS region_southeast, "
            "(region = 'southwest')::INT::DOUBLE AS region_southwest FROM f_side) m")


@query(sql(matrix_sql("test")))
def test_matrix(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    valid = c.validate(train, test, c.INSURED, key="id")
    _, matrix, encoder = build_matrices(train, test, "charges", "id", valid)
    return rounded(named_matrix(matrix, encoder.feature_names()))


@query(sql("SELECT id, is_test FROM sided"))
def split_exact(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir).select("id"), "id", exact=True)
    return train.withColumn("is_test", F.lit(False)).unionAll(test.withColumn("is_test", F.lit(True)))


@query(sql("SELECT id, h < CAST(floor(0.2 * 4503599627370496) AS BIGINT) AS is_test FROM hashed"))
def split_by_threshold(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir).select("id"), "id")
    return train.withColumn("is_test", F.lit(False)).unionAll(test.withColumn("is_test", F.lit(True)))


@query(sql("""SELECT id, CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|fold'), 1, 13) AS BIGINT) % 5
  AS INTEGER) AS fold FROM insured"""))
def folds(spark, sf_dir):
    return add_fold(insured(spark, sf_dir).select("id"), "id")


@query(sql("SELECT id, (ntile(7) OVER (ORDER BY id) - 1)::INT AS fold FROM insured"))
def contiguous_folds(spark, sf_dir):
    """Blocks of neighbouring keys; sizes differ by a row at most."""
    return add_contiguous_fold(insured(spark, sf_dir).select("id"), "id", 7)
