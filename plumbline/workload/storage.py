"""Queries that write to the shared folder and read back.

JDBC has no entry here: it needs a database that other processes can reach.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.contract import INSURED, judge_requests
from plumbline.operators.encode import ColumnTransformer, ColumnTransformerModel, build_matrices
from plumbline.operators.profile import REPORT_SCHEMA, quality_report
from plumbline.operators.split import train_test
from plumbline.shared import literal_rows, scratch_path
from plumbline.sources import catalog
from plumbline.sources.files import (
    OBJECT_STORE_TOKENS, named_matrix, read_csv, read_document, read_matrix, read_report, read_snapshot, snapshot,
    write_csv, write_document, write_matrix, write_report,
)
from plumbline.streaming.scorer import request_stream, write_available
from plumbline.workload.conformance import REASONS_SQL, matrix_sql
from plumbline.workload.fixtures import NAMES, insured, insured_dirty, insured_shifted, requests, rounded, rounded_report, sql
from plumbline.workload.profiling import quality_report as quality_report_query
from plumbline.workload.registry import ORACLES, query


@query(sql("""SELECT id, age, sex, bmi, children, smoker, region, round(charges, 6) AS charges
FROM insured_dirty"""))
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(insured_dirty(spark, sf_dir), path)
    return rounded(read_csv(spark, path, INSURED.spark_schema("id")), 6, ["charges"])


@query(sql("""SELECT id, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN NULL ELSE age END AS age,
  CASE WHEN id % 5 = 0 THEN NULL ELSE region END AS region FROM insured"""))
def csv_null_texts(spark, sf_dir):
    """Several spellings of a missing cell in a folder of files, as an object store gives them."""
    path = scratch_path(spark, "csv")
    write_csv(insured(spark, sf_dir).select(
        "id",
        F.expr("CASE WHEN id % 7 = 0 THEN 'na' WHEN id % 11 = 0 THEN 'NaN' ELSE CAST(age AS STRING) END AS age"),
        F.expr("IF(id % 5 = 0, 'N/A', region) AS region")), path)
    schema = StructType.fromDDL("id BIGINT, age BIGINT, region STRING")
    return read_csv(spark, path + "/*.csv", schema, OBJECT_STORE_TOKENS)


@query(sql("SELECT id, smoker, region, 'run-1' AS run_id FROM insured"))
def feature_snapshot(spark, sf_dir):
    base = scratch_path(spark, "store")
    snapshot(insured(spark, sf_dir), base, "run-1")
    snapshot(insured_dirty(spark, sf_dir), base, "run-2")
    return read_snapshot(spark, base, "run-1").select("id", "smoker", "region", "run_id")


@query(sql(matrix_sql("train")))
def matrix_round_trip(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    matrix, _, encoder = build_matrices(train, test, "charges", "id")
    path = scratch_path(spark, "matrix")
    write_matrix(matrix, path)
    return rounded(named_matrix(read_matrix(spark, path), encoder.feature_names()))


@query(sql("""SELECT id, round((age - (SELECT avg(age) FROM insured)) / (SELECT stddev_pop(age) FROM insured), 6)
  + 0.0::DOUBLE AS age, (smoker = 'yes')::INT::DOUBLE AS smoker_yes FROM insured"""))
def preprocessor_reload(spark, sf_dir):
    df = insured(spark, sf_dir)
    path = scratch_path(spark, "encoder")
    ColumnTransformer(numeric=["age"], categorical=["smoker"]).fit(df).write().overwrite().save(path)
    fitted = ColumnTransformerModel.load(path)
    return rounded(named_matrix(fitted.transform(df).select("id", "features"), fitted.feature_names()))


@query(ORACLES[quality_report_query.__name__].replace("SELECT 'dirty' AS dataset, * FROM", "SELECT * FROM"))
def report_round_trip(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_report(quality_report(insured_dirty(spark, sf_dir).select(*NAMES), "dirty").drop("dataset"), path)
    return rounded_report(read_report(spark, path, StructType.fromDDL(REPORT_SCHEMA)))


@query(ORACLES[quality_report_query.__name__].replace("SELECT 'dirty' AS dataset, * FROM", "SELECT * FROM"))
def nested_report(spark, sf_dir):
    """The report as one document of nested maps, read back and flattened."""
    path = scratch_path(spark, "document")
    write_document(quality_report(insured_dirty(spark, sf_dir).select(*NAMES), "dirty").drop("dataset"), path)
    return rounded_report(read_document(spark, path))


MOVED = ["-id AS id", "age", "smoker", "round(charges, 6) AS charges"]


@query(sql("""SELECT id, age, smoker, round(charges, 6) AS charges FROM insured
UNION ALL SELECT -id, age, smoker, round(charges, 6) FROM insured_shifted"""))
def catalog_round_trip(spark, sf_dir):
    """A catalog table made, replaced and appended to; the fourth writer finds it there and fails."""
    name, path = f"plumbline_{uuid.uuid4().hex}", scratch_path(spark, "table")
    rows = insured(spark, sf_dir).selectExpr("id", "age", "smoker", "round(charges, 6) AS charges")
    catalog.write_table(insured_dirty(spark, sf_dir).selectExpr("id", "age", "smoker", "charges"), name, mode="fail", path=path)
    catalog.write_table(rows, name, mode="replace", path=path)
    catalog.write_table(insured_shifted(spark, sf_dir).selectExpr(*MOVED[::-1]), name, mode="append")
    try:
        catalog.write_table(rows, name, mode="fail")
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError("mode 'fail' wrote to a table that exists")
    return rounded(catalog.read_table(spark, name), 6)


@query(sql("""SELECT 'base' AS table_name, false AS temporary, 4::BIGINT AS n_columns, count(*) AS n FROM insured
UNION ALL SELECT 'moved', true, 4, count(*) FROM insured_shifted"""))
def catalog_listing(spark, sf_dir):
    """Tables and views that the catalog lists, with their columns and rows."""
    mark = f"plumbline_{uuid.uuid4().hex}_"
    catalog.write_table(insured(spark, sf_dir).selectExpr("id", "age", "smoker", "charges"), mark + "base", path=scratch_path(spark, "table"))
    insured_shifted(spark, sf_dir).selectExpr(*MOVED).createTempView(mark + "moved")
    listed = catalog.list_tables(spark).where(F.col("table_name").startswith(mark))
    names = [r.table_name for r in listed.collect()]
    columns = literal_rows(spark, "table_name string, n_columns bigint",
                           [(name, catalog.describe_columns(spark, name).count()) for name in names])
    found = listed.join(columns, "table_name").join(catalog.row_counts(spark, names), "table_name")
    return found.withColumn("table_name", F.replace("table_name", F.lit(mark), F.lit("")))


@query(REASONS_SQL)
def stream_requests(spark, sf_dir):
    """Requests judged by a stream that reads what has arrived; how often each reason came up."""
    arrived, done = scratch_path(spark, "requests"), scratch_path(spark, "judged")
    requests(spark, sf_dir).write.parquet(arrived)
    judged = judge_requests(request_stream(spark, arrived)).select("id", "reason")
    write_available(judged, done, scratch_path(spark, "offsets")).awaitTermination()
    return (spark.read.schema("id BIGINT, reason STRING").parquet(done)
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))
