"""Derived test tables as DataFrames, and the same tables as SQL for the checking engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.contract import INSURED

NAMES = INSURED.names


# The columns of the tables in use. Declared, so that no read has to open
# a file just to learn its schema.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def insured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean base table: one row per order, charges follow from the features and noise."""
    joined = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    return joined.selectExpr(
        "o_orderkey AS id",
        "CAST(18 + (o_custkey * 7) % 47 AS BIGINT) AS age",
        "IF(o_orderkey % 2 = 0, 'female', 'male') AS sex",
        "15D + CAST((o_orderkey * 37) % 380 AS DOUBLE) / 10D AS bmi",
        "CAST(o_custkey % 6 AS BIGINT) AS children",
        "IF(o_orderpriority = '1-URGENT', 'yes', 'no') AS smoker",
        "CASE c_nationkey % 4 WHEN 0 THEN 'northeast' WHEN 1 THEN 'northwest' "
        "WHEN 2 THEN 'southeast' ELSE 'southwest' END AS region",
        "o_totalprice / 50D AS noise",
    ).selectExpr(
        "id", "age", "sex", "bmi", "children", "smoker", "region",
        "240D * age + 300D * bmi + 450D * children + IF(smoker = 'yes', 700D * bmi, 0D) + noise AS charges")


def insured_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, bad ranges, an unknown region and exact copies of some rows."""
    # Emitting a copied row twice in place keeps this to one scan.
    return insured(spark, sf_dir).selectExpr(
        "id", "IF(id % 97 = 0, 150L, age) AS age", "sex", "IF(id % 50 = 0, NULL, bmi) AS bmi",
        "IF(id % 61 = 0, NULL, children) AS children", "smoker",
        "IF(id % 101 = 0, 'unknown', region) AS region", "charges",
        "explode(sequence(1, IF(id % 211 = 0, 2, 1))) AS copy").drop("copy")


def insured_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current side of a drift check: more smokers and higher charges."""
    return insured(spark, sf_dir).selectExpr(
        "id", "age", "sex", "bmi", "children", "IF(id % 3 = 0, 'yes', smoker) AS smoker", "region",
        "charges * 1.5D AS charges")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form requests as text, some of them empty or unreadable."""
    return insured(spark, sf_dir).selectExpr(
        "id",
        "CASE WHEN id % 13 = 0 THEN '' WHEN id % 17 = 0 THEN 'abc' ELSE CAST(age AS STRING) END AS age",
        "sex", "IF(id % 19 = 0, 'n/a', CAST(bmi AS STRING)) AS bmi", "CAST(children AS STRING) AS children",
        "IF(id % 23 = 0, 'maybe', smoker) AS smoker", "region")


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Round doubles, whose last digits depend on the order of a sum. Adding zero turns -0.0 into 0.0."""
    kinds = dict(df.dtypes)
    return df.select([
        (F.round(F.col(c), digits) + F.lit(0.0)).alias(c)
        if kinds[c] == "double" and (only is None or c in only) else F.col(c) for c in df.columns])


def rounded_report(df: DataFrame) -> DataFrame:
    """Round a ``value`` by its ``metric``: means of short decimals often end exactly half-way
    between two roundings to six digits, where engines part."""
    few = F.col("metric").isin("mean", "std")
    value = F.when(few, F.round("value", 3)).otherwise(F.round("value", 6)) + F.lit(0.0)
    return df.withColumn("value", value)


CTES = """
insured AS (
  SELECT id, age, sex, bmi, children, smoker, region,
    CAST(240.0 AS DOUBLE) * age + CAST(300.0 AS DOUBLE) * bmi + CAST(450.0 AS DOUBLE) * children
    + CASE WHEN smoker = 'yes' THEN CAST(700.0 AS DOUBLE) * bmi ELSE CAST(0.0 AS DOUBLE) END
    + noise AS charges
  FROM (
    SELECT o_orderkey AS id,
      CAST(18 + (o_custkey * 7) % 47 AS BIGINT) AS age,
      CASE WHEN o_orderkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
      CAST(15 AS DOUBLE) + CAST((o_orderkey * 37) % 380 AS DOUBLE) / CAST(10 AS DOUBLE) AS bmi,
      CAST(o_custkey % 6 AS BIGINT) AS children,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' ELSE 'no' END AS smoker,
      CASE c_nationkey % 4 WHEN 0 THEN 'northeast' WHEN 1 THEN 'northwest'
        WHEN 2 THEN 'southeast' ELSE 'southwest' END AS region,
      o_totalprice / CAST(50 AS DOUBLE) AS noise
    FROM orders JOIN customer ON o_custkey = c_custkey) t),
dirty_once AS (
  SELECT id,
    CASE WHEN id % 97 = 0 THEN CAST(150 AS BIGINT) ELSE age END AS age,
    sex,
    CASE WHEN id % 50 = 0 THEN CAST(NULL AS DOUBLE) ELSE bmi END AS bmi,
    CASE WHEN id % 61 = 0 THEN CAST(NULL AS BIGINT) ELSE children END AS children,
    smoker,
    CASE WHEN id % 101 = 0 THEN 'unknown' ELSE region END AS region,
    charges
  FROM insured),
insured_dirty AS (SELECT * FROM dirty_once UNION ALL SELECT * FROM dirty_once WHERE id % 211 = 0),
insured_shifted AS (
  SELECT id, age, sex, bmi, children,
    CASE WHEN id % 3 = 0 THEN 'yes' ELSE smoker END AS smoker,
    region, charges * CAST(1.5 AS DOUBLE) AS charges
  FROM insured),
requests AS (
  SELECT id,
    CASE WHEN id % 13 = 0 THEN '' WHEN id % 17 = 0 THEN 'abc' ELSE CAST(age AS VARCHAR) END AS age,
    sex,
    CASE WHEN id % 19 = 0 THEN 'n/a' ELSE CAST(bmi AS VARCHAR) END AS bmi,
    CAST(children AS VARCHAR) AS children,
    CASE WHEN id % 23 = 0 THEN 'maybe' ELSE smoker END AS smoker,
    region
  FROM insured),
hashed AS (
  SELECT *, CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 13) AS BIGINT) AS h FROM insured),
sided AS (
  SELECT *, row_number() OVER (ORDER BY h, id) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM hashed),
train AS (SELECT id, age, sex, bmi, children, smoker, region, charges FROM sided WHERE NOT is_test),
test AS (SELECT id, age, sex, bmi, children, smoker, region, charges FROM sided WHERE is_test),
featured AS (
  SELECT *, (age / 10.0::DOUBLE) * (bmi / 25.0::DOUBLE) * w AS risk_score,
    CASE WHEN children > 0 THEN 1 ELSE 0 END AS children_flag,
    bmi * w AS smoker_bmi_interaction,
    CASE WHEN age > 0 AND age <= 30 THEN 1 WHEN age > 30 AND age <= 40 THEN 2
      WHEN age > 40 AND age <= 50 THEN 3 WHEN age > 50 AND age <= 60 THEN 4
      WHEN age > 60 AND age <= 100 THEN 5 END AS age_category,
    CASE WHEN bmi > 0 AND bmi <= 18.5 THEN 1 WHEN bmi > 18.5 AND bmi <= 25 THEN 2
      WHEN bmi > 25 AND bmi <= 30 THEN 3 WHEN bmi > 30 AND bmi <= 35 THEN 4
      WHEN bmi > 35 AND bmi <= 40 THEN 5 WHEN bmi > 40 AND bmi <= 100 THEN 6 END AS bmi_category
  FROM (SELECT *, CASE smoker WHEN 'yes' THEN 3 WHEN 'no' THEN 1 END AS w FROM insured_dirty) s)
"""


def sql(body: str) -> str:
    """A check query over the derived tables."""
    return f"WITH {CTES.strip()}\n{body.strip()}"
