"""Queries of the profiling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import profile
from plumbline.operators.contract import ALLOWED_VALUES, INSURED, VALUE_RANGES, columns_by_type
from plumbline.operators.quantiles import percentiles
from plumbline.operators.split import in_test_sample, read_side, train_test, write_sides
from plumbline.plans.reports import analysis_report, sample_metrics
from plumbline.shared import scratch_path
from plumbline.workload.fixtures import NAMES, insured, insured_dirty, rounded, rounded_report, sql, table
from plumbline.workload.registry import query

NUMERIC = list(INSURED.numeric)
CATEGORICAL = list(INSURED.categorical)
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union_sql(template: str, names: list[str]) -> str:
    """The same statement for several columns, stacked."""
    return "\nUNION ALL\n".join(template.replace("{c}", name) for name in names)


@query("SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def table_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "lineitem"))


MISSING = """SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count,
  round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM insured_dirty"""


@query(sql(union_sql(MISSING, NAMES)))
def missing_values(spark, sf_dir):
    return rounded(profile.missing(insured_dirty(spark, sf_dir).select(*NAMES)))


@query(sql(f"SELECT * FROM ({union_sql(MISSING, NAMES)}) m WHERE missing_pct > 1.8"))
def high_missing_columns(spark, sf_dir):
    return rounded(profile.high_missing(insured_dirty(spark, sf_dir).select(*NAMES), pct=1.8))


DUPLICATES = """SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
  round(sum(n - 1) * 100.0::DOUBLE / sum(n), 6) AS duplicate_pct
FROM (SELECT count(*) AS n FROM {t} GROUP BY {cols}) g"""


def duplicates_sql(source: str, cols: list[str]) -> str:
    return DUPLICATES.replace("{t}", source).replace("{cols}", ", ".join(cols))


@query(sql(duplicates_sql("insured_dirty", ["id", *NAMES])))
def duplicate_rows(spark, sf_dir):
    return rounded(profile.duplicates(insured_dirty(spark, sf_dir)))


@query(sql(duplicates_sql("insured_dirty", ["id", *NAMES])))
def duplicate_rows_by_hash(spark, sf_dir):
    return rounded(profile.duplicates(insured_dirty(spark, sf_dir), method="hash"))


@query(duplicates_sql("labels", ["quality", "toxic"]))
def duplicate_labels(spark, sf_dir):
    return rounded(profile.duplicates(table(spark, sf_dir, "labels").select("quality", "toxic")))


DESCRIBE = """SELECT '{c}' AS column_name, unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS metric,
  unnest([count({c})::DOUBLE, round(avg({c}), 3), round(stddev_samp({c}), 3), round(min({c}), 6)::DOUBLE,
    round(quantile_cont({c}, 0.25), 6)::DOUBLE, round(quantile_cont({c}, 0.5), 6)::DOUBLE,
    round(quantile_cont({c}, 0.75), 6)::DOUBLE, round(max({c}), 6)::DOUBLE]) AS value FROM {t}"""


@query(union_sql(DESCRIBE.replace("{t}", "lineitem"), LINE_NUMBERS))
def describe_lineitem(spark, sf_dir):
    return rounded_report(profile.describe(table(spark, sf_dir, "lineitem"), LINE_NUMBERS))


@query(sql(union_sql(DESCRIBE.replace("{t}", "insured_dirty"), NUMERIC)))
def describe_insured(spark, sf_dir):
    return rounded_report(profile.describe(insured_dirty(spark, sf_dir).select(*NUMERIC)))


@query(union_sql(DESCRIBE.replace("{t}", "labels"), ["doc_id", "quality", "toxic"]))
def describe_numeric_columns(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return rounded_report(profile.describe(labels, columns_by_type(labels, "numeric")))


PERCENTILES = """SELECT '{c}' AS column_name, unnest([0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0])::DOUBLE AS p,
  round(unnest(quantile_cont({c}, [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0])), 6)::DOUBLE AS value FROM lineitem"""


@query(union_sql(PERCENTILES, LINE_NUMBERS))
def percentile_table(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return rounded(percentiles(lineitem, LINE_NUMBERS, [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]), 6, ["value"])


COUNTS = """SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM {t}
WHERE {c} IS NOT NULL GROUP BY {c}"""
SHARES = """SELECT '{c}' AS column_name, {c} AS value, count(*) AS n,
  round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"""


@query(union_sql(COUNTS.replace("{t}", "lineitem"), ["l_returnflag", "l_linestatus"]))
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(sql(union_sql(SHARES.replace("{t}", "insured_dirty"), CATEGORICAL)))
def value_shares(spark, sf_dir):
    return rounded(profile.value_counts(insured_dirty(spark, sf_dir), CATEGORICAL, normalise=True))


@query(sql(union_sql("SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM insured_dirty",
                     ["region", "children"])))
def distinct_values(spark, sf_dir):
    return profile.distinct_values(insured_dirty(spark, sf_dir), ["region", "children"])


@query(sql(union_sql("""SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM insured_dirty
WHERE {c} IS NULL OR {c} NOT IN ('male', 'female', 'yes', 'no', 'southwest', 'southeast', 'northwest', 'northeast')""",
                     CATEGORICAL)))
def unexpected_values(spark, sf_dir):
    return profile.unexpected_values(insured_dirty(spark, sf_dir), ALLOWED_VALUES)


@query(sql("""SELECT 'age' AS column_name, count(*) FILTER (age < 18 OR age > 100) AS invalid_count,
  18.0::DOUBLE AS min_allowed, 100.0::DOUBLE AS max_allowed FROM insured_dirty
UNION ALL SELECT 'bmi', count(*) FILTER (bmi < 10 OR bmi > 60), 10.0::DOUBLE, 60.0::DOUBLE FROM insured_dirty"""))
def range_violations(spark, sf_dir):
    return profile.range_violations(insured_dirty(spark, sf_dir), VALUE_RANGES)


TYPES = {"age": "bigint", "sex": "string", "bmi": "double", "children": "bigint", "smoker": "string",
         "region": "string", "charges": "double"}


@query(sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) - count({c}) AS missing_count FROM insured_dirty"
    for c, kind in TYPES.items())))
def column_profile(spark, sf_dir):
    df = insured_dirty(spark, sf_dir).select(*NAMES)
    # One row per column on both sides.
    return (profile.missing(df).join(F.broadcast(profile.type_profile(df)), "column_name")
            .select("column_name", "data_type", "missing_count"))


@query(sql("\nUNION ALL\n".join(
    f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr({x}, {y}), 6) + 0.0::DOUBLE AS corr FROM insured_dirty"
    for x in NUMERIC for y in NUMERIC)))
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation(insured_dirty(spark, sf_dir), NUMERIC))


@query("\nUNION ALL\n".join(
    f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr({x}, {y}), 6) + 0.0::DOUBLE AS corr FROM lineitem"
    for x in LINE_NUMBERS for y in LINE_NUMBERS))
def correlation_lineitem(spark, sf_dir):
    return rounded(profile.correlation(table(spark, sf_dir, "lineitem"), LINE_NUMBERS))


#: Sixteen columns of line items, each with its own gaps: more pairs than one aggregate takes.
GAPPED = {
    f"c{i}": f"CASE WHEN (l_orderkey + {7 * i}) % {3 + i} = 0 THEN NULL "
             f"ELSE {LINE_NUMBERS[i % 4]} * {1 + i % 3} + l_linenumber * {i} + l_quantity * {i % 5} END" for i in range(16)}


@query("SELECT x AS column_x, y AS column_y, round(c, 6) + 0.0::DOUBLE AS corr FROM (SELECT "
       + ", ".join(f"corr({x}, {y}) AS {x}_{y}" for x in GAPPED for y in GAPPED)
       + " FROM (SELECT " + ", ".join(f"{cell} AS {name}" for name, cell in GAPPED.items()) + " FROM lineitem) g) w, "
       + "LATERAL (VALUES " + ", ".join(f"('{x}', '{y}', {x}_{y})" for x in GAPPED for y in GAPPED) + ") AS v(x, y, c)")
def correlation_with_gaps(spark, sf_dir):
    """A wide table with missing cells: masked sums in one scan behind the look for gaps."""
    wide = table(spark, sf_dir, "lineitem").select(*[F.expr(cell).alias(name) for name, cell in GAPPED.items()])
    return rounded(profile.correlation(wide))


@query(sql(union_sql("SELECT '{c}' AS column_name, round(corr({c}, charges), 6) + 0.0::DOUBLE AS corr FROM insured",
                     NUMERIC)))
def correlation_with_target(spark, sf_dir):
    return rounded(profile.correlation_with(insured(spark, sf_dir), NUMERIC, "charges"))


QUALITY = sql("""
SELECT * FROM (WITH counted AS (SELECT age, sex, bmi, children, smoker, region, charges, count(*) AS n FROM insured_dirty
  GROUP BY age, sex, bmi, children, smoker, region, charges),
s AS (SELECT sum(n) AS n, sum(n - 1) AS dup,
  sum(n * ((bmi IS NULL)::INT + (children IS NULL)::INT)) AS cells FROM counted)
SELECT CAST(n AS BIGINT) AS n_rows, CAST(cells AS BIGINT) AS missing_cells, CAST(dup AS BIGINT) AS duplicate_count,
  round(greatest(0, 100 - least(cells * 100.0::DOUBLE / n, 30) - least(dup * 100.0::DOUBLE / n, 20)), 6)::DOUBLE
    AS quality_score FROM s) q""")


@query(QUALITY)
def quality_score(spark, sf_dir):
    return rounded(profile.quality_score(insured_dirty(spark, sf_dir).select(*NAMES)))



def describe_report_sql(source: str, section: str, cols: list[str] = NUMERIC) -> str:
    inner = union_sql(DESCRIBE.replace("{t}", source), cols)
    return f"SELECT '{section}' AS section, column_name, metric, value, NULL::VARCHAR AS text FROM ({inner}) d"


def missing_report_sql(source: str, section: str) -> str:
    return union_sql(
        f"SELECT '{section}' AS section, '{{c}}' AS column_name, 'missing_count' AS metric, "
        f"count(*) FILTER ({{c}} IS NULL)::DOUBLE AS value, NULL::VARCHAR AS text FROM {source}", NAMES)


def duplicates_report_sql(source: str, section: str) -> str:
    return (f"SELECT '{section}' AS section, NULL::VARCHAR AS column_name, 'duplicate_rows' AS metric, "
            f"sum(n - 1)::DOUBLE AS value, NULL::VARCHAR AS text FROM "
            f"(SELECT count(*) AS n FROM {source} GROUP BY {', '.join(NAMES)}) g")


def shape_report_sql(source: str, section: str) -> str:
    return (f"SELECT '{section}' AS section, NULL::VARCHAR AS column_name, 'rows' AS metric, "
            f"count(*)::DOUBLE AS value, NULL::VARCHAR AS text FROM {source} UNION ALL "
            f"SELECT '{section}', NULL, 'columns', 7.0::DOUBLE, NULL FROM (SELECT count(*) FROM {source}) c")


@query(sql("SELECT 'dirty' AS dataset, * FROM (" + "\nUNION ALL\n".join([
    shape_report_sql("insured_dirty", "shape"),
    duplicates_report_sql("insured_dirty", "duplicates"),
    missing_report_sql("insured_dirty", "missing"),
    describe_report_sql("insured_dirty", "stats"),
    *[f"SELECT 'types' AS section, '{c}' AS column_name, 'data_type' AS metric, NULL::DOUBLE AS value, "
      f"'{kind}' AS text FROM (SELECT count(*) FROM insured_dirty) c" for c, kind in TYPES.items()],
]) + ") r"))
def quality_report(spark, sf_dir):
    return rounded_report(profile.quality_report(insured_dirty(spark, sf_dir).select(*NAMES), "dirty"))


def fence_sql(source: str) -> str:
    fences = ", ".join(
        f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_lo, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_hi"
        for c in NUMERIC)
    return f"SELECT {fences} FROM {source}"


def outlier_counts_sql(source: str) -> str:
    def hit(c):
        return f"coalesce({c} < {c}_lo OR {c} > {c}_hi, false)"
    anyhit = " OR ".join(hit(c) for c in NUMERIC)
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER ({hit(c)}) AS outlier_count "
             f"FROM {source}, ({fence_sql(source)}) f" for c in NUMERIC]
    parts.append(f"SELECT 'any' AS column_name, count(*) FILTER ({anyhit}) AS outlier_count "
                 f"FROM {source}, ({fence_sql(source)}) f")
    return "\nUNION ALL\n".join(parts)


def winsorised_sql(source: str) -> str:
    """Winsorised bmi and charges beside the other columns."""
    def clip(c):
        return (f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, "
                f"(SELECT max({c}) FILTER (r = k + 1) FROM {c}_ranked)), "
                f"(SELECT max({c}) FILTER (r = n - k) FROM {c}_ranked)) END AS {c}")

    def ranked(c):
        return (f"{c}_ranked AS (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n, "
                f"CAST(floor(0.05 * count(*) OVER ()) AS BIGINT) AS k FROM {source} WHERE {c} IS NOT NULL)")
    return (f"WITH {ranked('bmi')}, {ranked('charges')} "
            f"SELECT id, age, sex, {clip('bmi')}, children, smoker, region, {clip('charges')} FROM {source}")


ANALYSIS_PARTS = []
for _side in ("train", "test"):
    ANALYSIS_PARTS += [
        shape_report_sql(_side, f"original_{_side}_shape"), shape_report_sql(_side, f"cleaned_{_side}_shape"),
        f"SELECT '{_side}_outliers' AS section, column_name, 'outlier_count' AS metric, "
        f"outlier_count::DOUBLE AS value, NULL::VARCHAR AS text FROM ({outlier_counts_sql(_side)}) o",
        missing_report_sql(_side, f"{_side}_missing"),
        duplicates_report_sql(_side, f"{_side}_duplicates"),
        describe_report_sql(_side, f"{_side}_descriptive"),
    ]
ANALYSIS_PARTS += [
    union_sql("SELECT 'correlation_with_target' AS section, '{c}' AS column_name, 'corr' AS metric, "
              "round(corr({c}, charges), 6) + 0.0::DOUBLE AS value, NULL::VARCHAR AS text "
              f"FROM ({winsorised_sql('train')}) w", NUMERIC),
    union_sql("SELECT 'categorical_summary' AS section, '{c}' AS column_name, 'n' AS metric, "
              "count(*)::DOUBLE AS value, {c} AS text FROM train GROUP BY {c}", CATEGORICAL),
]


def stored_split(spark, sf_dir):
    """The two samples as tables, the form in which a run hands them to its later stages."""
    path, df = scratch_path(spark, "split"), insured(spark, sf_dir)
    write_sides(df, in_test_sample(df, "id", exact=True), path)
    return read_side(spark, path, "train"), read_side(spark, path, "test")


@query(sql("\nUNION ALL\n".join(ANALYSIS_PARTS)))
def analysis(spark, sf_dir):
    train, test = stored_split(spark, sf_dir)
    return rounded_report(analysis_report(train.select(*NAMES), test.select(*NAMES)))


@query(sql("""SELECT 'ingest' AS stage, s || '_samples' AS metric, n::DOUBLE AS value, NULL::VARCHAR AS text
FROM (SELECT 'train' AS s, count(*) AS n FROM train UNION ALL SELECT 'test', count(*) FROM test) c
UNION ALL
SELECT 'ingest', s || '_columns', 8.0::DOUBLE, 'id,age,sex,bmi,children,smoker,region,charges'
FROM (SELECT 'train' AS s, count(*) AS n FROM train UNION ALL SELECT 'test', count(*) FROM test) c"""))
def stage_metrics(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return sample_metrics([("train", train), ("test", test)])


@query(union_sql("SELECT '{c}' AS column_name, round(avg({c}), 3) AS mean FROM lineitem", LINE_NUMBERS))
def column_means(spark, sf_dir):
    return rounded(profile.means(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), 3)
