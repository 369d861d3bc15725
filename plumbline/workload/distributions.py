"""Queries of outliers, distribution tables and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import drift, drift_tests, outliers
from plumbline.operators.contract import INSURED
from plumbline.operators.split import train_test
from plumbline.workload.fixtures import insured, insured_dirty, insured_shifted, rounded, sql, table
from plumbline.workload.profiling import (
    CATEGORICAL, LINE_NUMBERS, NUMERIC, fence_sql, outlier_counts_sql, union_sql, winsorised_sql,
)
from plumbline.workload.registry import query

HITS = {name: f"coalesce({name} < {name}_lo OR {name} > {name}_hi, false)" for name in NUMERIC}


@query(sql("SELECT id, " + ", ".join(f"{hit} AS {name}_outlier" for name, hit in HITS.items())
           + f" FROM insured_dirty, ({fence_sql('insured_dirty')}) f WHERE " + " OR ".join(HITS.values())))
def iqr_outliers(spark, sf_dir):
    return outliers.iqr_outliers(insured_dirty(spark, sf_dir), "id", NUMERIC)


@query(sql(outlier_counts_sql("insured_dirty")))
def outlier_counts(spark, sf_dir):
    return outliers.outlier_counts(insured_dirty(spark, sf_dir), NUMERIC)


@query(sql("SELECT id, age, sex, bmi, children, smoker, region, round(charges, 6) AS charges FROM "
           f"({winsorised_sql('insured_dirty')}) w"))
def winsorised(spark, sf_dir):
    return rounded(outliers.winsorise(insured_dirty(spark, sf_dir), ["bmi", "charges"]))


def histogram_sql(source: str, col: str, bins: str) -> str:
    return f"""SELECT * FROM (WITH s AS (SELECT min({col}) AS lo, max({col}) AS hi, count({col}) AS n,
  quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25) AS iqr FROM {source}),
b AS (SELECT *, {bins} AS bins FROM s),
w AS (SELECT *, (hi - lo) / bins AS w FROM b),
c AS (SELECT least(floor(({col} - lo) / w), bins - 1)::BIGINT AS bin, count(*) AS n
  FROM {source}, w WHERE {col} IS NOT NULL GROUP BY 1)
SELECT r.bin, round(lo + r.bin * w, 6) AS lo, round(lo + (r.bin + 1) * w, 6) AS hi, coalesce(c.n, 0) AS n
FROM w, (SELECT unnest(range(bins)) AS bin FROM b) r LEFT JOIN c ON r.bin = c.bin) h"""


@query(histogram_sql("lineitem", "l_extendedprice", "CAST(20 AS BIGINT)"))
def histogram(spark, sf_dir):
    return rounded(outliers.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 20))


@query(sql(histogram_sql("insured_dirty", "bmi", """CAST(ceil((hi - lo) / least(
  greatest(2 * iqr * pow(n, -1.0 / 3.0), (hi - lo) / sqrt(n) / 2), (hi - lo) / (log2(n) + 1))) AS BIGINT)""")))
def histogram_automatic(spark, sf_dir):
    return rounded(outliers.histogram(insured_dirty(spark, sf_dir), "bmi"))


@query(sql("""SELECT round(g.x, 6) AS x, round(sum(exp(-0.5 * pow((g.x - charges) / h, 2)))
  / max(n * h * sqrt(2 * pi())), 12) AS density
FROM insured, (SELECT lo + i * (hi - lo) / 199 AS x, n, h FROM
  (SELECT min(charges) AS lo, max(charges) AS hi, count(*) AS n,
     stddev_samp(charges) * pow(count(*), -0.2) AS h FROM insured) s,
  (SELECT unnest(range(200)) AS i) r) g GROUP BY g.x"""))
def density(spark, sf_dir):
    return rounded(rounded(outliers.density(insured(spark, sf_dir), "charges"), 6, ["x"]), 12, ["density"])


@query(sql("""SELECT round(g.x, 6) AS x, round(sum(exp(-0.5 * pow((g.x - age) / h, 2)))
  / max(n * h * sqrt(2 * pi())), 9) AS density
FROM insured, (SELECT lo + i * (hi - lo)::DOUBLE / 49 AS x, n, h FROM
  (SELECT min(age) AS lo, max(age) AS hi, count(*) AS n,
     stddev_samp(age) * pow(count(*), -0.2) AS h FROM insured) s,
  (SELECT unnest(range(50)) AS i) r) g GROUP BY g.x"""))
def density_repeated_values(spark, sf_dir):
    return rounded(rounded(outliers.density(insured(spark, sf_dir), "age", 50), 6, ["x"]), 9, ["density"])


BOX = """SELECT '{c}' AS column_name, round(max(q1), 6)::DOUBLE AS q1, round(max(med), 6)::DOUBLE AS median,
  round(max(q3), 6)::DOUBLE AS q3,
  round(min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)), 6)::DOUBLE AS whisker_low,
  round(max({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)), 6)::DOUBLE AS whisker_high,
  count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS flier_count
FROM insured_dirty, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
  quantile_cont({c}, 0.75) AS q3 FROM insured_dirty) q"""


@query(sql(union_sql(BOX, NUMERIC)))
def box_statistics(spark, sf_dir):
    return rounded(outliers.box_stats(insured_dirty(spark, sf_dir), NUMERIC))


MEANS = """SELECT '{c}' AS column_name, r AS reference_mean, s AS current_mean,
  CASE WHEN r <> 0 THEN abs(r - s) / r ELSE abs(r - s) END AS score FROM
  (SELECT (SELECT avg({c}) FROM {ref}) AS r, (SELECT avg({c}) FROM {cur}) AS s) m"""


def mean_drift_sql(ref: str, cur: str, cols: list[str]) -> str:
    inner = union_sql(MEANS.replace("{ref}", ref).replace("{cur}", cur), cols)
    return ("SELECT column_name, round(reference_mean, 3) AS reference_mean, "
            "round(current_mean, 3) AS current_mean, round(score, 6) AS score, "
            f"coalesce(score > 0.2, false) AS drifted FROM ({inner}) m")


def rounded_means(df):
    return rounded(rounded(df, 3, ["reference_mean", "current_mean"]), 6, ["score"])


@query(sql(mean_drift_sql("insured", "insured_shifted", NUMERIC)))
def mean_drift(spark, sf_dir):
    return rounded_means(drift.mean_drift(insured(spark, sf_dir), insured_shifted(spark, sf_dir), NUMERIC))


HALVES = """ev AS (SELECT *, ts < (SELECT make_timestamp(CAST((epoch_us(min(ts)) + epoch_us(max(ts))) // 2 AS BIGINT))
  FROM events) AS early FROM events),
early AS (SELECT * FROM ev WHERE early), late AS (SELECT * FROM ev WHERE NOT early)"""


def _event_halves(spark, sf_dir):
    """Events before and after the middle of the covered time."""
    events = table(spark, sf_dir, "events")
    ends = events.agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("lo"),
                      F.unix_micros(F.max("ts").cast("timestamp")).alias("hi")).first()
    early = F.unix_micros(F.col("ts").cast("timestamp")) < F.lit((ends["lo"] + ends["hi"]) // 2)
    return events.filter(early), events.filter(~early)


@query(f"WITH {HALVES} " + mean_drift_sql("early", "late", ["value"]))
def mean_drift_of_time_slices(spark, sf_dir):
    early, late = _event_halves(spark, sf_dir)
    return rounded_means(drift.mean_drift(early, late, ["value"]))


def shares_sql(ref: str, cur: str, cols: list[str]) -> str:
    one = """SELECT '{c}' AS column_name, coalesce(a.v, b.v) AS value, coalesce(a.p, 0) AS p, coalesce(b.p, 0) AS q
FROM (SELECT {c} AS v, count(*) / (sum(count(*)) OVER ())::DOUBLE AS p FROM {ref} WHERE {c} IS NOT NULL GROUP BY {c}) a
FULL OUTER JOIN
  (SELECT {c} AS v, count(*) / (sum(count(*)) OVER ())::DOUBLE AS p FROM {cur} WHERE {c} IS NOT NULL GROUP BY {c}) b
ON a.v = b.v"""
    return union_sql(one.replace("{ref}", ref).replace("{cur}", cur), cols)


def category_drift_sql(ref: str, cur: str, cols: list[str]) -> str:
    return ("SELECT column_name, round(0.5 * sum(abs(p - q)), 6) AS score, 0.5 * sum(abs(p - q)) > 0.1 AS drifted "
            f"FROM ({shares_sql(ref, cur, cols)}) s GROUP BY column_name")


@query(sql(category_drift_sql("insured", "insured_shifted", CATEGORICAL)))
def category_drift(spark, sf_dir):
    return rounded(drift.category_drift(insured(spark, sf_dir), insured_shifted(spark, sf_dir), CATEGORICAL))


@query(f"WITH {HALVES} " + category_drift_sql("early", "late", ["event_type"]))
def category_drift_of_time_slices(spark, sf_dir):
    early, late = _event_halves(spark, sf_dir)
    return rounded(drift.category_drift(early, late, ["event_type"]))


@query(sql("SELECT column_name, value, round(p, 6) AS ref_share, round(q, 6) AS cur_share FROM "
           f"({shares_sql('insured', 'insured_dirty', CATEGORICAL)}) s"))
def category_distributions(spark, sf_dir):
    return rounded(drift.category_distributions(
        insured(spark, sf_dir), insured_dirty(spark, sf_dir), CATEGORICAL))


def basic_drift_sql(ref: str, cur: str) -> str:
    return f"""SELECT *, bool_or(drifted) OVER () AS dataset_drift FROM (
SELECT column_name, 'mean_difference' AS method, score, drifted FROM ({mean_drift_sql(ref, cur, NUMERIC)}) n
UNION ALL
SELECT column_name, 'total_variation', score, drifted FROM ({category_drift_sql(ref, cur, CATEGORICAL)}) c) b"""


@query(sql(basic_drift_sql("insured", "insured_shifted")))
def basic_drift(spark, sf_dir):
    return rounded(drift.basic_drift(insured(spark, sf_dir), insured_shifted(spark, sf_dir), INSURED))


@query(sql(basic_drift_sql("train", "test")))
def basic_drift_of_split(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return rounded(drift.basic_drift(train, test, INSURED))


def curve_sql(ref: str, cur: str, cols: list[str]) -> str:
    """Largest gap and area between the two distribution functions of each column."""
    one = """SELECT '{c}' AS column_name, max(abs(f - g)) AS ks, sum(abs(f - g) * (nxt - v)) AS area,
  max(r) AS n_ref, max(s) AS n_cur FROM
  (SELECT v, sum(a) OVER w / (sum(a) OVER ())::DOUBLE AS f, sum(b) OVER w / (sum(b) OVER ())::DOUBLE AS g,
     coalesce(lead(v) OVER w, v) AS nxt, sum(a) OVER () AS r, sum(b) OVER () AS s
   FROM (SELECT v, sum(a) AS a, sum(b) AS b FROM
     (SELECT {c} AS v, 1 AS a, 0 AS b FROM {ref} UNION ALL SELECT {c}, 0, 1 FROM {cur}) u
     WHERE v IS NOT NULL GROUP BY v) k
   WINDOW w AS (ORDER BY v)) d"""
    return union_sql(one.replace("{ref}", ref).replace("{cur}", cur), cols)


@query(sql("SELECT column_name, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, "
           f"round(ks, 9) AS statistic FROM ({curve_sql('insured', 'insured_shifted', NUMERIC)}) k"))
def ks_statistic(spark, sf_dir):
    return rounded(drift_tests.ks_statistic(
        insured(spark, sf_dir), insured_shifted(spark, sf_dir), NUMERIC), 9)


KS_TAIL = """least(greatest(CASE WHEN z < 0.2 THEN 1.0::DOUBLE ELSE (SELECT 2 * sum(
  (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * i * i * z * z)) FROM range(1, 101) r(i)) END, 0), 1)"""


@query(sql(f"""SELECT column_name, round(ks, 9) AS statistic, round({KS_TAIL}, 6) AS p_value, {KS_TAIL} < 0.05 AS drifted
FROM (SELECT *, ks * sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS z
  FROM ({curve_sql('train', 'test', NUMERIC)}) k) t"""))
def ks_test(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return rounded(rounded(drift_tests.ks(train, test, NUMERIC), 9, ["statistic"]), 6, ["p_value"])


SUPPLIER_SIDES = """a AS (SELECT * FROM supplier WHERE s_nationkey < 12), b AS (SELECT * FROM supplier WHERE s_nationkey >= 12)"""


@query(f"""WITH RECURSIVE {SUPPLIER_SIDES},
k AS (SELECT column_name, ks, n_ref::BIGINT AS n, n_cur::BIGINT AS m, round(ks * n_ref * n_cur)::BIGINT AS far
  FROM ({curve_sql('a', 'b', ['s_acctbal'])}) c),
walk AS (
  SELECT column_name, 0::BIGINT AS s, [CASE WHEN i = 0 AND far <= 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FOR i IN range(0, n + 1)] AS share FROM k
  UNION ALL
  SELECT w.column_name, s + 1, [CASE WHEN s + 1 - i < 0 OR s + 1 - i > m THEN 0.0::DOUBLE WHEN abs(i * m - (s + 1 - i) * n) >= far THEN 1.0::DOUBLE
    ELSE ((CASE WHEN i > 0 THEN share[i] ELSE 0.0::DOUBLE END) * i + share[i + 1] * (s + 1 - i)) / (s + 1) END FOR i IN range(0, n + 1)]
  FROM walk w JOIN k ON w.column_name = k.column_name WHERE s < n + m)
SELECT k.column_name, round(ks, 9) AS statistic, round(share[n + 1], 9) AS p_value, share[n + 1] < 0.05 AS drifted
FROM k JOIN walk w ON k.column_name = w.column_name AND s = n + m""")
def ks_exact_test(spark, sf_dir):
    """Balances of suppliers in two groups of nations: samples small enough for the exact tail."""
    suppliers = table(spark, sf_dir, "supplier")
    found = drift_tests.ks(suppliers.filter("s_nationkey < 12"), suppliers.filter("s_nationkey >= 12"), ["s_acctbal"])
    return rounded(found, 9)


def wasserstein_sql(ref: str, cur: str, cols: list[str]) -> str:
    spread = union_sql(f"SELECT '{{c}}' AS column_name, stddev_pop({{c}}) AS std FROM {ref}", cols)
    return (f"SELECT column_name, area AS distance, area / greatest(std, 0.001) AS score, "
            f"area / greatest(std, 0.001) >= 0.1 AS drifted FROM ({curve_sql(ref, cur, cols)}) k "
            f"JOIN ({spread}) s USING (column_name)")


WASSERSTEIN = "SELECT column_name, round(distance, 6) AS distance, round(score, 6) AS score, drifted FROM ({}) w"


@query(sql(WASSERSTEIN.format(wasserstein_sql("insured", "insured_shifted", NUMERIC))))
def wasserstein(spark, sf_dir):
    return rounded(drift_tests.wasserstein(insured(spark, sf_dir), insured_shifted(spark, sf_dir), NUMERIC))


LINE_HALVES = """WITH a AS (SELECT * FROM lineitem WHERE l_linestatus = 'O'),
b AS (SELECT * FROM lineitem WHERE l_linestatus = 'F') """


@query(LINE_HALVES + WASSERSTEIN.format(wasserstein_sql("a", "b", LINE_NUMBERS)))
def wasserstein_lineitem(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return rounded(drift_tests.wasserstein(
        lineitem.filter("l_linestatus = 'O'"), lineitem.filter("l_linestatus = 'F'"), LINE_NUMBERS))


CHI = """SELECT '{c}' AS column_name,
  sum(CASE WHEN a > 0 THEN pow(b - a * tb / ta, 2) / (a * tb / ta) ELSE 'inf'::DOUBLE END) AS statistic,
  count(*) - 1 AS freedom FROM
  (SELECT v, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b, (sum(sum(a)) OVER ())::DOUBLE AS ta,
     (sum(sum(b)) OVER ())::DOUBLE AS tb
   FROM (SELECT {c} AS v, 1 AS a, 0 AS b FROM {ref} UNION ALL SELECT {c}, 0, 1 FROM {cur}) u
   WHERE v IS NOT NULL GROUP BY v) k"""


@query(sql("SELECT column_name, round(statistic, 6) AS statistic, freedom FROM ("
           + union_sql(CHI.replace("{ref}", "train").replace("{cur}", "test"), CATEGORICAL) + ") c"))
def chi_square_statistic(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return rounded(drift_tests.chi_square_statistic(train, test, CATEGORICAL))


# Two-sided normal tail by the midpoint rule, and from it the chi-square tail of the
# freedoms that the category columns have.
NORMAL_TAIL = """(SELECT 1 - 2 * sum(exp(-0.5 * pow((i + 0.5) * z / 4000, 2))) * z / 4000 / sqrt(2 * pi())
  FROM range(4000) r(i))"""
CHI_TAIL = (f"CASE freedom WHEN 1 THEN {NORMAL_TAIL} WHEN 2 THEN exp(-statistic / 2) "
            f"WHEN 3 THEN {NORMAL_TAIL} + sqrt(2 * statistic / pi()) * exp(-statistic / 2) END")


def chi_square_sql(ref: str, cur: str, cols: list[str]) -> str:
    inner = union_sql(CHI.replace("{ref}", ref).replace("{cur}", cur), cols)
    return (f"SELECT column_name, statistic, freedom, {CHI_TAIL} AS p_value "
            f"FROM (SELECT *, sqrt(statistic) AS z FROM ({inner}) c) t")


@query(sql("SELECT column_name, round(statistic, 5) AS statistic, freedom, round(p_value, 5) AS p_value, "
           f"p_value < 0.05 AS drifted FROM ({chi_square_sql('train', 'test', CATEGORICAL)}) c"))
def chi_square_test(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return rounded(drift_tests.chi_square(train, test, CATEGORICAL), 5)


Z = """SELECT '{c}' AS column_name, (pa - pb) / sqrt(pp * (1 - pp) * (1 / na + 1 / nb)) AS statistic FROM
  (SELECT sum(a) FILTER (v = lo) / sum(a)::DOUBLE AS pa, sum(b) FILTER (v = lo) / sum(b)::DOUBLE AS pb,
     count(*) FILTER (v = lo) / count(*)::DOUBLE AS pp, sum(a)::DOUBLE AS na, sum(b)::DOUBLE AS nb FROM
     (SELECT *, min(v) OVER () AS lo FROM
       (SELECT {c} AS v, 1 AS a, 0 AS b FROM {ref} UNION ALL SELECT {c}, 0, 1 FROM {cur}) u) k) z"""


@query(sql("SELECT column_name, round(statistic, 6) + 0.0::DOUBLE AS statistic FROM ("
           + union_sql(Z.replace("{ref}", "train").replace("{cur}", "test"), ["sex", "smoker"]) + ") z"))
def proportion_statistic(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return rounded(drift_tests.proportion_statistic(train, test, ["sex", "smoker"]))


def proportion_sql(ref: str, cur: str, cols: list[str]) -> str:
    inner = union_sql(Z.replace("{ref}", ref).replace("{cur}", cur), cols)
    return (f"SELECT column_name, statistic, {NORMAL_TAIL} AS p_value "
            f"FROM (SELECT *, abs(statistic) AS z FROM ({inner}) c) t")


@query(sql("SELECT column_name, round(statistic, 5) + 0.0::DOUBLE AS statistic, round(p_value, 5) AS p_value, "
           f"p_value < 0.05 AS drifted FROM ({proportion_sql('train', 'test', ['sex', 'smoker'])}) z"))
def proportion_test(spark, sf_dir):
    train, test = train_test(insured(spark, sf_dir), "id", exact=True)
    return rounded(drift_tests.proportion_z(train, test, ["sex", "smoker"]), 5)


def shannon_sql(ref: str, cur: str, cols: list[str]) -> str:
    return f"""SELECT column_name, js AS score, js >= 0.1 AS drifted FROM (
  SELECT column_name, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
    + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS js
  FROM ({shares_sql(ref, cur, cols)}) s GROUP BY column_name) j"""


@query(sql("SELECT column_name, round(score, 6) AS score, drifted FROM ("
           + shannon_sql("insured", "insured_shifted", CATEGORICAL) + ") j"))
def jensen_shannon(spark, sf_dir):
    return rounded(drift_tests.jensen_shannon(
        insured(spark, sf_dir), insured_shifted(spark, sf_dir), CATEGORICAL))


@query(sql(f"""SELECT column_name, test, round(score, 6) AS score, drifted,
  count(*) FILTER (drifted) OVER () AS drifted_columns, count(*) OVER () AS n_columns,
  round(count(*) FILTER (drifted) OVER () / (count(*) OVER ())::DOUBLE, 6) AS drift_share,
  count(*) FILTER (drifted) OVER () / (count(*) OVER ())::DOUBLE >= 0.5 AS dataset_drift FROM (
SELECT column_name, 'wasserstein' AS test, score, drifted
FROM ({wasserstein_sql('insured', 'insured_shifted', NUMERIC)}) w
UNION ALL SELECT column_name, 'jensen_shannon', score, drifted
FROM ({shannon_sql('insured', 'insured_shifted', CATEGORICAL)}) j) d"""))
def dataset_drift(spark, sf_dir):
    return rounded(drift_tests.dataset_drift(
        insured(spark, sf_dir), insured_shifted(spark, sf_dir), INSURED))


@query(sql(f"""SELECT column_name, test, round(score, 5) AS score, score < 0.05 AS drifted,
  count(*) FILTER (score < 0.05) OVER () AS drifted_columns, count(*) OVER () AS n_columns,
  round(count(*) FILTER (score < 0.05) OVER () / (count(*) OVER ())::DOUBLE, 5) AS drift_share,
  count(*) FILTER (score < 0.05) OVER () / (count(*) OVER ())::DOUBLE >= 0.5 AS dataset_drift FROM (
SELECT column_name, 'ks' AS test, {KS_TAIL} AS score
FROM (SELECT *, ks * sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS z
  FROM ({curve_sql('insured', 'insured_shifted', NUMERIC)}) k) t
UNION ALL SELECT column_name, 'proportion_z', p_value
FROM ({proportion_sql('insured', 'insured_shifted', ['sex', 'smoker'])}) z
UNION ALL SELECT column_name, 'chi_square', p_value
FROM ({chi_square_sql('insured', 'insured_shifted', ['region'])}) c) d"""))
def dataset_drift_by_p_values(spark, sf_dir):
    """The tests meant for small samples, on every row."""
    rules = drift_tests.DriftRules(by_sample_size=True, small_sample=10 ** 15)
    return rounded(drift_tests.dataset_drift(
        insured(spark, sf_dir), insured_shifted(spark, sf_dir), INSURED, rules), 5)
