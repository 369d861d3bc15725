import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import drift, drift_tests, outliers, profile
from plumbline.operators.contract import INSURED
from plumbline.shared import literal_rows


def frame(spark, **cols):
    names = list(cols)
    kinds = ", ".join(f"{n} {'string' if any(isinstance(v, str) for v in cols[n]) else 'double'}" for n in names)
    return literal_rows(spark, kinds, list(zip(*cols.values())))


def by_column(df, *fields):
    return {r.column_name: tuple(r[f] for f in fields) if len(fields) > 1 else r[fields[0]] for r in df.collect()}


def test_signed_denominator_never_drifts_on_a_negative_mean(spark):
    ref, cur = frame(spark, x=[-10.0, -10.0], z=[1.0, -1.0]), frame(spark, x=[-20.0, -20.0], z=[0.1, 0.1])
    assert by_column(drift.mean_drift(ref, cur, ["x", "z"]), "score", "drifted") == {
        "x": (-1.0, False), "z": (pytest.approx(0.1), False)}
    assert by_column(drift.mean_drift(ref, cur, ["x"], denominator="abs"), "score", "drifted") == {"x": (1.0, True)}


def test_empty_means_do_not_drift(spark):
    ref, cur = frame(spark, x=[None, None]), frame(spark, x=[1.0, 2.0])
    assert by_column(drift.mean_drift(ref, cur, ["x"]), "drifted") == {"x": False}


def test_total_variation_is_symmetric_and_bounded(spark):
    a, b = frame(spark, s=["u", "u", "v", None]), frame(spark, s=["w", "w", "w", "w"])
    forth, back = by_column(drift.category_drift(a, b, ["s"]), "score"), by_column(drift.category_drift(b, a, ["s"]), "score")
    assert forth == pytest.approx(back) and forth == {"s": pytest.approx(1.0)}
    assert by_column(drift.category_drift(a, a, ["s"]), "score", "drifted") == {"s": (0.0, False)}


def test_column_without_values_keeps_its_row(spark):
    a, b = frame(spark, s=["u", None]), literal_rows(spark, "s string", [(None,), (None,)])
    assert by_column(drift.category_drift(a, b, ["s"]), "score") == {"s": pytest.approx(0.5)}


def curve(ref, cur):
    """Largest gap and area between two distribution functions, point by point."""
    points = sorted({*ref, *cur})
    def share(sample, v):
        return sum(1 for s in sample if s <= v) / len(sample)
    gaps = [abs(share(ref, v) - share(cur, v)) for v in points]
    return max(gaps), sum(g * (b - a) for g, a, b in zip(gaps, points, points[1:]))


@pytest.mark.parametrize("bucket_values", [3, 25, 10 ** 6])
def test_curve_tests_match_brute_force(spark, bucket_values):
    rng = np.random.default_rng(5)
    ref = {"x": [round(v, 1) for v in rng.normal(0, 2, 90)], "y": [4.0] * 60 + list(rng.normal(4, 1, 30))}
    cur = {"x": [round(v, 1) for v in rng.normal(1, 2, 70)], "y": [4.0] * 10 + list(rng.normal(5, 1, 60))}
    a, b = frame(spark, **ref).repartition(5), frame(spark, **cur).repartition(3)
    scores = by_column(drift_tests.ks_statistic(a, b, ["x", "y"], bucket_values), "statistic", "n_ref", "n_cur")
    areas = by_column(drift_tests.wasserstein(a, b, ["x", "y"], bucket_values=bucket_values), "distance", "score")
    for col in ("x", "y"):
        gap, area = curve(ref[col], cur[col])
        assert scores[col] == (pytest.approx(gap), 90, 70)
        assert areas[col] == (pytest.approx(area), pytest.approx(area / np.std(ref[col])))


def test_bucket_curves_are_close_and_never_above(spark):
    rng = np.random.default_rng(6)
    ref, cur = rng.normal(0, 1, 900).tolist(), (rng.normal(0.4, 1, 600).tolist() + [0.5] * 300)
    a, b = frame(spark, x=ref), frame(spark, x=cur)
    gap, area = curve(ref, cur)
    close = by_column(drift_tests.ks_statistic(a, b, ["x"], exact=False), "statistic")["x"]
    assert gap - 0.01 <= close <= gap + 1e-12
    assert by_column(drift_tests.wasserstein(a, b, ["x"], exact=False), "distance")["x"] == pytest.approx(area, rel=0.05)


def test_tail_probabilities():
    assert drift_tests.chi_square_sf(3.841458820694124, 1) == pytest.approx(0.05)
    assert drift_tests.chi_square_sf(5.991464547107979, 2) == pytest.approx(0.05)
    assert drift_tests.chi_square_sf(7.814727903251179, 3) == pytest.approx(0.05)
    assert drift_tests.chi_square_sf(18.307038053275146, 10) == pytest.approx(0.05)
    assert drift_tests.chi_square_sf(math.inf, 3) == 0.0 and drift_tests.chi_square_sf(0.0, 3) == 1.0
    # 1.3581 is the tabulated 5 % point of the Kolmogorov distribution.
    assert drift_tests.kolmogorov_sf(1.3581 / math.sqrt(50), 100, 100) == pytest.approx(0.05, abs=1e-4)


def test_unseen_category_has_no_chance(spark):
    a, b = frame(spark, s=["u", "v"] * 20), frame(spark, s=["u", "w"] * 20)
    row = drift_tests.chi_square(a, b, ["s"]).first()
    assert row.statistic == math.inf and row.p_value == 0.0 and row.drifted


def test_choice_of_tests():
    names = {"age": 40, "sex": 2, "region": 4, "children": 5}
    rules = drift_tests.DriftRules(by_sample_size=True)
    assert drift_tests.choose_tests(1000, names, INSURED, rules) == {
        "ks": ["age"], "proportion_z": ["sex"], "chi_square": ["region", "children"]}
    assert drift_tests.choose_tests(1001, names, INSURED, rules) == {
        "wasserstein": ["age"], "jensen_shannon": ["sex", "region", "children"]}
    for rows in (900, 1100):  # by default the size plays no part
        assert drift_tests.choose_tests(rows, names, INSURED, drift_tests.DriftRules()) == {
            "wasserstein": ["age"], "jensen_shannon": ["sex", "region", "children"]}


def test_dataset_drift_of_a_small_sample(spark):
    ref = frame(spark, age=[float(i) for i in range(60)], sex=["male", "female"] * 30)
    cur = frame(spark, age=[float(i + 50) for i in range(60)], sex=["male", "female"] * 30)
    rules = drift_tests.DriftRules(by_sample_size=True)
    rows = {r.column_name: r for r in drift_tests.dataset_drift(ref, cur, INSURED, rules).collect()}
    assert rows["age"].test == "ks" and rows["age"].drifted and rows["age"].score < 1e-6
    assert rows["sex"].test == "proportion_z" and rows["sex"].score == 1.0 and not rows["sex"].drifted
    assert rows["age"].drift_share == 0.5 and rows["age"].dataset_drift


def test_winsorise_keeps_rows_nulls_and_order_statistics(spark):
    values = [float(v) for v in range(1, 101)] + [None]
    out = [r.x for r in outliers.winsorise(frame(spark, x=values), ["x"]).collect()]
    kept = sorted(v for v in out if v is not None)
    assert len(out) == 101 and out.count(None) == 1
    assert kept[:6] == [6.0] * 6 and kept[-6:] == [95.0] * 6 and kept[6:-6] == [float(v) for v in range(7, 95)]


@pytest.mark.parametrize("task_values", [30, 100_000])
def test_fences_match_numpy(spark, task_values):
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(0, 1, 300), [50.0, -40.0], np.full(120, 0.25)])
    fence = outliers.fences(frame(spark, x=values.tolist()), ["x"], task_values=task_values)["x"]
    q1, q3 = np.percentile(values, [25, 75])
    assert (fence.low, fence.high) == (pytest.approx(q1 - 1.5 * (q3 - q1)), pytest.approx(q3 + 1.5 * (q3 - q1)))


def test_propagated_null_hides_outliers(spark):
    df = frame(spark, k=[float(i) for i in range(22)], x=[1.0, 2.0, 3.0] * 7 + [900.0])
    holes = df.unionByName(literal_rows(spark, "k double, x double", [(99.0, None)]))
    assert outliers.iqr_outliers(holes, "k", ["x"]).count() == 1
    assert outliers.iqr_outliers(holes, "k", ["x"], null_policy="propagate").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_histogram_follows_numpy(spark, seed):
    values = np.random.default_rng(seed).exponential(3, 500)
    rows = sorted(outliers.histogram(frame(spark, x=values.tolist()), "x").collect())
    counts, edges = np.histogram(values, bins="auto")
    assert [r.n for r in rows] == counts.tolist()
    assert [r.lo for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    rows = outliers.histogram(frame(spark, x=[2.0] * 9), "x", 3).collect()
    assert sum(r.n for r in rows) == 9 and len(rows) == 3


@pytest.mark.parametrize("values", [np.random.default_rng(4).normal(0, 1, 200), np.repeat([1.0, 2.0, 5.0], 40)])
def test_density_matches_the_plain_sum(spark, values):
    grid = np.linspace(values.min(), values.max(), 25)
    h = np.std(values, ddof=1) * len(values) ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - values[None, :]) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    rows = sorted(outliers.density(frame(spark, x=values.tolist()), "x", 25).collect())
    assert [r.density for r in rows] == pytest.approx(want.tolist())


def test_narrow_kernels_leave_far_points_at_zero(spark):
    rows = sorted(outliers.density(frame(spark, x=[0.0, 1000.0]), "x", 11, bandwidth=0.5).collect())
    assert rows[5].density == 0.0 and rows[0].density == pytest.approx(1 / (2 * 0.5 * math.sqrt(2 * math.pi)))


def test_correlation_of_a_constant_is_null(spark):
    df = frame(spark, a=[1.0, 2.0, 3.0, None], b=[2.0, 4.0, 7.0, 1.0], c=[5.0] * 4)
    rows = {(r.column_x, r.column_y): r.corr for r in profile.correlation(df).collect()}
    assert rows["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert rows["a", "c"] is None and rows["c", "c"] is None and rows["a", "a"] == pytest.approx(1.0)


@pytest.mark.parametrize("method", ["rows", "hash"])
def test_duplicates_count_nulls_as_equal(spark, method):
    df = frame(spark, a=[1.0, 1.0, None, None, 2.0], s=["x", "x", "y", "y", "z"])
    row = profile.duplicates(df, method).first()
    assert (row.n_rows, row.duplicate_count, row.duplicate_pct) == (5, 2, 40.0)


def test_quality_score_caps_its_penalties(spark):
    df = literal_rows(spark, "a double, b double", [(None, None)] * 10)
    assert profile.quality_score(df).first().quality_score == 50.0


def test_describe_matches_numpy(spark):
    values = np.random.default_rng(2).normal(10, 3, 333)
    got = profile.describe_values(frame(spark, x=values.tolist()), ["x"], task_values=20)
    assert got["x", "std"] == pytest.approx(np.std(values, ddof=1))
    assert got["x", "75%"] == pytest.approx(np.percentile(values, 75))


def test_few_values_are_counted_exactly_and_tests_can_be_named(spark):
    ref = frame(spark, age=[float(i % 100) for i in range(900)], sex=["male"] * 900)
    rules = drift_tests.DriftRules(few_values=100)
    got = {r.column_name: r.test for r in drift_tests.dataset_drift(ref, ref, INSURED, rules).collect()}
    assert got == {"age": "jensen_shannon", "sex": "jensen_shannon"}
    got = {r.column_name: r.test for r in drift_tests.dataset_drift(ref, ref, INSURED, tests={"age": "ks"}).collect()}
    assert got["age"] == "ks"


def test_columns_go_together_up_to_the_bucket_limit(monkeypatch):
    monkeypatch.setattr(drift_tests, "MAX_BUCKETS", 10)
    assert drift_tests._together({"a": 4, "b": 6, "c": 1, "d": 10}) == [["a", "b"], ["c"], ["d"]]


@pytest.mark.parametrize("x, freedom, want", [
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (11.070497693516351, 5, 0.05), (0.5, 3, 0.9188914116),
    (124.34211340400407, 100, 0.05), (1074.6794494, 1000, 0.05), (10_233.7488, 10_000, 0.05)])
def test_chi_square_tail(x, freedom, want):
    assert drift_tests.chi_square_sf(x, freedom) == pytest.approx(want, rel=2e-3)


def test_nan_is_no_drift(spark):
    ref, cur = frame(spark, age=[1.0, 2.0]), frame(spark, age=[1.0, float("nan")])
    assert not drift.mean_drift(ref, cur, ["age"]).first().drifted
    assert not drift_tests.wasserstein(ref, cur, ["age"]).first().drifted


def test_wide_correlation_by_matrix_and_by_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    cols = {f"c{i}": (rng.normal(size=80) + (i % 3)).tolist() for i in range(17)} | {"flat": [2.0] * 80}
    df = frame(spark, **cols)
    by_matrix = {(r.column_x, r.column_y): r.corr for r in profile.correlation(df).collect()}
    monkeypatch.setattr(profile, "PAIRS_PER_SCAN", 1000)
    by_pairs = {(r.column_x, r.column_y): r.corr for r in profile.correlation(df).collect()}
    assert len(by_matrix) == 18 * 18 and by_matrix.keys() == by_pairs.keys()
    for key, value in by_pairs.items():
        assert by_matrix[key] == (None if value is None else pytest.approx(value, abs=1e-9))


@pytest.mark.parametrize("widest", [1000, 5])
def test_wide_correlation_with_gaps_equals_the_pairs(spark, monkeypatch, widest):
    monkeypatch.setattr(profile, "WIDEST", widest)
    rng = np.random.default_rng(6)
    cols = {f"c{i}": (1e6 * (i % 2) + rng.normal(size=90) * 10.0 ** (i % 4) + i).tolist() for i in range(16)}
    cols |= {"flat": [1.1] * 90, "none": [None] * 90, "one": [7.0] + [None] * 89, "half": [0.1] * 45 + [0.2] * 45}
    for i in range(16):
        for j in rng.choice(90, 4 * i, replace=False):
            cols[f"c{i}"][j] = None if j % 3 else float("nan")
    cols["c0"] = [x if j < 45 else None for j, x in enumerate(cols["c0"])]  # "half" is constant beside it
    df = frame(spark, **cols).repartition(4)
    one_scan = profile._masked_correlation(df, list(cols), list(cols), {c: 0.0 for c in cols})
    assert one_scan._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    masked = {(r.column_x, r.column_y): r.corr for r in profile.correlation(df).collect()}
    monkeypatch.setattr(profile, "PAIRS_PER_SCAN", 1000)
    # A NaN is a missing cell of a wide table; the aggregates of single pairs need it as null.
    plain = df.select([F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns])
    pairs = {(r.column_x, r.column_y): r.corr for r in profile.correlation(plain).collect()}
    assert masked.keys() == pairs.keys() and len(pairs) == 400
    for key, value in pairs.items():
        assert masked[key] == (None if value is None else pytest.approx(value, abs=1e-7)), key


def test_exact_smirnov_tail_equals_an_enumeration():
    from itertools import combinations

    for n, m in ((1, 1), (2, 3), (4, 4), (5, 3), (6, 4)):
        gaps = []
        for ref in combinations(range(n + m), n):
            i = j = top = 0
            for place in range(n + m):
                i, j = i + (place in ref), j + (place not in ref)
                top = max(top, abs(i * m - j * n))
            gaps.append(top)
        for gap in sorted({0, *gaps}):
            want = sum(g >= gap for g in gaps) / len(gaps)
            assert drift_tests.smirnov_sf(gap / (n * m), n, m) == pytest.approx(want, rel=1e-12)


def test_exact_and_asymptotic_tails_meet_and_small_tails_keep_digits():
    for d in (0.05, 0.08, 0.12):
        assert drift_tests.smirnov_sf(d, 900, 800) == pytest.approx(drift_tests.kolmogorov_sf(d, 900, 800), rel=0.2)
    # Only the two orders that keep the samples apart reach 1.
    assert drift_tests.smirnov_sf(1.0, 20, 20) == pytest.approx(2 / math.comb(40, 20), rel=1e-12)
    assert drift_tests.smirnov_sf(0.0, 5, 5) == 1.0


def test_the_named_size_decides_between_exact_and_asymptotic(spark):
    ref, cur = frame(spark, age=[float(i) for i in range(9)]), frame(spark, age=[i + 4.5 for i in range(7)])
    row = drift_tests.ks(ref, cur, ["age"]).first()
    assert row.p_value == pytest.approx(drift_tests.smirnov_sf(row.statistic, 9, 7))
    row = drift_tests.ks(ref, cur, ["age"], exact_size=8).first()
    assert row.p_value == pytest.approx(drift_tests.kolmogorov_sf(row.statistic, 9, 7))


def test_missing_cells_keep_pairs_complete(spark):
    cols = {f"c{i}": [float((i + 1) * j % 7) for j in range(20)] for i in range(16)}
    cols["c3"][4] = None
    rows = {(r.column_x, r.column_y): r.corr for r in profile.correlation(frame(spark, **cols)).collect()}
    a, b = (np.delete(np.array(cols[c], float), 4) for c in ("c3", "c5"))
    assert rows["c3", "c5"] == pytest.approx(np.corrcoef(a, b)[0, 1])
