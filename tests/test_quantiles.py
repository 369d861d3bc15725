import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plumbline.operators.quantiles import first_look, interpolated, order_statistics, percentiles
from plumbline.shared import literal_rows


def column(spark, values):
    return literal_rows(spark, "x double", [(None if v is None else float(v),) for v in values])


def hot(n=4000):
    """A third of the rows share one value; the rest are spread over many magnitudes."""
    rng = np.random.default_rng(3)
    return np.concatenate([np.full(n // 3, 7.0), rng.normal(0, 1e6, n // 3), rng.exponential(1e-3, n - 2 * (n // 3))])


@pytest.mark.parametrize("task_values", [20, 300, 100_000])
def test_order_statistics_match_a_sort(spark, task_values):
    values = hot()
    ranks = [0, 1, 17, 999, 1333, 2000, 2666, 3333, 3998, 3999]
    df = column(spark, values).repartition(8)
    got = order_statistics(df, {"x": ranks}, {"x": len(values)}, task_values)
    want = np.sort(values)
    assert [got["x", r] for r in ranks] == [want[r] for r in ranks]


@pytest.mark.parametrize("near", [(-1e12, -1e11), (1e11, 1e12), (7.0, 7.0), (6.9, 7.1), (-1e12, 1e12)])
def test_a_poor_proposal_costs_no_result(spark, near):
    values = hot()
    got = order_statistics(column(spark, values), {"x": [100, 1999]}, {"x": len(values)}, 30,
                           {("x", 100): near, ("x", 1999): near})
    want = np.sort(values)
    assert (got["x", 100], got["x", 1999]) == (want[100], want[1999])


@pytest.mark.parametrize("values", [[5.0] * 50, list(range(50)), [1.0] * 25 + [2.0] * 25, [-1e300, 1e300] * 10])
def test_narrowing_ends_on_odd_shapes(spark, values):
    got = order_statistics(column(spark, values), {"x": [0, 10, len(values) - 1]}, {"x": len(values)}, 4)
    want = sorted(values)
    assert [got["x", r] for r in (0, 10, len(values) - 1)] == [want[0], want[10], want[-1]]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=60), p=st.floats(0, 1))
def test_percentile_is_linear(spark, values, p):
    df = column(spark, values)
    got = interpolated(df, first_look(df, ["x"], [p]), ["x"], [p], task_values=5)["x", p]
    assert got == pytest.approx(np.percentile(values, 100 * p), rel=1e-9, abs=1e-9)


def test_nulls_are_skipped_and_empty_is_null(spark):
    df = literal_rows(spark, "x double, y double", [(1.0, None), (None, None), (3.0, None)])
    rows = {(r.column_name, r.p): r.value for r in percentiles(df, ["x", "y"], [0.5]).collect()}
    assert rows == {("x", 0.5): 2.0, ("y", 0.5): None}
    assert first_look(df, ["x", "y"], [0.5]).counts == {"x": 2, "y": 0}


def test_sketch_stays_close(spark):
    values = np.arange(20_000.0)
    df = column(spark, values)
    got = interpolated(df, first_look(df, ["x"], [0.5]), ["x"], [0.5], exact=False)["x", 0.5]
    assert abs(got - 10_000) <= 20
