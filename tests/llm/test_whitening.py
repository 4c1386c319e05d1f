import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.whitening import feast, inertia, intervals, leading_pairs, whiten


def symmetric(values, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    full = q @ np.diag(values) @ q.T
    return (full + full.T) / 2


@settings(max_examples=80, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=14), st.floats(-60, 60), st.integers(0, 99))
def test_inertia_counts_eigenvalues_below_a_shift(values, shift, seed):
    if min(abs(v - shift) for v in values) > 1e-6:
        assert inertia(symmetric(values, seed), shift) == sum(v < shift for v in values)


def test_inertia_takes_pivots_of_two_rows():
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    a = np.kron(np.eye(3), np.array([[0.0, 2.0], [2.0, 0.0]]))
    assert inertia(a, 0.0) == 3


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 41.0),
        [5.0] * 12 + [1.0] * 20 + [0.1] * 8,
        np.concatenate([[1e6, 1e6 + 1e-3], np.linspace(1, 2, 38)]),
        np.geomspace(1e-6, 1e6, 40),
        [3.0, 2.0, 0.0, 0.0, 0.0],
        [7.0],
    ],
)
def test_leading_pairs_equal_a_direct_solution(values):
    a = symmetric(list(values), 3)
    got, vectors = leading_pairs(a, 32)
    want = np.sort([v for v in values if v > 0])[::-1][:32]
    assert len(got) == len(want)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9 * max(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-10
    assert np.abs(a @ vectors - vectors * got).max() < 1e-9 * max(values)


def test_an_interval_gives_as_many_as_the_inertia_counts():
    a = symmetric(np.arange(1, 31.0), 5)
    for low, high, count in intervals(a, 20):
        assert count == inertia(a, high) - inertia(a, low)
        assert feast(a, low, high, count).shape == (30, count)
    assert sum(count for _, _, count in intervals(a, 20)) == 20


def brute_force(vectors, components=32):
    """All of it with a direct eigen solution and whole numbers of any size."""
    x = [[int(np.floor(64.0 * c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(d)]
    centred = np.array([[(n * row[j] - sums[j]) / n for j in range(d)] for row in x])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-12 * values.max()]
    deviation = [sum((n * row[j] - sums[j]) ** 2 for j in range(d)) for row in x]
    return n, deviation, centred @ (vectors_[:, order] / np.sqrt(values[order])), values[order] / values.sum()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    mix = rng.standard_normal((40, 40)) * np.geomspace(1, 0.05, 40)
    good = (rng.standard_normal((300, 40)) @ mix + 3).astype(np.float32).tolist()
    good += [good[0]] * 40 + [[-x for x in good[1]]]
    bad = [None, [], good[0][:39], good[0][:39] + [None], good[0][:39] + [float("nan")], [float("inf")] * 40]
    rows = [(i, v) for i, v in enumerate(good)] + [(5000 + i, v) for i, v in enumerate(bad)]
    rows += [(None, good[2]), (7, good[9])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    df = df.selectExpr("*", "1 AS n", "2.0 AS whitened", "3 AS component", "'x' AS v", "4 AS _at")
    used = [v for _, v in rows if v is not None and len(v) == 40 and all(x is not None and np.isfinite(x) for x in v)]
    n, deviation, white, explained = brute_force(used)
    got = whiten(df.repartition(5)).collect()
    assert len(got) == n * 32 and {r.n for r in got} == {n}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    sign = {}
    for i in range(300):
        for k in range(32):
            found = by_id[i, k + 1]
            match = min(found, key=lambda r: abs(r.deviation - deviation[i]))
            assert match.deviation == deviation[i]
            assert match.explained == pytest.approx(explained[k], rel=1e-9)
            sign.setdefault(k, 1.0 if match.whitened * white[i, k] >= 0 else -1.0)
            assert match.whitened * sign[k] == pytest.approx(white[i, k], abs=1e-6)
    assert len(by_id[7, 1]) == 2 and len(by_id[None, 32]) == 1


def test_large_entries_and_few_components(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1e-3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whiten(df).collect()
    assert {r.component for r in got} <= {1, 2}
    assert all(r.deviation is None or r.deviation >= 0 for r in got)


def test_nothing_usable_one_vector_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    assert whiten(df).collect() == []
    assert whiten(df.filter("vec_id = 2")).collect() == []
    assert whiten(df.filter("false")).collect() == []
    assert whiten(df.filter("false")).columns == whiten(df).columns
