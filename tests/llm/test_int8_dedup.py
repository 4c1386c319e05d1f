import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.int8_dedup import forest, near_duplicates, quantise, unit


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 80), st.floats(-30, 30))
def test_quantisation_error_stays_within_its_bound(seed, dim, scale):
    rng = np.random.default_rng(seed)
    x = unit(rng.standard_normal((6, dim)) * 10.0**scale + 1e-300)
    p, s, d = quantise(x)
    for i in range(6):
        for j in range(6):
            whole = float(p[i].astype(int) @ p[j].astype(int)) * s[i] * s[j]
            assert abs(float(x[i] @ x[j]) - whole) <= d[i] + (1 + d[i]) * d[j] + 1e-12


def brute_force(rows, threshold=0.95):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [unit(np.array([v], dtype=np.float64))[0] if good(v) else None for _, v in rows]
    linked = np.zeros((len(rows), len(rows)), dtype=bool)
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and len(a) == len(b):
                linked[i, j] = a @ b >= threshold
    root = forest(len(rows), *np.nonzero(linked))
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((str(key), int(linked[i].sum()), str(component), key is None or component is None or key == component))
    return sorted(out)


@pytest.mark.parametrize("tile", [8, 4096])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(spark, tile, kind):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((12, 16))
    near = [centres[i % 12] + 0.28 * rng.standard_normal(16) * (i % 5) / 4 for i in range(160)]
    chain = [[np.cos(t), np.sin(t), *[0.0] * 14] for t in np.arange(0, 2, 0.2)]
    vectors = [np.float32(v).tolist() for v in near] + [np.float32(v).tolist() for v in chain]
    vectors += [vectors[0]] * 12 + [[x * 4 for x in vectors[5]], [-x for x in vectors[5]]]
    vectors += [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    vectors += [[0.0, -0.0, 1.0], [0.0, 0.0, 1.0], [1e30, 0.0, 1e-30], [1e38, 0.0, 0.0]]
    order = rng.permutation(len(vectors))
    rows = [(int(i), vectors[k]) for i, k in enumerate(order)] + [(None, vectors[0]), (4, vectors[order[4]])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    df = df.selectExpr("*", "7 AS label", "'x' AS _class", "1 AS _n")
    found = near_duplicates(df, tile=tile).collect()
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found)
    assert got == brute_force(rows)


def test_nothing_usable_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in near_duplicates(df).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert near_duplicates(df.filter("false")).collect() == []
