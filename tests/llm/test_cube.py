import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.cube import _flights, flight, mix, mixed_documents, source_table, targets


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=12))
def test_targets(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    found = targets(sizes, weights)
    assert sum(found) == pytest.approx(sum(sizes), abs=1e-3)
    assert all(t <= 3 * s + 1e-6 for t, s in zip(found, sizes))
    shares = {round(t / w, 3) for t, w, s in zip(found, weights, sizes) if t < 3 * s - 1e-3}
    assert len(shares) <= 1 or max(shares) - min(shares) < 0.01


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=3, max_size=80), st.floats(0.01, 0.99), st.integers())
def test_flight_keeps_both_totals(sizes, p, seed):
    out = flight(sizes, [p] * len(sizes), random.Random(seed))
    assert sum(out) == pytest.approx(p * len(sizes), abs=1e-4)
    assert sum(a * b for a, b in zip(sizes, out)) == pytest.approx(p * sum(sizes), abs=0.1)
    assert sum(0 < x < 1 for x in out) <= 2
    landed = flight(sizes, [p] * len(sizes), random.Random(seed), land=True)
    assert set(landed) <= {0.0, 1.0}
    assert abs(sum(landed) - p * len(sizes)) < 1 + 1e-6


def test_inclusion_keeps_its_probability():
    rng, hits = random.Random(0), Counter()
    for _ in range(4000):
        hits.update(i for i, x in enumerate(flight([5, 9, 1, 7, 3], [0.3] * 5, rng, True)) if x)
    assert all(abs(hits[i] / 4000 - 0.3) < 0.04 for i in range(5))


def corpus(spark, n=900):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "b", "b", "b", "c", None, "é"])
        rows.append((i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), "en", source))
    rows += [(None, "x y", "en", "a")] * 5 + [(7, "same row", "en", "b")] * 9 + [(n, None, "en", "c"), (n + 1, "", "en", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "1 AS size", "'z' AS _k", "2 AS _copies"
    )


def test_small_tables_need_no_other_kind_of_worker(spark):
    sizes = spark.sql("SELECT * FROM VALUES (null, 5L), ('b', 3L), ('a', 2L), ('b', 4L) AS t(_source, _size)")
    sources = source_table(sizes, (5, 2, 1), 3)
    assert [tuple(r)[:3] for r in sources.orderBy("_k").collect()] == [("a", 0, 2), ("b", 1, 7), (None, 2, 5)]
    assert [t for _, t in sources.dtypes] == ["string", "int", "bigint", "double"]
    units = spark.sql("SELECT 0 AS _k, id AS _id, id AS _size, id AS _text, 0.5D AS _p FROM range(9)")
    flights = _flights(units, {0: 1}, 0)
    assert flights.count() == 9
    for table in (sources, flights):
        assert "PythonRDD" not in table._jdf.queryExecution().toRdd().toDebugString()
    assert source_table(sizes.filter("false"), (5, 2, 1), 3).collect() == []


@pytest.mark.parametrize("block", [40, 5000])
def test_mix(spark, block):
    rows, docs = corpus(spark)
    first = mix(docs, block=block).collect()
    assert sorted(map(str, first)) == sorted(map(str, mix(docs.repartition(3), block=block).collect()))
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, targets([sizes[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))])))
    assert len(first) == len(rows)
    by_total = {sizes[s]: s for s in names}
    taken = Counter()
    for r in first:
        source = by_total[r.source_size]
        assert r.target == pytest.approx(goal[source])
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[source] += r.taken
    for s in names:
        assert abs(taken[s] - goal[s]) <= 0.02 * goal[s] + 20


def test_mixed_documents_are_those_of_the_mix(spark):
    _, docs = corpus(spark, 300)
    want = Counter()
    for r in mix(docs).collect():
        want[r.doc_id] += r.taken
    got, out = Counter(), mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        got[r.doc_id] += len((r.text or "").split())
    assert +got == +want


def test_no_rows_and_no_words(spark):
    _, docs = corpus(spark, 3)
    assert mix(docs.filter("false")).collect() == []
    empty = mix(spark.createDataFrame([(1, None, "s"), (2, " ", "s")], "doc_id long, text string, source string"))
    assert sorted((r.doc_id, r.target, r.taken) for r in empty.collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
