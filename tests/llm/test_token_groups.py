import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm import components, token_groups
from docmill.llm.token_groups import enough_shared, jaccard_components, links, prefix


def shingles(text):
    own = (text or "").encode().lower().split()
    if not own:
        return frozenset()
    if len(own) < 5:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and 100 * both >= 80 * either:
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), len(s), str(least.get(find(k)))) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def family(rng, n, words, changes):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("group", [3, 256])
@pytest.mark.parametrize("sample", [1, 16])
def test_components_equal_brute_force(docs_of, monkeypatch, group, sample):
    monkeypatch.setattr(token_groups, "SAMPLE_ONE_IN", sample)
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = family(rng, 30, 60, 3) + family(rng, 25, 30, 2) + family(rng, 12, 200, 12)
    texts += [passage + " " + f for f in family(rng, 15, 25, 25)]
    texts += [passage + f" y{i} z{i}" for i in range(10)] + [texts[0]] * 8
    texts += ["", None, "A b", "a B", "a b c d", "  a\tb ", "a b c d e", "A B C D E", "É a b", "é a b"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, None)]
    found = jaccard_components(docs_of(rows), group=group).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute_force(rows)


def test_one_python_step_in_a_task(spark):
    """The bound and the comparison are steps of their own: a task holds one Python worker."""
    sets = [np.arange(k, k + 10, dtype=np.uint64) for k in (0, 1, 50)]
    rows = [(g, [g], [s.tobytes()], None) for g, s in zip("xyz", sets, strict=True)]
    groups = spark.createDataFrame(rows, "_g string, _names array<string>, _sets array<binary>, _union binary")
    pairs = spark.createDataFrame([("x", "y"), ("x", "z")], "a string, b string")
    found = token_groups._outer_links(pairs, groups, 80)
    assert [tuple(r) for r in found.collect()] == [("x", "y")]
    plan = found._jdf.queryExecution().executedPlan()
    assert plan.toString().split("Initial Plan")[0].count("MapInPandas") == 1


def test_no_plan_holds_a_table_many_times(docs_of, monkeypatch):
    """The driver plans a query anew after each stage: what it holds follows the plan's size."""
    read = {}
    for module in (components, token_groups):

        def noted(df, name, *rest, write=module.written):
            read[name] = max(read.get(name, 0), df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
            return write(df, name, *rest)

        monkeypatch.setattr(module, "written", noted)
    rng = random.Random(3)
    texts = family(rng, 12, 60, 3) + family(rng, 10, 30, 2)
    rows = list(enumerate(texts))
    found = jaccard_components(docs_of(rows), group=3).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute_force(rows)
    assert {"edges", "group-pairs", "set-links", "set-names"} <= set(read)
    assert max(read.values()) <= 4, read


def test_components_of_a_path(spark):
    """A path, a cycle, a loop, repeated and reversed edges, and ends that are null."""
    edges = [(i, i + 1) for i in range(10, 30)] + [(41, 40), (42, 41), (40, 42), (42, 41), (7, 7), (None, 1), (2, None)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = [(i, 10) for i in range(10, 31)] + [(i, 40) for i in (40, 41, 42)]
    assert sorted(map(tuple, found.collect())) == want


def test_empty_table(docs_of):
    assert jaccard_components(docs_of([])).collect() == []


def test_repeated_ids_keep_their_rows(docs_of):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words than those here now"), (2, "a b c d e f")]
    found = jaccard_components(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (1, 1), (2, 1)]


SETS = st.sets(st.integers(0, 60), min_size=1, max_size=61)


@settings(max_examples=300, deadline=None)
@given(SETS, SETS, st.sets(st.integers(0, 60)))
def test_similar_sets_share_a_prefix_token(a, b, frequent):
    x, y, late = (np.array(sorted(s), dtype=np.uint64) for s in (a, b, frequent))
    similar = 100 * len(a & b) >= 80 * len(a | b)
    assert links([x], [y], 80)[0, 0] == similar
    if similar:
        shared = len(set(prefix(x, late).tolist()) & set(prefix(y, late).tolist()))
        assert shared > 0
        assert enough_shared(len(x), shared)
        assert enough_shared(len(y), shared)
