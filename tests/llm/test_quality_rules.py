import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.quality_rules import (
    FEATURES,
    LEAST_SPREAD,
    chi2_quantile,
    consistency,
    quality_rules,
    repeated_words,
    sound_documents,
    statistics_of,
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    gone = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            gone.update(range(i, i + 8))
    assert repeated_words(words) == len(gone)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aé#*|\n\t A日 \x0b"), max_size=80))
def test_statistics(text):
    words = [w for w in __import__("re").split("[ \t\n\x0b\x0c\r]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    n, chars, symbols, dup, repeats, *_ = statistics_of(text)
    assert (n, chars) == (len(words), sum(map(len, words)))
    assert symbols == sum(c in "#*$%&|<>" for c in text)
    assert dup == len(lines) - len(set(lines))


def test_quantiles():
    assert chi2_quantile(0.05, 6) == pytest.approx(12.5916, abs=1e-3)
    assert chi2_quantile(0.25, 6) == pytest.approx(7.8408, abs=1e-3)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400_000, 6))
    d = (x * x).sum(axis=1)
    assert x[d <= np.quantile(d, 0.75)].var(axis=0).mean() * consistency(0.75, 6) == pytest.approx(1, abs=0.01)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def brute_force(rows, least):
    """Concentration steps over each group, in numpy."""
    stats = [statistics_of(t) for _, t, _, _ in rows]
    failed = [s[0] < 20 or 100 * s[4] > 30 * s[0] for s in stats]
    groups = {}
    for k, (_, _, lang, source) in enumerate(rows):
        if not failed[k]:
            groups.setdefault((lang, source), []).append(k)
    floors = np.array(list(LEAST_SPREAD.values()))

    def estimate(members):
        x = np.array([stats[k][5:] for k in members])
        mean, inverse = np.median(x, axis=0), np.diag(1 / floors**2)
        for _ in range(5):
            d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
            near = x[d <= np.quantile(d, 0.75)]
            mean = near.mean(axis=0)
            cov = np.cov(near.T, bias=True) * consistency(0.75, len(FEATURES))
            inverse = np.linalg.inv(cov + np.diag(floors**2))
        return mean, inverse

    sound = [k for k in range(len(rows)) if not failed[k]]
    pool = estimate(sound) if len(sound) >= least else None
    own = {g: estimate(m) for g, m in groups.items() if len(m) >= least}
    out = []
    for k, (_, _, lang, source) in enumerate(rows):
        mean_inverse = own.get((lang, source), pool)
        distance = None
        if mean_inverse:
            away = np.array(stats[k][5:]) - mean_inverse[0]
            distance = float(away @ mean_inverse[1] @ away)
        out.append((failed[k], distance))
    return out


def test_a_text_is_read_once_a_pass(spark, tmp_path):
    rows = [(i, " ".join(f"w{i + j}" for j in range(30)), "en", "s") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/docs")
    kept = sound_documents(spark.read.parquet(f"{tmp_path}/docs"))
    assert kept.count() == 20
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_rejects_what_brute_force_rejects(spark):
    rng = random.Random(2)
    rows = []
    for i in range(700):
        lang, source = rng.choice([("en", "a"), ("en", "a"), ("de", None)])
        rows.append((i, prose(rng, rng.randrange(20, 300)), lang, source))
    junk = ["x#*$%&| " * 60, "SHOUTED WORDS " * 2 + prose(rng, 80).upper(), "line one two\n" * 3 + prose(rng, 60), "| a | b |\n" + "| % | # |\n" * 30]
    rows += [(1000 + i, t, "en", "a") for i, t in enumerate(junk)]
    rows += [(2000, None, None, None), (2001, "", "en", "a"), (None, prose(rng, 50), "en", "a"), (3, rows[3][1], "fr", "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "1 AS n_words", "'x' AS _group", "2 AS distance"
    )
    found = quality_rules(docs, least_rows=100).collect()
    limit = chi2_quantile(1e-9, len(FEATURES))
    want = Counter()
    for (i, text, *_), (failed, distance) in zip(rows, brute_force(rows, 100)):
        assert distance is None or abs(distance - limit) > 0.1 * limit  # none so close that a quantile decides
        want[str(i), statistics_of(text)[:5], failed, not failed and distance <= limit] += 1
    got = Counter(
        (str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed, r.kept)
        for r in found
    )
    assert got == want
    assert not any(r.kept for r in found if r.doc_id in (1000, 1001, 1003))
    assert all(r.kept for r in found if r.doc_id is not None and r.doc_id < 700)
    kept = sound_documents(docs, least_rows=100)
    assert kept.columns == docs.columns
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(str(r.doc_id) for r in found if r.kept)


def test_few_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "w " * 7), (2, " ".join(map(str, range(30))))], "doc_id long, text string")
    docs = docs.selectExpr("*", "'en' AS lang", "'s' AS source")
    assert sorted((r.doc_id, r.kept) for r in quality_rules(docs).collect()) == [(1, False), (2, True)]
    assert quality_rules(docs.filter("false")).collect() == []


def capitals(rng, n):
    return " ".join(w.capitalize() if rng.random() < 0.8 else w for w in prose(rng, n).split())


def test_small_groups_are_judged_by_themselves(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(50, 200)), "en", "a") for i in range(400)]
    rows += [(1000 + i, capitals(rng, rng.randrange(50, 200)), "de", "b") for i in range(60)]
    rows += [(2000, prose(rng, 100), "de", "b"), (2001, capitals(rng, 100).upper(), "de", "b"), (2002, capitals(rng, 90), "fr", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules(docs).collect()}
    assert sorted(i for i in kept if not kept[i]) == [2000, 2001]


@pytest.mark.parametrize("n", [25, 199])
def test_one_more_row_moves_distances_little(spark, n):
    rng = random.Random(n)
    rows = [(i, prose(rng, rng.randrange(50, 200)), "en", "a") for i in range(300)]
    rows += [(1000 + i, capitals(rng, rng.randrange(50, 200)), "de", "b") for i in range(n)]
    rows += [(2000, capitals(rng, 100).upper(), "de", "b")]
    more = [*rows, (3000, capitals(rng, 120), "de", "b")]
    schema = "doc_id long, text string, lang string, source string"
    one, two = (
        {r.doc_id: r.distance for r in quality_rules(spark.createDataFrame(x, schema)).collect()} for x in (rows, more)
    )
    assert two[2000] == pytest.approx(one[2000], rel=0.25)
    assert all(two[i] == pytest.approx(one[i], rel=0.25, abs=0.5) for i in one)
