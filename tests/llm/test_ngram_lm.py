"""Scores against a dictionary model, and the sequences that the trie is made of."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm import levels
from docmill.llm.elias_fano import EliasFano, encode
from docmill.llm.ngram_lm import DISCOUNT, LEAST_COUNT, score_texts, tokens


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.lists(st.integers(0, 2**64 - 1)), st.integers(0, 64))
def test_sequences_find_what_they_hold(values, asked, bits):
    values = {v >> bits for v in values}
    asked = np.array([*values, *[a >> bits for a in asked]], dtype=np.uint64)
    ordered = np.array(sorted(values), dtype=np.uint64)
    sequence = EliasFano(encode(ordered, int(ordered[-1]) + 1 if values else 1))
    assert sequence.get(np.arange(len(ordered))).tolist() == ordered.tolist()
    at, found = sequence.successor(asked)
    assert found.tolist() == [int(x) in values for x in asked]
    assert ordered[at[found]].tolist() == asked[found].tolist()


def test_dense_and_repeated_values():
    values = np.sort(np.array([0, 0, 0, 5, 5, 6, *range(100, 400), 10_000], dtype=np.uint64))
    assert EliasFano(encode(values, 10_001)).get(np.arange(len(values))).tolist() == values.tolist()


def brute_force(train, texts):
    """(n_known, base, score) of each text by plain dictionaries, without quantisation."""
    one, two, three = Counter(), Counter(), Counter()
    for text in train:
        own = tokens(text)
        one.update(own)
        two.update(zip(own, own[1:], strict=False))
        three.update(zip(own, own[1:], own[2:], strict=False))
    two = {k: c for k, c in two.items() if c >= LEAST_COUNT}
    three = {k: c for k, c in three.items() if c >= LEAST_COUNT}
    kept1, kept2 = defaultdict(float), defaultdict(float)
    for (a, _), c in two.items():
        kept1[a] += c - DISCOUNT
    for (a, b, _), c in three.items():
        kept2[a, b] += c - DISCOUNT
    total = sum(one.values()) + len(one) + 1

    def p1(w):
        return (one[w] + 1) / total

    def p2(a, w):
        if a not in one:
            return p1(w)
        low = (1 - kept1[a] / one[a]) * p1(w)
        return low + ((two[a, w] - DISCOUNT) / one[a] if (a, w) in two else 0)

    def p3(a, b, w):
        if (a, b) not in two:
            return p2(b, w)
        low = (1 - kept2[a, b] / two[a, b]) * p2(b, w)
        return low + ((three[a, b, w] - DISCOUNT) / two[a, b] if (a, b, w) in three else 0)

    out = []
    for text in texts:
        own = tokens(text)
        score = 0.0
        for i, w in enumerate(own):
            p = p1(w) if i == 0 else p2(own[0], w) if i == 1 else p3(own[i - 2], own[i - 1], w)
            score += math.log10(p)
        base = sum(math.log10(p1(w)) for w in own)
        out.append((len(own), sum(w in one for w in own), sum(one.values()), base, score))
    return out


def check(spark, rows, learn_from="true", train=None):
    docs = spark.createDataFrame(rows, "doc_id long, text string, c string, key string")
    found = sorted(score_texts(docs, learn_from=learn_from).collect(), key=lambda r: (r[0] is None, r[0] or 0))
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = brute_force([r[1] for r in (train if train is not None else rows)], [r[1] for r in rows])
    assert len(found) == len(want)
    for have, expected in zip(found, want, strict=True):
        assert tuple(have[1:4]) == expected[:3]
        assert have[4] == pytest.approx(expected[3], rel=1e-9)
        assert have[5] == pytest.approx(expected[4], abs=2e-4 * expected[0] + 1e-9)


def test_scores_equal_a_dictionary_model(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        words = [f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 90))]
        rows.append((i, " ".join(words), "x", "y"))
    rows += [(200, None, None, None), (201, "", "", ""), (None, "W1 w1\tw2", "", ""), (5, rows[5][1], "", "")]
    check(spark, rows)
    monkeypatch.setattr(levels, "SEGMENT", 20)  # many segments
    check(spark, rows)


def test_learns_only_where_told(spark):
    rows = [(i, "a b c a b" if i % 2 else "x y a b", "", "") for i in range(20)]
    check(spark, rows, "_id % 2 = 1", [r for r in rows if r[0] % 2])


def test_nothing_to_learn_from(spark):
    rows = [(1, "a b", "", ""), (2, None, "", "")]
    check(spark, rows, "false", [])
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_what_was_seen_once_is_known(spark):
    rows = [(1, "a b c", "", ""), (2, "c a", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c string, key string")
    score = {r.doc_id: r.score for r in score_texts(docs).collect()}[1]
    # counts: a 2, b 1, c 2, end 2; 7 tokens, 4 words, so p(w) = (count + 1) / 12
    p_a, p_b, p_c, p_end = 3 / 12, 2 / 12, 3 / 12, 3 / 12
    ab = 0.5 / 2 + (1 - 1 / 2) * p_b  # a: b, end
    bc = 0.5 / 1 + (1 - 0.5 / 1) * p_c  # b: c
    abc = 0.5 / 1 + (1 - 0.5 / 1) * bc
    c_end = 0.5 / 2 + (1 - 1 / 2) * p_end  # c: end, a
    bc_end = 0.5 / 1 + (1 - 0.5 / 1) * c_end
    assert score == pytest.approx(math.log10(p_a * ab * abc * bc_end), abs=1e-3)


def test_pairs_behind_a_back_off_that_rounds_to_one_are_found(spark):
    # "id" keeps 1 of 5,001 occurrences at this discount: its back-off has the code 0
    text = " ".join(f"id n{max(i, 1)}" for i in range(5001))
    rows = [(1, text), (2, "id n1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = score_texts(docs, learn_from="_id = 1", discount=1.0).filter("doc_id = 2").first()
    total = 10_003 + 5_002 + 1
    p_id, p_n1, p_end = 5002 / total, 3 / total, 2 / total
    # (id, n1) and n1 are followed by id twice, of which 1 is kept and half is left to the end
    pair = 1 / 5001 + (1 - 1 / 5001) * p_n1
    assert learnt.score == pytest.approx(math.log10(p_id) + math.log10(pair) + math.log10(p_end / 4), abs=2e-3)
