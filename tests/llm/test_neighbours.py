import random

import numpy as np

from docmill.llm.neighbours import TERMS, Voter, terms_of, vote_quality
from docmill.llm.queries import op5_quality_classifier


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
        good = i % 3 > 0
        out.append((i, " ".join(words) if good else "!! ".join(words).upper(), int(good)))
    return out


def test_held_out_accuracy_and_odd_rows(spark):
    data = rows(300, 1)
    odd = [(900, None), (901, ""), (902, "ab"), (None, data[0][1]), (5, data[5][1]), (903, "x" * 200_000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + odd, "doc_id long, text string").selectExpr(
        "*", "0.5 AS score", "1 AS label", "'x' AS _id"
    )
    marks = [(i, q) for i, _, q in data] + [(None, 1), (900, 0), (901, None), (902, 7), (7777, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = vote_quality(docs, labels, learn_from="_id % 2 = 0", sample=100).collect()
    assert len(found) == len(docs.collect())
    truth = {i: q for i, _, q in data}
    held = [r for r in found if r.doc_id in truth and r.doc_id % 2]
    assert all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id in (900, 901)}
    assert len(empty) == 1 and 0 < empty.pop() < 1
    assert vote_quality(docs.filter("false"), labels).collect() == []
    assert {r.score for r in vote_quality(docs, labels, learn_from="false").collect()} == {0.5}


def test_vote_equals_plain_neighbours():
    data = rows(120, 4)
    terms = np.stack([terms_of(t) for _, t, _ in data])
    assert terms.shape[1] == TERMS
    voter = Voter(terms[:90].copy(), np.array([q for *_, q in data[:90]]), rank=20)
    scores = voter.score(terms[90:], neighbours=5)
    for row, score in zip(terms[90:], scores):
        v = row * voter.weight
        z = (v / np.linalg.norm(v)) @ voter.axes
        cosine = voter.latent @ (z / np.linalg.norm(z))
        close = np.argsort(-cosine)[:5]
        weight = np.clip(cosine[close], 0, 1) ** 8
        assert abs(score - (weight * voter.labels[close]).sum() / weight.sum()) < 1e-4


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = [r for r in op5_quality_classifier(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in found) / len(found) > 0.9
