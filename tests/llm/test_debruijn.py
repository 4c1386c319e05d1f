import hashlib
import random

import numpy as np
import pytest

from docmill.llm import debruijn
from docmill.llm.debruijn import remove_repeats


def brute_force(rows, k=13):
    own = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), words in zip(rows, own, strict=True):
        for at in range(len(words) - k + 1):
            key = tuple(words[at : at + k])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), words in zip(rows, own, strict=True):
        gone = set()
        for at in range(len(words) - k + 1):
            if i is not None and first[tuple(words[at : at + k])] < i:
                gone.update(range(at, at + k))
        kept = b" ".join(w for at, w in enumerate(words) if at not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def text(rng, n, of=50):
    return " ".join(f"w{rng.randrange(of)}" for _ in range(n))


@pytest.mark.parametrize("vocabulary", [2, 50, 10**6])
def test_equals_brute_force(docs_of, vocabulary):
    rng = random.Random(vocabulary)
    passages = [text(rng, n, vocabulary) for n in (12, 13, 14, 60, 200)]
    texts = []
    for _ in range(120):
        parts = [text(rng, rng.randrange(30), vocabulary)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), text(rng, rng.randrange(20), vocabulary)]
        texts.append("\n".join(parts))
    texts += [texts[0], texts[0], None, "", " ", "the " * 40, "the " * 40, passages[3] + " " + passages[3]]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[5]), (None, passages[4]), (7, passages[3])]
    found = remove_repeats(docs_of(rows)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in found) == brute_force(rows)


def test_colliding_keys_are_told_apart(docs_of, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join([text(rng, 20), "q " * 9, text(random.Random(i % 5), 15)])) for i in range(30)]
    strong = debruijn.Windows.edges

    def weak(self, hashes):
        key, check, other = strong(self, hashes)
        return key % np.uint64(7), check, other

    monkeypatch.setattr(debruijn.Windows, "edges", weak)
    found = remove_repeats(docs_of(rows)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in found) == brute_force(rows)


def test_kept_text_and_carried_columns(docs_of):
    long = " ".join(f"v{i}" for i in range(20))
    rows = [(1, "a  b\n" + long), (2, "c\t" + long + "  d"), (3, "plain  text")]
    found = remove_repeats(docs_of(rows), carried=["lang", "_id"], with_text=True).collect()
    assert sorted((r.doc_id, r.kept_text, r.lang, r["_id"]) for r in found) == [
        (1, "a  b\n" + long, "en", "x"), (2, "c d", "en", "x"), (3, "plain  text", "en", "x")
    ]


def test_empty_table(docs_of):
    assert remove_repeats(docs_of([])).collect() == []


def test_an_id_of_which_one_text_is_a_copy(docs_of):
    rng = random.Random(6)
    one, other = text(rng, 30, 10**6), text(rng, 40, 10**6)
    rows = [(1, one), (2, one), (2, other), (3, "x " + other), (4, one)]
    found = remove_repeats(docs_of(rows)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in found) == brute_force(rows)
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (2, 0), (2, 30), (3, 40), (4, 30)]
