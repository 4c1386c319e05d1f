from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm import counted_keys
from docmill.llm.levels import distinct
from docmill.llm.ngram_lm import score_texts
from docmill.llm.split_words import parted

KEYS = st.integers(0, 40) | st.integers(0, 2**64 - 1)


@given(st.lists(st.binary(max_size=30) | st.text("ab \t\n\x0b\x0c\r\x1c\x85é", max_size=20).map(str.encode)))
def test_words_are_those_of_split(texts):
    joined, codes, sizes = parted(texts)
    words = joined.split()
    found = [words[k] for k in codes]
    ends = np.cumsum(sizes).tolist()
    assert [found[e - n : e] for e, n in zip(ends, sizes.tolist(), strict=True)] == [t.split() for t in texts]
    assert len(set(words)) == len(words)


@given(st.lists(KEYS))
def test_distinct_equals_unique(values):
    values = np.array(values, dtype=np.uint64)
    own, back = distinct(values)
    assert own.tolist() == sorted(set(values.tolist()))
    assert own[back].tolist() == values.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(KEYS, min_size=1), min_size=1), st.lists(KEYS), st.integers(1, 50))
def test_runs_of_all_chunks_add_up(chunks, bounds, held):
    bounds = np.unique(np.array(bounds, dtype=np.uint64))
    chunks = [np.array(c, dtype=np.uint64) for c in chunks]
    before, counted_keys.HELD = counted_keys.HELD, held
    try:
        plain = list(counted_keys.runs(((c, None) for c in chunks), bounds))
        twice = list(counted_keys.runs(((c, np.full(len(c), 300)) for c in chunks), bounds))
        for frames, times in ((plain, 1), (twice, 300)):
            found, last = {}, -1
            rows = [row for frame in frames for _, row in frame.iterrows()]
            for k in sorted({row["range"] for row in rows}):
                part = frames[0].iloc[:0].copy()
                for row in rows:
                    if row["range"] == k:
                        part.loc[len(part)] = row
                keys, counts = counted_keys._merged(part)
                assert int(keys[0]) > last and (np.diff(keys) > 0).all()
                last = int(keys[-1])
                found.update(zip(keys.tolist(), counts.tolist(), strict=True))
            want = Counter(k for c in chunks for k in c.tolist())
            assert found == {k: n * times for k, n in want.items()}
    finally:
        counted_keys.HELD = before


def test_scoring_leaves_no_shuffle_of_its_n_grams(spark, docs_of):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        own = {files.apply(k).getName(): files.apply(k).length() for k in range(files.size())}
        return {name: size for name, size in own.items() if name.startswith("shuffle_")}

    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 400))) for i in range(200)]
    before = shuffled()
    assert score_texts(docs_of(rows).repartition(4)).count() == 200
    left = sum(size for name, size in shuffled().items() if name not in before)
    # a row for each pair and triple would leave more than 16 bytes a token behind
    assert left < 4 * 200 * 401
