import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docmill.llm.lexical_packing import B, END_ID, K1, Index, Packer, best_first, pack
from docmill.llm.word_coder import coder

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_word_coder_equals_the_tokenizer_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    words = coder(PATH)
    assert np.frombuffer(words.encode([text])[0], words.dtype).tolist() == ids_of(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aAbeErstnghüéßñøłiIoO", min_size=1, max_size=70), max_size=12))
def test_word_coder_equals_the_tokenizer_on_words(found):
    words = coder(PATH)
    text = " ".join(found)
    assert np.frombuffer(words.encode([text])[0], words.dtype).tolist() == ids_of(text)


@pytest.mark.parametrize(
    "text",
    [
        "it's, they're; I'll DON'T! rock'n'roll o'clock. 'tis",
        "a\tb\nc\x0bd\x0ce\rf\x1cg\x1fh\x85i\xa0j k　l",
        "end.<|endoftext|> <|endoftext|>. x<|startoftext|>y <|ENDOFTEXT|> endoftext|>",
        "İstanbul ẞ ΣΑΣ ὈΔΥΣΣΕΎΣ. étude, ́x Å.",
        "x̸= != 12,345.67 a1b2 1. v2.0; ...wait?! —“quoted”, …) ).",
        "日本語、テスト。 русский; текст! עברית: \U0001f600\U0001f600, ﬁn. ŉ ǆ Ǆ, ʼn.",
        "word " * 400 + "x" * 3000,
        "",
    ],
)
def test_word_coder_on_hard_texts(text):
    words = coder(PATH)
    assert np.frombuffer(words.encode([text])[0], words.dtype).tolist() == ids_of(text)


def bm25(documents, query, idf, average):
    """Each document's score, term by term."""
    out = []
    for doc in documents:
        counts, score = Counter(doc.tolist()), 0.0
        for term in set(query.tolist()):
            f = counts[term]
            score += idf[term] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(doc) / average)) if f else 0.0
        out.append(score)
    return np.array(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=25), min_size=1, max_size=12), st.integers(0, 11))
def test_index_scores_equal_bm25(rows, which):
    documents = [np.array(r, dtype=np.uint16) for r in rows]
    idf = np.linspace(0.1, 3, 31)
    query = np.unique(documents[which % len(rows)]).astype(np.int64)
    got = Index(documents, idf, 7.5).scores(query)
    assert np.allclose(got, bm25(documents, query, idf, 7.5))


@given(st.lists(st.integers(0, 5), max_size=40), st.integers(1, 10))
def test_best_first_is_a_stable_sort(scores, most):
    values = np.array(scores, dtype=float)
    assert list(best_first(values, most)) == np.argsort(-values, kind="stable").tolist()


def test_a_window_is_filled_with_the_seeds_best_unused_neighbours():
    rng = np.random.default_rng(1)
    topics = [np.arange(k * 40, k * 40 + 40) for k in range(5)]
    documents = [rng.choice(topics[k % 5], 12).astype(np.uint16) for k in range(60)]
    idf = np.ones(200)
    packer = Packer(idf, 12.0, 0, window=64)
    pieces = packer.feed(list(range(60)), documents) + packer.close()
    windows = defaultdict(list)
    for key, start, length, *_ in pieces:
        windows[_[2]].append((key, start, length))
    used = set()
    for sequence in sorted(windows):
        seed, *rest = [key for key, _, _ in windows[sequence]]
        if sum(length for _, _, length in windows[sequence]) < 64:
            break
        used.add(seed)
        for key in rest:
            scores = bm25(documents, np.unique(documents[seed]), idf, 12.0)
            unused = [k for k in range(60) if k not in used]
            assert key == max(unused, key=lambda k: (round(scores[k], 9), -k))
            used.add(key)


def check_pieces(rows, pieces, window):
    """Each id in one piece, sequences without gaps, as long as the window or a power of two."""
    whole = Counter()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.length == len(p.ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window and at & (at - 1) == 0
    for key, text in rows:
        whole[key, tuple(ids_of(text) + [END_ID])] += 1
    for key, found in by_doc.items():
        want = sorted(ids for (k, ids), n in whole.items() if k == key for _ in range(n))
        assert sum(p.length for p in found) == sum(map(len, want))
        assert {p.doc_tokens for p in found} == {len(ids) for ids in want}
        if len(want) == 1:
            at, ids = 0, []
            for p in sorted(found, key=lambda p: p.start):
                assert p.start == at
                at += p.length
                ids += p.ids
            assert tuple(ids) == want[0]
    assert set(by_doc) == {key for key, _ in rows}
    return by_sequence


@pytest.mark.parametrize("shard_tokens", [300, 1 << 20])
def test_pieces_cover_every_document(spark, docs_of, shard_tokens):
    rng = np.random.default_rng(6)
    syllables = ["ba", "re", "tion", "ü", "queja", "the", "ont", "й"]

    def text(n):
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)) + "."

    rows = [(i, text(int(rng.integers(1, 120)))) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(200, 280)]  # a family of copies
    rows += [(300, None), (301, ""), (302, " \n"), (303, text(9000)), (None, text(40)), (7, rows[7][1]), (8, "other")]
    df = docs_of(rows).selectExpr("*", "1 AS ids", "2 AS start", "3 AS tie", "4 AS sequence_id")
    pieces = pack(df.repartition(4), PATH, window=256, with_ids=True, shard_tokens=shard_tokens).collect()
    check_pieces(rows, pieces, 256)


def test_copies_share_windows(spark, docs_of):
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in ("anti", "edro", "ilu", "osta", "une")]
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice(words, 40))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(60)]
    pieces = pack(docs_of(rows), PATH, window=1024, with_ids=True).collect()
    by_sequence = check_pieces(rows, pieces, 1024)
    together = sum(
        1 for i in range(60) if any({i, 100 + i} <= {p.doc_id for p in s} for s in by_sequence.values())
    )
    assert together >= 50


def test_no_rows_and_bad_window(spark, docs_of):
    df = docs_of([(1, "x")])
    assert pack(df.filter("false"), PATH).collect() == []
    with pytest.raises(ValueError):
        pack(df, PATH, window=1000)
    assert math.isclose(K1, 1.2)
