import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docmill.llm import word_coder
from docmill.llm.lexical_packing import Index, least_pairs
from docmill.llm.shingles import mixed
from docmill.llm.word_coder import WordCoder

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def test_a_word_is_learnt_once_whatever_its_case_and_punctuation():
    words = WordCoder(PATH)
    text = "Window, window. WINDOW! wInDow*** window%%% window"
    found = words.encode([text])[0]
    assert np.frombuffer(found, words.dtype).tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    assert [w for w in words.known if b"window" in w.lower()] == [b"window"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aTHJy'.,;*&%$#<|> \n1é̸̱́İẞ", max_size=25), max_size=5))
def test_texts_with_marks_and_punctuation_equal_the_tokenizer(texts):
    words = WordCoder(PATH) if not _ONE else _ONE[0]
    _ONE[:] = [words]
    for text, found in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(found, words.dtype).tolist() == PLAIN.encode(text, add_special_tokens=False).ids


_ONE: list[WordCoder] = []


@pytest.mark.parametrize("text", ["H̱, T̈.", "x<|ENDOFTEXT|>.", "Q<|endoftext|>, a", "oneuxè, éaux***", ".,a", ""])
def test_what_lower_case_could_change(text):
    words = WordCoder(PATH)
    assert np.frombuffer(words.encode([text])[0], words.dtype).tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_forgotten_words_are_found_again(monkeypatch):
    monkeypatch.setattr(word_coder, "MOST_WORDS", 3)
    words = WordCoder(PATH)
    for text in ["one two three four", "five six one", "seven one, eight nine", "one two three", None]:
        ids = np.frombuffer(words.encode([text])[0], words.dtype).tolist()
        assert ids == PLAIN.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.lists(st.integers(0, 65535), min_size=1, max_size=6), min_size=1, max_size=8))
def test_least_pairs_of_each_document(rows):
    ids = np.concatenate([np.array(r, dtype=np.uint16) for r in rows])
    sizes = np.array([len(r) for r in rows])
    want = []
    for row in rows:
        pairs = [a << 32 | b for a, b in zip(row, row[1:], strict=False)] or row
        want.append(min(int(x) >> 1 for x in mixed(np.array(pairs, dtype=np.uint64))))
    assert least_pairs(ids, np.cumsum(sizes) - sizes).tolist() == want


def test_scores_stay_when_used_documents_leave_the_index():
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint16) for _ in range(60)]
    index = Index(documents, rng.random(50), 20.0)
    query = np.unique(documents[0]).astype(np.int64)
    before, size = index.scores(query), len(index.owner)
    unused = rng.random(60) < 0.5
    index.keep(unused)
    assert (index.scores(query)[unused] == before[unused]).all()
    assert len(index.owner) < size
