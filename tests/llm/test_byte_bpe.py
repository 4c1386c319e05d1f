import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm import byte_bpe
from docmill.llm.byte_bpe import ByteBPE, encode_decode, merge_piece

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = ByteBPE(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=TOKENIZER.ranks, special_tokens={}
)
TEXT = st.text(st.one_of(st.sampled_from(" \t\n\r\x0b\x1c\x1f\x85  　'aAbsdtlré1٣!,#"), st.characters(exclude_categories=("Cs",))), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_ids_are_those_of_the_library(text):
    ids = TOKENIZER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert TOKENIZER.decode(ids) == text.encode()


@pytest.mark.parametrize("piece", ["a" * 5000, "ab" * 3000, "thethere" * 700, "é" * 900, "xyz" * 33])
def test_long_pieces(piece):
    assert list(merge_piece(piece.encode(), TOKENIZER.ranks)) == LIBRARY.encode_ordinary(piece)


def test_short_and_long_pieces_merge_alike(monkeypatch):
    pieces = [("ther" * k + "ing" * (k % 5)).encode() for k in range(1, 24)]
    whole = [merge_piece(p, TOKENIZER.ranks) for p in pieces]
    monkeypatch.setattr(byte_bpe, "SHORT_PIECE", 1)
    assert [merge_piece(p, TOKENIZER.ranks) for p in pieces] == whole


TEXTS = [
    None,
    "",
    " ",
    "x",
    "The quick  brown fox's   12345 tails.\n\n  \tEnd ",
    "word " * 300,
    "w" * 400,  # no boundary in any overlap
    "ab " * 30 + "z" * 200 + " and on and on 77" * 20,
    "日本語のテキスト。" * 30,
    " " * 150 + "!" * 70 + "\n" * 60,
]


@pytest.mark.parametrize(("chunk", "overlap"), [(8, 8), (16, 5), (64, 20), (100_000, 10)])
def test_chunks_do_not_show(docs_of, chunk, overlap):
    rows = [*enumerate(TEXTS), (None, "no id " * 9), (4, "again, one id"), (5, TEXTS[5])]
    found = encode_decode(
        docs_of(rows), PATH, public_tokenizers.PATTERN, chunk_chars=chunk, overlap_chars=overlap,
        with_ids=True, with_decoded=True,
    ).collect()
    have = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids), bytes(r.decoded)) for r in found)
    want = []
    for i, text in rows:
        ids, data = LIBRARY.encode_ordinary(text or ""), (text or "").encode()
        joined = ",".join(map(str, ids)).encode()
        want.append((str(i), len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(data).hexdigest(), ids, data))
    assert have == sorted(want)


def test_empty_table_and_bad_overlap(docs_of):
    assert encode_decode(docs_of([]), PATH, public_tokenizers.PATTERN).collect() == []
    with pytest.raises(ValueError):
        encode_decode(docs_of([]), PATH, public_tokenizers.PATTERN, chunk_chars=4, overlap_chars=5)
