"""Ids of texts by way of their words, for a BPE tokenizer with word ends.

White space parts a text before everything else, so the ids of a text are those of its
words in turn, and each word is encoded once while it is remembered. Words of Latin letters alone,
which are nearly all, are merged side by side in arrays; others go to the library.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from docmill.llm.common import utf8
from docmill.llm.split_words import parted

#: New words after which a worker forgets those that it has not met since as many before.
MOST_WORDS = 1_000_000
#: Longer words go to the library.
_LONGEST = 64
_TAIL = b".,;:!?*&%$#"
#: Words that are merged at once; their arrays stay in a core's cache.
_SIDE_BY_SIDE = 1 << 14
_NONE = np.int64(1) << np.int64(62)
_PLACE = 40


class Merges:
    """The merges of a BPE model, for many words at a time."""

    def __init__(self, tokenizer: Tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        # of merges that are listed twice the library keeps the last
        order = np.lexsort((np.arange(len(keys)), keys))
        order = order[np.append(keys[order][1:] != keys[order][:-1], True)]
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[pairs[k][0] + pairs[k][1]] for k in order], dtype=np.int64)
        self.inner, self.last = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
        for byte in range(256):
            symbol = _SYMBOLS[byte]
            self.inner[byte], self.last[byte] = vocab.get(symbol, -1), vocab.get(symbol + end, -1)
        # all pairs of bytes, the second one inside or at the end of its word
        left, right = np.repeat(self.inner, 512), np.tile(np.append(self.inner, self.last), 256)
        self.first_rank, self.first_merged = self._rank(left, right)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair and what it becomes; ``_NONE`` where it is no merge."""
        asked = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        found = self.keys[at] == asked
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def encode(self, words: list[bytes], dtype: np.dtype) -> list[bytes]:
        """Each word's ids as bytes. A round merges the first of the lowest pairs of every word
        that has one, as the library does one word after another."""
        out: list[bytes] = [b""] * len(words)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.inner[data]
        stops = np.cumsum(sizes) - 1
        ids[stops] = self.last[data[stops]]
        open_ = np.arange(len(words))
        second = data.astype(np.int64)
        second[stops] += 256
        pair = data[:-1].astype(np.int64) * 512 + second[1:]
        rank, merged = np.append(self.first_rank[pair], _NONE), np.append(self.first_merged[pair], 0)
        rank[stops] = _NONE
        while len(open_):
            starts = np.cumsum(sizes) - sizes
            keys = np.where(rank < _NONE, rank << _PLACE | np.arange(len(ids)), _NONE)
            best = np.minimum.reduceat(keys, starts)
            done = best == _NONE
            if done.any():
                codes, width = ids.astype(dtype).tobytes(), dtype.itemsize
                ends = (starts + sizes) * width
                for k in np.flatnonzero(done).tolist():
                    out[open_[k]] = codes[starts[k] * width : ends[k]]
            at = best[~done] & ((1 << _PLACE) - 1)
            ids[at] = merged[at]
            kept = np.repeat(~done, sizes)
            kept[at + 1] = False
            moved = np.cumsum(kept)[at] - 1
            ids, rank, merged = ids[kept], rank[kept], merged[kept]
            open_, sizes = open_[~done], sizes[~done] - 1
            # only the pairs to either side of what was merged are new ones
            ends = np.cumsum(sizes) - 1
            right = moved[moved < ends]
            rank[right], merged[right] = self._rank(ids[right], ids[right + 1])
            rank[ends] = _NONE
            left = moved[moved > ends - sizes + 1] - 1
            rank[left], merged[left] = self._rank(ids[left], ids[left + 1])
        return out


def _symbols() -> list[str]:
    """The characters that stand for bytes in a byte-level vocabulary: a byte's own where
    it is printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


_SYMBOLS = _symbols()


class WordCoder:
    def __init__(self, path: str):
        # a task has one core, and forked threads would hang
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.merges = Merges(self.tokenizer)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        known = self.known
        plain = [word for word in words if word.isalpha() and len(word) <= _LONGEST]
        lowered = [word.lower() for word in plain]
        # words whose last letter is not ASCII still have their punctuation
        tailed: list[tuple[bytes, bytes, bytes]] = []
        new: set[bytes] = set()
        for word in set(words).difference(plain):
            stem = word.rstrip(_TAIL)
            if len(stem) < len(word) and stem[-1:] >= b"\x80" and _latin(stem):
                tail = word[len(stem) :]
                tailed.append((word, stem, tail))
                new.add(tail)
                new.add(stem)
            else:
                new.add(word)
        others = []
        for part in new.difference(known):
            low = _latin(part)
            if low is None or len(low) > _LONGEST:
                others.append(part)
            else:
                plain.append(part)
                lowered.append(low)
        for at in range(0, len(plain), _SIDE_BY_SIDE):
            found = self.merges.encode(lowered[at : at + _SIDE_BY_SIDE], self.dtype)
            known.update(zip(plain[at : at + _SIDE_BY_SIDE], found, strict=True))
        texts = [part.decode("utf-8", "replace") for part in others]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for part, encoding in zip(others, found, strict=True):
            known[part] = np.array(encoding.ids, dtype=self.dtype).tobytes()
        for word, stem, tail in tailed:
            known[word] = known[stem] + known[tail]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes; null and empty texts have none."""
        joined, codes, sizes = parted([_lower(utf8(text)) for text in texts], _TAIL)
        words = joined.split()
        if not words:
            return [b""] * len(texts)
        if len(self.known) > MOST_WORDS:
            self.known, self.older = {}, self.known
        new = [word for word in words if word not in self.known]
        if new:
            again = list(map(self.older.get, new))
            self.known.update((w, ids) for w, ids in zip(new, again, strict=True) if ids is not None)
            self._learn([w for w, ids in zip(new, again, strict=True) if ids is None])
        ids = pa.array([self.known[w] for w in words], pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        data = ids.buffers()[2].to_pybytes()
        return [data[begin:end] for begin, end in zip(ends[:-1], ends[1:], strict=True)]


def _lower(text: bytes) -> bytes:
    """A-Z in lower case, as the tokenizer sees them, unless that could matter: in special
    tokens, and before marks (U+0300 to U+037F) that combine with small letters only."""
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text
    return text.lower()


def _latin(word: bytes) -> bytes | None:
    """The word in lower case, if it holds nothing but letters that stand before U+0250 and
    stay single letters; such words look the same in every normal form."""
    text = word.decode("utf-8", "replace")
    if not text or max(text) >= "ɐ":
        return None
    low = text.lower()
    return low.encode() if low.isalpha() else None


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """The coder of a file, kept by the worker."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]
