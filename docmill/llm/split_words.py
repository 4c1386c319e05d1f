"""Words of many texts at once, each distinct one held once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


_OTHER, _LETTER, _TAIL, _SPACE = range(4)


def _kinds(tail: bytes) -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
    kinds[list(tail)] = _TAIL
    kinds[list(b" \t\n\v\f\r")] = _SPACE
    return kinds


def _apart(texts: list[bytes], tail: bytes) -> list[pa.Buffer | None]:
    """The buffers of an array of the texts with a blank between a word's last letter of
    ASCII and the characters of ``tail`` that end the word."""
    octets = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    kind = _kinds(tail)[octets]
    turns = np.flatnonzero(np.diff(kind == _TAIL)) + 1  # each run's begin and end, in turn
    if len(kind) and kind[0] == _TAIL:
        turns = turns[1:]
    begin, end = turns[::2], turns[1::2]
    begin = begin[(kind[begin - 1] == _LETTER) & (kind[end] == _SPACE)]
    data = np.insert(octets, begin, ord(" "))
    offsets = offsets + np.searchsorted(begin, offsets)
    return [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]


def parted(texts: list[bytes], tail: bytes = b"") -> tuple[bytes, np.ndarray, np.ndarray]:
    """(distinct words, joined by blanks; the number of each word among them; words of
    each text). Words are parted as by ``bytes.split``: at six ASCII characters; those
    of ``tail`` that end a word behind an ASCII letter are a word of their own."""
    buffers = _apart(texts, tail) if tail else pa.array(texts, pa.large_binary()).buffers()
    # only ASCII is looked at, so whether the bytes are UTF-8 does not matter
    split = pc.ascii_split_whitespace(
        pa.Array.from_buffers(pa.large_string(), len(texts), buffers, null_count=0)
    )
    offsets = split.offsets.to_numpy()
    encoded = split.values.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    found = encoded.dictionary
    # white space before the first word or behind the last leaves an empty one
    empty = pc.index(pc.binary_length(found), 0).as_py()
    if empty >= 0:
        kept = codes != empty
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        codes = codes[kept]
        codes = codes - (codes > empty)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(found), found.buffers(), null_count=0, offset=found.offset
    )
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(found)], found.cast(pa.binary())), b" ")[0].as_py()
    if empty >= 0:
        joined = b" ".join(joined.split())
    return joined, codes.astype(np.int64), np.diff(offsets).astype(np.int64)
