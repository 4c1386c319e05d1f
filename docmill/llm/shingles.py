"""64-bit hashes of words and of runs of words, for numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_MASK = (1 << 64) - 1
#: Bytes of a word that have a factor of their own; longer words are hashed one by one.
_LONGEST = 1024


def _factor(seed: int, place: int) -> np.uint64:
    """An odd 64-bit factor for a place in a run."""
    x = (seed * 0x9E3779B97F4A7C15 + (place + 1) * 0xD1B54A32D192ED03) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return np.uint64((x ^ (x >> 31)) | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The hash of each run of ``length`` words; none if there are fewer."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n] * _factor(seed, 0)
    for place in range(1, length):
        out += hashes[place : place + n] * _factor(seed, place)
    return mixed(out)


_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[list(b" \t\n\v\f\r")] = False
_FACTORS = np.array([_factor(97, place) for place in range(_LONGEST)], dtype=np.uint64)


def word_hashes(data: bytes) -> np.ndarray:
    """The hash of each word of a text: its bytes, each times the factor of its place,
    and its length. Equal words have equal hashes wherever they stand."""
    octets = np.frombuffer(data, dtype=np.uint8)
    inside = _IN_WORD[octets]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(octets) and inside[0]:
        turns = np.concatenate([[0], turns])
    if len(turns) % 2:
        turns = np.append(turns, len(octets))
    starts, ends = turns[::2], turns[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    place = np.arange(starts[0], len(octets)) - np.repeat(starts, np.diff(starts, append=len(octets)))
    values = octets[starts[0] :].astype(np.uint64) + np.uint64(1)
    values *= inside[starts[0] :]
    values *= _FACTORS[np.minimum(place, _LONGEST - 1)]
    out = np.add.reduceat(values, starts - starts[0])
    out = mixed(out + lengths.astype(np.uint64) * _FACTORS[0])
    for k in np.flatnonzero(lengths > _LONGEST):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out
