"""Counts of 64-bit keys, added up by ranges of keys and written as segments of a level.

A task sorts and counts the keys of a few chunks and sends each range's share as one row:
the differences of neighbouring keys and the counts, byte by byte. Spark brings the rows of
a range together, and the task that has them writes the range's segment. Rows of single
keys would cost the JVM more than all else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm import levels
from docmill.llm.common import done_with, written
from docmill.llm.elias_fano import encode
from docmill.llm.shingles import mixed

#: Keys that a task holds before it counts them, and before it adds counts up.
HELD = 3_000_000
#: Occurrences in the sample that parts keys into ranges, and sampled keys for each range.
_SAMPLE, _PER_RANGE, _MOST_SAMPLED = 2_000_000, 100, 400_000

RUNS = "range int, first decimal(20,0), n int, steps binary, counts binary"


def _bytes(values: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, then the next ones, as many as the largest needs."""
    width = max(1, -(-int(values.max()).bit_length() // 8))
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    width = len(data) // n
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def narrow(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need; ``Level.numbers`` tells by the file's size."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    new = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
    return joined[new], np.add.reduceat(np.concatenate(counts)[order], new)


def runs(chunks: Iterable[tuple[np.ndarray, np.ndarray | None]], bounds: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows of ``RUNS`` for chunks of (keys, counts); without counts each key counts once."""
    keys, counts, n = [], [], 0
    for part, times in chunks:
        if not len(part):
            continue
        keys.append(part)
        counts.append(times)
        n += len(part)
        if n > HELD:
            yield _run(keys, counts, bounds)
            keys, counts, n = [], [], 0
    if n:
        yield _run(keys, counts, bounds)


def _run(keys: list[np.ndarray], counts: list, bounds: np.ndarray) -> pd.DataFrame:
    if counts[0] is None:
        own, times = np.unique(np.concatenate(keys), return_counts=True)
    else:
        own, times = _added(keys, counts)
    cut = np.concatenate([[0], np.searchsorted(own, bounds), [len(own)]])
    rows = []
    for k in np.flatnonzero(np.diff(cut)).tolist():
        part = own[cut[k] : cut[k + 1]]
        steps = np.concatenate([[np.uint64(0)], np.diff(part)])
        rows.append((k, Decimal(int(part[0])), len(part), _bytes(steps), _bytes(times[cut[k] : cut[k + 1]])))
    return pd.DataFrame(rows, columns=["range", "first", "n", "steps", "counts"])


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a range with their counts; few more than those are held at a time."""
    keys, counts, held = [], [], 0
    for first, n, steps, times in zip(rows["first"], rows["n"], rows["steps"], rows["counts"], strict=True):
        keys.append(np.cumsum(_numbers(steps, n)) + np.uint64(int(first)))
        counts.append(_numbers(times, n).astype(np.int64))
        held += n
        if held > HELD:
            found = _added(keys, counts)
            keys, counts, held = [found[0]], [found[1]], 0
    return _added(keys, counts)


def count_segments(rows: DataFrame, folder: str, name: str) -> tuple[list[tuple], int]:
    """The segments (first key, n, key file, {"count": file}) of a level, and the sum of all counts."""

    def write(part: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(part)
        first, total = int(keys[0]), int(counts.sum())
        file = levels.save(folder, encode(keys - np.uint64(first), int(keys[-1]) - first + 1))
        side = levels.save(folder, narrow(counts))
        return pd.DataFrame(
            {"first": [Decimal(first)], "n": [len(keys)], "total": [total], "keys": [file], "count": [side]}
        )

    schema = "first decimal(20,0), n long, total long, keys string, count string"
    files = written(rows.groupBy("range").applyInPandas(write, schema), name, free_shuffles=True)
    found = files.collect()  # one row per segment
    done_with(files)
    segments = sorted((int(r["first"]), r["n"], r["keys"], {"count": r["count"]}) for r in found)
    return segments, sum(r["total"] for r in found)


def even_bounds(ranges: int) -> np.ndarray:
    """Bounds of equal ranges of all 64-bit numbers, for hashes."""
    return np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)


def sampled_bounds(rows: DataFrame, keys_of, n: int) -> np.ndarray:
    """Bounds of ranges of about ``SEGMENT`` keys, from a sample of the rows that the
    ``n`` occurrences come from. They decide how long segments are, never what they hold."""
    ranges = -(-n // levels.SEGMENT)
    if ranges <= 1:
        return np.zeros(0, dtype=np.uint64)
    share = min(1.0, _SAMPLE / n)
    thin = max(1, int(levels.SEGMENT * share / _PER_RANGE), min(n, _SAMPLE) // _MOST_SAMPLED)

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys in keys_of(batches):
            own = np.unique(keys)
            yield pd.DataFrame({"key": own[mixed(own) % np.uint64(thin) == 0].view(np.int64)})

    some = rows if share == 1.0 else rows.sample(share, seed=1)
    found = some.mapInPandas(sample, "key long").distinct().agg(F.sort_array(F.collect_list("key"))).first()[0]
    keys = np.array(found, dtype=np.int64).view(np.uint64)
    at = np.unique(np.arange(1, ranges) * len(keys) // ranges)
    return keys[at[at > 0]] if len(keys) else keys
