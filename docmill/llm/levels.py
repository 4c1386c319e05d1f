"""Sorted keys in segments of the shared folder, which tasks map into memory.

Spark sorts the keys into ranges; the task that holds a range writes it in Elias-Fano
form, with arrays that run alongside. A table of file names is all that travels.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import done_with, written
from docmill.llm.elias_fano import EliasFano, encode
from docmill.session import scratch_path

#: Keys in a segment.
SEGMENT = 1_500_000
#: Segments that a worker holds of a store that cannot be mapped.
_MOST_READ = 16
NONE = -1


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of the shared one, as a URI."""
    folder = scratch_path(spark, name)
    return folder if ":/" in folder else f"file://{folder}"


def save(folder: str, array: np.ndarray) -> str:
    """Write an array under a name of its own; each attempt of a task has another."""
    store, base = arrow_fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    name = uuid.uuid4().hex
    with store.open_output_stream(f"{base}/{name}") as out:
        out.write(np.ascontiguousarray(array).view(np.uint8).data)
    return name


def mapped(folder: str, name: str, dtype) -> np.ndarray:
    """Map a segment into memory; one in a store that cannot be mapped is read."""
    store, base = arrow_fs.FileSystem.from_uri(folder)
    path = f"{base}/{name}"
    if isinstance(store, arrow_fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=dtype)
    with store.open_input_stream(path) as source:
        return np.frombuffer(source.read(), dtype=dtype)


def _most_open(folder: str) -> int:
    """Segments that stay open: all that are mapped, few of those that had to be read."""
    local = isinstance(arrow_fs.FileSystem.from_uri(folder)[0], arrow_fs.LocalFileSystem)
    return 1 << 30 if local else _MOST_READ


class Level:
    """Segments of one level: keys in order, and arrays that run alongside."""

    def __init__(self, folder: str, segments: list[tuple]):
        self.folder = folder
        self.segments = segments  # (first key, n, key file, {name: file})
        self.first = np.array([s[0] for s in segments], dtype=np.uint64)
        self.offset = np.concatenate([[0], np.cumsum([s[1] for s in segments])]).astype(np.int64)
        self.n = int(self.offset[-1])
        self._keys: dict[int, EliasFano] = {}
        self._side: dict[tuple[int, str], np.ndarray] = {}
        self._most = _most_open(folder)

    def _sequence(self, k: int) -> EliasFano:
        if k not in self._keys:
            if len(self._keys) >= self._most:
                self._keys.pop(next(iter(self._keys)))
            self._keys[k] = EliasFano(mapped(self.folder, self.segments[k][2], np.uint64))
        return self._keys[k]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The places of keys, -1 for those that are missing."""
        asked, back = distinct(keys.astype(np.uint64))
        out = np.full(len(asked), NONE, dtype=np.int64)
        if self.n and len(asked):
            # asked is in order, so each segment answers for a slice
            bounds = np.append(np.searchsorted(asked, self.first), len(asked))
            for k in range(len(self.segments)):
                part = slice(bounds[k], bounds[k + 1])
                if part.start < part.stop:
                    at, equal = self._sequence(k).successor(asked[part] - self.first[k])
                    out[part] = np.where(equal, at + self.offset[k], NONE)
        return out[back]

    def split(self, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        if len(self.segments) == 1:
            yield 0, slice(None)
            return
        segment = np.searchsorted(self.offset, places, side="right") - 1
        # numbers of 16 bits are sorted in one pass over them
        order = np.argsort(segment.astype(np.min_scalar_type(len(self.segments))), kind="stable")
        bounds = np.searchsorted(segment[order], np.arange(len(self.segments) + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            yield int(k), order[bounds[k] : bounds[k + 1]]

    def keys(self, places: np.ndarray) -> np.ndarray:
        out = np.zeros(len(places), dtype=np.uint64)
        for k, part in self.split(places):
            out[part] = self._sequence(k).get(places[part] - self.offset[k]) + self.first[k]
        return out

    def side(self, name: str, places: np.ndarray, dtype) -> np.ndarray:
        """Values of a side array at places; a segment without one has zeros."""
        out = np.zeros(len(places), dtype=dtype)
        for k, part in self.split(places):
            file = self.segments[k][3].get(name)
            if file:
                if (k, name) not in self._side:
                    if len(self._side) >= self._most:
                        self._side.pop(next(iter(self._side)))
                    self._side[k, name] = mapped(self.folder, file, dtype)
                out[part] = self._side[k, name][places[part] - self.offset[k]]
        return out


    def numbers(self, name: str, places: np.ndarray) -> np.ndarray:
        """Whole numbers of a side array, which each segment holds in as few bytes as they need."""
        out = np.zeros(len(places), dtype=np.int64)
        for k, part in self.split(places):
            if (k, name) not in self._side:
                if len(self._side) >= self._most:
                    self._side.pop(next(iter(self._side)))
                self._side[k, name] = self._narrow(k, name)
            out[part] = self._side[k, name][places[part] - self.offset[k]]
        return out

    def _narrow(self, k: int, name: str) -> np.ndarray:
        data = mapped(self.folder, self.segments[k][3][name], np.uint8)
        return data.view(f"<u{len(data) // self.segments[k][1]}")

    def segment_keys(self, k: int) -> np.ndarray:
        """All keys of a segment."""
        return self._sequence(k).all() + self.first[k]

    def segment_numbers(self, k: int, name: str) -> np.ndarray:
        return self._narrow(k, name).astype(np.int64)

    def followers(self, width: int, begin: int, end: int) -> np.ndarray:
        """For each context from ``begin`` to ``end`` the number of keys ``context * width + follower``."""
        out = np.zeros(end - begin, dtype=np.int64)
        if not self.n:
            return out
        low = np.searchsorted(self.first, np.uint64(begin * width), side="right") - 1
        high = np.searchsorted(self.first, np.uint64(end * width))
        for k in range(max(low, 0), high):
            context = (self.segment_keys(k) // np.uint64(width)).astype(np.int64)
            a, b = np.searchsorted(context, [begin, end])
            out += np.bincount(context[a:b] - begin, minlength=end - begin)
        return out


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unsigned numbers in order, and which of them each value is. Values that leave
    room for their places are sorted together with them, which is many times faster."""
    n = len(values)
    bits = max(n - 1, 0).bit_length()
    if not n or int(values.max()).bit_length() + bits > 64:
        return np.unique(values, return_inverse=True)
    packed = np.sort(values << np.uint64(bits) | np.arange(n, dtype=np.uint64))
    at = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    packed >>= np.uint64(bits)
    new = np.concatenate([[True], packed[1:] != packed[:-1]])
    back = np.empty(n, dtype=np.int64)
    back[at] = np.cumsum(new) - 1
    return packed[new], back


def in_ranges(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Rows in ranges of about ``SEGMENT`` keys, each in order."""
    return rows.repartitionByRange(max(1, -(-n // SEGMENT)), key).sortWithinPartitions(key)


def write_segments(rows: DataFrame, write, name: str) -> list[tuple]:
    """Let each partition write its segment; (first key, n, key file, side files)."""
    schema = "first decimal(20,0), n long, keys string, side map<string,string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield write(pd.concat(parts, ignore_index=True))

    files = written(rows.mapInPandas(run, schema), name)
    found = files.collect()  # one row per segment
    done_with(files)
    return sorted((int(r["first"]), r["n"], r["keys"], dict(r["side"])) for r in found)


def segment(folder: str, keys: np.ndarray, side: dict[str, np.ndarray]) -> pd.DataFrame:
    first = int(keys[0])
    file = save(folder, encode(keys - np.uint64(first), int(keys[-1]) - first + 1))
    sides = {name: save(folder, values) for name, values in side.items()}
    return pd.DataFrame(
        {"first": [Decimal(first)], "n": [len(keys)], "keys": [file], "side": [sides]}
    )


def unsigned_order(key: str) -> str:
    """SQL for a long that sorts as the unsigned number of the same bits."""
    return f"{key} ^ (-9223372036854775807L - 1L)"


class KeyTable:
    """64-bit keys with values alongside, written once; what travels to tasks are its
    file names. The maps are opened once in a worker."""

    def __init__(self, rows: DataFrame, key: str, name: str, values: tuple[str, ...] = ()):
        """``rows`` holds each key once, in the long column ``key``; ``values`` are long columns."""
        rows = written(rows.select(key, *values), name)
        folder = new_folder(rows.sparkSession, name)

        def one(part: pd.DataFrame) -> pd.DataFrame:
            side = {v: part[v].to_numpy(np.int64) for v in values}
            return segment(folder, part[key].to_numpy(np.int64).view(np.uint64), side)

        ordered = rows.withColumn("_order", F.expr(unsigned_order(key)))
        self.folder, self.n = folder, rows.count()
        self.segments = write_segments(in_ranges(ordered, "_order", self.n), one, f"{name}-segments")

    def _level(self) -> Level:
        if self.folder not in _OPEN:
            while len(_OPEN) >= _MOST_OPEN:
                _OPEN.pop(next(iter(_OPEN)))
            _OPEN[self.folder] = Level(self.folder, self.segments)
        return _OPEN[self.folder]

    def contains(self, keys: np.ndarray) -> np.ndarray:
        return self._level().find(keys) != NONE

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where the keys are, -1 for those that are not."""
        return self._level().find(keys)

    def values(self, name: str, places: np.ndarray) -> np.ndarray:
        return self._level().side(name, places, np.int64)


_OPEN: dict[str, Level] = {}
_MOST_OPEN = 8
