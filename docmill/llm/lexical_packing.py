"""Packing of documents into training windows, by lexical retrieval.

Every text is tokenised once and its ids are written. Documents are dealt into shards by
the least hash of their pairs of neighbouring ids, so that copies and texts with common
passages mostly meet. A shard has an inverted index with BM25 weights; their counts are
those of the whole corpus. The first unused document seeds a window, the index returns
its unused neighbours, best first, and these fill the window greedily. A document that
no longer fits is cut there: what is left of it seeds the next window.

Shards are runs of a range partition of about ``SHARD_TOKENS`` ids, whatever the size of
the partition, so a task holds one shard. What is open at the end of a shard goes on in
the next one; what is open at the end of a partition is cut into powers of two. Nothing
is padded, then.

Defined results
---------------
- A null or empty text has the end id alone.
- A text longer than the window fills whole windows, and its rest seeds another.
- Each row is a document of its own, also where ids or texts repeat, or ids are null.
- Equal scores are filled in the order of the shard. Documents that share no id with the
  seed come last.
- An empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import small_batches, written
from docmill.llm.shingles import mixed
from docmill.llm.word_coder import coder

WINDOW = 4096
END_ID = 2
#: BM25's saturation of counts and its share of length.
K1, B = 1.2, 0.75
SHARD_TOKENS = 1 << 20
PARTITION_TOKENS = 1 << 22
#: Share of a shard's indexed documents below which the used ones leave the index.
_WORTH_KEEPING = 0.8


def least_pairs(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each document, none of them empty, the least hash of two neighbouring ids; of one
    id alone its own."""
    wide = ids.astype(np.uint64)
    hashes = mixed(wide << np.uint64(32) | np.append(wide[1:], np.uint64(0)))
    last = np.append(starts[1:], len(ids)) - 1
    hashes[last] = np.where(last == starts, mixed(wide[last]), np.uint64(0xFFFFFFFFFFFFFFFF))
    return (np.minimum.reduceat(hashes, starts) >> np.uint64(1)).astype(np.int64)


def token_table(
    documents: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids, n_ids, shard_key, tie), written once; ids are little-endian bytes."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = coder(path)
        end = np.array([end_id], dtype=words.dtype).tobytes()
        for batch in small_batches(batches, "text", 8_000_000):
            ids = [found + end for found in words.encode(batch["text"].tolist())]
            sizes = np.array([len(x) // words.dtype.itemsize for x in ids], dtype=np.int64)
            joined = np.frombuffer(b"".join(ids), dtype=words.dtype)
            keys = least_pairs(joined, np.cumsum(sizes) - sizes) if ids else []
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "ids": ids, "n_ids": sizes, "shard_key": keys}
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, ids binary, n_ids long, shard_key long"
    rows = docs.mapInPandas(run, schema)
    # The row's place, kept with it, parts equal keys: a family of copies spans many ranges.
    place = F.xxhash64(F.monotonically_increasing_id())
    return written(rows.withColumn("tie", place), "tokens")


def document_counts(tokens: DataFrame, size: int, dtype: np.dtype) -> np.ndarray:
    """In how many documents each id occurs; a table of the vocabulary's size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, last = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            for data in batch["ids"]:
                ids = np.frombuffer(data, dtype=dtype)
                at = np.arange(len(ids))
                last[ids] = at
                total[ids[last[ids] == at]] += 1  # each id once, where it stands last
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    rows = tokens.select("ids").mapInPandas(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, dtype=np.int64)
    for row in rows.collect():  # bounded by the vocabulary
        out[row["id"]] = row["n"]
    return out


class Index:
    """Postings of a shard: for each id its documents, with BM25 weights."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, average: float):
        self.idf, self.n = idf, len(documents)
        sizes = np.array([len(d) for d in documents], dtype=np.int64)
        owner = np.repeat(np.arange(self.n, dtype=np.int64), sizes)
        terms = np.concatenate(documents).astype(np.int64) if self.n else np.zeros(0, dtype=np.int64)
        pairs, counts = np.unique(terms * max(self.n, 1) + owner, return_counts=True)
        term, self.owner = pairs // max(self.n, 1), pairs % max(self.n, 1)
        damped = K1 * (1 - B + B * sizes / average)
        self.weight = idf[term] * counts * (K1 + 1) / (counts + damped[self.owner])
        self.start = np.searchsorted(term, np.arange(len(idf) + 1))

    def keep(self, unused: np.ndarray) -> None:
        """Drop the postings of used documents, whose scores are no longer asked for."""
        kept = unused[self.owner]
        self.start = np.concatenate([[0], np.cumsum(kept)])[self.start]
        self.owner, self.weight = self.owner[kept], self.weight[kept]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The BM25 score of every document for the distinct ids of a query."""
        bounds = list(zip(self.start[query].tolist(), self.start[query + 1].tolist(), strict=True))
        owner = np.concatenate([self.owner[begin:end] for begin, end in bounds])
        weight = np.concatenate([self.weight[begin:end] for begin, end in bounds])
        return np.bincount(owner, weights=weight, minlength=self.n)


def best_first(scores: np.ndarray, most: int = 128) -> Iterator[int]:
    """Places by falling score, equal ones in order; only those that are asked for are sorted."""
    if len(scores) > most:
        limit = np.partition(scores, len(scores) - most)[len(scores) - most]
        head = np.flatnonzero(scores >= limit)
        yield from head[np.argsort(-scores[head], kind="stable")].tolist()
        rest = np.flatnonzero(scores < limit)
    else:
        rest = np.arange(len(scores))
    yield from rest[np.argsort(-scores[rest], kind="stable")].tolist()


class Packer:
    """Windows of one partition; ``feed`` takes a shard, ``close`` what is still open."""

    def __init__(self, idf: np.ndarray, average: float, first_sequence: int, window: int = WINDOW):
        self.idf, self.average, self.window = idf, average, window
        self.sequence = first_sequence
        self.open: list[tuple] = []  # (document, start, ids, its size) of the open window
        self.filled = 0
        self.seed: np.ndarray | None = None
        self.done: list[tuple] = []

    def feed(self, keys: list, documents: list[np.ndarray]) -> list[tuple]:
        index = Index(documents, self.idf, self.average)
        unused = np.ones(len(documents), dtype=bool)
        following, indexed = 0, len(documents)
        while True:
            if not self.filled or self.seed is None:
                while following < len(documents) and not unused[following]:
                    following += 1
                if following == len(documents):
                    break
                self._take(keys, documents, following, unused)
                continue
            left = np.flatnonzero(unused)
            if not len(left):
                break
            if len(left) < _WORTH_KEEPING * indexed:
                index.keep(unused)
                indexed = len(left)
            scores = index.scores(np.unique(self.seed).astype(np.int64))[left]
            sequence = self.sequence
            for place in best_first(scores):
                self._take(keys, documents, int(left[place]), unused)
                if self.sequence != sequence:
                    break  # a window is full; what is left of the document seeds the next
        done, self.done = self.done, []
        return done

    def _take(self, keys: list, documents: list[np.ndarray], at: int, unused: np.ndarray) -> None:
        unused[at] = False
        ids, start = documents[at], 0
        while start < len(ids):
            if not self.filled:
                self.seed = ids
            piece = ids[start : start + self.window - self.filled]
            self.open.append((keys[at], start, piece, len(ids)))
            self.filled += len(piece)
            start += len(piece)
            if self.filled == self.window:
                self._finish(self.open)
                self.open, self.filled = [], 0

    def _finish(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, size in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.done.append((key, start, len(ids), crc, size, self.sequence, offset, ids))
            offset += len(ids)
        self.sequence += 1

    def close(self) -> list[tuple]:
        """Cut the open window into powers of two, the greatest first."""
        pieces, self.open = self.open, []
        while self.filled:
            room = 1 << (self.filled.bit_length() - 1)
            self.filled -= room
            part = []
            while room:
                key, start, ids, size = pieces.pop(0)
                part.append((key, start, ids[:room], size))
                if len(ids) > room:
                    pieces.insert(0, (key, start + room, ids[room:], size))
                room -= min(room, len(ids))
            self._finish(part)
        done, self.done = self.done, []
        return done


_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(
    documents: DataFrame,
    path: str,
    end_id: int = END_ID,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``, with ``with_ids`` also ``ids``. ``window`` is a power of two.

    What is collected is a count per id of the vocabulary.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    words = coder(path)
    size, dtype = words.size, words.dtype
    tokens = token_table(documents, path, end_id, id_col, text_col)
    n, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    counts = document_counts(tokens, size, dtype)
    counts[end_id] = n  # ends every document, so it tells none apart
    idf = np.log1p((n - counts + 0.5) / (counts + 0.5))
    idf[end_id] = 0.0
    average = total / max(n, 1)
    ranges = max(1, -(-total // PARTITION_TOKENS))
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    dealt = tokens.repartitionByRange(ranges, "shard_key", "tie").sortWithinPartitions("shard_key", "tie")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(idf, average, TaskContext.get().partitionId() << 33, window)
        keys, shard, held = [], [], 0
        for batch in batches:
            for key, ids in zip(batch["doc_id"], batch["ids"], strict=True):
                keys.append(key)
                shard.append(np.frombuffer(ids, dtype=dtype))
                held += len(shard[-1])
                if held >= shard_tokens:
                    yield from _frames(packer.feed(keys, shard), with_ids)
                    keys, shard, held = [], [], 0
        yield from _frames(packer.feed(keys, shard), with_ids)
        yield from _frames(packer.close(), with_ids)

    longs = ", ".join(f"{c} long" for c in _COLUMNS[1:])
    schema = f"doc_id {id_type}, {longs}" + (", ids array<int>" if with_ids else "")
    return dealt.select("doc_id", "ids").mapInPandas(run, schema)


def _frames(pieces: list[tuple], with_ids: bool) -> Iterator[pd.DataFrame]:
    for begin in range(0, len(pieces), 2000):
        columns = list(zip(*pieces[begin : begin + 2000], strict=True))
        frame = dict(zip(_COLUMNS, columns, strict=False))
        # ids may be null: kept as objects, they stay whole numbers
        frame["doc_id"] = pd.Series(columns[0], dtype=object).map(lambda k: None if pd.isna(k) else k)
        if with_ids:
            frame["ids"] = [ids.astype(np.int32) for ids in columns[7]]
        yield pd.DataFrame(frame)
