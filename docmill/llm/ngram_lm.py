"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a trigram model with absolute discounting. Its trie has three levels,
each a table of segments that tasks map into memory:

* words: hashes in order (a word's place is its id), counts, back-off weights, and
  monotone pointers to where the followers of each word begin in the second level;
* pairs: (word id, word id) in order, with quantised probabilities and back-off weights;
* triples: (place of the pair, follower), where the follower is given relative to its
  context: by its rank among the followers of the middle word.

Keys are counted and sorted in tasks, a chunk at a time; Spark brings the runs of a range of
keys together, and the task that has them writes the range's part of the level to the shared
folder. How many followers a word or pair has is counted where the sorted keys lie. Texts become word ids once, then
places of pairs; later passes read those instead of texts. Every document is scored
where its ids are read, by successor searches in the mapped levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import done_with, lower_ascii, small_batches, written
from docmill.llm.counted_keys import RUNS, count_segments, even_bounds, runs, sampled_bounds
from docmill.llm.elias_fano import EliasFano, encode
from docmill.llm.levels import NONE, Level, distinct, mapped, new_folder, save
from docmill.llm.shingles import word_hashes
from docmill.llm.split_words import parted
from docmill.session import discard

#: The token behind each text's last word; no word can hold white space.
END = b"\n"
DISCOUNT = 0.5
#: Occurrences from which a pair or triple is in the trie: all that were seen are.
LEAST_COUNT = 1
#: Quantisation steps per unit of log10.
STEPS = 4096
#: Tokens that are looked up at once.
TOKENS = 1_000_000
#: Keys of a level whose probabilities are computed at once.
_SLICE = 200_000


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words, then one end."""
    own = lower_ascii(text).split()
    own.append(END)
    return own


# Fixed value: stands for the end in place of a word's hash.
_END_HASH = np.array([0x5851F42D4C957F2D], dtype=np.uint64)


def _codes(log10: np.ndarray) -> np.ndarray:
    """Logarithms at or below 0 as whole steps, in 16 bits."""
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


def _logs(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) / -STEPS


@dataclass
class Model:
    """What a task needs to open the trie: file names and totals, no n-grams."""

    folder: str
    words: list[tuple]
    pairs: list[tuple]
    triples: list[tuple]
    pointers: list[tuple]  # per segment of words: (first pair, file)
    n_tokens: int
    widest: int  # followers of the word that has most

    def open(self) -> Trie:
        """Open once in each worker."""
        name = repr((self.folder, self.words, self.pairs, self.triples, self.pointers))
        if _OPEN.get("name") != name:
            _OPEN.clear()
            _OPEN.update(name=name, trie=Trie(self))
        return _OPEN["trie"]


_OPEN: dict = {}


class Trie:
    def __init__(self, model: Model):
        self.model = model
        self.words = Level(model.folder, model.words)
        self.pairs = Level(model.folder, model.pairs)
        self.triples = Level(model.folder, model.triples)
        self.v = self.words.n
        self.total = model.n_tokens + self.v + 1
        self._starts: dict[int, EliasFano] = {}

    # -- words --

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids, -1 for words that the training texts lack."""
        return self.words.find(hashes)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), dtype=np.int64)
        known = ids >= 0
        out[known] = self.words.numbers("count", ids[known])
        return out

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / self.total)

    def first_follower(self, ids: np.ndarray) -> np.ndarray:
        """Where the pairs of a word begin: a pointer, itself in Elias-Fano form."""
        asked, back = distinct(ids.astype(np.uint64))
        asked = asked.astype(np.int64)
        out = np.zeros(len(asked), dtype=np.int64)
        for k, part in self.words.split(asked):
            begin, file = self.model.pointers[k]
            if k not in self._starts:
                self._starts[k] = EliasFano(mapped(self.model.folder, file, np.uint64))
            out[part] = self._starts[k].get(asked[part] - self.words.offset[k]).astype(np.int64) + begin
        return out[back]

    # -- pairs and triples --

    def pair_places(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each token the place of the pair that it ends, -1 at a text's start."""
        out = np.full(len(ids), NONE, dtype=np.int64)
        left = np.concatenate([[NONE], ids[:-1]])
        left[starts] = NONE
        # every known word but the end has followers, so none is left out
        ask = np.nonzero((left >= 0) & (ids >= 0))[0]
        out[ask] = self.pairs.find(left[ask].astype(np.uint64) * np.uint64(self.v) + ids[ask].astype(np.uint64))
        return out

    def triple_keys(self, ids: np.ndarray, pairs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token numbers, keys) where both pairs of a triple are in the trie."""
        context = np.concatenate([[NONE], pairs[:-1]])
        context[starts] = NONE
        at = np.nonzero((context >= 0) & (pairs >= 0))[0]
        rank = pairs[at] - self.first_follower(ids[at - 1])
        keys = context[at].astype(np.uint64) * np.uint64(self.model.widest) + rank.astype(np.uint64)
        return at, keys

    def score(self, ids: np.ndarray, pairs: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each token."""
        out = np.zeros(len(ids))
        at, keys = self.triple_keys(ids, pairs, starts)
        places = self.triples.find(keys)
        found = places >= 0
        out[at[found]] = _logs(self.triples.side("prob", places[found], np.uint16))
        # the others: by their pair or word, weighed by what their context leaves
        others = np.ones(len(ids), dtype=bool)
        others[at[found]] = False
        others = np.flatnonzero(others)
        low = self.base(counts[others])
        left = np.concatenate([[NONE], ids[:-1]])
        left[starts] = NONE
        left = left[others]
        known = np.flatnonzero(left >= 0)
        low[known] += _logs(self.words.side("backoff", left[known], np.uint16))
        pair = pairs[others]
        found = np.flatnonzero(pair >= 0)
        low[found] = _logs(self.pairs.side("prob", pair[found], np.uint16))
        context = np.concatenate([[NONE], pairs[:-1]])
        context[starts] = NONE
        context = context[others]
        known = np.flatnonzero(context >= 0)
        low[known] += _logs(self.pairs.side("backoff", context[known], np.uint16))
        out[others] = low
        return out


# --- building -------------------------------------------------------------------


def _chunks(rows, column: str, more: tuple[str, ...] = ()) -> Iterator[tuple]:
    """Arrays of whole documents, side by side, up to about ``TOKENS`` at a time:
    (frame of the documents, starts, values, values of the columns ``more``)."""
    for batch in rows:
        sizes = batch["_n"].to_numpy(np.int64)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // TOKENS)) + 1, [len(batch)]])
        for begin, end in zip(cut[:-1], cut[1:], strict=True):
            if begin < end:
                part = batch.iloc[begin:end]
                starts = np.cumsum(sizes[begin:end]) - sizes[begin:end]
                yield part, starts, *[_numbers(part[c], int(sizes[begin:end].sum())) for c in (column, *more)]


def _numbers(blobs: pd.Series, n: int) -> np.ndarray:
    """The numbers of documents, kept as bytes of 4 or 8 each."""
    if isinstance(blobs.iloc[0], np.ndarray):
        return np.concatenate(list(blobs))
    joined = b"".join(blobs)
    return np.frombuffer(joined, dtype="<i8" if len(joined) == 8 * n else "<i4").astype(np.int64)


def _worded(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(frame of the documents, starts, the number of each token's hash, hashes)."""
    for batch in small_batches(batches, "_text", 8_000_000):
        joined, codes, sizes = parted([lower_ascii(t) for t in batch["_text"]])
        hashes = np.concatenate([word_hashes(joined), _END_HASH])
        ends = np.cumsum(sizes + 1) - 1
        out = np.full(len(codes) + len(sizes), len(hashes) - 1, dtype=np.int64)
        words = np.ones(len(out), dtype=bool)
        words[ends] = False
        out[words] = codes
        yield batch.assign(_n=sizes + 1), ends - sizes, out, hashes


def _word_counts(train: DataFrame, folder: str) -> tuple[list[tuple], int]:
    """Segments of the words, and the number of tokens. Hashes fall evenly into ranges."""
    bounds = even_bounds(max(1, train.rdd.getNumPartitions()))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted = (
            (hashes, np.bincount(codes, minlength=len(hashes)))
            for _, _, codes, hashes in _worded(batches)
            if len(codes)
        )
        yield from runs(counted, bounds)

    return count_segments(train.select("_text").mapInPandas(emit, RUNS), folder, "lm-words")


def _pair_keys(trie: Trie, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys of all pairs of neighbours in a text."""
    both = np.ones(len(ids), dtype=bool)
    both[starts] = False
    at = np.nonzero(both)[0]
    return ids[at - 1].astype(np.uint64) * np.uint64(trie.v) + ids[at].astype(np.uint64)


def _key_counts(train: DataFrame, model: Model, order: int) -> list[tuple]:
    """Segments with the counts of all pairs or triples."""
    columns = ["_n", "_ids"] + ["_pairs"] * (order == 3)

    def keys_of(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        trie = model.open()
        if order == 2:
            return (_pair_keys(trie, ids, starts) for _, starts, ids in _chunks(batches, "_ids"))
        return (
            trie.triple_keys(ids, pairs, starts)[1]
            for _, starts, ids, pairs in _chunks(batches, "_ids", ("_pairs",))
        )

    rows = train.select(*columns)
    bounds = sampled_bounds(rows, keys_of, model.n_tokens)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from runs(((keys, None) for keys in keys_of(batches)), bounds)

    name = "lm-pairs" if order == 2 else "lm-triples"
    return count_segments(rows.mapInPandas(emit, RUNS), model.folder, name)[0]


def _parts(values: np.ndarray, starts: np.ndarray, most: int) -> list[bytes]:
    """Each document's numbers as bytes: cheaper to write and read than arrays."""
    dtype = "<i8" if most > 1 << 31 else "<i4"
    return [x.tobytes() for x in np.split(values.astype(dtype), starts[1:])]


def _with_ids(docs: DataFrame, model: Model, v: int) -> DataFrame:
    """(_id, _train, _n, _ids): documents as word ids, written once."""
    id_type = docs.schema["_id"].dataType.simpleString()

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = model.open()
        for part, starts, codes, hashes in _worded(batches):
            if not len(part):
                continue
            ids = _parts(trie.word_ids(hashes)[codes], starts, v)
            yield part[["_id", "_train", "_n"]].assign(_ids=ids)

    schema = f"_id {id_type}, _train boolean, _n int, _ids binary"
    return written(docs.select("_id", "_train", "_text").mapInPandas(emit, schema), "lm-ids", free_shuffles=True)


def _with_pairs(rows: DataFrame, model: Model, n: int) -> DataFrame:
    """The same with _pairs, for each token the place of the pair that it ends."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = model.open()
        for part, starts, ids in _chunks(batches, "_ids"):
            places = trie.pair_places(ids, starts)
            yield part.assign(_pairs=_parts(places, starts, n))

    return written(rows.mapInPandas(emit, f"{schema}, _pairs binary"), "lm-places", free_shuffles=True)


def _each_segment(rows: DataFrame, n: int, write, schema: str) -> list:
    """What ``write`` returns for each segment's number, in a task of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"].tolist():
                yield pd.DataFrame([{"segment": k, **write(k)}])

    numbers = rows.sparkSession.range(0, n, 1, max(1, n))
    return sorted(numbers.mapInPandas(run, f"segment long, {schema}").collect(), key=lambda r: r["segment"])


def build(docs: DataFrame, discount: float = DISCOUNT) -> tuple[Model, DataFrame]:
    """The trie of all texts (_text) that are for training (_train), and all documents
    (_id, _train, _n tokens) as word ids (_ids) and places of pairs (_pairs)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "trie")

    words, n = _word_counts(docs.filter("_train"), folder)
    model = Model(folder, words, [], [], [], n, 1)
    v = sum(w[1] for w in words)
    _fits(v, v, "pairs of words")
    rows = _with_ids(docs, model, v)
    train = rows.filter("_train")

    # Pairs: first their counts, from which the first level gets pointers and back-off.
    model.pairs = _key_counts(train, model, 2)
    n_pairs = sum(p[1] for p in model.pairs)

    def followers(k: int) -> dict:
        trie = model.open()
        begin, end = trie.words.offset[k : k + 2].tolist()
        n = trie.pairs.followers(v, begin, end)
        total = trie.words.segment_numbers(k, "count")
        # every occurrence but those of the end has a follower
        kept = np.where(n > 0, total - discount * n, 0)
        return {
            "n": int(n.sum()),
            "most": int(n.max()),
            "backoff": save(folder, _codes(np.log10(np.maximum(1 - kept / total, 1e-12)))),
            "pointer": save(folder, encode(np.cumsum(n) - n, int(n.sum()) + 1)),
        }

    begin = 0
    for r in _each_segment(docs, len(words), followers, "n long, most long, backoff string, pointer string"):
        model.words[r["segment"]][3]["backoff"] = r["backoff"]
        model.pointers.append((begin, r["pointer"]))
        model.widest = max(model.widest, r["most"])
        begin += r["n"]

    def pair_level(k: int) -> dict:
        trie = model.open()
        keys, c = trie.pairs.segment_keys(k), trie.pairs.segment_numbers(k, "count")
        codes = []
        for at in range(0, len(keys), _SLICE):
            left, right = (x.astype(np.int64) for x in np.divmod(keys[at : at + _SLICE], np.uint64(v)))
            low = 10 ** (_logs(trie.words.side("backoff", left, np.uint16)) + trie.base(trie.counts(right)))
            prob = (c[at : at + _SLICE] - discount) / trie.counts(left) + low
            codes.append(_codes(np.log10(prob)))
        return {"prob": save(folder, np.concatenate(codes))}

    for r in _each_segment(docs, len(model.pairs), pair_level, "prob string"):
        model.pairs[r["segment"]][3]["prob"] = r["prob"]
    _fits(n_pairs, model.widest, "triples of words")
    ids, rows = rows, _with_pairs(rows, model, n_pairs)
    done_with(ids)
    train = rows.filter("_train")
    model.triples = _key_counts(train, model, 3)
    widest = model.widest

    def pair_backoff(k: int) -> dict:
        trie = model.open()
        begin, end = trie.pairs.offset[k : k + 2].tolist()
        n = trie.triples.followers(widest, begin, end)
        total = trie.pairs.segment_numbers(k, "count")
        kept = np.where(n > 0, total - discount * n, 0)
        return {"backoff": save(folder, _codes(np.log10(np.maximum(1 - kept / total, 1e-12))))}

    for r in _each_segment(docs, len(model.pairs), pair_backoff, "backoff string"):
        model.pairs[r["segment"]][3]["backoff"] = r["backoff"]

    def triple_level(k: int) -> dict:
        trie = model.open()
        keys, c = trie.triples.segment_keys(k), trie.triples.segment_numbers(k, "count")
        codes = []
        for at in range(0, len(keys), _SLICE):
            context, rank = (x.astype(np.int64) for x in np.divmod(keys[at : at + _SLICE], np.uint64(widest)))
            # several triples share a context, and their contexts come in order
            own, back = distinct(context.astype(np.uint64))
            own = own.astype(np.int64)
            start = trie.first_follower((trie.pairs.keys(own) % np.uint64(v)).astype(np.int64))
            backoff = _logs(trie.pairs.side("backoff", own, np.uint16))
            low = backoff[back] + _logs(trie.pairs.side("prob", start[back] + rank, np.uint16))
            kept = (c[at : at + _SLICE] - discount) / trie.pairs.numbers("count", own)[back]
            codes.append(_codes(np.log10(kept + 10**low)))
        return {"prob": save(folder, np.concatenate(codes))}

    for r in _each_segment(docs, len(model.triples), triple_level, "prob string"):
        model.triples[r["segment"]][3]["prob"] = r["prob"]
    # counts of pairs and triples are in their probabilities now
    for level in (model.pairs, model.triples):
        for segment in level:
            discard(spark, f"{folder}/{segment[3].pop('count')}")
    return model, rows


def _fits(left: int, right: int, what: str) -> None:
    """Keys are signed 64-bit numbers: larger ones would be those of other contexts."""
    if left * right >= 1 << 63:
        raise OverflowError(f"too many {what} for 64-bit keys: {left} x {right}")


# --- scoring --------------------------------------------------------------------


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    learn_from: str = "true",
    discount: float = DISCOUNT,
) -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all documents for which the SQL condition ``learn_from`` on
    the column ``_id`` holds. Null and empty texts are one end token. Without training
    texts every token has the probability 1. Repeated rows and null ids are learnt from
    and scored like others. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    docs = docs.withColumn("_train", F.coalesce(F.expr(learn_from), F.lit(False)))
    model, rows = build(docs, discount)
    id_type = docs.schema["_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = model.open()
        for part, starts, ids, pairs in _chunks(batches, "_ids", ("_pairs",)):
            counts = trie.counts(ids)
            yield pd.DataFrame(
                {
                    "_id": part["_id"],
                    "n_tokens": np.diff(np.append(starts, len(ids))),
                    "n_known": np.add.reduceat((counts > 0).astype(np.int64), starts),
                    "train_tokens": model.n_tokens,
                    "base_score": np.add.reduceat(trie.base(counts), starts),
                    "score": np.add.reduceat(trie.score(ids, pairs, counts, starts), starts),
                }
            )

    schema = f"_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.select("_id", "_n", "_ids", "_pairs").mapInPandas(score, schema).withColumnRenamed("_id", id_col)
