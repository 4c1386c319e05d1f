"""Substring deduplication over a de Bruijn graph of word k-mers.

1. Of rows with equal texts only those with the smallest id go through the graph; the others
   repeat all of it.
2. Each window of k words has a minimiser, the least hash of its m-word runs. Only
   minimisers that occur in two documents can belong to a repeated window; they are
   found from about a fifth as many rows as there are words.
3. Windows with such a minimiser are the graph's edges (from their first to their last
   k - 1 words), known by fingerprints. Of edges that occur in two documents, the
   smallest id is their source. Both tables are written sorted, and mapped into memory
   by the tasks that look them up, so that texts are not moved for it.
4. Neighbouring edges of a text with one source form a path and compact into a span.
   The words of each span are compared, through a join, with those of its source
   before any result is returned; where the source branches, edge by edge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import small_batches, utf8, words, written
from docmill.llm.levels import NONE, KeyTable
from docmill.llm.shingles import runs, sliding_min, word_hashes

WINDOW = 13
RUN = 5


class Windows:
    """Minimisers and fingerprints of a text's windows."""

    def __init__(self, window: int, run: int):
        if not 1 <= run <= window:
            raise ValueError("a run must not be longer than a window")
        self.window, self.run = window, run

    def hashes(self, text: str | None) -> np.ndarray:
        return word_hashes(utf8(text))

    def minimisers(self, hashes: np.ndarray) -> np.ndarray:
        """One value per window."""
        if len(hashes) < self.window:
            return np.zeros(0, dtype=np.uint64)
        return sliding_min(runs(hashes, self.run), self.window - self.run + 1)

    def edges(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The key of each window, a check on it, and the key where keys collide."""
        key = runs(hashes, self.window, 1)
        check = (runs(hashes, self.window, 2) >> np.uint64(32)).astype(np.int64)
        return key, check, runs(hashes, self.window, 3)


def _copies(docs: DataFrame) -> KeyTable:
    """The smallest id of each text that two ids have, by the text's hash. Texts whose
    first hashes collide are left out and go through the graph."""
    rows = docs.filter("_id IS NOT NULL AND _text IS NOT NULL")
    ends = [F.min("_t2").alias("_t2"), F.max("_t2").alias("_most"), F.min("_id").alias("_lo"), F.max("_id").alias("_hi")]
    first = rows.groupBy("_t1").agg(*ends).filter("_lo < _hi AND _t2 = _most")
    return KeyTable(first, "_t1", "copies", ("_t2", "_lo"))


def _copied(batch: pd.DataFrame, copies: KeyTable) -> np.ndarray:
    """Which rows have a text that a smaller id has, too."""
    places = copies.places(batch["_t1"].to_numpy(np.int64).view(np.uint64))
    out = (places != NONE) & batch["_id"].notna().to_numpy()
    own, places = batch[out], places[out]
    equal = copies.values("_t2", places) == own["_t2"].to_numpy(np.int64)
    out[out] = equal & (copies.values("_lo", places) < own["_id"].to_numpy(np.int64))
    return out


def _originals(batches: Iterator[pd.DataFrame], copies: KeyTable) -> Iterator[pd.DataFrame]:
    """The rows that are no copies, in small batches."""
    for batch in small_batches(batches, "_text"):
        yield batch[~_copied(batch, copies)]


def _joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(0, dtype)])


def _repeated_minimisers(docs: DataFrame, copies: KeyTable, windows: Windows) -> KeyTable:
    """The minimisers that occur in two documents."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _originals(batches, copies):
            found = [np.unique(windows.minimisers(windows.hashes(t))) for t in batch["_text"]]
            ids = np.repeat(batch["_id"].to_numpy(np.int64), [len(x) for x in found])
            yield pd.DataFrame({"_m": _joined(found, np.uint64).view(np.int64), "_id": ids})

    marks = docs.mapInPandas(emit, "_m long, _id long")
    ends = marks.groupBy("_m").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
    return KeyTable(ends.filter("lo < hi"), "_m", "repeated-minimisers")


class Sources:
    """The smallest id of each window that occurs in two documents. Keys whose checks
    differ belong to several windows; those are told apart by another key."""

    def __init__(self, docs: DataFrame, copies: KeyTable, windows: Windows, repeated: KeyTable):
        self.copies, self.windows, self.repeated = copies, windows, repeated
        self.collided: KeyTable | None = None
        ends = written(self._ends(docs, False), "repeat-edges")
        whole = ends.filter("_c1 = _c2 AND _lo < _hi")
        self.first = KeyTable(whole, "_f", "edge-sources", ("_lo", "_c1"))
        collided = ends.filter("_c1 <> _c2").select("_f")
        if collided.take(1):
            self.collided = KeyTable(collided, "_f", "edge-collisions")
            other = written(self._ends(docs, True), "repeat-edges")
            if other.filter("_c1 <> _c2").take(1):
                raise ValueError("windows collide in both keys")
            self.second = KeyTable(other.filter("_lo < _hi"), "_f", "edge-sources", ("_lo", "_c1"))

    def _candidates(self, batch: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: numbers, keys, checks and second keys of the windows that may repeat."""
        hashes = [self.windows.hashes(t) for t in batch["_text"]]
        marks = [self.windows.minimisers(h) for h in hashes]
        found = self.repeated.contains(_joined(marks, np.uint64))
        out, begin = [], 0
        for own, mine in zip(hashes, marks, strict=True):
            at = np.nonzero(found[begin : begin + len(mine)])[0]
            begin += len(mine)
            out.append((at, *(e[at] for e in self.windows.edges(own))))
        return out

    def _ends(self, docs: DataFrame, second: bool) -> DataFrame:
        """(_f, _c1, _c2, _lo, _hi): least and greatest check and id of each key."""

        def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in _originals(batches, self.copies):
                found = self._candidates(batch)
                ids = np.repeat(batch["_id"].to_numpy(np.int64), [len(x[0]) for x in found])
                key, check, other = (
                    _joined([x[k] for x in found], kind)
                    for k, kind in ((1, np.uint64), (2, np.int64), (3, np.uint64))
                )
                if second:
                    here = self.collided.contains(key)
                    ids, key, check = ids[here], other[here], check[here]
                yield pd.DataFrame({"_f": key.view(np.int64), "_c": check.astype(np.int32), "_id": ids})

        edges = docs.mapInPandas(emit, "_f long, _c int, _id long")
        checks = [F.min("_c").cast("long").alias("_c1"), F.max("_c").cast("long").alias("_c2")]
        return (
            edges.groupBy("_f")
            .agg(*checks, F.min("_id").alias("_lo"), F.max("_id").alias("_hi"))
            .filter("_lo < _hi OR _c1 <> _c2")
        )

    def of(self, batch: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: numbers of windows, their keys, and the smallest id that has them."""
        found = self._candidates(batch)
        key, check, other = (
            _joined([x[k] for x in found], kind) for k, kind in ((1, np.uint64), (2, np.int64), (3, np.uint64))
        )
        check = check.astype(np.int32).astype(np.int64)
        source, known = self._lookup(self.first, key, check)
        if self.collided is not None:
            here = self.collided.contains(key)
            source[here], known[here] = self._lookup(self.second, other[here], check[here])
        out, begin = [], 0
        for at, own, *_ in found:
            part = slice(begin, begin + len(at))
            begin += len(at)
            out.append((at[known[part]], own[known[part]], source[part][known[part]]))
        return out

    @staticmethod
    def _lookup(table: KeyTable, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = table.places(key)
        source, known = np.zeros(len(key), dtype=np.int64), places != NONE
        known[known] = table.values("_c1", places[known]) == check[known]
        source[known] = table.values("_lo", places[known])
        return source, known


def _digest(own: list[bytes]) -> bytes:
    return hashlib.blake2b(b"\n".join(own), digest_size=16).digest()


_SPAN = "struct<_key:bigint,_n:int,_source:bigint,_digest:binary>"


def _unmatched(spans: DataFrame, docs: DataFrame, windows: Windows) -> DataFrame:
    """The spans (_id, _key, _n, _source, _digest) whose words no text of their source holds."""
    asked = spans.select("_source", "_key", "_n").distinct()
    asked = asked.groupBy("_source").agg(F.collect_list(F.struct("_key", "_n")).alias("_asked"))
    sources = docs.join(asked, F.col("_id") == F.col("_source")).select("_source", "_text", "_asked")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches, "_text"):
            out = []
            for source, text, asked in zip(batch["_source"], batch["_text"], batch["_asked"], strict=True):
                own = words(text)
                keys = windows.edges(windows.hashes(text))[0].view(np.int64)
                order = np.argsort(keys, kind="stable")
                ordered = keys[order]
                for x in asked:
                    begin = np.searchsorted(ordered, x["_key"], side="left")
                    end = np.searchsorted(ordered, x["_key"], side="right")
                    for at in order[begin:end]:
                        part = own[at : at + x["_n"] + windows.window - 1]
                        out.append((source, x["_key"], x["_n"], _digest(part)))
            yield pd.DataFrame(out, columns=["_source", "_key", "_n", "_digest"])

    held = sources.mapInPandas(digest, "_source long, _key long, _n int, _digest binary")
    return spans.join(held, ["_source", "_key", "_n", "_digest"], "left_anti")


def _verify(spans: DataFrame, docs: DataFrame, sources: Sources) -> None:
    """Compare all spans with their sources; paths on which the source branches edge by edge."""
    windows = sources.windows
    left = written(_unmatched(spans, docs, windows), "repeat-branches")
    if not left.take(1):
        return
    branching = left.select("_id").distinct()

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches, "_text"):
            out = []
            for doc, text, found in zip(batch["_id"], batch["_text"], sources.of(batch), strict=True):
                own = words(text)
                for at, key, source in zip(*found, strict=True):
                    if source < doc:
                        part = own[at : at + windows.window]
                        out.append((doc, int(key.view(np.int64)), 1, int(source), _digest(part)))
            yield pd.DataFrame(out, columns=["_id", "_key", "_n", "_source", "_digest"])

    schema = "_id long, _key long, _n int, _source long, _digest binary"
    edges = docs.join(branching, "_id", "left_semi").mapInPandas(single, schema)
    if _unmatched(edges, docs, windows).take(1):
        raise ValueError("two windows of one fingerprint differ")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: list[str] | None = None,
    with_text: bool = False,
    window: int = WINDOW,
    run: int = RUN,
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (kept words joined by
    one space), with ``with_text`` also ``kept_text``: the text itself where nothing was
    removed, else the kept words joined by one space. ``carried`` columns come along.

    A word is removed if a window of ``window`` words that covers it also starts in a
    document with a smaller id, judged on the input. Null texts have no words. Rows
    with a null id remove nothing and lose nothing; rows that share an id are parts of
    one document, which do not remove each other. Other columns are not read.
    """
    windows = Windows(window, run)
    kept = F.struct(F.lit(1).alias("_one"), *[docs[c] for c in carried or []]).alias("_carried")
    id_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), kept)
    # the literal comes first: as a seed, the one hash would decide the other
    docs = docs.withColumn("_t1", F.xxhash64("_text")).withColumn("_t2", F.xxhash64(F.lit(1), "_text"))
    copies = _copies(docs)
    known = docs.filter("_id IS NOT NULL").select("_id", "_text", "_t1", "_t2")
    sources = Sources(known, copies, windows, _repeated_minimisers(known, copies, windows))
    names = ["n_words", "n_removed", "kept_sha256", "_spans"] + ["kept_text"] * with_text

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches, "_text"):
            ids = batch["_id"].to_numpy(np.float64, na_value=np.nan)
            plain = batch["_id"].fillna(0).to_numpy(np.int64)
            copied = _copied(batch, copies)
            out = []
            for k, (text, found) in enumerate(zip(batch["_text"], sources.of(batch), strict=True)):
                own = words(text)
                gone, spans = np.zeros(len(own) + 1, dtype=np.int64), []
                if copied[k]:
                    gone[0] = int(len(own) >= window)
                elif not np.isnan(ids[k]):
                    spans = _paths(*found, int(plain[k]))
                    for at, _, _, n in spans:
                        gone[at] += 1
                        gone[at + n + window - 1] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                whole = bool(stay.all())
                left = b" ".join(own if whole else [w for w, keep in zip(own, stay, strict=True) if keep])
                told = [
                    {"_key": key, "_n": n, "_source": source, "_digest": _digest(own[at : at + n + window - 1])}
                    for at, key, source, n in spans
                ]
                row = [len(own), int((~stay).sum()), hashlib.sha256(left).hexdigest(), told]
                if with_text:
                    row.append(text if whole else left.decode("utf-8", "surrogatepass"))
                out.append(row)
            done = pd.DataFrame(out, columns=names)
            yield pd.concat([batch[["_id", "_carried"]].reset_index(drop=True), done], axis=1)

    carried_type = docs.schema["_carried"].dataType.simpleString()
    schema = f"_id long, _carried {carried_type}, n_words long, n_removed long, kept_sha256 string"
    schema += f", _spans array<{_SPAN}>" + ", kept_text string" * with_text
    done = written(docs.select("_id", "_carried", "_text", "_t1", "_t2").mapInPandas(cut, schema), "repeat-free")
    spans = done.select("_id", F.explode("_spans").alias("_s")).select("_id", "_s.*")
    _verify(spans, docs.select("_id", "_text"), sources)
    columns = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    own = [F.col("_carried")[c].alias(c) for c in carried or []]
    return done.select(F.col("_id").cast(id_type).alias(id_col), *columns, *own)


def _paths(
    at: np.ndarray, key: np.ndarray, source: np.ndarray, doc: int
) -> list[tuple[int, int, int, int]]:
    """(first window, its key, source, number of windows) of maximal runs of windows that
    have one source with an id below ``doc``."""
    here = source < doc
    at, key, source = at[here], key[here].view(np.int64), source[here]
    if not len(at):
        return []
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (source[1:] != source[:-1])
    head = np.nonzero(new)[0]
    n = np.diff(np.append(head, len(at)))
    return [(int(at[h]), int(key[h]), int(source[h]), int(c)) for h, c in zip(head, n, strict=True)]
