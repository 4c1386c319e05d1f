"""Byte-level BPE encoding and decoding with overlapping chunks.

A text is cut into chunks that overlap. Chunks are pre-tokenised independently;
two neighbours are stitched at the first pre-token boundary that both have in
their overlap, since from a shared boundary on the pattern splits both alike (it
never looks back). Spans between stitches are then encoded on their own. Where
an overlap has no shared boundary nothing is cut, so the result never depends on
chunk sizes. Texts of one chunk need no stitch and are encoded where they are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import small_batches

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
#: Bytes up to which rescanning a piece's pairs is faster than a heap.
SHORT_PIECE = 100
_NEVER = 1 << 40
#: Encodings of pieces each Python worker keeps at most.
KEPT_PIECES = 250_000

# Fixed value: the white space of the pattern's dialect. The pattern is written for an engine
# whose \s is the Unicode property; the class is spelled out so that no engine adds to it.
_SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def compile_pattern(pattern: str) -> regex.Pattern:
    """The pre-tokenising pattern with white space as the Unicode property."""
    inner = pattern.replace(r"[^\s", f"[^{_SPACE}")
    return regex.compile(inner.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings, one ``base64 rank`` pair a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    rank = ranks.get
    pairs = [rank(a + b, _NEVER) for a, b in pairwise(parts)]
    while pairs and (least := min(pairs)) != _NEVER:
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], _NEVER)
    return tuple(map(ranks.__getitem__, parts))


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: the adjacent pair of lowest rank merges first, the
    leftmost among equals. A heap keeps long pieces at n log n."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    if len(piece) <= SHORT_PIECE:
        return _merge_short(piece, ranks)
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        left = before[i]
        if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
            heappush(heap, (r, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(ids)


class ByteBPE:
    """Encodes and decodes texts; made once in each task."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = read_ranks(ranks_path)
        self.pattern = compile_pattern(pattern)
        self.bytes_of = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self._known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        pieces = self.pattern.findall(text)
        known = self._known
        if len(known) > KEPT_PIECES:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = merge_piece(piece.encode("utf-8", "surrogatepass"), self.ranks)
        return list(chain.from_iterable(map(known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def text_of(self, ids: list[int]) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]


def encode_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    with_ids: bool = False,
    with_decoded: bool = False,
) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, and on demand
    ``ids`` (array) and ``decoded`` (binary).

    Null and empty texts have no tokens; both digests are those of nothing. Each
    repeated row is encoded for itself; null ids are kept. Other columns are not read.
    ``ranks_path`` must be readable on every executor (a file of an installed package).
    """
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("the overlap must be positive and at most a chunk")
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    fits = F.coalesce(F.length("_text"), F.lit(0)) <= chunk_chars
    id_type = docs.schema["_id"].dataType.simpleString()
    extra = ["ids array<int>"] * with_ids + ["decoded binary"] * with_decoded
    schema = ", ".join(
        [f"_id {id_type}", "n_tokens long", "ids_sha256 string", "decoded_sha256 string", *extra]
    )

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = ByteBPE(ranks_path, pattern)
        for batch in small_batches(batches, "_text"):
            rows = []
            for text in batch["_text"]:
                ids = tokenizer.encode(text or "")
                decoded = tokenizer.decode(ids)
                digests = hashlib.sha256(tokenizer.text_of(ids).encode()), hashlib.sha256(decoded)
                row = [len(ids), *[d.hexdigest() for d in digests]]
                row += [np.array(ids, dtype=np.int32)] * with_ids + [decoded] * with_decoded
                rows.append(row)
            names = [x.split()[0] for x in schema.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[]] * (len(names) - 1)
            out = dict(zip(names[1:], map(list, columns), strict=True))
            yield pd.DataFrame({"_id": batch["_id"], **out})

    short = docs.filter(fits).mapInPandas(whole, schema)
    long = _long_texts(docs.filter(~fits), ranks_path, pattern, chunk_chars, overlap_chars)
    ids = F.when(F.col("ids") == "", F.array().cast("array<int>")).otherwise(
        F.split("ids", ",").cast("array<int>")
    )
    long = long.withColumn("ids", ids).select(short.columns)
    return short.unionByName(long).withColumnRenamed("_id", id_col)


def _long_texts(
    docs: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int
) -> DataFrame:
    """Texts of several chunks. Row numbers come from the scan's own order, which
    a task that runs again repeats."""
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    starts = F.sequence(F.lit(0), F.length("_text") - 1, F.lit(chunk))
    chunks = (
        docs.select("_row", "_text", F.posexplode(starts).alias("_k", "_start"))
        .select(
            "_row",
            "_k",
            "_start",
            F.expr(f"substring(_text, _start + 1, {chunk + overlap})").alias("_chunk"),
        )
        .repartition("_row", "_k")
    )

    def boundaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each chunk the boundaries in its first and its last ``overlap`` characters.
        The last boundary of a cut chunk may move with more text and is left out."""
        tokenizer = ByteBPE(ranks_path, pattern)
        for batch in batches:
            out = []
            for row, k, start, text in batch.itertuples(index=False):
                found = tokenizer.starts(text)
                head = [start + p for p in found if p < overlap]
                tail = [start + p for p in found[:-1] if p >= chunk]
                out += [(row, k, True, head), (row, k + 1, False, tail)]
            yield pd.DataFrame(out, columns=["_row", "_seam", "_is_head", "_at"])

    marks = chunks.mapInPandas(
        boundaries, "_row long, _seam int, _is_head boolean, _at array<int>"
    )
    seams = (
        marks.filter("_seam > 0")
        .groupBy("_row", "_seam")
        .agg(
            F.max(F.when(F.col("_is_head"), F.col("_at"))).alias("_head"),
            F.max(F.when(~F.col("_is_head"), F.col("_at"))).alias("_tail"),
        )
        .filter("_head IS NOT NULL")  # behind the last chunk there is no seam
        .withColumn("_cut", F.array_min(F.array_intersect("_head", "_tail")))
    )
    # A seam counts only if all before it were found: only then is its left chunk in step.
    cuts = seams.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("_seam", "_cut"))).alias("_seams")
    )
    missing = F.expr("filter(_seams, s -> s._cut IS NULL)._seam")
    first_missing = F.coalesce(F.array_min(missing), F.lit(2**31 - 1))
    cuts = cuts.withColumn("_first_missing", first_missing).select(
        "_row", F.expr("filter(_seams, s -> s._seam < _first_missing)._cut").alias("_cuts")
    )
    spans = (
        docs.join(cuts, "_row")
        .withColumn("_from", F.concat(F.array(F.lit(0)), F.col("_cuts")))
        .withColumn("_to", F.concat(F.col("_cuts"), F.array(F.length("_text"))))
        .select("_row", "_id", "_text", F.posexplode(F.arrays_zip("_from", "_to")).alias("_k", "_s"))
        .select(
            "_row", "_id", "_k", F.expr("substring(_text, _s._from + 1, _s._to - _s._from)").alias("_span")
        )
        .repartition("_row", "_k")
    )
    id_type = docs.schema["_id"].dataType.simpleString()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = ByteBPE(ranks_path, pattern)
        for batch in small_batches(batches, "_span"):
            found = [tokenizer.encode(span) for span in batch["_span"]]
            yield batch.drop(columns="_span").assign(
                n=[len(ids) for ids in found],
                ids=[tokenizer.text_of(ids) for ids in found],
                decoded=[tokenizer.decode(ids) for ids in found],
            )

    parts = spans.mapInPandas(
        encode, f"_row long, _id {id_type}, _k int, n long, ids string, decoded binary"
    )
    whole = parts.groupBy("_row", "_id").agg(
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("_k", "ids", "decoded"))).alias("_parts"),
    )
    return whole.select(
        "_id",
        "n_tokens",
        F.array_join("_parts.ids", ",").alias("ids"),
        F.expr("aggregate(_parts.decoded, cast('' as binary), (a, b) -> concat(a, b))").alias("decoded"),
    ).select(
        "_id",
        "n_tokens",
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
        "decoded",
    )
