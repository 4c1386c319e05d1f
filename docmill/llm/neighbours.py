"""Quality by nearest-neighbour voting among latent-semantic vectors.

A text's terms are hashed byte trigrams (letters' case and symbols tell) and a few
terms for how often its words repeat. A bounded sample of labelled rows gives
term weights and the leading singular vectors; its latent vectors and labels are
broadcast, and every document takes the exact cosine to each of them, in blocks.
The closest vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model holds at most; what bounds the broadcast.
SAMPLE = 6_000
TRIGRAM_TERMS = 4_096
RANK = 96
NEIGHBOURS = 25
#: Similarities are raised to this power as weights, so that close ones count more.
SHARPNESS = 8
CUT = 0.3
_SHAPE_BINS = 16
_SHAPES = 4
TERMS = TRIGRAM_TERMS + _SHAPES * _SHAPE_BINS
_BLOCK = 512


def _soft_bin(out: np.ndarray, share: float) -> None:
    """A share between 0 and 1 as two neighbouring bins."""
    at = min(max(share, 0.0), 1.0) * (_SHAPE_BINS - 1)
    low = int(at)
    out[low] += low + 1 - at
    if low + 1 < _SHAPE_BINS:
        out[low + 1] += at - low


def terms_of(text: str | None) -> np.ndarray:
    """Term counts of a whole text, damped; an empty text has none."""
    out = np.zeros(TERMS, dtype=np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) == 0:
        return out
    if len(data) >= 3:
        wide = data.astype(np.uint32)
        code = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761)
        counts = np.bincount(code >> np.uint32(20), minlength=TRIGRAM_TERMS)
        out[:TRIGRAM_TERMS] = np.sqrt(counts / len(data))
    words = data.tobytes().split()
    if words:
        n, seen = len(words), len(set(words))
        shapes = out[TRIGRAM_TERMS:].reshape(_SHAPES, _SHAPE_BINS)
        letters = ((data >= 65) & (data <= 90)).sum(), ((data >= 97) & (data <= 122)).sum()
        symbols = ((data > 32) & (data < 127)).sum() - sum(letters)
        _soft_bin(shapes[0], seen / n)
        _soft_bin(shapes[1], float(letters[0] / max(1, sum(letters))))
        _soft_bin(shapes[2], float(symbols / len(data)) * 2)
        _soft_bin(shapes[3], np.log1p(n) / 10)
        shapes *= 0.15
    return out


class Voter:
    """The fitted model: term weights, singular vectors, latent sample and labels. The
    given terms are weighted in place, as they are the largest array here."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray, rank: int = RANK):
        present = np.count_nonzero(terms, axis=0)
        self.weight = np.log((1 + len(terms)) / (1 + present)).astype(np.float32) + 0.1
        weighted = terms
        weighted *= self.weight
        length = np.sqrt(np.einsum("ij,ij->i", weighted, weighted))[:, None]
        weighted /= np.where(length > 0, length, 1)
        self.axes = _leading(weighted, min(rank, *weighted.shape))
        self.latent = self._normal(weighted @ self.axes)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean())

    @staticmethod
    def _normal(rows: np.ndarray) -> np.ndarray:
        length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return (rows / np.where(length > 0, length, 1)).astype(np.float32)

    def score(self, terms: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 in the vote; texts without terms get the sample's mean."""
        latent = self._normal(self._normal(terms * self.weight) @ self.axes)
        cosine = latent @ self.latent.T
        k = min(neighbours, len(self.labels))
        close = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosine, close, axis=1), 0, 1) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = (weight * self.labels[close]).sum(axis=1) / np.where(total > 0, total, 1)
        known = (total > 0) & (terms.max(axis=1) > 0)
        return np.where(known, vote, self.prior).astype(np.float64)


def _leading(rows: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    rng = np.random.default_rng(5)
    basis = rng.standard_normal((rows.shape[1], min(rank + 16, *rows.shape))).astype(np.float32)
    for _ in range(6):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    small = rows @ basis
    _, _, turn = np.linalg.svd(small.T @ small)
    return (basis @ turn.T)[:, :rank].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Voter:
    """A voter from at most ``sample`` labelled rows, those of the smallest hash of the
    id; documents without a text, and labels other than 0 and 1, are left out. An id
    labelled both ways counts with both labels."""
    marks = labels.filter("label IN (0, 1)").select("_id", F.col("label").cast("int").alias("label"))
    chosen = marks.distinct().orderBy(F.xxhash64("_id"), "_id", "label").limit(sample)
    # The chosen labels are at most ``sample`` narrow rows, so they can be broadcast.
    texts = docs.filter("_text IS NOT NULL").join(F.broadcast(chosen), "_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blobs = [terms_of(t).astype(np.float16).tobytes() for t in batch["_text"]]
            yield pd.DataFrame({"_id": batch["_id"], "label": batch["label"], "b": blobs})

    id_type = docs.schema["_id"].dataType.simpleString()
    found = texts.mapInPandas(features, f"_id {id_type}, label int, b binary")
    # A repeated document could exceed the bound; the smallest rows count.
    rows = found.orderBy(F.xxhash64("_id"), "_id", "label", F.xxhash64("b")).limit(sample).collect()
    if not rows:
        return Voter(np.zeros((1, TERMS), np.float32), np.array([0.5]))
    terms = np.empty((len(rows), TERMS), dtype=np.float32)
    for k, r in enumerate(rows):
        terms[k] = np.frombuffer(r["b"], np.float16)
    marks = np.array([r["label"] for r in rows])
    del rows
    return Voter(terms, marks)


def vote_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    cut: float = CUT,
    learn_from: str = "true",
) -> DataFrame:
    """One row per document: id, score (0 to 1, higher for label 1), predicted.

    Labels are learnt only from rows for which the SQL condition ``learn_from`` on the
    column ``_id`` holds. Null and empty texts get the mean label of the sample; with
    no usable label every score is 0.5. Repeated rows and null ids are scored like
    others. Only the text is an input of the score; other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"))
    voter = docs.sparkSession.sparkContext.broadcast(
        fit(docs.filter(learn_from), marks.filter(learn_from), sample)
    )
    id_type = docs.schema["_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [np.zeros(0)]
            for at in range(0, len(batch), _BLOCK):
                block = np.stack([terms_of(t) for t in batch["_text"].iloc[at : at + _BLOCK]])
                scores.append(voter.value.score(block))
            yield pd.DataFrame({"_id": batch["_id"], "score": np.concatenate(scores)})

    scored = docs.mapInPandas(score, f"_id {id_type}, score double")
    return scored.select(
        F.col("_id").alias(id_col), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )
