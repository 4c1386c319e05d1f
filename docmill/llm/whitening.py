"""Whitened principal components of embeddings, by contour integration.

Spark sums the vectors and their centred products; the driver holds the d x d
covariance alone. Its eigenvalues are counted below a shift by the signs of an LDL'
factorisation (inertia), which cuts the upper spectrum into intervals of few
eigenvalues. For each interval a quadrature of the resolvent (zI - V)^-1 over a circle
through its ends filters random vectors onto its eigenvectors, and a Rayleigh-Ritz step
on that subspace extracts them (FEAST). As many pairs must come out as the inertia
counts of both ends differ by; otherwise the interval is done again with a wider
subspace, so that none is missed.

Defined results
---------------
- A vector that is null, empty, or holds a null or a non-finite entry is dropped. The
  dimension is the greatest length left; a shorter vector lacks entries and is dropped.
- ``floor(64 * c)`` saturates at 2^62, so that whole numbers never overflow.
- Rows that share an id, and equal vectors, are rows of their own; a null id stays null.
- Eigenvalues that are zero to working precision have no component, so a table of one
  vector, or of equal ones, gives no rows; an empty table gives none either.
- A ``deviation`` beyond the range of a long is null.
- Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Eigenvalues of an interval, at most, where they can be told apart.
_IN_INTERVAL = 8
_NODES = 8
_ROUNDS = 12
_MOST = 2.0**62
_HALF = np.int64(1) << np.int64(31)


def usable(vector: Column) -> Column:
    """Not null, not empty, every entry there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


# --- eigenpairs of a symmetric matrix ------------------------------------------------


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie below ``shift``: the negative signs in D of an LDL'
    factorisation of ``matrix - shift``, with pivots of one or two rows (Bunch-Kaufman)."""
    a = matrix - shift * np.eye(len(matrix))
    alpha = (1 + math.sqrt(17)) / 8
    below, k, n = 0, 0, len(a)
    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        largest = column.max(initial=0.0)
        step = 1
        if largest > 0 and abs(a[k, k]) < alpha * largest:
            beside = np.abs(a[r, k:])
            beside[r - k] = 0
            widest = beside.max()
            if abs(a[k, k]) * widest >= alpha * largest * largest:
                pass
            elif abs(a[r, r]) >= alpha * widest:
                _swap(a, k, r)
            else:
                _swap(a, k + 1, r)
                step = 2
        pivot = a[k : k + step, k : k + step].copy()
        if step == 1:
            below += pivot[0, 0] < 0
            if pivot[0, 0] != 0:
                rest = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(rest / pivot[0, 0], rest)
        else:
            below += 1  # a pivot of two rows is taken only where its determinant is negative
            rest = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(pivot, rest.T)
        k += step
    return int(below)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def feast(matrix: np.ndarray, low: float, high: float, expected: int, seed: int = 0) -> np.ndarray:
    """Orthonormal eigenvectors, as columns, of the eigenvalues between two shifts.

    Half the circle is integrated: the matrix is real, so the other half is its conjugate.
    """
    d = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    points, weights = np.polynomial.legendre.leggauss(_NODES)
    angles = np.pi / 2 * (1 - points)
    middle, radius = (low + high) / 2, (high - low) / 2
    shifts = middle + radius * np.exp(1j * angles)
    width = min(d, expected + max(4, expected // 2))
    rng = np.random.default_rng(seed)
    while True:
        basis = rng.standard_normal((d, width))
        for _ in range(_ROUNDS):
            filtered = np.zeros_like(basis)
            for z, angle, weight in zip(shifts, angles, weights, strict=True):
                solved = np.linalg.solve(z * np.eye(d) - matrix, basis)
                filtered += weight / 2 * radius * (np.exp(1j * angle) * solved).real
            kept, size, _ = np.linalg.svd(filtered, full_matrices=False)
            kept = kept[:, size > size[0] * 1e-14]
            values, turn = np.linalg.eigh(kept.T @ matrix @ kept)  # Rayleigh-Ritz
            basis = kept @ turn
            inside = (values >= low) & (values < high)
            left = np.abs(matrix @ basis[:, inside] - basis[:, inside] * values[inside])
            if inside.sum() == expected and left.max(initial=0.0) <= 1e-13 * scale:
                return basis[:, inside]
            if basis.shape[1] < width:
                fresh = rng.standard_normal((d, width - basis.shape[1]))
                basis = np.concatenate([basis, fresh], axis=1)
        if width == d:
            if inside.sum() != expected:
                raise ArithmeticError(f"{inside.sum()} eigenvalues of {expected} in [{low}, {high})")
            return basis[:, inside]
        width = min(d, 2 * width)


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) that hold the ``wanted`` greatest eigenvalues and no
    more than are equal to the least of them; zero ones are left out."""
    d = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max())  # Gershgorin
    if not bound > 0:
        return []
    zero = bound * d * np.finfo(float).eps
    resolution = 64 * zero
    top = bound * (1 + 1e-9)
    above = {top: 0, zero: d - inertia(matrix, zero)}
    low, high = zero, top
    if above[zero] > wanted:  # cut below the last component that is wanted
        while high - low > resolution:
            middle = (low + high) / 2
            above[middle] = d - inertia(matrix, middle)
            if above[middle] == wanted:
                low = middle
                break
            low, high = (middle, high) if above[middle] > wanted else (low, middle)
    open_, done = [(low, top)], []
    while open_:
        low, high = open_.pop()
        count = above[low] - above[high]
        if count <= _IN_INTERVAL or high - low <= resolution:
            if count:
                done.append((low, high, count))
            continue
        middle = (low + high) / 2
        if middle not in above:
            above[middle] = d - inertia(matrix, middle)
        open_ += [(low, middle), (middle, high)]
    return done


def leading_pairs(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their eigenvectors as columns."""
    found = [feast(matrix, *interval, seed=k) for k, interval in enumerate(intervals(matrix, wanted))]
    if not found:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # One more Rayleigh-Ritz step makes vectors of neighbouring intervals orthogonal too.
    basis, _ = np.linalg.qr(np.concatenate(found, axis=1))
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], basis @ turn[:, order]


# --- sums over all rows --------------------------------------------------------------


def whole_numbers(vectors: pd.Series) -> np.ndarray:
    stacked = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * stacked)
    return np.clip(scaled, -_MOST, _MOST).astype(np.int64) + SHIFT


def _sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of whole numbers in each dimension."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, high, low = 0, np.zeros(d, dtype=np.int64), np.zeros(d, dtype=np.int64)
        for batch in batches:
            if len(batch):
                x = whole_numbers(batch["v"])
                n += len(x)
                high += (x >> 32).sum(axis=0)  # halves, whose sums stay whole
                low += (x & (2 * _HALF - 1)).sum(axis=0)
        yield pd.DataFrame({"n": [n] * d, "j": np.arange(d), "high": high, "low": low})

    parts = vectors.mapInPandas(run, "n long, j int, high long, low long")
    total = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = parts.groupBy("j").agg(*total).orderBy("j").collect()  # one row per dimension
    return int(rows[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _products(rows: DataFrame, batch_of, d: int) -> np.ndarray:
    """The sum of outer products of the vectors that ``batch_of`` makes of a batch. A task
    adds up its own before anything is shuffled."""
    at_i, at_j = np.triu_indices(d)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d))
        for batch in batches:
            if len(batch):
                centred = batch_of(batch["v"])
                total += centred.T @ centred
        yield pd.DataFrame({"at": np.arange(len(at_i)), "total": total[at_i, at_j]})

    parts = rows.mapInPandas(run, "at int, total double")
    summed = parts.groupBy("at").agg(F.sum("total").alias("total")).collect()  # d (d + 1) / 2 rows
    out = np.zeros((d, d))
    for r in summed:
        out[at_i[r["at"]], at_j[r["at"]]] = out[at_j[r["at"]], at_i[r["at"]]] = r["total"]
    return out


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component, for components by falling eigenvalue:
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    All usable vectors are fitted. ``identity_error`` is measured on the whitened rows.
    What is collected and broadcast grows with the dimension, not with the rows: sums of
    d entries, d (d + 1) / 2 products, and d x ``components`` weights.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    ).filter(usable(F.col("v")))
    d = vectors.agg(F.max(F.size("v"))).first()[0]
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    if d is None:
        return spark.createDataFrame([], schema)
    vectors = vectors.filter(F.size("v") == d)
    n, sums = _sums(vectors, d)
    # Centred at the whole number next to the mean, products stay exact while they fit
    # the mantissa; what is left of the mean is taken off afterwards, as a fraction.
    base = [round(Fraction(s, n)) for s in sums]
    left = [s - n * b for s, b in zip(sums, base, strict=True)]
    mean = np.array([float(Fraction(r, n)) for r in left])
    centre = np.array([min(max(b, -(2**63)), 2**63 - 1) for b in base], dtype=np.int64)

    def centred(series: pd.Series) -> np.ndarray:
        return (whole_numbers(series) - centre).astype(np.float64)

    covariance = _products(vectors, centred, d) / n - np.outer(mean, mean)
    values, weights = leading_pairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    whitening = weights / np.sqrt(values)
    k = len(values)

    def whitened(series: pd.Series) -> np.ndarray:
        return (centred(series) - mean) @ whitening

    spread = _products(vectors, whitened, k) / n
    error = float(np.abs(spread - np.eye(k)).max())
    explained = [float(v) for v in values / np.trace(covariance)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame(
                    {
                        "vec_id": batch["vec_id"],
                        "deviation": deviations(whole_numbers(batch["v"]), n, base, left),
                        "whitened": list(whitened(batch["v"])),
                    }
                )

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.mapInPandas(run, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>")
    shares = F.array(*[F.lit(x) for x in explained])
    return rows.select(
        "vec_id", F.posexplode("whitened").alias("_at", "whitened"), F.expr("try_cast(deviation AS long)").alias("deviation")
    ).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def deviations(x: np.ndarray, n: int, base: list[int], left: list[int]) -> list:
    """sum (n * x - S)^2 of each row, exactly, with S = n * base + left; None from 10^38 on."""
    from decimal import Decimal

    widest = max(max(abs(int(x.max()) - b), abs(int(x.min()) - b)) for b in base)
    kind = np.int64 if len(base) * max(widest * widest, widest * n, 1) < 2**62 else object
    centre, rest = np.array(base, dtype=kind), np.array(left, dtype=kind)
    off = x.astype(kind) - centre
    squares, mixed = (off * off).sum(axis=1), (off * rest).sum(axis=1)
    constant = sum(r * r for r in left)
    exact = [n * n * int(s) - 2 * n * int(m) + constant for s, m in zip(squares, mixed, strict=True)]
    return [Decimal(value) if value < 10**38 else None for value in exact]
