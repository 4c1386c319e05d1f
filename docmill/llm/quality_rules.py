"""Quality rules: fixed limits, then robust multivariate outliers.

Every text becomes a vector of transformed statistics. For each language and source
a minimum-covariance-determinant estimate is found by concentration steps: the
rows closest to the present estimate (three quarters of them) give the next one.
Steps are Spark aggregations over all rows of a group, so no group is collected.
Every group has its own centre; its covariance is shrunk towards the one common within
groups, by a weight that falls smoothly with the group's rows.
A text is rejected where its Mahalanobis distance exceeds a chi-square quantile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import written

# Fixed values of the base rules.
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

#: Part of a group's rows that carries the estimate.
SUPPORT = 0.75
STEPS = 5
#: Rows that the spread within all groups counts as in each; from as many rows on, a
#: group's own spread weighs more.
LEAST_ROWS = 30
#: Chance of a larger distance for a normal vector.
TAIL = 1e-9
#: Spread that each statistic is given at least, so that one which hardly varies
#: within a group does not reject what differs a little.
LEAST_SPREAD = {
    "log_words": 0.5,
    "log_word_length": 0.08,
    "root_symbols": 0.05,
    "root_dup_lines": 0.1,
    "root_repeats": 0.1,
    "root_capitals": 0.05,
}
#: Added to a text's lines and words, so that one repetition in a short text weighs little.
SHORT_LINES = 5
SHORT_WORDS = 50
FEATURES = list(LEAST_SPREAD)
DIM = len(FEATURES)
_UPPER = [(i, j) for i in range(DIM) for j in range(i, DIM)]
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
STATISTICS = _BASE + "".join(f", {name} double" for name in FEATURES)

_KIND = np.zeros(256, dtype=np.int64)
_KIND[list(b" \t\n\v\f\r")] = 1
_KIND[0x80:0xC0] = 2  # continuation bytes of UTF-8
_KIND[list(SYMBOLS)] = 3
_KIND[ord("A") : ord("Z") + 1] = 4


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words within windows of ``window`` words (a power of two) that occur twice or
    more. Windows are ranked by doubling, so equal ranks mean equal words."""
    if len(words) < window + 1:
        return 0
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    width, counts = 1, None
    while width < window:
        pairs = rank[:-width] * (rank.max() + 1) + rank[width:]
        _, rank, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(counts) == len(rank):
            return 0
        width *= 2
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    twice = np.nonzero(counts[rank] > 1)[0]
    np.add.at(starts, twice, 1)
    np.add.at(starts, twice + window, -1)
    return int((np.cumsum(starts) > 0).sum())


def statistics_of(text: str | None) -> tuple:
    """The values of ``STATISTICS``; a text without words has zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    kinds = np.bincount(_KIND[np.frombuffer(data, dtype=np.uint8)], minlength=5)
    chars = len(data) - int(kinds[1]) - int(kinds[2])
    symbols = int(kinds[3])
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    n = len(words)
    return (
        n,
        chars,
        symbols,
        dup,
        repeats,
        math.log1p(n),
        math.log(chars / n) if n else 0.0,
        math.sqrt(symbols / chars) if chars else 0.0,
        math.sqrt(dup / (len(lines) + SHORT_LINES)),
        math.sqrt(repeats / (n + SHORT_WORDS)),
        math.sqrt(int(kinds[4]) / chars) if chars else 0.0,
    )


def _rows_of(texts: pd.Series) -> pd.DataFrame:
    names = [x.split()[0] for x in STATISTICS.split(", ")]
    return pd.DataFrame([statistics_of(t) for t in texts], columns=names)


def _statistics(text: Column) -> Column:
    # Of a function that Spark takes to be deterministic, filters on its result make a second
    # copy below: each text is then read twice, and a task holds two Python workers.
    return F.pandas_udf(_rows_of, STATISTICS).asNondeterministic()(text)


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


# --- minimum covariance determinant -------------------------------------------


def _chi2_cdf(x: float, dof: int) -> float:
    """For even degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, dof // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p_above: float, dof: int) -> float:
    """The value that a chi-square variable exceeds with probability ``p_above``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        term, total = 1.0, 1.0
        for k in range(1, dof // 2):
            term *= middle / 2 / k
            total += term
        if math.exp(-middle / 2) * total > p_above:
            low = middle
        else:
            high = middle
    return high


def consistency(support: float, dof: int) -> float:
    """What the covariance of the closest rows of a normal sample is too small by."""
    return support / _chi2_cdf(chi2_quantile(1 - support, dof), dof + 2)


def _distance(center: str = "_mean", inverse: str = "_inverse") -> Column:
    """Squared Mahalanobis distance, as plain arithmetic."""
    away = [f"(`{name}` - {center}[{i}])" for i, name in enumerate(FEATURES)]
    parts = []
    for i in range(DIM):
        for j in range(i, DIM):
            parts.append(f"{1 if i == j else 2} * {inverse}[{i * DIM + j}] * {away[i]} * {away[j]}")
    return F.expr(" + ".join(parts))


def _moments() -> list[Column]:
    out = [F.count(F.lit(1)).alias("_n")]
    out += [F.avg(name).alias(f"_m{i}") for i, name in enumerate(FEATURES)]
    out += [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"_c{i}_{j}") for i, j in _UPPER]
    return out


def _common(moments: DataFrame) -> np.ndarray:
    """The covariance within groups, over all groups; zeros if no group has two rows."""
    sums = [F.sum(F.col("_n") * F.col(f"_c{i}_{j}")) for i, j in _UPPER]
    free, *upper = moments.agg(F.sum("_n") - F.count(F.lit(1)), *sums).first()
    return _symmetric([x / free for x in upper]) if free else np.zeros((DIM, DIM))


def _symmetric(upper) -> np.ndarray:
    out = np.empty((DIM, DIM))
    for (i, j), x in zip(_UPPER, upper, strict=True):
        out[i, j] = out[j, i] = x
    return out


def _inverted(moments: DataFrame, scale: float, common: np.ndarray | None = None, rows: float = 0) -> DataFrame:
    """(_group, _mean, _inverse) from moments; variances get their least spread. The
    covariance ``common`` counts as so many ``rows`` of each group."""
    floor = np.diag(np.array(list(LEAST_SPREAD.values())) ** 2)

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            mean, inverse = [], []
            for row in batch.to_dict("records"):
                mean.append([row[f"_m{i}"] for i in range(DIM)])
                cov = _symmetric([row[f"_c{i}_{j}"] for i, j in _UPPER])
                if common is not None:
                    cov = (row["_n"] * cov + rows * common) / (row["_n"] + rows)
                inverse.append(np.linalg.inv(cov * scale + floor).ravel().tolist())
            yield pd.DataFrame({"_group": batch["_group"], "_mean": mean, "_inverse": inverse})

    return moments.mapInPandas(invert, "_group string, _mean array<double>, _inverse array<double>")


def estimates(
    stats: DataFrame, least_rows: int = LEAST_ROWS, support: float = SUPPORT, steps: int = STEPS
) -> DataFrame:
    """(_group, _mean, _inverse) of each group of ``stats`` (columns _group and
    ``FEATURES``), from all of its rows. Small tables, one row per group. The last step
    adds the spread within all groups to each, as ``least_rows`` rows of its own."""
    centers = [F.percentile_approx(name, 0.5, 1000).alias(f"_q{i}") for i, name in enumerate(FEATURES)]
    middle = stats.groupBy("_group").agg(*centers)
    floors = list(LEAST_SPREAD.values())
    start = [[f"{1 / floors[i] ** 2 if i == j else 0.0}D" for j in range(DIM)] for i in range(DIM)]
    present = written(
        middle.select(
            "_group",
            F.array(*[F.col(f"_q{i}").cast("double") for i in range(DIM)]).alias("_mean"),
            F.expr(f"array({', '.join(x for row in start for x in row)})").alias("_inverse"),
        ),
        "mcd-start",
    )
    scale = consistency(support, DIM)
    for step in range(steps):
        away = stats.join(present, "_group").withColumn("_d", _distance())
        limits = away.groupBy("_group").agg(F.percentile_approx("_d", support, 1000).alias("_limit"))
        near = written(limits, "mcd-limits")  # read back, its size is known
        closest = away.join(near, "_group").filter("_d <= _limit")
        moments = closest.groupBy("_group").agg(*_moments())
        if step < steps - 1:
            present = written(_inverted(moments, scale), "mcd-step")
    moments = written(moments, "mcd-moments")
    return written(_inverted(moments, scale, _common(moments), least_rows), "mcd-estimates")


def _group(lang: Column, source: Column) -> Column:
    """A group's name; null languages and sources are groups of their own."""
    return F.to_json(F.struct(lang.alias("l"), source.alias("s")))


def judged(
    stats: DataFrame, rows: DataFrame, least_rows: int = LEAST_ROWS, tail: float = TAIL
) -> DataFrame:
    """``rows`` (with _lang, _source and the columns of ``STATISTICS``) with base_failed,
    distance and kept, by estimates from ``stats``: the same rows, written, without texts."""

    def grouped(table: DataFrame) -> DataFrame:
        own = _group(F.col("_lang"), F.col("_source"))
        return table.withColumn("_own", own).withColumn("base_failed", base_failed())

    stats, rows = grouped(stats), grouped(rows)
    sound = stats.filter("NOT base_failed")
    found = estimates(sound.withColumn("_group", F.col("_own")).select("_group", *FEATURES), least_rows)
    limit = chi2_quantile(tail, DIM)
    return (
        rows.withColumn("_group", F.col("_own"))
        .join(found, "_group", "left")
        .withColumn("distance", _distance())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))
        .drop("_group", "_own", "_mean", "_inverse")
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_rows: int = LEAST_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, distance.

    Null and empty texts have no words and fail. Null languages and sources form
    groups like others. Repeated rows and null ids are judged like others. Other
    columns are not read. Estimates cover all rows that pass the base rules; a group of
    any size has its own, in which the common spread counts as ``least_rows`` rows.
    """
    stats = written(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(lang_col).alias("_lang"),
            F.col(source_col).alias("_source"),
            _statistics(F.col(text_col)).alias("_s"),
        ).select("_id", "_lang", "_source", "_s.*"),
        "statistics",
    )
    return judged(stats, stats, least_rows, tail).select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "distance",
    )


def sound_documents(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_rows: int = LEAST_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """The documents that are kept, with their columns."""
    # Statistics are computed twice, so that texts are neither written nor moved for them.
    whole = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
        F.col(lang_col).alias("_lang"),
        F.col(source_col).alias("_source"),
        _statistics(F.col(text_col)).alias("_s"),
    ).select("_doc", "_lang", "_source", "_s.*")
    stats = written(whole.drop("_doc"), "statistics")
    return judged(stats, whole, least_rows, tail).filter("kept").select("_doc.*")
