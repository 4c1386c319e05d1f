"""URL allow and block rules by a cascade of Bloom filters.

The listed keys are encoded by a first filter; of all keys that the corpus asks
for (its key universe) those it passes wrongly are encoded by a second filter; the
listed keys that pass the second one by a third; and so on until a filter errs no
more. A key of the universe is listed exactly if the first filter that rejects it
is an even one. Membership thus needs no join with the list, and the cascade's
size depends on the list: the first filter's error rate is set so that about as
many keys pass it wrongly as are listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules one cascade may list; its filters are broadcast, at about 3 bytes a rule.
MAX_RULES = 20_000_000
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


class Bloom:
    """A Bloom filter over pairs of 64-bit hashes, with double hashing."""

    def __init__(self, n: int, error: float, level: int):
        self.bits = max(64, math.ceil(n * math.log(1 / error) / math.log(2) ** 2))
        self.hashes = max(1, round(self.bits / max(n, 1) * math.log(2)))
        self.level = level
        self.field = np.zeros(-(-self.bits // 8), dtype=np.uint8)

    def _positions(self, pairs: np.ndarray) -> Iterator[np.ndarray]:
        first, second = pairs[:, 0], pairs[:, 1] | np.uint64(1)
        with np.errstate(over="ignore"):
            # another mixture at each level, so that levels err independently
            first = _mixed(first + np.uint64(self.level) * np.uint64(0x9E3779B97F4A7C15))
            for i in range(self.hashes):
                yield (first + np.uint64(i) * second) % np.uint64(self.bits)

    def add(self, pairs: np.ndarray) -> None:
        for at in self._positions(pairs):
            np.bitwise_or.at(self.field, at >> np.uint64(3), _bit(at))

    def passes(self, pairs: np.ndarray) -> np.ndarray:
        found = np.ones(len(pairs), dtype=bool)
        for at in self._positions(pairs):
            found &= (self.field[at >> np.uint64(3)] & _bit(at)) != 0
        return found


def _bit(at: np.ndarray) -> np.ndarray:
    return (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Cascade:
    """Levels of Bloom filters; exact for the universe that it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def contains(self, pairs: np.ndarray) -> np.ndarray:
        """Whether the key is listed, for each pair of hashes."""
        listed = np.zeros(len(pairs), dtype=bool)
        open_ = np.arange(len(pairs))
        for depth, bloom in enumerate(self.levels):
            passed = bloom.passes(pairs[open_])
            listed[open_[~passed]] = depth % 2 == 1
            open_ = open_[passed]
            if not len(open_):
                return listed
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _as_pairs(first: pd.Series, second: pd.Series) -> np.ndarray:
    pairs = np.empty((len(first), 2), dtype=np.uint64)
    pairs[:, 0] = first.to_numpy(np.int64).view(np.uint64)
    pairs[:, 1] = second.to_numpy(np.int64).view(np.uint64)
    return pairs


def hashed(key: Column) -> list[Column]:
    """The two hashes that stand for a key."""
    return [F.xxhash64(key).alias("_h1"), _second_hash(key).alias("_h2")]


def _second_hash(key: Column) -> Column:
    """Not a function of the first: what comes first is the seed of what follows."""
    return F.xxhash64(F.lit(1), key)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade for the keys of ``listed`` (bounded by ``MAX_RULES``) that is exact
    over ``universe``; both have the columns ``_h1`` and ``_h2``. Each pass over the
    universe tests all of its keys; only those that a filter passes wrongly, about
    as many as are listed, come to the driver."""
    inside = _collected(listed)
    size = max(1, universe.agg(F.approx_count_distinct("_h1")).first()[0])
    n = max(1, len(inside))
    levels = [Bloom(n, max(1e-12, min(0.5, n * math.sqrt(0.5) / size)), 0)]
    levels[0].add(inside)
    first, known = levels[0], {tuple(x) for x in inside.tolist()}

    def wrongly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[first.passes(_as_pairs(batch["_h1"], batch["_h2"]))]

    passed = universe.mapInPandas(wrongly, "_h1 long, _h2 long").distinct()
    outside = _collected(passed)
    outside = np.array([x for x in outside.tolist() if tuple(x) not in known], dtype=np.uint64).reshape(-1, 2)
    inner, other = inside, outside
    while len(other):
        if len(levels) == MAX_LEVELS:
            raise ValueError("the cascade does not end; are two keys' hashes equal?")
        level = Bloom(len(other), 0.5, len(levels))
        level.add(other)
        levels.append(level)
        inner, other = other, inner[level.passes(inner)]
    return Cascade(levels)


def _collected(keys: DataFrame) -> np.ndarray:
    """Keys on the driver; their number is bounded by the list's, and checked."""
    rows = keys.limit(2 * MAX_RULES + 1).toPandas()
    if len(rows) > 2 * MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} listed keys")
    return np.unique(_as_pairs(rows["_h1"], rows["_h2"]), axis=0)


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, path_lengths: list[int], label_counts: list[int]) -> Column:
    """The keys of all rules that could fit, the longest first; of two equally long
    ones, that of the longer host. ``path_lengths`` and ``label_counts`` are those that
    rules have, so a host of many labels has no more suffixes than a short one."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.array_compact(
        F.array(*[F.when(labels >= n, F.substring_index(host, ".", -n)) for n in label_counts])
    )
    keys = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                F.filter(
                    F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length(path)
                ),
                lambda n: F.struct(
                    (-(F.length(s) + n)).alias("order"),
                    (-F.length(s)).alias("host"),
                    F.concat(s, F.substring(path, F.lit(1), n)).alias("key"),
                ),
            ),
        )
    )
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: id, host, path, rule (or null), verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the
    longest rule wins. A url that no rule fits gets ``default``. Null urls and urls
    without ``://`` have empty host and path, and fit no rule with a host. Repeated
    rows and null ids are judged like others; other columns are not read. A key that
    is listed as both allow and block is blocked. A host or path of any length is judged
    whole, in time linear in it.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    spark = pages.sparkSession
    split = pages.select(
        F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path")
    )
    lengths = sorted({len(r.path) for r in rules})
    labels = sorted({r.host.count(".") + 1 for r in rules})
    if not lengths:
        return split.select(
            F.col("_id").alias(id_col),
            F.col("_host").alias("host"),
            F.col("_path").alias("path"),
            F.lit(None).cast("string").alias("rule"),
            F.lit(default).alias("verdict"),
        )
    keyed = split.withColumn("_keys", candidate_keys(F.col("_host"), F.col("_path"), lengths, labels))
    universe = keyed.select(F.explode("_keys").alias("_key")).select(*hashed(F.col("_key")))
    cascades = []
    for verdict in ("block", "allow"):
        keys = spark.createDataFrame(
            [(r.key,) for r in rules if r.verdict == verdict], "_key string"
        )
        cascades.append(build_cascade(keys.select(*hashed(F.col("_key"))), universe))
    block, allow = (spark.sparkContext.broadcast(c) for c in cascades)

    id_type = split.schema["_id"].dataType.simpleString()

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["_keys"].map(len).to_numpy()
            pairs = np.empty((int(sizes.sum()), 2), dtype=np.uint64)
            for column, name in enumerate(("_h1", "_h2")):
                parts = [np.asarray(x, dtype=np.int64) for x in batch[name]]
                pairs[:, column] = np.concatenate([*parts, np.zeros(0, np.int64)]).view(np.uint64)
            blocked, allowed = block.value.contains(pairs), allow.value.contains(pairs)
            rule, verdict, at = [], [], 0
            for keys in batch["_keys"]:
                mine = blocked[at : at + len(keys)] | allowed[at : at + len(keys)]
                if mine.any():
                    first = int(mine.argmax())
                    rule.append(keys[first])
                    verdict.append("block" if blocked[at + first] else "allow")
                else:
                    rule.append(None)
                    verdict.append(default)
                at += len(keys)
            yield pd.DataFrame(
                {"_id": batch["_id"], "host": batch["_host"], "path": batch["_path"], "rule": rule, "verdict": verdict}
            )

    hashes = keyed.select(
        "*",
        F.transform("_keys", lambda k: F.xxhash64(k)).alias("_h1"),
        F.transform("_keys", _second_hash).alias("_h2"),
    )
    schema = f"_id {id_type}, host string, path string, rule string, verdict string"
    return hashes.mapInPandas(judged, schema).withColumnRenamed("_id", id_col)
