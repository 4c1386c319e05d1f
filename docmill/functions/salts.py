"""Salts of row ids, and the set of salts a key's rows use.

The set is kept as bits of a few longs, which Spark aggregates in its hash
aggregation without objects and without sorting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALTS = 256
_BITS = 64


def salt(id_col: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int")


def used_salts(salt_col: str, salts: int = SALTS) -> dict[str, Column]:
    """Aggregates that note which salts occur; read them with ``salt_list``."""
    value = F.col(salt_col)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), value % _BITS)
    return {
        name: F.bit_or(F.when(F.floor(value / _BITS) == word, bit).otherwise(F.lit(0).cast("long")))
        for word, name in enumerate(_words(salts))
    }


def _words(salts: int) -> list[str]:
    return [f"_salts{word}" for word in range(-(-salts // _BITS))]


def salt_list(salts: int = SALTS) -> Column:
    """The noted salts as an array."""
    bits = F.sequence(F.lit(0), F.lit(_BITS - 1))

    def noted(word: int, name: str) -> Column:
        found = F.transform(
            F.filter(bits, lambda b: F.getbit(F.col(name), b) == 1), lambda b: b + word * _BITS
        )
        return F.when(F.col(name) == 0, F.array().cast("array<int>")).otherwise(found)

    return F.concat(*[noted(word, name) for word, name in enumerate(_words(salts))])
