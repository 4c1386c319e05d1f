"""What a zip file's own directory says, read with built-in expressions.

A zip may hold other zips, whole and unpacked, so that their bytes stand in its data.
Only the directory at its end tells which entries it has itself, and only its
first entry tells the media type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill import rules
from docmill.functions.bind import let

#: Sizes of the record at the end and of the fields before names; the
#: longest comment that may follow the record.
_END_SIZE, _ENTRY_SIZE, _LOCAL_SIZE, _LONGEST_COMMENT = 22, 46, 30, 65_535


def _number(data: Column, at: Column, size: int) -> Column:
    """A little-endian number at a place counted from 0."""

    def turned(digits: Column) -> Column:
        return F.conv(F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))]), 16, 10)

    return let(F.hex(F.substring(data, at + 1, F.lit(size))), turned).cast("long")


def _latin(data: Column) -> Column:
    """A character for each byte, so that patterns can be used."""
    return F.decode(data, "ISO-8859-1")


def directory(data: Column) -> Column:
    """The directory of a zip as text of one character for each byte; null if there is none.

    The record that says where it lies is the last one whose comment ends with the file.
    """
    size = F.octet_length(data)
    tail_size = F.least(size, F.lit(_END_SIZE + _LONGEST_COMMENT))
    tail = F.substring(data, size - tail_size + 1, tail_size)
    # the last mark: what follows it has no other; without one all of the tail does
    behind = F.length(F.substring_index(_latin(tail), rules.ZIP_END.decode("latin-1"), -1))

    def listed(end: Column) -> Column:
        whole = (end >= 0) & (end + _END_SIZE + _number(data, end + 20, 2) == size)
        place = F.struct(_number(data, end + 16, 4).alias("start"), _number(data, end + 12, 4).alias("length"))
        return F.when(whole, let(place, lambda at: F.when(
            at["start"] + at["length"] <= end,
            _latin(F.substring(data, (at["start"] + 1).cast("int"), at["length"].cast("int"))),
        )))

    return let(size - behind - len(rules.ZIP_END), listed)


def has_entry(listed: Column, name: bytes) -> Column:
    """Whether a directory has an entry of just this name: its header gives the name's length."""
    mark = "".join(f"\\x{b:02x}" for b in rules.ZIP_ENTRY)
    length = "".join(f"\\x{b:02x}" for b in len(name).to_bytes(2, "little"))
    # 24 bytes to the length of the name, then 16 to the name itself
    pattern = rf"(?s){mark}.{{24}}{length}.{{16}}\Q{name.decode()}\E"
    return listed.rlike(pattern)


def media_type(data: Column) -> Column:
    """The media type that the first entry states, as bytes; null if it is not that entry."""
    zero = F.lit(0)
    name, extra = _number(data, zero + 26, 2), _number(data, zero + 28, 2)
    size, method = _number(data, zero + 18, 4), _number(data, zero + 8, 2)
    named = F.substring(data, _LOCAL_SIZE + 1, len(rules.ZIP_TYPE_NAME)) == F.lit(rules.ZIP_TYPE_NAME)
    plain = (name == len(rules.ZIP_TYPE_NAME)) & named & (method == 0)
    start = (extra + _LOCAL_SIZE + len(rules.ZIP_TYPE_NAME) + 1).cast("int")
    return F.when(plain, F.substring(data, start, F.least(size, F.lit(256)).cast("int")))
