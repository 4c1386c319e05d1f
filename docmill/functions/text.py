"""String predicates that follow the contract's idea of blank and trimmed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters of the contract. No-break spaces are
# not among them; U+3000 is.
WHITESPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
    r"\x{2028}\x{2029}\x{205F}\x{3000}"
)


def is_blank(value: Column) -> Column:
    """True for null, empty or whitespace only."""
    return ~F.coalesce(value.rlike(f"[^{WHITESPACE}]"), F.lit(False))


def non_blank(value: Column) -> Column:
    return F.coalesce(value.rlike(f"[^{WHITESPACE}]"), F.lit(False))


def trimmed(value: Column) -> Column:
    """Drop spaces and control characters at both ends."""
    return F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def flag(value: Column) -> Column:
    """A nullable boolean read as false when absent."""
    return F.coalesce(value, F.lit(False))


def as_bytes(content: Column) -> Column:
    """Content as binary, whether the column holds text or bytes."""
    return content.cast("binary")


def as_text(content: Column) -> Column:
    return content.cast("string")
