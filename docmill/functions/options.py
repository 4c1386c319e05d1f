"""Conversion options as one nullable struct per row, and their fingerprint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.text import flag, non_blank, trimmed
from docmill.schemas import OPTIONS


def options(
    include_assets: bool | Column | None = None,
    timeout_seconds: int | Column | None = None,
    use_cache: bool | Column | None = None,
    pages: str | Column | None = None,
    max_pages: int | Column | None = None,
    headers_footers: bool | Column | None = None,
) -> Column:
    """An options struct; what is left out follows the default."""
    given = dict(
        include_assets=include_assets,
        timeout_seconds=timeout_seconds,
        use_cache=use_cache,
        pages=pages,
        max_pages=max_pages,
        headers_footers=headers_footers,
    )
    return F.struct(
        *[
            (v if isinstance(v, Column) else F.lit(v)).cast(OPTIONS[name].dataType).alias(name)
            for name, v in given.items()
        ]
    )


def variant_fingerprint(opts: Column) -> Column:
    """Text that differs whenever the options lead to another product."""

    def piece(label: str, value: Column, present: Column) -> Column:
        return F.when(present, F.concat(F.lit(label), value.cast("string"))).otherwise("")

    timeout, cache, pages, cap, hf = (
        opts[name]
        for name in ("timeout_seconds", "use_cache", "pages", "max_pages", "headers_footers")
    )
    return F.concat(
        piece("t=", timeout, timeout.isNotNull()),
        piece(";c=", cache, cache.isNotNull()),
        piece(";p=", trimmed(pages), non_blank(pages)),
        piece(";mp=", cap, cap.isNotNull()),
        piece(";hf=", hf, hf.isNotNull()),
    )


def variant_key(sha256: Column, filename: Column, opts: Column) -> Column:
    """Rows with equal keys share one conversion. The request id is not in it.

    Content that was not read has no hash and so no key: it shares with nothing.
    """
    parts = (
        sha256,
        F.coalesce(filename, F.lit("")),
        flag(opts["include_assets"]).cast("string"),
        variant_fingerprint(opts),
    )
    joined = [x for part in parts for x in (F.lit(":"), part)][1:]
    return F.concat(*joined)


def bypasses_cache(opts: Column) -> Column:
    """use_cache=false neither reads nor writes the store."""
    return ~F.coalesce(opts["use_cache"], F.lit(True))
