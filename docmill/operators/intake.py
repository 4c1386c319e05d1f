"""Intake of documents: names, ids, gates, fingerprints, formats.

Rows have ``input_ordinal`` (unique), ``content`` (text or bytes), ``filename``,
``request_id`` and an ``options`` struct. All of this is projection, so intake
adds no shuffle and prunes ``content`` where a result does not need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill import rules
from docmill.functions import options as opt
from docmill.functions import zipped
from docmill.functions.bind import let
from docmill.functions.text import as_bytes, as_text, is_blank, trimmed


def normalise_documents(df: DataFrame, id_col: str = "input_ordinal") -> DataFrame:
    """Default and trim names, keep or derive request ids.

    ``safe_filename`` is the name for headers and paths. A missing request id is
    derived from the row's own id, so that a rerun gives the same one.
    """
    name, rid = F.col("filename"), F.col("request_id")
    return df.withColumns(
        {
            "filename": F.when(is_blank(name), rules.DEFAULT_FILENAME).otherwise(trimmed(name)),
            "request_id": F.when(
                is_blank(rid), F.md5(F.concat(F.lit("document:"), F.col(id_col).cast("string")))
            ).otherwise(trimmed(rid)),
        }
    ).withColumn("safe_filename", F.regexp_replace("filename", r'[\r\n"]', "_"))


def with_size(df: DataFrame) -> DataFrame:
    """Add ``size_bytes`` unless the source already gave it."""
    if "size_bytes" in df.columns:
        return df
    return df.withColumn("size_bytes", F.octet_length(F.col("content")).cast("long"))


def _too_large(max_bytes: int) -> Column:
    """Over the limit; so is content that a source with a limit of its own left unread."""
    size = F.coalesce("size_bytes", F.lit(0))
    return (size > max_bytes) | ((size > 0) & F.col("content").isNull())


def _gate_class(max_bytes: int) -> Column:
    return (
        F.when(F.coalesce("size_bytes", F.lit(0)) == 0, "invalid_input")
        .when(_too_large(max_bytes), "too_large")
        .otherwise(F.lit(None).cast("string"))
    )


def reject_empty(df: DataFrame) -> DataFrame:
    """Rows without content, as ``invalid_input`` rejections."""
    return with_size(df).filter(F.coalesce("size_bytes", F.lit(0)) == 0).withColumn(
        "class", F.lit("invalid_input")
    )


def size_gate(df: DataFrame, max_bytes: int = rules.MAX_BYTES) -> DataFrame:
    """Mark rows over the limit ``too_large`` (413, not retried)."""
    return with_size(df).withColumns(
        {
            "class": F.when(_too_large(max_bytes), "too_large").otherwise("accepted"),
            "http_status": F.when(_too_large(max_bytes), F.lit(413).cast("long")),
            "retryable": F.lit(False),
        }
    )


def gate(df: DataFrame, max_bytes: int = rules.MAX_BYTES) -> DataFrame:
    """Both gates at once: ``class`` is null for rows that go on."""
    return with_size(df).withColumn("class", _gate_class(max_bytes))


def fingerprint(df: DataFrame) -> DataFrame:
    """Add the lower-case hex SHA-256 of the content, unless it is there."""
    if "content_sha256" in df.columns:
        return df
    return df.withColumn("content_sha256", F.sha2(as_bytes(F.col("content")), 256))


def variant_key(df: DataFrame) -> DataFrame:
    """Add the key under which rows share one conversion, unless it is there.

    Store it with the corpus: whoever finds the column reads no content for it.
    """
    if "variant_key" in df.columns:
        return df
    return fingerprint(df).withColumn(
        "variant_key",
        opt.variant_key(F.col("content_sha256"), F.col("filename"), F.col("options")),
    )


def _starts_with(content: Column, magic: bytes) -> Column:
    return F.substring(content, 1, len(magic)) == F.lit(magic)


# White space, comments and an XML declaration may stand before the first tag. All
# quantifiers are possessive or lazy over single characters, so that it is linear.
_HTML_START = (
    r"(?is)\A[\s\x{FEFF}]*+(?:(?:<!--.*?-->|<\?xml\b[^>]*+>)\s*+)*+"
    r"<(?:!doctype\s++html|html|head|body)(?=[\s/>])"
)


def _zip_format(said: Column, listed: Column) -> Column:
    """By the media type of the first entry, else by the entries of the directory."""
    kind = F.lit(None).cast("string")
    for name, part in reversed(rules.ZIP_PARTS.items()):
        kind = F.when(zipped.has_entry(listed, part), name).otherwise(kind)
    for name, mark in rules.ZIP_TYPES.items():
        kind = F.when(said == mark.decode(), name).otherwise(kind)
    return kind


def format_by_content(content: Column) -> Column:
    """Format told by the bytes alone; null when they do not tell."""
    data = as_bytes(content)
    zip_format = let(
        zipped.directory(data),
        lambda listed: let(
            F.trim(zipped.media_type(data).cast("string")), lambda said: _zip_format(said, listed)
        ),
    )
    return (
        F.when(_starts_with(data, rules.PDF_MAGIC), "pdf")
        .when(_starts_with(data, rules.RTF_MAGIC), "rtf")
        .when(_starts_with(data, rules.ZIP_MAGIC), zip_format)
        .when(as_text(data).rlike(_HTML_START), "html")
    )


def format_by_name(filename: Column) -> Column:
    extension = F.lower(F.regexp_extract(filename, r"\.([^.]+)$", 1))
    return F.try_element_at(rules.literal_map(rules.EXTENSIONS), extension)


def sniff_format(df: DataFrame) -> DataFrame:
    """Add ``format`` and ``format_source``: bytes first, then the extension.

    The old binary office formats share one signature; the extension says which.
    """
    ole = _starts_with(as_bytes(F.col("content")), rules.OLE_MAGIC)
    by_name = format_by_name(F.col("filename"))
    by_bytes = F.coalesce(
        format_by_content(F.col("content")),
        F.when(ole, F.when(by_name.isin(*rules.OLE_FORMATS), by_name).otherwise("doc")),
    )
    return (
        df.withColumn("_by_bytes", by_bytes)
        .withColumn("_by_name", by_name)
        .withColumns(
            {
                "format": F.coalesce("_by_bytes", "_by_name"),
                "format_source": F.when(F.col("_by_bytes").isNotNull(), "content")
                .when(F.col("_by_name").isNotNull(), "extension")
                .otherwise("unknown"),
            }
        )
        .drop("_by_bytes", "_by_name")
    )
