"""Conversion of the two formats Spark expressions can do, and the result gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.delimited import with_csv_markdown
from docmill.functions.html import with_html_markdown
from docmill.functions.text import as_text, is_blank

CONVERTIBLE = ("html", "csv")


def html_to_markdown(df: DataFrame, source: str = "html", out: str = "markdown") -> DataFrame:
    return with_html_markdown(df, as_text(F.col(source)), out)


def csv_to_markdown(df: DataFrame, source: str = "content", out: str = "markdown") -> DataFrame:
    return with_csv_markdown(df, as_text(F.col(source)), out)


def to_markdown(
    df: DataFrame, source: str = "content", out: str = "markdown", pages: str | None = None
) -> DataFrame:
    """Convert each row by its ``format``; other formats give null. With ``pages`` also the
    Markdown of each page of a paged text, as an array."""

    def when_format(kind: str) -> Column:
        return F.when(F.col("format") == kind, as_text(F.col(source)))

    tables = with_csv_markdown(df, when_format("csv"), "_table")
    return (
        with_html_markdown(tables, when_format("html"), "_page", pages)
        .withColumn(out, F.coalesce("_page", "_table"))
        .drop("_page", "_table")
    )


def empty_result_gate(df: DataFrame, markdown: str = "markdown") -> DataFrame:
    """Blank Markdown goes to the fallback route, the rest is fine."""
    blank = is_blank(F.col(markdown))
    return df.withColumns(
        {"is_empty": blank, "route": F.when(blank, "fallback").otherwise("ok")}
    )
