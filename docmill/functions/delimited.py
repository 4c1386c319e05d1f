"""CSV to a GitHub-flavoured pipe table with built-in expressions.

A line break is put in front of the text, so that every field, the first one
too, is a delimiter followed by its value and one pattern finds them all. The
possessive repeat keeps long quoted fields off the regex engine's stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIELD = r'(?:\r\n|\n|\r|,)(?:"[^"]*(?:""[^"]*)*+"[^,\r\n]*|[^,\r\n]*)'


def _fields(text: Column) -> Column:
    body = F.regexp_replace(text, r"^\x{FEFF}|[\r\n]+$", "")
    return F.when(
        F.length(body) > 0, F.regexp_extract_all(F.concat(F.lit("\n"), body), F.lit(_FIELD), F.lit(0))
    )


def _opens_row(field: Column) -> Column:
    return ~field.startswith(",")


def _value(raw: Column) -> Column:
    """A field's value: unquoted, kept on one line, pipes escaped."""
    quoted = raw.startswith('"') & raw.endswith('"') & (F.length(raw) > 1)
    inside = F.substring(raw, F.lit(2), F.length(raw) - 2)
    with_rest = raw.startswith('"') & F.contains(F.substring(raw, F.lit(2), F.length(raw)), F.lit('"'))
    value = (
        F.when(quoted, F.replace(inside, F.lit('""'), F.lit('"')))
        .when(
            with_rest,
            F.concat(
                F.replace(F.regexp_extract(raw, r'(?s)^"(.*)"[^"]*$', 1), F.lit('""'), F.lit('"')),
                F.regexp_extract(raw, r'(?s)^".*"([^"]*)$', 1),
            ),
        )
        .otherwise(raw)
    )
    one_line = F.trim(value)
    for found, put in (("\r\n", "<br>"), ("\n", "<br>"), ("\r", "<br>"), ("|", "\\|")):
        one_line = F.replace(one_line, F.lit(found), F.lit(put))
    return one_line


def _table(cells: Column, opens: Column, ends: Column, width: Column) -> Column:
    header_width = F.element_at(ends, 1)
    header = F.concat(
        F.slice(cells, F.lit(1), header_width), F.array_repeat(F.lit(""), width - header_width)
    )
    rest = F.zip_with(
        F.slice(cells, header_width + 1, F.size(cells)),
        F.slice(opens, header_width + 1, F.size(cells)),
        lambda cell, opened: F.concat(
            F.when(opened, F.lit(" |\n| ")).otherwise(F.lit(" | ")), cell
        ),
    )
    rows = F.array_join(rest, "")
    return F.concat(
        F.lit("| "),
        F.array_join(header, " | "),
        F.lit(" |\n|"),
        F.repeat(F.lit(" --- |"), width),
        F.when(
            F.size(cells) > header_width,
            F.concat(F.substring(rows, F.lit(3), F.length(rows)), F.lit(" |")),
        ).otherwise(""),
    )


def with_csv_markdown(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add the table of each row's CSV text; null text gives null.

    The first row is the header, widened to the longest row so that no cell is
    lost. One projection per step: Spark then splits each text only once.
    """
    opened_at = F.filter(
        F.transform("_opens", lambda opened, i: F.when(opened, i)), lambda i: i.isNotNull()
    )
    raw = F.transform("_fields", lambda f: F.regexp_replace(f, r"^(?:\r\n|\n|\r|,)", ""))
    staged = (
        df.withColumn("_fields", F.when(text.isNotNull(), F.coalesce(_fields(text), F.array())))
        .withColumns({"_opens": F.transform("_fields", _opens_row), "_raw": raw})
        .withColumns({"_starts": opened_at, "_cells": F.transform("_raw", _value)})
        .withColumn(
            "_ends",
            F.concat(
                F.slice("_starts", F.lit(2), F.size("_starts") + 1), F.array(F.size("_fields"))
            ),
        )
        .withColumn(
            "_width", F.array_max(F.zip_with("_starts", "_ends", lambda start, end: end - start))
        )
    )
    table = _table(F.col("_cells"), F.col("_opens"), F.col("_ends"), F.col("_width"))
    return staged.withColumn(
        out, F.when(F.size("_cells") > 0, table).when(F.col("_cells").isNotNull(), "")
    ).drop("_fields", "_opens", "_raw", "_starts", "_cells", "_ends", "_width")
