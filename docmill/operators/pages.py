"""Pages: repeated headers and footers, page selection, page caps.

A page row has a document (``group``), a page id and its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmill import rules, schemas
from docmill.functions import pagespec
from docmill.functions.salts import SALTS, salt, salt_list, used_salts
from docmill.functions.text import non_blank
from docmill.session import cut


def normalised(text: Column) -> Column:
    """Text in which lines that differ only in numbers or spacing look the same."""
    return F.regexp_replace(F.regexp_replace(text, r"[ \t\x0B\f\r]+", " "), r"[0-9]+", "#")


def _normalised_lines(text: str) -> Column:
    return F.transform(F.split(normalised(F.col(text)), "\n"), lambda line: F.trim(line))


def is_page_number(line: Column) -> Column:
    left = F.regexp_replace(F.lower(line), r"page|of|第|页|共|[\s/|.:·–—()\[\]-]", "")
    return left.rlike("^#+$")


def _line_hashes(pages: DataFrame, group: str, page: str, text: str, salts: int) -> DataFrame:
    """Distinct 64-bit hashes of each page's lines: what travels instead of text.

    Equal hashes only make candidates; results always compare the text itself.
    """
    hashes = F.array_distinct(
        F.transform(
            F.filter(_normalised_lines(text), non_blank), lambda line: F.xxhash64(group, line)
        )
    )
    return pages.select(
        group, page, salt(page, salts).alias("_salt"), F.explode(hashes).alias("_hash")
    )


def _lines(pages: DataFrame, group: str, page: str, text: str, salts: int) -> DataFrame:
    return (
        pages.withColumns(
            {"_raw": F.split(text, "\n"), "_clean": _normalised_lines(text)}
        )
        .select(
            group,
            page,
            salt(page, salts).alias("_salt"),
            F.size("_raw").alias("_n"),
            F.posexplode(F.arrays_zip("_raw", "_clean")).alias("_pos", "_line"),
        )
        .select(
            group,
            page,
            "_salt",
            "_n",
            "_pos",
            F.col("_line._raw").alias("_raw"),
            F.col("_line._clean").alias("normalised"),
        )
        .filter(non_blank(F.col("normalised")))
        .withColumn("_hash", F.xxhash64(group, "normalised"))
    )


def detect_repeated_lines(
    pages: DataFrame,
    min_pages: int = 2,
    min_frequency: float = 0.0,
    group: str = "source",
    page: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
) -> DataFrame:
    """Lines found on at least ``min_pages`` pages of a document.

    Gives the pages seen, their share of the document's pages, the most frequent
    original text (ties: the smallest text) and whether it is only a page number.

    Hashes of lines are counted first; only lines whose hash is on enough pages
    are looked at as text. A line that is on every page is spread over the salts
    of its pages and counted per task before any shuffle.
    """
    noted = [bits.alias(name) for name, bits in used_salts("_salt", salts).items()]
    candidates = (
        _line_hashes(pages, group, page, text, salts)
        .groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_pages"), *noted)
        .filter(F.col("_pages") >= min_pages)
        .select("_hash", F.explode(salt_list(salts)).alias("_salt"))
    )
    in_upper_half = (F.col("_pos") * 2 < F.col("_n")).cast("long")
    per_page = (
        _lines(pages, group, page, text, salts)
        .join(candidates, ["_hash", "_salt"], "left_semi")
        .groupBy(group, "normalised", page)
        .agg(F.collect_list("_raw").alias("_raws"), F.sum(in_upper_half).alias("_upper"))
    )
    # The first wording on each page stands for the page, so that one pass
    # counts pages and wordings alike. A page holds no more lines than its text.
    first = F.col("_at") == 0
    seen = (
        per_page.select(group, "normalised", "_upper", F.posexplode("_raws").alias("_at", "_raw"))
        .groupBy(group, "normalised", "_raw")
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            F.count_if(first).alias("_pages"),
            F.sum(F.when(first, F.col("_upper")).otherwise(0)).alias("_upper"),
        )
        .groupBy(group, "normalised")
        .agg(
            F.min(F.struct((-F.col("_lines")).alias("rank"), "_raw"))["_raw"].alias("text"),
            F.sum("_pages").alias("pages_seen"),
            F.sum("_lines").alias("occurrences"),
            F.sum("_upper").alias("_upper"),
        )
        .filter(F.col("pages_seen") >= min_pages)
    )
    total = pages.groupBy(group).agg(F.countDistinct(page).alias("_pages"))
    upper = F.col("_upper") * 2 >= F.col("occurrences")
    return (
        seen.join(total, group)
        .withColumn("page_frequency", F.col("pages_seen") / F.col("_pages"))
        .filter(F.col("page_frequency") >= min_frequency)
        .select(
            group,
            "normalised",
            "text",
            "pages_seen",
            "page_frequency",
            "occurrences",
            F.when(upper, "header").otherwise("footer").alias("kind"),
            F.when(upper, "top").otherwise("bottom").alias("location"),
            is_page_number(F.col("normalised")).alias("page_number"),
        )
    )


def strip_repeated_lines(
    pages: DataFrame,
    found: DataFrame,
    group: str = "source",
    page: str = "doc_id",
    text: str = "text",
    salts: int = SALTS,
) -> DataFrame:
    """Remove found lines; ``lines_stripped`` is null where none applied.

    Only hashes of lines travel; a page gets back the few found lines it may
    hold and drops those it does hold. The text moves once, by ``page``, which
    is unique over all documents. Pages are salted, so a line that is on every
    page spreads as well; a found line is repeated only for the salts of its
    own pages.
    """
    on_page = _line_hashes(pages, group, page, text, salts)
    wanted = found.select(
        group, "normalised", F.xxhash64(group, "normalised").alias("_hash")
    )
    used = on_page.select(group, "_hash", "_salt").distinct().join(wanted, [group, "_hash"])
    hits = (
        on_page.join(used, [group, "_hash", "_salt"])
        .groupBy(page)
        .agg(F.collect_list("normalised").alias("_found"))
    )
    kept = F.filter(
        F.arrays_zip("_raw", "_clean"), lambda line: ~F.array_contains(F.col("_found"), line["_clean"])
    )
    hit = F.col("_found").isNotNull()
    return (
        pages.join(hits, page, "left")
        .withColumns(
            {
                "_raw": F.when(hit, F.split(text, "\n")),
                "_clean": F.when(hit, _normalised_lines(text)),
            }
        )
        .withColumn("_kept", F.when(hit, kept))
        .withColumns(
            {
                "lines_stripped": F.nullif(
                    (F.size("_raw") - F.size("_kept")).cast("long"), F.lit(0).cast("long")
                ),
                "stripped_text": F.coalesce(
                    F.array_join(F.transform("_kept", lambda line: line["_raw"]), "\n"),
                    F.col(text),
                ),
            }
        )
        .drop("_found", "_raw", "_clean", "_kept")
    )


def document_headers_footers(
    docs: DataFrame,
    doc: str,
    texts: str,
    min_pages: int = 2,
    min_frequency: float = 0.5,
    separator: str = "\n\n",
    salts: int = SALTS,
) -> DataFrame:
    """Headers and footers of documents that hold their pages as an array of texts.

    Per document (``doc`` is unique) with any: ``headers_footers``, its entries by first
    kind and text, ``headers_footers_stripped``, the lines taken out, and ``_stripped``, its
    pages without them. A line counts as one where it is on ``min_pages`` pages and on
    ``min_frequency`` of them.
    """
    rows = docs.select(F.col(doc), F.posexplode(texts).alias("_no", "_text"))
    # a page's own id, so that a long document's pages spread
    rows = rows.withColumn("_page", F.concat_ws("#", F.col(doc).cast("string"), F.col("_no").cast("string")))
    found = cut(detect_repeated_lines(rows, min_pages, min_frequency, doc, "_page", "_text", salts), "repeated-lines")
    entry = {
        "kind": F.col("kind"),
        "location": F.col("location"),
        "text": F.col("text"),
        "pages_seen": F.col("pages_seen"),
        "page_frequency": F.col("page_frequency"),
        "page_number": F.col("page_number"),
        "source": F.lit("repeated_lines"),
    }
    fields = [
        entry.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.HEADER_FOOTER.fields
    ]
    order = F.struct(F.when(F.col("kind") == "header", 0).otherwise(1), "normalised", F.struct(*fields).alias("entry"))
    entries = found.groupBy(doc).agg(F.sort_array(F.collect_list(order)).alias("_entries"))
    entries = entries.select(doc, F.transform("_entries", lambda e: e["entry"]).alias("headers_footers"))
    stripped = strip_repeated_lines(rows, found, doc, "_page", "_text", salts)
    # a document's pages come back together, as they were in its row
    whole = stripped.groupBy(doc).agg(
        F.sort_array(F.collect_list(F.struct("_no", "stripped_text"))).alias("_all"),
        F.sum("lines_stripped").alias("headers_footers_stripped"),
    )
    filled = F.filter(F.transform("_all", lambda p: F.btrim(p["stripped_text"], F.lit("\n"))), lambda t: t != "")
    whole = whole.select(doc, "headers_footers_stripped", F.array_join(filled, separator).alias("_stripped"))
    return whole.join(entries, doc)


def select_pages(
    pages: DataFrame, spec: str | Column | None, page_no: str = "page_no"
) -> DataFrame:
    """Keep the selected pages.

    One spec for all becomes comparisons that reach the scan; a column is worked
    out row by row. Neither needs a join.
    """
    if isinstance(spec, Column):
        return pages.filter(pagespec.in_spec(F.col(page_no), spec))
    return pages.filter(pagespec.in_fixed_spec(F.col(page_no), spec))


def cap_pages(
    pages: DataFrame,
    max_pages: int | None = None,
    doc: str = "doc",
    page_no: str = "page_no",
    fmt: str = "format",
) -> DataFrame:
    """First ``max_pages`` pages per document: none given means the default, 0 no limit.

    Only documents of paged formats are cut, by the column ``fmt``. The rank filter is applied
    in each task before the shuffle, so a huge document sends only its first
    pages.
    """
    limit = rules.DEFAULT_MAX_PAGES if max_pages is None else max_pages
    if limit == 0:
        return pages
    paged = F.col(fmt).isin(*rules.PAGED_FORMATS)
    whole = pages.filter(~F.coalesce(paged, F.lit(False)))
    return _first_pages(pages.filter(paged), limit, doc, page_no).unionByName(whole)


def _first_pages(pages: DataFrame, limit: int, doc: str, page_no: str) -> DataFrame:
    order = W.partitionBy(doc).orderBy(page_no)
    return (
        pages.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= limit)
        .drop("_rank")
    )
