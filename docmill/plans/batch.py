"""The batch: documents in, exactly one outcome per document out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill import rules, schemas
from docmill.functions.options import bypasses_cache
from docmill.functions.text import flag, is_blank
from docmill.operators import contract, convert, intake, pages, reuse, sections
from docmill.session import cut

# Failures that are decided without converting: class, http_status, error_code.
_REFUSED = {
    "invalid_input": (None, "invalid_input"),
    "too_large": (413, "too_large"),
    "unsupported": (415, "unsupported"),
    "corrupted": (422, "malformed"),
}


def _fixed(values: dict[str, str | int | None], kind: str):
    pick = F.lit(None).cast(kind)
    for name, value in values.items():
        pick = F.when(F.col("class") == name, F.lit(value).cast(kind)).otherwise(pick)
    return pick


def prepare(
    docs: DataFrame, id_col: str = "input_ordinal", max_bytes: int = rules.MAX_BYTES
) -> DataFrame:
    """Names, ids, key, format, and ``class`` for rows that cannot be converted.

    A zip-based format known by its extension only is a damaged file: the bytes
    would have told.
    """
    ready = intake.sniff_format(
        intake.variant_key(intake.gate(intake.normalise_documents(docs, id_col), max_bytes))
    )
    damaged = (F.col("format_source") == "extension") & F.col("format").isin(*rules.ZIP_FORMATS)
    return ready.withColumn(
        "class",
        F.when(F.col("class").isNotNull(), F.col("class"))
        .when(damaged, "corrupted")
        .when(~F.coalesce(F.col("format").isin(*convert.CONVERTIBLE), F.lit(False)), "unsupported"),
    )


def convert_batch(
    docs: DataFrame,
    store: DataFrame | None = None,
    id_col: str = "input_ordinal",
    max_bytes: int = rules.MAX_BYTES,
    salts: int = reuse.SALTS,
) -> DataFrame:
    """Outcomes with nullable ``result`` and ``error`` structs, and a route.

    Rows of one key share a conversion, or the stored result in ``store``
    (variant_key, markdown, and what ``schemas.EXTRAS`` names, if it has it). A row that
    fails touches no other row.

    ``include_assets`` fills ``result.assets`` with the images that a text holds itself.
    ``headers_footers`` finds the lines that recur on most pages of a paged text, takes
    them out and lists them; without it both fields are null. A row is not timed, so
    ``elapsed_ms`` is null.
    """
    ready = prepare(docs, id_col, max_bytes)
    # Names, hashes, formats and classes are worked out once, and written without the
    # content; all joins are between these narrow rows.
    narrow = cut(
        ready.drop("content", "content_sha256", "format_source").withColumn(
            "_bypass", bypasses_cache(F.col("options"))
        )
    )
    wanted = {f"_{name}": flag(F.col("options")[name]) for name in ("include_assets", "headers_footers")}
    keys = reuse.distinct_keys(
        narrow.filter(F.col("class").isNull()).withColumns(wanted),
        "variant_key",
        id_col,
        salts,
        ("format", "_bypass", *wanted),
    ).drop("calls")
    if store is None:
        todo, hits = keys, None
    else:
        # Keys are matched first; the store's texts move for hits only.
        known = store.select(F.col("variant_key").alias("_known"))
        match = (F.col("variant_key") == F.col("_known")) & ~F.col("_bypass")
        todo = keys.join(known, match, "left_anti")
        kept = [c for c in schemas.EXTRAS if c in store.columns]
        hits = keys.join(known, match, "left_semi").join(
            store.select("variant_key", F.col("markdown").alias("_stored"), *kept), "variant_key"
        )
    # What is refused is dropped at the scan, before its content would be moved.
    convertible = ready.filter(F.col("class").isNull()).select(id_col, "content")
    work = reuse.with_content(convertible, todo, id_col)
    # What no row asks for costs nothing: the narrow rows tell.
    asked = narrow.agg(*[F.coalesce(F.max(value), F.lit(False)).alias(name) for name, value in wanted.items()]).first()
    shared = ["variant_key", "_salts", "markdown", F.col(id_col).alias("_owner"), *schemas.EXTRAS]
    done = _converted(work, id_col, asked["_include_assets"], asked["_headers_footers"]).select(*shared, F.lit(False).alias("cache_hit"))
    if hits is not None:
        hits = _with_extras(hits.withColumn("markdown", F.col("_stored")))
        done = done.unionByName(hits.select(*shared, F.lit(True).alias("cache_hit")))
    calls = narrow.drop("_bypass")
    return _outcomes(reuse.hand_back(calls, done, "variant_key", id_col, salts), id_col)


def _with_extras(rows: DataFrame) -> DataFrame:
    """Fields of a result that rows lack, as nulls."""
    missing = [c for c in schemas.EXTRAS if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast(schemas.RESULT[c].dataType) for c in missing})


def _converted(work: DataFrame, id_col: str, include_assets: bool, headers_footers: bool) -> DataFrame:
    """Markdown of the rows to convert, and what their options ask for besides."""
    done = convert.to_markdown(work, pages="_pages" if headers_footers else None)
    if headers_footers:
        paged = F.col("_headers_footers") & (F.size("_pages") > 1)
        done = cut(done.drop("content").withColumn("_pages", F.when(paged, F.col("_pages"))), "converted")
        found = pages.document_headers_footers(done.filter("_pages IS NOT NULL"), id_col, "_pages")
        none = F.array().cast(schemas.RESULT["headers_footers"].dataType)
        done = done.join(found, id_col, "left").withColumns(
            {
                "markdown": F.coalesce("_stripped", "markdown"),
                "headers_footers": F.when(F.col("_headers_footers"), F.coalesce("headers_footers", none)),
            }
        )
    if include_assets:
        asked = F.when(F.col("_include_assets"), F.col("markdown"))
        done = done.withColumn("assets", F.when(F.col("_include_assets"), sections.embedded_assets(asked)))
    return _with_extras(done)


def _outcomes(rows: DataFrame, id_col: str) -> DataFrame:
    classed = rows.withColumns(
        {
            "class": F.coalesce("class", F.lit(rules.SUCCESS)),
            "retryable": F.lit(False),
            "is_empty": is_blank(F.col("markdown")),
            "shared": F.coalesce((F.col("_owner") != F.col(id_col)) & ~F.col("cache_hit"), F.lit(False)),
        }
    )
    routed = contract.route(classed, is_empty=F.col("is_empty"))
    ok = F.col("class") == rules.SUCCESS
    status = _fixed({name: value[0] for name, value in _REFUSED.items()}, "long")
    code = _fixed({name: value[1] for name, value in _REFUSED.items()}, "string")
    no_assets = F.array().cast(schemas.RESULT["assets"].dataType)
    return routed.select(
        F.col(id_col),
        "request_id",
        "filename",
        "variant_key",
        "options",
        "format",
        "size_bytes",
        "class",
        "route",
        F.coalesce("cache_hit", F.lit(False)).alias("cache_hit"),
        "shared",
        F.when(
            ok,
            F.struct(
                "markdown",
                "format",
                F.lit(None).cast("double").alias("elapsed_ms"),
                F.col("size_bytes").alias("input_bytes"),
                "request_id",
                F.coalesce("assets", no_assets).alias("assets"),
                F.coalesce("cache_hit", F.lit(False)).alias("cache_hit"),
                "headers_footers",
                "headers_footers_stripped",
            ),
        ).alias("result"),
        F.when(
            ~ok,
            F.struct(
                F.col("class"),
                status.alias("http_status"),
                code.alias("error_code"),
                F.col("retryable"),
            ),
        ).alias("error"),
    )


def results_of(outcomes: DataFrame) -> DataFrame:
    """The results of what was converted, with the columns that the tables of nested parts read."""
    return outcomes.filter(F.col("result").isNotNull()).select("result.*")


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Outcomes as flat columns, with the size of the Markdown instead of its text."""
    return outcomes.select(
        "*",
        F.length("result.markdown").cast("long").alias("markdown_chars"),
        F.col("error.http_status").alias("http_status"),
        F.col("error.error_code").alias("error_code"),
        F.col("size_bytes").alias("input_bytes"),
    ).drop("result", "error")
