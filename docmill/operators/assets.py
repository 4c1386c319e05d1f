"""Nested parts of results as tables: assets, placements, headers and footers,
rendered pages. Projection and generators only; Spark reads just the nested
fields a query uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill import schemas
from docmill.functions.text import flag, non_blank
from docmill.operators import contract

PATH_SEPARATOR = " > "


def has_data(asset: Column) -> Column:
    return F.coalesce(F.octet_length(asset["data_b64"]) > 0, F.lit(False))


def assets(results: DataFrame) -> DataFrame:
    """One row per asset."""
    row = F.col("_asset")
    return results.select("request_id", F.explode("assets").alias("_asset")).select(
        "request_id",
        row["id"].alias("asset_id"),
        row["media_type"].alias("media_type"),
        row["origin_part"].alias("origin_part"),
        row["size"].alias("size"),
        flag(row["truncated"]).alias("truncated"),
        row["data_b64"].alias("data"),
        row["placements"].alias("placements"),
        F.coalesce(row["media_type"].startswith("image/"), F.lit(False)).alias("is_image"),
        has_data(row).alias("has_data"),
        flag(row["floating"]).alias("is_floating"),
    )


def heading_path(path: Column) -> Column:
    return F.coalesce(F.array_join(path, PATH_SEPARATOR), F.lit(""))


def anchor_text(after: Column, before: Column) -> Column:
    """Text after the asset, often its caption, else the text before it."""
    return F.when(non_blank(after), after).otherwise(F.coalesce(before, F.lit("")))


def placements(asset_rows: DataFrame) -> DataFrame:
    """One row per place of an asset; an asset without any keeps one empty row."""
    place = F.col("_place")
    return asset_rows.select(
        "request_id", "asset_id", F.posexplode_outer("placements").alias("_pos", "_place")
    ).select(
        "request_id",
        "asset_id",
        F.coalesce("_pos", F.lit(0)).cast("long").alias("placement_no"),
        (F.coalesce("_pos", F.lit(0)) == 0).alias("is_primary"),
        heading_path(place["heading_path"]).alias("heading_path"),
        place["block_index"].alias("block_index"),
        anchor_text(place["context_after"], place["context_before"]).alias("anchor_text"),
    )


def enrichable_counts(results: DataFrame) -> DataFrame:
    """Number of assets that carry bytes, per result."""
    return results.select(
        "request_id",
        F.size(F.filter("assets", has_data)).cast("long").alias("enrichable_assets"),
    )


def headers_footers(results: DataFrame) -> DataFrame:
    """One row per header or footer entry, in the order given."""
    row = F.col("_entry")
    return results.select(
        "request_id", F.posexplode("headers_footers").alias("_pos", "_entry")
    ).select(
        "request_id",
        F.col("_pos").cast("long").alias("entry_no"),
        row["kind"].alias("kind"),
        F.coalesce(row["kind"] == "header", F.lit(False)).alias("is_header"),
        F.coalesce(row["kind"] == "footer", F.lit(False)).alias("is_footer"),
        row["scope"].alias("scope"),
        row["location"].alias("location"),
        row["text"].alias("text"),
        row["sections"].alias("sections"),
        row["pages_seen"].alias("pages_seen"),
        row["page_frequency"].alias("page_frequency"),
        flag(row["page_number"]).alias("is_page_number"),
        row["source"].alias("source"),
        row["image"]["origin_part"].alias("image_part"),
        row["image"]["media_type"].alias("image_media_type"),
        row["image"]["alt"].alias("image_alt"),
        row["image"]["size"].alias("image_size"),
        row["image"]["data_b64"].alias("image_data"),
        has_data(row["image"]).alias("image_has_data"),
        flag(row["image"]["truncated"]).alias("image_truncated"),
    )


def header_footer_texts(results: DataFrame) -> DataFrame:
    """Distinct non-blank texts in first-seen order, and whether there are entries."""
    texts = F.transform("headers_footers", lambda e: e["text"])
    return results.select(
        "request_id",
        (F.size("headers_footers") > 0).alias("has_headers_footers"),
        F.array_distinct(F.filter(texts, non_blank)).alias("texts"),
    )


def rendered_pages(log: DataFrame) -> DataFrame:
    """One row per page of successful render responses.

    A body that does not parse, or a page of wrong types, gives one row with
    ``error_code`` ``bad_response`` and no page.
    """
    parsed = contract.parsed_body(F.col("body"), schemas.RENDER)
    row = F.col("_page")
    pages = F.col("_parsed.pages")
    bad = contract.unparsable(F.col("_parsed")) | F.coalesce(F.exists(pages, lambda p: p.isNull()), F.lit(False))
    return (
        log.filter((F.col("endpoint") == "render") & (F.col("raw_status") == 200))
        .select("request_id", parsed.alias("_parsed"))
        .withColumn("_bad", bad)
        .withColumn("_parsed", F.when(~F.col("_bad"), F.col("_parsed")))
        .withColumn("_pages", F.when(F.col("_bad"), F.array(F.lit(None))).otherwise(pages))
        .select(
            "request_id",
            F.when(F.col("_bad"), "bad_response").alias("error_code"),
            F.col("_parsed.total_pages").alias("total_pages"),
            F.col("_parsed.rendered").alias("rendered"),
            F.col("_parsed.scale").alias("scale"),
            F.explode("_pages").alias("_page"),
        )
        .select(
            "request_id",
            "error_code",
            "total_pages",
            "rendered",
            "scale",
            row["page"].alias("page"),
            row["width"].alias("width"),
            row["height"].alias("height"),
            row["media_type"].alias("media_type"),
            row["data_b64"].alias("data"),
            F.coalesce(row["media_type"] == "image/png", F.lit(False)).alias("is_png"),
        )
    )
