"""Markdown blocks with their heading chain, and what sits under each heading.

A document is one row, so its blocks are worked out where the row is: nothing is
shuffled or sorted, and each document is passed over once.
"""

from __future__ import annotations

import base64
import binascii
import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill import schemas
from docmill.functions.text import WHITESPACE
from docmill.operators.assets import PATH_SEPARATOR

_BREAK = re.compile(r"\n{2,}")
_HEADING = re.compile(r"(#{1,6})[ \t]+([^\n]*)")
_IMAGE = re.compile(r"!\[[^\]]*\]\([^)\s]*[^)]*\)")
_IMAGE_TARGET = re.compile(r"!\[[^\]]*\]\(([^)\s]*)")
_NON_BLANK = re.compile("[^" + re.sub(r"\\x\{([0-9A-F]+)\}", r"\\u\1", WHITESPACE) + "]")


def _blocks(markdown: str) -> Iterator[tuple[int, str, int, tuple[str, ...]]]:
    chain: list[str | None] = [None] * 6
    for index, block in enumerate(_BREAK.split(markdown)):
        heading = _HEADING.match(block)
        level = len(heading[1]) if heading else 0
        if heading:
            chain[level - 1 :] = [heading[2].strip(" "), *[None] * (6 - level)]
        yield index, block, level, tuple(t for t in chain if t is not None)


def blocks_of(markdown: str) -> Iterator[tuple[int, str, int, str]]:
    """(index, block, heading level or 0, heading path) of a document's blocks."""
    for index, block, level, path in _blocks(markdown):
        yield index, block, level, PATH_SEPARATOR.join(path)


def _images(markdown: str) -> Iterator[tuple[int, int, str, tuple[str, ...], str, str]]:
    blocks = list(_blocks(markdown))
    texts = [_IMAGE.sub("", block).strip(" ") for _, block, _, _ in blocks]
    after, following = [""] * len(blocks), ""
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = following
        following = texts[i] if _NON_BLANK.search(texts[i]) else following
    before = ""
    for (index, block, _, path), text, behind in zip(blocks, texts, after, strict=True):
        parts = [part.strip(" ") for part in _IMAGE.split(block)]
        said = [part if _NON_BLANK.search(part) else None for part in parts]
        for number, target in enumerate(_IMAGE_TARGET.findall(block)):
            left = next((p for p in reversed(said[: number + 1]) if p is not None), before)
            right = next((p for p in said[number + 1 :] if p is not None), behind)
            yield index, number, target, path, left, right
        before = text if _NON_BLANK.search(text) else before


def images_of(markdown: str) -> Iterator[tuple[int, int, str, str, str, str]]:
    """(block, number in it, target, heading path, text before, text after) of images."""
    for index, number, target, path, before, after in _images(markdown):
        yield index, number, target, PATH_SEPARATOR.join(path), before, after


def data_uri(target: str) -> tuple[str, bytes] | None:
    """Media type and bytes of a ``data:`` address; None if it is none, or holds no data.

    Without a media type it is plain text, as for any such address.
    """
    head, comma, body = target.partition(",")
    if not comma or not head[:5].lower() == "data:":
        return None
    kind, *parameters = head[5:].split(";")
    data = unquote_to_bytes(body)
    if "base64" in (p.strip().lower() for p in parameters):
        try:
            data = base64.b64decode(data + b"=" * (-len(data) % 4), validate=True)
        except binascii.Error:
            return None
    return kind.strip().lower() or "text/plain", data


def assets_of(markdown: str) -> list[dict]:
    """The images that a text holds itself, each with all places where it is shown."""
    found: dict[str, dict | None] = {}
    for index, _, target, path, before, after in _images(markdown):
        if target not in found:
            read = data_uri(target)
            number = sum(asset is not None for asset in found.values())
            found[target] = None if read is None else {
                "id": number,
                "media_type": read[0],
                "origin_part": None,
                "size": len(read[1]),
                "truncated": False,
                "data_b64": read[1],
                "placements": [],
                "floating": False,
            }
        asset = found[target]
        if asset is not None:
            asset["placements"].append(
                {
                    "heading_path": list(path),
                    "block_index": index,
                    "context_before": before,
                    "context_after": after,
                }
            )
    return [asset for asset in found.values() if asset is not None]


def embedded_assets(markdown: Column) -> Column:
    """The assets of each text as an array; null gives none."""

    @F.pandas_udf(T.ArrayType(schemas.ASSET))
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [] if text is None else assets_of(text))

    return read(markdown)


def _per_document(
    docs: DataFrame, doc_id: str, markdown: str, rows_of: Callable, columns: str
) -> DataFrame:
    """The rows of each document behind its id; null Markdown has none."""
    names = [column.split()[0] for column in columns.split(", ")]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, rows = [], []
            for key, text in zip(batch[doc_id], batch[markdown], strict=True):
                if text is not None:
                    found = list(rows_of(text))
                    rows += found
                    ids += [key] * len(found)
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, doc_id, pd.Series(ids, dtype=batch[doc_id].dtype))
            yield out

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, markdown).mapInPandas(emit, f"`{doc_id}` {kind}, {columns}")


def markdown_blocks(
    docs: DataFrame, doc_id: str = "doc_id", markdown: str = "markdown"
) -> DataFrame:
    columns = "block_index long, block string, heading_level int, heading_path string"
    return _per_document(docs, doc_id, markdown, blocks_of, columns)


def section_summary(blocks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Blocks and characters under each heading path."""
    return blocks.groupBy(doc_id, "heading_path").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.sum(F.length("block")).cast("long").alias("chars"),
        F.min("block_index").alias("first_block"),
    )


def image_placements(
    docs: DataFrame, doc_id: str = "doc_id", markdown: str = "markdown"
) -> DataFrame:
    """Each image's heading path, block and nearest text before and after it.

    Text next to the image in its own block comes first, then that of the nearest
    block with text.
    """
    columns = (
        "block_index long, image_no long, target string, heading_path string, "
        "context_before string, context_after string"
    )
    with_images = docs.filter(F.contains(F.col(markdown), F.lit("![")))
    return _per_document(with_images, doc_id, markdown, images_of, columns)
