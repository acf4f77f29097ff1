"""Content hashes over all items of a source, from sums that tasks can share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions.html import content_hash

#: A SHA-256 digest is summed in words of 15 hexadecimal digits; the last one has four.
_WORDS = range(1, 65, 15)


def _digest(items: DataFrame, key: str, entry: Column) -> DataFrame:
    """Hash of the bag of entries of every key: the sums of their digests' words and their number.

    Sums are taken task by task before the shuffle, so a source of any size is hashed the
    same way and no task holds it.
    """
    digested = items.select(key, F.sha2(entry, 256).alias("_sha"))
    sums = digested.groupBy(key).agg(
        F.count("*").alias("items"),
        *[F.sum(F.conv(F.substring("_sha", at, 15), 16, 10).cast("decimal(38,0)")).alias(f"_{at}") for at in _WORDS])
    parts = [F.col(f"_{at}").cast("string") for at in _WORDS]
    return sums.select(key, content_hash(F.concat_ws(":", *parts, F.col("items").cast("string"))).alias("content_hash"), "items")


def list_content_hash(items: DataFrame, source: str, ident: str, published: str) -> DataFrame:
    """Hash of a source's ``id:date`` entries, whatever order the items come in."""
    return _digest(items, source, F.concat_ws(":", ident, published))


def source_archive_hash(pages: DataFrame, source: str = "source", content: str = "content", position: str = "pos") -> DataFrame:
    """Hash of a source's pages, each with its position; a null page counts as empty."""
    page = F.sha2(F.coalesce(F.col(content), F.lit("")), 256)
    return _digest(pages, source, F.concat_ws(":", F.col(position).cast("string"), page))
