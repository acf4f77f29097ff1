"""The daily run: fetched pages and model answers to appended records and new hashes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.config import ORGANISATION_PATTERN, Vertical
from noticeworks.functions import html, urls
from noticeworks.functions.text import with_once
from noticeworks.operators import loading, lookups, shaping


@dataclass(frozen=True)
class DailyRun:
    """What a run leaves behind; every member is lazy."""

    to_append: DataFrame
    hashes: DataFrame
    source_status: DataFrame
    dropped: DataFrame


def page_extract(pages: DataFrame) -> DataFrame:
    """Text, hash, host and number of links of every page big enough to be read."""
    read = with_once(pages, content=html.to_text(F.col("html"))).withColumns({
        "links": F.size(html.anchors(F.col("html"))), "host": urls.host(F.col("url"))})
    return shaping.min_content_gate(read).select(
        *[c for c in pages.columns if c != "html"], "host", "links",
        F.length("content").alias("text_chars"), html.content_hash(F.col("content")).alias("content_hash"))


def pages_to_read(pages: DataFrame, stored_hashes: DataFrame, force: bool = False) -> DataFrame:
    """Stripped pages with hash and error, flagged where unchanged since the last run."""
    stripped = with_once(pages, content=html.strip_non_content(F.col("html"))).drop("html")
    return shaping.flag_unchanged(shaping.gate_and_hash(stripped), stored_hashes, force)


def clean_records(records: DataFrame, vertical: Vertical) -> DataFrame:
    """Mapped fields with what the contract forbids nulled: odd enums, numbers out of range, private names."""
    mapped = shaping.map_fields(records, vertical.field_mapping)
    inside = {f: r for f, r in vertical.numeric_ranges.items() if f in mapped.columns}
    clean = shaping.null_out_of_range(shaping.null_invalid_enums(mapped, vertical.allowed_values), inside)
    return clean.withColumns({
        f: F.when(F.col(f).rlike("(?iu)" + ORGANISATION_PATTERN), F.col(f)) for f in vertical.organisation_fields if f in clean.columns})


def load(records: DataFrame, target: DataFrame, places: DataFrame | None, flagged: DataFrame,
         stored_hashes: DataFrame, vertical: Vertical, model: str, cut_over: datetime) -> DailyRun:
    """Records of one run, with ``page_url, page_hash, arrival``, into the target of their vertical.

    With ``places`` names of sources are resolved to those of the table and the vertical's
    columns of it are added; without, names stay as they are.
    """
    name = vertical.source_field
    if places is not None:
        records = lookups.resolve_canonical_name(records, name, places, "name").withColumn(name, F.col("canonical")).drop("canonical")
    unset = {c: F.lit(None).cast("string") for c in ("source_type", "type_override") if c not in records.columns}
    filled = shaping.default_fields(records.withColumns(unset), "page_url", "type_override", vertical.default_source_type)
    clean = clean_records(filled, vertical)
    if places is not None and vertical.enrichment:
        clean = lookups.enrich_lookup(clean, places, name, "name", vertical.enrichment)
    checked = shaping.require_technical_fields(clean, name, "created_at", cut_over)
    rows = shaping.add_metadata(shaping.storable(checked), model, None).select(*target.columns)
    return DailyRun(
        to_append=loading.insert_records(
            target, rows, vertical.primary, vertical.conflict_key, vertical.dedup_fields, ["arrival"]),
        hashes=loading.update_page_hashes(stored_hashes, flagged),
        source_status=shaping.source_status(flagged),
        dropped=shaping.drop_reason_counts(checked),
    )
