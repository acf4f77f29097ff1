"""Readers of landed tables and payloads.

Payload readers take a DataFrame with one JSON, JSONP or XML text per row, so the
same code serves files (``spark.read.text(path, wholetext=True)``) and columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions import html
from noticeworks.functions.text import any_of, blank_to_null
from noticeworks.functions.times import day, moment

RECORD_SCHEMA = (
    "array<struct<municipality:string,case_number:string,address:string,property:string,"
    "permit_type:string,status:string,date:string,description:string,applicant:string,"
    "source_url:string>>"
)
BILLBOARD_SCHEMA = (
    "struct<result:struct<results:array<struct<diary_name:string,diarie:string,title:string>>>>"
)
NOTICE_SCHEMA = (
    "struct<notices:array<struct<id:string,title:string,text:string,published:string,"
    "noticeCategoryId:string,noticeType:string,metadata:array<struct<title:string,value:string>>,"
    "attachments:array<struct<title:string>>>>,totalIndex:bigint>"
)
SETUP_SCHEMA = (
    "struct<categories:array<struct<id:string,name:string>>,"
    "types:array<struct<id:string,name:string,type:string>>>"
)
_LANGUAGES = "struct<swe:string,eng:string>"
TENDER_SCHEMA = (
    "struct<`publication-number`:string,`title-proc`:" + _LANGUAGES + ",`description-proc`:"
    + _LANGUAGES + ",`publication-date`:string,`estimated-value-proc`:string,"
    "`estimated-value-cur-proc`:string,`deadline-receipt-tender-date-lot`:array<string>,"
    "`classification-cpv`:array<string>,`place-of-performance`:string>"
)


def scan_table(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def scan_database(spark: SparkSession, url: str, table: str, columns: Iterable[str], key: str,
                  bounds: tuple[int, int], partitions: int,
                  properties: Mapping[str, str] | None = None) -> DataFrame:
    """Table of a relational database, read in parallel ranges of a numeric key."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=dict(properties or {}),
    ).select(*columns)


def parse_config_rows(rows: DataFrame) -> DataFrame:
    """Configuration rows flattened; the row's own name goes before the configured one."""
    flat = [f for f in rows.schema["config"].dataType.names
            if f not in ("municipality", "needs_browser")]
    needs_browser = F.coalesce(F.col("config.needs_browser"), F.lit(False)) | F.coalesce(
        F.col("needs_browser"), F.lit(False)
    )
    return rows.select(
        "municipality",
        "approved",
        F.coalesce(F.col("verified"), F.lit(False)).alias("verified"),
        needs_browser.alias("needs_browser"),
        F.concat("municipality", F.lit("_config.json")).alias("file"),
        *[F.col(f"config.{f}").alias(f) for f in flat],
    )


def scan_approved_sources(rows: DataFrame, source_type: str | None = None) -> DataFrame:
    kept = rows.where("approved")
    if source_type is not None:
        kept = kept.where(F.col("source_type") == source_type)
    return parse_config_rows(kept)


def scan_extracted_json(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*_extracted.json")
    return extracted_records(raw.select(F.col("_metadata.file_name"), "value"))


def extracted_records(raw: DataFrame) -> DataFrame:
    """Records of ``(file_name, value)`` rows; the source id is the file's name."""
    source = F.regexp_replace("file_name", "_extracted.json", "")
    return raw.select(
        source.alias("source"), F.posexplode(F.from_json("value", RECORD_SCHEMA)).alias("pos", "r")
    ).select("source", "pos", "r.*")


def latest_run_cost(raw: DataFrame, prefix: str = "extraction_cost") -> DataFrame:
    """Cost report of the newest of the ``(file_name, value)`` rows; only that one is parsed."""
    schema = "struct<total_cost_usd:double,total_permits:bigint,cost_per_permit_usd:double>"
    newest = raw.where(F.col("file_name").startswith(prefix)).agg(
        F.max("file_name").alias("file_name"), F.max_by("value", "file_name").alias("value"))
    return newest.select("file_name", F.from_json("value", schema).alias("c")).select("file_name", "c.*")


def scan_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Fetched files of a folder; PDF bytes stay binary."""
    files = spark.read.format("binaryFile").load(folder)
    return page_rows(files.select(F.lit(None).cast("string").alias("source"),
                                  F.col("path").alias("url"), "content"))


def page_rows(raw: DataFrame) -> DataFrame:
    """``(source, url, content binary)`` to pages with decoded text or PDF bytes."""
    is_pdf = F.substring(F.col("content"), 1, 5) == F.lit(b"%PDF-")
    return raw.select(
        "source",
        "url",
        F.when(~is_pdf, html.to_text(F.col("content").cast("string"))).alias("content"),
        F.when(is_pdf, F.col("content")).alias("pdf"),
        is_pdf.alias("is_pdf"),
    )


def scan_billboard_items(raw: DataFrame, payload: str = "payload",
                         limit: int | None = None) -> DataFrame:
    """Items of billboard replies; ``limit`` is the number one reply may hold."""
    items = F.from_json(payload, BILLBOARD_SCHEMA)["result"]["results"]
    if limit is not None:
        items = F.slice(items, 1, limit)
    rest = [c for c in raw.columns if c != payload]
    return raw.select(*rest, F.posexplode(items).alias("pos", "i")).select(*rest, "pos", "i.*")


def _listed(payload: Column) -> Column:
    """Elements of a reply that is a bare array or wraps it in Items / items."""
    v = F.try_parse_json(payload)
    return F.coalesce(
        F.try_variant_get(v, "$", "array<variant>"),
        F.try_variant_get(v, "$.Items", "array<variant>"),
        F.try_variant_get(v, "$.items", "array<variant>"),
    )


def scan_announcements(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Announcements of replies that spell their keys upper or lower case."""

    def text(name: str) -> Column:
        return F.coalesce(
            F.try_variant_get("a", f"$.{name}", "string"),
            F.try_variant_get("a", f"$.{name[0].lower()}{name[1:]}", "string"),
        )

    rest = [c for c in raw.columns if c != payload]
    return raw.select(*rest, F.posexplode(_listed(F.col(payload))).alias("pos", "a")).select(
        *rest, "pos", text("Id").alias("id"), text("Title").alias("title"),
        text("Name").alias("name"), text("StartDate").alias("start_date"),
        text("Description").alias("description"), text("DocumentTitle").alias("document_title"),
    )


def strip_callback(payload: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(payload, r"^cb\(", ""), r"\);?\s*\z", "")


def scan_notices_jsonp(raw: DataFrame, payload: str = "payload") -> DataFrame:
    rest = [c for c in raw.columns if c != payload]
    reply = F.from_json(strip_callback(F.col(payload)), NOTICE_SCHEMA)
    return raw.select(*rest, F.posexplode(reply["notices"]).alias("pos", "n")).select(
        *rest, "pos", F.col("n.id").alias("id"), F.col("n.title").alias("title"),
        F.col("n.text").alias("text"), F.col("n.published").alias("published"),
        F.col("n.noticeCategoryId").alias("category_id"), F.col("n.noticeType").alias("type_key"),
        F.col("n.metadata").alias("metadata"), F.col("n.attachments").alias("attachments"),
    )


def scan_board_setup(raw: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Categories and types of boards, names decoded."""
    rest = [c for c in raw.columns if c != payload]
    setup = raw.select(*rest, F.from_json(strip_callback(F.col(payload)), SETUP_SCHEMA).alias("s"))
    categories = setup.select(*rest, F.explode("s.categories").alias("c")).select(
        *rest, F.col("c.id").alias("id"), html.decode_entities(F.col("c.name")).alias("name"))
    types = setup.select(*rest, F.explode("s.types").alias("t")).select(
        *rest, F.col("t.id").alias("id"), F.col("t.type").alias("type"),
        html.decode_entities(F.col("t.name")).alias("name"))
    return categories, types


def scan_procurement(raw: DataFrame, start: date, payload: str = "payload") -> DataFrame:
    """Tender notices published after ``start``."""
    rest = [c for c in raw.columns if c != payload]
    # One-element generator: the payload is parsed once, not once per field.
    n = raw.select(*rest, F.explode(F.array(F.from_json(payload, TENDER_SCHEMA))).alias("n"))

    def get(name: str) -> Column:
        return F.col("n").getField(name)

    tenders = n.select(
        *rest, get("publication-number").alias("number"), get("title-proc").alias("title"),
        get("description-proc").alias("description"),
        get("publication-date").alias("publication_date"),
        get("estimated-value-proc").alias("value"),
        get("estimated-value-cur-proc").alias("currency"),
        get("deadline-receipt-tender-date-lot").alias("deadlines"),
        get("classification-cpv").alias("cpv"), get("place-of-performance").alias("place"),
    )
    return tenders.where(F.left("publication_date", F.lit(10)).try_cast("date") > day(start))


def scan_sitemap(raw: DataFrame, xml: str = "xml") -> DataFrame:
    rest = [c for c in raw.columns if c != xml]
    return raw.select(*rest, F.posexplode(html.sitemap_urls(F.col(xml))).alias("pos", "url"))


def scan_key_value_json(raw: DataFrame, payload: str = "payload") -> DataFrame:
    rest = [c for c in raw.columns if c != payload]
    return raw.select(*rest, F.explode(F.from_json(payload, "map<string,string>")).alias("name", "homepage"))


def static_reference_rows(spark: SparkSession, rows: Iterable[tuple[str, str]],
                          organization_id: int) -> DataFrame:
    """Listed ``(designation, municipality)`` pairs of one organisation."""
    listed = spark.createDataFrame(list(rows), "property_designation string, municipality string")
    return attach_organization(listed, organization_id)


def attach_organization(properties: DataFrame, organization_id) -> DataFrame:
    """Distinct properties with one organisation's id."""
    return properties.select("property_designation", "municipality").distinct().withColumn(
        "organization_id", F.lit(organization_id).cast("long"))


def scan_range(df: DataFrame, column: str, since: datetime) -> DataFrame:
    return df.where(F.col(column) >= moment(since))


def scan_unverified(rows: DataFrame, browser_only: bool = False) -> DataFrame:
    """Unverified sources that have a listing page."""
    kept = rows.where(~F.col("verified"))
    if browser_only:
        kept = kept.where("needs_browser")
    return kept.where(blank_to_null(F.col("config.listing_url")).isNotNull())


def scan_targets(places: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Places that have a home page, and if parts of names are given, only those whose name has one."""
    targets = places.where(blank_to_null(F.col("homepage")).isNotNull()).select("name", F.col("homepage").alias("url"))
    return targets if only is None else targets.where(any_of(F.lower("name"), [part.lower() for part in only]))
