"""Structured notice boards and tenders to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions import html, records, urls
from noticeworks.functions.text import any_of, blank_to_null, with_once
from noticeworks.operators.lookups import in_set_flag, type_name_lookup


def bygg_item_filter(items: DataFrame) -> DataFrame:
    """Billboard items about building: by keyword, or by diary when the title has a type."""
    keyword = F.col("title").rlike("(?iu)" + config.BILLBOARD_PATTERN)
    diary = F.col("diary_name").isin(*config.BUILDING_DIARIES)
    typed = records.classify_permit_type(F.col("title")).isNotNull()
    return items.where(F.coalesce(keyword, F.lit(False)) | (diary & typed))


def billboard_permits(items: DataFrame) -> DataFrame:
    """Items ``(source, base_url, diary_name, diarie, title)`` as permit records."""
    parsed = bygg_item_filter(items).withColumn("p", records.parse_billboard_title(F.col("title")))
    return parsed.select(
        F.col("source").alias("municipality"), blank_to_null(F.col("diarie")).alias("case_number"),
        F.col("p.address").alias("address"), F.lit(None).cast("string").alias("property"),
        records.classify_permit_type(F.col("title")).alias("permit_type"),
        F.lit("beviljat").alias("status"), F.lit(None).cast("string").alias("date"),
        F.col("p.description").alias("description"), F.lit(None).cast("string").alias("applicant"),
        F.concat(urls.origin(F.col("base_url")), F.lit("/#!/billboard/")).alias("source_url"))


def pbl_type_filter(types: DataFrame, name: str = "type_name") -> DataFrame:
    return types.where(any_of(F.lower(name), config.PBL_TYPE_KEYWORDS))


def announcement_detail_join(types: DataFrame, announcements: DataFrame, details: DataFrame) -> DataFrame:
    """Announcements of the relevant types with their details where there are any."""
    listed = pbl_type_filter(types).join(announcements, ["source", "type_id"])
    return listed.join(details, ["source", "id"], "left")


def announcement_permits(announcements: DataFrame) -> DataFrame:
    """Announcements with details as permit records; only identified ones are kept."""
    title = F.coalesce("title", F.lit(""))
    text = F.coalesce("description", F.lit(""))
    document = F.coalesce("document_title", F.lit(""))
    parsed = with_once(
        announcements, place=records.announcement_property(title, text),
        street=records.announcement_street(title, text), case_number=records.announcement_case_number(text),
        permit_type=records.classify_permit_type(F.concat_ws(" ", title, text, document)))
    place, address = F.col("place"), F.coalesce("street", "place")
    identified = parsed.where(F.col("permit_type").isNotNull() | F.col("case_number").isNotNull())
    return identified.select(
        F.col("source").alias("municipality"),
        "case_number",
        address.alias("address"),
        F.when(place != address, place).alias("property"),
        "permit_type",
        records.status_from_type_name(F.concat_ws(" ", F.col("type_name"), document)).alias("status"),
        F.col("start_date").alias("date"),
        records.announcement_text(title).alias("description"),
        records.organisation_applicant(text).alias("applicant"),
        F.concat(urls.origin(F.col("base_url")), F.lit("/digital-bulletin-board/announcements/"), F.col("id")).alias("source_url"),
    )


def _metadata_text(metadata: Column, *titles: str) -> Column:
    def last(title: str) -> Column:
        def titled(m: Column) -> Column:
            return m["title"] == title

        newest = F.slice(F.reverse(F.filter(metadata, titled)), 1, 1)
        return F.when(F.exists(metadata, titled), blank_to_null(F.element_at(newest, 1)["value"]))

    return F.coalesce(*[last(t) for t in titles])


def notice_text(notices: DataFrame) -> DataFrame:
    """Entities decoded and ``all_text`` added: metadata values, attachment titles, title and text."""
    decoded = with_once(
        notices,
        metadata=F.transform(F.col("metadata"), lambda m: F.struct(
            html.decode_entities(m["title"]).alias("title"), html.decode_entities(m["value"]).alias("value"))),
        attachments=F.transform(F.col("attachments"), lambda a: html.decode_entities(a["title"])))
    values = F.filter(F.transform(F.col("metadata"), lambda m: m["value"]), lambda v: v != "")
    empty = F.lit("")
    return with_once(decoded, all_text=F.concat_ws(
        " ", F.coalesce(F.array_join(values, " "), empty), F.coalesce(F.array_join("attachments", " "), empty),
        F.coalesce("title", empty), F.coalesce("text", empty)))


def notice_filter(notices: DataFrame, categories: DataFrame, types: DataFrame) -> DataFrame:
    """Notices about building by category, type or text, with ``permit_type`` and ``is_building_type``.

    Categories and types are those of the notice's own board. A notice that only has the right
    category also needs a permit type.
    """
    building_categories = categories.where(F.col("name").rlike("(?iu)" + config.NOTICE_CATEGORY_PATTERN))
    building_types = types.where(F.col("name").rlike("(?iu)" + config.NOTICE_TEXT_PATTERN))
    flagged = in_set_flag(notices, "category_id", building_categories, "id", "is_building_category", ["board_id"])
    flagged = in_set_flag(flagged, "type_key", building_types, "type", "is_building_type", ["board_id"])
    named = notice_text(type_name_lookup(flagged, types))  # after all joins: the rows that they sort are short, and sorted once for both look-ups of a type
    named = with_once(
        named, permit_type=records.classify_permit_type(F.concat_ws(" ", "all_text", "type_name")),
        has_keyword=F.col("all_text").rlike("(?iu)" + config.NOTICE_TEXT_PATTERN))
    keyword = F.col("has_keyword")
    wanted = F.col("is_building_category") | F.col("is_building_type") | keyword
    certain = F.col("is_building_type") | F.col("permit_type").isNotNull() | keyword
    return named.where(wanted & certain)


def notice_permits(notices: DataFrame, categories: DataFrame, types: DataFrame, site: str) -> DataFrame:
    kept = notice_filter(notices, categories, types)
    text = _metadata_text(F.col("metadata"), "Beskrivning", "beskrivning", "Information", "information")
    p = with_once(kept, p=records.parse_notice_description(F.coalesce(text, F.lit(""))))
    return p.select(
        F.col("source").alias("municipality"), records.notice_case_number(F.col("all_text")).alias("case_number"),
        F.coalesce("p.address", "p.property").alias("address"),
        F.when(F.col("p.address").isNotNull(), F.col("p.property")).alias("property"),
        F.coalesce("permit_type", F.when(F.col("is_building_type"), "bygglov")).alias("permit_type"),
        records.status_from_text(F.concat_ws(" ", "all_text", "type_name")).alias("status"),
        F.substring_index("published", " ", 1).alias("date"), F.col("p.description").alias("description"),
        F.lit(None).cast("string").alias("applicant"),
        F.concat(F.lit(f"{site}/bulletinboard/public/"), F.col("board_id"), F.coalesce(F.concat(F.lit("/"), F.col("id")), F.lit(""))).alias("source_url"))


def cpv_filter(tenders: DataFrame) -> DataFrame:
    return tenders.where(records.relevant_cpv(F.col("cpv")))


def procurement_signals(tenders: DataFrame, site: str, title_chars: int = 80, description_chars: int = 200) -> DataFrame:
    """Relevant tenders of an organisation as signals.

    ``title`` and ``description`` are cut to the given lengths for display; ``full_title`` and
    ``full_description`` are whole, and category and excerpt follow from the whole body.
    """
    kept = with_once(
        cpv_filter(tenders),
        full_title=F.coalesce(blank_to_null(F.col("title.swe")), blank_to_null(F.col("title.eng"))),
        body=F.coalesce(blank_to_null(F.col("description.swe")), blank_to_null(F.col("description.eng")), F.lit("")),
        amount=records.convert_amount(F.col("value"), F.col("currency")),
        timeline=F.concat(F.lit("Anbudsfrist: "), F.left(F.get("deadlines", F.lit(0)), F.lit(10))),
        code=records.nuts_code(F.col("place")))
    full_title, body, amount, timeline, code = (
        F.col(c) for c in ("full_title", "body", "amount", "timeline", "code"))
    parts = F.array_compact(F.array(
        F.concat(F.lit("Titel: "), full_title), blank_to_null(body),
        F.concat(F.lit("CPV: "), F.when(F.size("cpv") > 0, F.array_join("cpv", ", "))),
        F.when(amount != 0, F.concat(F.lit("Uppskattat varde: "), records.thousands(amount), F.lit(" SEK"))),
        timeline, F.concat(F.lit("NUTS: "), code)))
    return kept.select(
        "organization_id", "organization_name",
        records.pick_language(F.col("title"), title_chars, "(okänd titel)").alias("title"), "full_title", F.lit("tender").alias("maturity"),
        amount.alias("amount_sek"), timeline.alias("timeline"), blank_to_null(F.left(body, F.lit(description_chars))).alias("description"),
        blank_to_null(body).alias("full_description"),
        F.concat(F.lit(site), F.col("number")).alias("source_url"),
        records.date_part(F.col("publication_date")).alias("source_date"),
        records.nuts_county(code).alias("region"), records.map_category(F.col("cpv"), body).alias("category"),
        F.lit("ted").alias("source_type"),
        F.when(F.size(parts) > 0, F.array_join(parts, "\n\n")).alias("source_excerpt"),
        F.col("number").alias("reference"), code.alias("nuts_code"))
