"""Queries of the readers and of the projections and filters over what they read."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from bindings.derived import frame, table
from bindings.registry import query
from bindings.sqltext import (
    LINKS, any_word, ascii_name, bare_host, extract, fold, hash16, host, in_list, normal_place, page_text,
    permit_class, q, rx, sanitized, stripped, trim,
)
from noticeworks import config
from noticeworks.functions import composition, html, names, urls
from noticeworks.operators import boards, shaping
from noticeworks.plans import daily_run
from noticeworks.session import shared_folder
from noticeworks.sources import scans
from noticeworks.streaming import page_changes

PAGE_TERMS = ("the", "and", "tion", "que", "en", "der")
LINK_SELECTOR = "a[href*='tion'], a[href*='the']"
CUT_OVER = datetime(1998, 1, 1)


def links(s, d):
    return html.extract_links(table(s, d, "pages"))


def config_rows(s, d):
    c = frame(s, d, "d_configs")
    return c.select(
        "id", "municipality", "source_type", "approved", "verified", F.col("row_browser").alias("needs_browser"),
        F.struct("municipality", F.col("config_browser").alias("needs_browser"), "listing_url").alias("config"))


# Readers

@query("scan_table", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def _(s, d):
    return scans.scan_table(s, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_shipdate"])


_FLAT = """SELECT municipality, approved, coalesce(verified, false) AS verified,
  coalesce(config_browser, false) OR coalesce(row_browser, false) AS needs_browser,
  municipality || '_config.json' AS file, listing_url FROM d_configs"""


@query("scan_approved_sources", _FLAT + " WHERE approved AND source_type = 'BUILDING'")
def _(s, d):
    return scans.scan_approved_sources(config_rows(s, d), "BUILDING")


@query("parse_config_rows", _FLAT)
def _(s, d):
    return scans.parse_config_rows(config_rows(s, d))


def extracted_files(s, d):
    r = frame(s, d, "d_records").withColumn("property", F.col("place"))
    one = F.struct("municipality", "case_number", "address", "property", "permit_type", "status", "date")
    two = F.struct("municipality", F.lit(None).cast("string").alias("case_number"), "address", "property", "permit_type", "status", "date")
    return r.select(
        F.concat("place", F.lit("-"), F.col("arrival").cast("string"), F.lit("_extracted.json")).alias("file_name"),
        F.to_json(F.array(one, two)).alias("value"))


@query("scan_extracted_json", """
    SELECT place || '-' || arrival AS source, pos, municipality, CASE WHEN pos = 0 THEN case_number END AS case_number,
      address, place AS property, permit_type, status, date, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS applicant, CAST(NULL AS VARCHAR) AS source_url
    FROM d_records, range(2) AS t(pos)""")
def _(s, d):
    return scans.extracted_records(extracted_files(s, d))


@query("scan_latest_run_cost", """
    SELECT 'extraction_cost_' || o_orderkey AS file_name, o_totalprice AS total_cost_usd, o_custkey AS total_permits,
      CAST(NULL AS DOUBLE) AS cost_per_permit_usd FROM orders ORDER BY 1 DESC LIMIT 1""")
def _(s, d):
    reports = table(s, d, "orders").select(
        F.concat(F.lit("extraction_cost_"), F.col("o_orderkey").cast("string")).alias("file_name"),
        F.to_json(F.struct(F.col("o_totalprice").alias("total_cost_usd"), F.col("o_custkey").alias("total_permits"))).alias("value"))
    return scans.latest_run_cost(reports)


@query("scan_pages", f"""
    SELECT {host('url')} AS source, url, CASE WHEN url NOT LIKE '%.html' THEN {page_text('html')} END AS content,
      CASE WHEN url LIKE '%.html' THEN '%PDF-' || html END AS pdf, url LIKE '%.html' AS is_pdf FROM pages""")
def _(s, d):
    p = table(s, d, "pages")
    content = F.when(F.col("url").endswith(".html"), F.concat(F.lit("%PDF-"), F.col("html"))).otherwise(F.col("html"))
    raw = p.select(urls.host(F.col("url")).alias("source"), "url", content.cast("binary").alias("content"))
    return scans.page_rows(raw).withColumn("pdf", F.col("pdf").cast("string"))


@query("scan_billboard_items", "SELECT source, base_url, 0 AS pos, diary_name, diarie, title FROM d_items")
def _(s, d):
    i = frame(s, d, "d_items")
    reply = F.to_json(F.struct(F.struct(F.array(F.struct("diary_name", "diarie", "title")).alias("results")).alias("result")))
    return scans.scan_billboard_items(i.select("source", "base_url", reply.alias("payload")))


@query("scan_announcements", """
    SELECT source, pos, id, title, CAST(NULL AS VARCHAR) AS name, start_date, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS document_title
    FROM d_announced, range(2) AS t(pos) WHERE pos = 0 OR type_id = '1-URGENT'""")
def _(s, d):
    a = frame(s, d, "d_announced")
    upper = F.struct(F.col("id").alias("Id"), F.col("title").alias("Title"), F.col("start_date").alias("StartDate"))
    lower = F.struct("id", "title", F.col("start_date").alias("startDate"))
    reply = (
        F.when(F.col("type_id") == "1-URGENT", F.to_json(F.array(lower, lower)))
        .when(F.col("type_id") == "2-HIGH", F.to_json(F.struct(F.array(upper).alias("Items"))))
        .otherwise(F.to_json(F.struct(F.array(lower).alias("items")))))
    return scans.scan_announcements(a.select("source", reply.alias("payload")))


def notice_rows(s, d):
    n = frame(s, d, "d_noticed")
    return n.select(
        "source", "board_id", "id", "category_id", "type_key", "published", "title", "text",
        F.array(F.struct(F.col("value_title").alias("title"), "value")).alias("metadata"),
        F.array(F.struct(F.col("attachment").alias("title"))).alias("attachments"))


@query("scan_notices_jsonp", """
    SELECT board_id, row_number() OVER (PARTITION BY board_id ORDER BY id) - 1 AS pos, id, title, text, published, category_id, type_key, value, attachment FROM d_noticed""")
def _(s, d):
    n = notice_rows(s, d)
    notice = F.struct("id", "title", "text", "published", F.col("category_id").alias("noticeCategoryId"),
                      F.col("type_key").alias("noticeType"), "metadata", "attachments")
    boards = n.groupBy("board_id").agg(F.array_sort(F.collect_list(notice)).alias("notices"))  # one reply per board, in the order of ids
    reply = F.concat(F.lit("cb("), F.to_json(F.struct("notices", F.size("notices").alias("totalIndex"))), F.lit(");\n"))
    found = scans.scan_notices_jsonp(boards.select("board_id", reply.alias("payload")))
    return found.withColumns({"value": F.col("metadata")[0]["value"], "attachment": F.col("attachments")[0]["title"]}).drop("metadata", "attachments")


@query("scan_board_setup", """
    SELECT board_id, 'category' AS kind, id, NULL AS type, name FROM d_categories
    UNION ALL SELECT board_id, 'type', id, type, name FROM d_types""")
def _(s, d):
    coded = F.replace("name", F.lit("ä"), F.lit("&#228;")).alias("name")
    groups = frame(s, d, "d_categories").groupBy("board_id").agg(F.collect_list(F.struct("id", coded)).alias("categories")).join(
        frame(s, d, "d_types").groupBy("board_id").agg(F.collect_list(F.struct("id", coded, "type")).alias("types")), "board_id", "full_outer")
    reply = F.concat(F.lit("cb("), F.to_json(F.struct("categories", "types")), F.lit(");"))
    categories, types = scans.scan_board_setup(groups.select("board_id", reply.alias("payload")))
    return categories.select("board_id", F.lit("category").alias("kind"), "id", F.lit(None).cast("string").alias("type"), "name").unionByName(
        types.select("board_id", F.lit("type").alias("kind"), "id", "type", "name"))


def tender_payload(s, d):
    t = frame(s, d, "d_tenders")
    notice = F.struct(
        F.col("number").alias("publication-number"),
        F.struct(F.col("title_swe").alias("swe"), F.col("title_eng").alias("eng")).alias("title-proc"),
        F.struct(F.col("body_swe").alias("swe"), F.col("body_eng").alias("eng")).alias("description-proc"),
        F.col("publication_date").alias("publication-date"), F.col("value").alias("estimated-value-proc"),
        F.col("currency").alias("estimated-value-cur-proc"), F.array_compact(F.array("deadline")).alias("deadline-receipt-tender-date-lot"),
        F.when(F.col("cpv").isNotNull(), F.array("cpv")).alias("classification-cpv"), F.col("place").alias("place-of-performance"))
    return t.select("organization_id", F.to_json(notice).alias("payload"))


@query("scan_procurement", """
    SELECT organization_id, number, title_swe, title_eng, publication_date, value, currency, cpv, place
    FROM d_tenders WHERE CAST(substring(publication_date, 1, 10) AS DATE) > DATE '1998-06-01'""")
def _(s, d):
    t = scans.scan_procurement(tender_payload(s, d), date(1998, 6, 1))
    return t.select("organization_id", "number", F.col("title.swe").alias("title_swe"), F.col("title.eng").alias("title_eng"),
                    "publication_date", "value", "currency", F.get("cpv", F.lit(0)).alias("cpv"), "place")


@query("scan_sitemap", """
    SELECT page_id, pos, CASE pos WHEN 0 THEN url ELSE url || '/b' END AS url FROM pages, range(2) AS t(pos)""")
def _(s, d):
    xml = F.concat(F.lit("<urlset><url><loc> "), F.col("url"), F.lit("\n</loc></url><url><LOC>"), F.col("url"), F.lit("/b</LOC></url></urlset>"))
    return scans.scan_sitemap(table(s, d, "pages").select("page_id", xml.alias("xml")))


@query("scan_key_value_json", "SELECT name, 'https://' || place_id || '.example' AS homepage FROM d_places")
def _(s, d):
    p = frame(s, d, "d_places")
    payload = F.to_json(F.create_map("name", F.concat(F.lit("https://"), F.col("place_id").cast("string"), F.lit(".example"))))
    return scans.scan_key_value_json(p.select(payload.alias("payload")))


@query("static_reference_rows", """
    SELECT DISTINCT property_designation, municipality, 7 AS organization_id FROM d_properties""")
def _(s, d):
    return scans.attach_organization(frame(s, d, "d_properties"), 7)


@query("scan_range", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 03:30:00'")
def _(s, d):
    return scans.scan_range(table(s, d, "events"), "ts", datetime(2024, 1, 20, 3, 30)).select("event_id", "ts")


@query("scan_unverified", """
    SELECT municipality, listing_url FROM d_configs WHERE NOT verified AND row_browser AND listing_url <> ''""")
def _(s, d):
    return scans.scan_unverified(config_rows(s, d), browser_only=True).select("municipality", "config.listing_url")


@query("scan_targets", "SELECT name, homepage AS url FROM d_places WHERE homepage <> ''")
def _(s, d):
    return scans.scan_targets(frame(s, d, "d_places"))


@query("scan_named_targets", """
    SELECT name, homepage AS url FROM d_places WHERE homepage <> '' AND (contains(lower(name), '#00000001') OR contains(lower(name), '7'))""")
def _(s, d):
    return scans.scan_targets(frame(s, d, "d_places"), ["#00000001", "7"])


# Projections

@query("map_fields", """
    SELECT arrival, municipality, case_number, nullif(address, '') AS address, permit_type, status, date, description,
      CAST(NULL AS VARCHAR) AS applicant, CAST(NULL AS VARCHAR) AS property, source_url FROM d_records""")
def _(s, d):
    mapping = config.PERMITS.field_mapping
    return shaping.map_fields(frame(s, d, "d_records"), mapping).select("arrival", *mapping.values())


@query("add_metadata", """
    SELECT arrival, 'm1' AS extraction_model, CAST(NULL AS DOUBLE) AS extraction_cost_usd,
      coalesce(page_hash, 'ff00') AS raw_html_hash FROM d_records""")
def _(s, d):
    return shaping.add_metadata(frame(s, d, "d_records"), "m1", "ff00").select(
        "arrival", "extraction_model", F.col("extraction_cost_usd").cast("double").alias("extraction_cost_usd"), "raw_html_hash")


@query("default_fields", """
    SELECT arrival, coalesce(source_url, 'https://page.example/' || place) AS source_url,
      coalesce(permit_type, nullif(address, ''), 'pressroom') AS source_type FROM d_records""")
def _(s, d):
    r = frame(s, d, "d_records").withColumns({
        "page_url": F.concat(F.lit("https://page.example/"), "place"), "source_type": F.col("permit_type")})
    return shaping.default_fields(r, "page_url", "address", config.PRESSROOM.default_source_type).select(
        "arrival", "source_url", "source_type")


@query("legacy_flag", "SELECT arrival, created_at < TIMESTAMP '1998-01-01' AS is_legacy FROM d_records")
def _(s, d):
    return shaping.legacy_flag(frame(s, d, "d_records"), "created_at", CUT_OVER).select("arrival", "is_legacy")


# Filters

@query("filter_by_name_list", "SELECT id, name FROM d_named WHERE contains(lower(name), 'västra') OR contains(lower(name), '00001')")
def _(s, d):
    return shaping.filter_by_name_list(frame(s, d, "d_named"), "name", "VÄSTRA, 00001").select("id", "name")


@query("route_source_kind", """
    SELECT municipality, CASE WHEN contains(listing_url, '#!/billboard') THEN 'ciceron'
      WHEN contains(lower(listing_url), '/digital-bulletin-board') THEN 'meetingplus'
      WHEN regexp_matches(lower(listing_url), 'netpublicator\\.com/bulletinboard') THEN 'netpublicator'
      WHEN coalesce(config_browser, false) OR coalesce(row_browser, false) THEN 'browser' ELSE 'http' END AS kind
    FROM d_configs""")
def _(s, d):
    return shaping.route_source_kind(scans.parse_config_rows(config_rows(s, d))).select("municipality", "kind")


@query("keyword_filter", f"""
    WITH {LINKS} SELECT page_id, pos, text FROM links WHERE {any_word('lower(text)', PAGE_TERMS)}""")
def _(s, d):
    return shaping.keyword_filter(links(s, d), "text", PAGE_TERMS).select("page_id", "pos", "text")


@query("domain_filter", f"""
    WITH {LINKS}, c AS (SELECT page_id, url, pos, CASE WHEN length(text) <= 3 THEN href || '.pdf'
        WHEN length(text) >= 9 THEN replace(href, '.example.', '.other.') ELSE href END AS href FROM links
      UNION ALL SELECT page_id, url, pos + 1000, href FROM links)
    SELECT url, href, min(pos) AS pos FROM c
    WHERE NOT regexp_matches(href, '(?i)\\.(pdf|doc|docx|xlsx|xls|zip|png|jpg|jpeg|gif)$')
      AND ({bare_host('href')} = {bare_host('url')} OR ends_with({bare_host('href')}, '.' || {bare_host('url')}))
    GROUP BY 1, 2""")
def _(s, d):
    found = links(s, d)
    size = F.length("text")
    varied = found.withColumn("href", F.when(size <= 3, F.concat("href", F.lit(".pdf")))
                              .when(size >= 9, F.replace("href", F.lit(".example."), F.lit(".other."))).otherwise(F.col("href")))
    again = found.withColumn("pos", F.col("pos") + 1000)
    return shaping.domain_filter(varied.unionByName(again), "href", "url", ["pos"]).select("url", "href", "pos")


@query("href_pattern_filter", f"""
    WITH {LINKS} SELECT page_id, pos, href FROM links WHERE contains(lower(href), 'tion') OR contains(lower(href), 'the')""")
def _(s, d):
    hinted = links(s, d).withColumn("selector", F.lit(LINK_SELECTOR))
    return shaping.href_pattern_filter(hinted, "href", "selector").select("page_id", "pos", "href")


@query("min_content_gate", f"""
    SELECT doc_id, octet_length(encode(text)) AS bytes FROM documents WHERE octet_length(encode(text)) >= 500""")
def _(s, d):
    kept = shaping.min_content_gate(table(s, d, "documents"), "text")
    return kept.select("doc_id", F.octet_length("text").cast("long").alias("bytes"))


_FLAGGED = f"""
    new AS (SELECT source, doc_id AS url, lang <> 'de' AS verified, CASE WHEN octet_length(encode(text)) >= 500 THEN {hash16('text')} END AS content_hash
      FROM documents),
    old AS (SELECT source, doc_id AS url, {hash16("CASE WHEN lang = 'fr' THEN text || '.' ELSE text END")} AS stored FROM documents),
    flagged AS (SELECT new.*, coalesce(verified AND stored = content_hash, false) AS skipped FROM new LEFT JOIN old USING (source, url))"""


def flagged_documents(s, d):
    docs = table(s, d, "documents")
    new = shaping.gate_and_hash(docs.select("source", F.col("doc_id").alias("url"), (F.col("lang") != "de").alias("verified"),
                                            F.col("text").alias("content")))
    old_text = F.when(F.col("lang") == "fr", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    old = docs.select("source", F.col("doc_id").alias("url"), html.content_hash(old_text).alias("content_hash"))
    return new, old


@query("split_subpages", """
    SELECT page_id, 0 AS part, url AS source_url, length(html) AS size FROM pages
    UNION ALL SELECT page_id, 1, url || '/2', length('<!-- SUBPAGE: ' || url || '/2 -->' || html) FROM pages WHERE page_id % 3 > 0
    UNION ALL SELECT page_id, 2, url || '/3', length('<!--subpage:' || url || '/3-->') FROM pages WHERE page_id % 3 > 1""")
def _(s, d):
    p = table(s, d, "pages")
    second = F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("<!-- SUBPAGE: "), "url", F.lit("/2 -->"), "html")).otherwise(F.lit(""))
    third = F.when(F.col("page_id") % 3 > 1, F.concat(F.lit("<!--subpage:"), "url", F.lit("/3-->"))).otherwise(F.lit(""))
    joined = p.select("page_id", "url", F.concat("html", second, third).alias("html"))
    return shaping.split_subpages(joined).select("page_id", "part", "source_url", F.length("html").alias("size"))


@query("unchanged_page_filter", f"WITH {_FLAGGED} SELECT source, url, content_hash FROM flagged WHERE NOT skipped")
def _(s, d):
    return shaping.unchanged_page_filter(*flagged_documents(s, d)).select("source", "url", "content_hash")


_STREAMED = f"""
    v AS (SELECT source, doc_id AS url, lang <> 'de' AS verified, CASE WHEN octet_length(encode(text)) >= 500 THEN text END AS content FROM documents),
    r AS (SELECT source, url, verified, 1 AS run, {hash16('content')} AS content_hash FROM v
      UNION ALL SELECT source, url, verified, 2, {hash16("CASE WHEN url % 3 = 0 THEN content || '!' ELSE content END")} FROM v WHERE url % 5 > 0
      UNION ALL SELECT source, url, verified, 3, {hash16("CASE WHEN url % 3 = 0 THEN content || '!' ELSE content END")} FROM v)"""


@query("changed_pages_stream", f"""
    WITH {_STREAMED} SELECT r.source, CAST(r.url AS VARCHAR) AS url, r.content_hash, CAST(r.run AS BIGINT) AS run FROM r
    LEFT JOIN r AS before ON before.source = r.source AND before.url = r.url AND before.run = r.run - 1
    WHERE NOT coalesce(r.verified AND before.content_hash = r.content_hash, false)""")
def _(s, d):
    """Three runs over the documents arrive one after another, the second without every fifth page."""
    docs = table(s, d, "documents")
    v = docs.select("source", "doc_id", (F.col("lang") != "de").alias("verified"), F.when(F.octet_length("text") >= 500, F.col("text")).alias("content"))
    later = F.when(F.col("doc_id") % 3 == 0, F.concat("content", F.lit("!"))).otherwise(F.col("content"))
    folder = f"{shared_folder(s)}/page-stream-{uuid.uuid4().hex}"
    for run, rows, content in ((1, v, F.col("content")), (2, v.where(F.col("doc_id") % 5 > 0), later), (3, v, later)):
        rows.select("source", F.col("doc_id").cast("string").alias("url"), "verified", html.content_hash(content).alias("content_hash"),
                    F.lit(run).cast("long").alias("run")).write.mode("append").parquet(f"{folder}/in")
        stream = s.readStream.schema(page_changes.PAGES).parquet(f"{folder}/in")
        page_changes.start_changes(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return s.read.schema(page_changes.CHANGED).parquet(f"{folder}/out")


@query("source_status", f"""
    WITH {_FLAGGED} SELECT source, count(*) FILTER (WHERE skipped) AS skipped_pages, count(*) FILTER (WHERE NOT skipped) AS read_pages,
      CASE WHEN bool_and(skipped) THEN 'unchanged' ELSE 'changed' END AS status FROM flagged GROUP BY source""")
def _(s, d):
    return shaping.source_status(shaping.flag_unchanged(*flagged_documents(s, d)))


@query("bygg_item_filter", f"""
    SELECT id FROM d_items WHERE regexp_matches(lower(title), {q(config.BILLBOARD_PATTERN)})
      OR (diary_name IN {in_list(config.BUILDING_DIARIES)} AND {permit_class('title')} IS NOT NULL)""")
def _(s, d):
    return boards.bygg_item_filter(frame(s, d, "d_items")).select("id")


@query("pbl_type_filter", f"SELECT id, type_name FROM d_announced WHERE {any_word('lower(type_name)', config.PBL_TYPE_KEYWORDS)}")
def _(s, d):
    return boards.pbl_type_filter(frame(s, d, "d_announced")).select("id", "type_name")


@query("keep_identified", "SELECT arrival FROM d_records WHERE permit_type IS NOT NULL OR case_number IS NOT NULL")
def _(s, d):
    return shaping.keep_identified(frame(s, d, "d_records")).select("arrival")


def tenders(s, d):
    t = frame(s, d, "d_tenders")
    return t.withColumns({
        "cpv": F.when(F.col("cpv").isNotNull(), F.array("cpv")), "deadlines": F.array_compact(F.array("deadline")),
        "title": F.struct(F.col("title_swe").alias("swe"), F.col("title_eng").alias("eng")),
        "description": F.struct(F.col("body_swe").alias("swe"), F.col("body_eng").alias("eng"))})


@query("cpv_filter", "SELECT number FROM d_tenders WHERE cpv IS NULL OR substring(cpv, 1, 2) IN ('45', '71', '44')")
def _(s, d):
    return boards.cpv_filter(tenders(s, d)).select("number")


_STAGES = """CASE lower(trim(status)) WHEN 'ansökt' THEN 'rumor' WHEN 'beviljat' THEN 'planned' WHEN 'startbesked' THEN 'planned'
    WHEN 'slutbesked' THEN 'awarded' WHEN 'överklagat' THEN 'rumor' END"""


@query("status_is_rejected", f"""
    SELECT id, {_STAGES} AS maturity FROM d_permits WHERE coalesce(lower(trim(status)), '') <> 'avslag'""")
def _(s, d):
    return shaping.status_is_rejected(frame(s, d, "d_permits")).select("id", "maturity")


@query("ungrouped_split", """
    SELECT signal_id, CASE WHEN source_type = 'permit' THEN 'permit' ELSE 'other' END AS part FROM d_signals WHERE project_id IS NULL""")
def _(s, d):
    permits, others = shaping.ungrouped_split(frame(s, d, "d_signals"))
    return permits.select("signal_id", F.lit("permit").alias("part")).union(others.select("signal_id", F.lit("other").alias("part")))


_REASONS = """
    checked AS (SELECT arrival, CASE WHEN case_number IS NULL THEN 'missing_identifier' END AS a,
      CASE WHEN source_url IS NULL THEN 'missing_source_url' END AS b,
      CASE WHEN created_at >= TIMESTAMP '1996-01-01' AND page_hash IS NULL THEN 'missing_page_hash' END AS c FROM d_records)"""


def checked_records(s, d):
    return shaping.require_technical_fields(frame(s, d, "d_records"), "case_number", "created_at", date(1996, 1, 1))


@query("require_technical_fields", f"WITH {_REASONS} SELECT arrival, concat_ws(',', a, b, c) AS reasons FROM checked")
def _(s, d):
    return checked_records(s, d).select("arrival", F.array_join("drop_reasons", ",").alias("reasons"))


@query("storable_records", f"WITH {_REASONS} SELECT arrival FROM checked WHERE a IS NULL AND b IS NULL AND c IS NULL")
def _(s, d):
    return shaping.storable(checked_records(s, d)).select("arrival")


@query("drop_reason_counts", f"""
    WITH {_REASONS} SELECT reason, count(*) AS records FROM (SELECT unnest([a, b, c]) AS reason FROM checked) WHERE reason IS NOT NULL GROUP BY 1""")
def _(s, d):
    return shaping.drop_reason_counts(checked_records(s, d))


# Set operations and samples

@query("union_records", """
    SELECT arrival AS id, municipality, case_number, CAST(NULL AS VARCHAR) AS lan FROM d_records
    UNION ALL SELECT id, municipality, case_number, lan FROM d_permits""")
def _(s, d):
    a = frame(s, d, "d_records").select(F.col("arrival").alias("id"), "municipality", "case_number")
    return shaping.union_records(a, frame(s, d, "d_permits").select("id", "municipality", "case_number", "lan"))


@query("distinct_links", f"WITH {LINKS} SELECT href, min(page_id * 1000 + pos) AS first_seen FROM links GROUP BY href")
def _(s, d):
    return shaping.distinct_links(links(s, d), ["href"], ["page_id", "pos"]).select(
        "href", (F.col("page_id") * 1000 + F.col("pos")).alias("first_seen"))


@query("pages_per_source_limit", """
    SELECT source, url FROM (SELECT source, doc_id AS url, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS r
      FROM documents) WHERE r <= 10""")
def _(s, d):
    p = table(s, d, "documents").select("source", F.col("doc_id").alias("url"), F.col("n_chars").alias("pos"))
    return shaping.pages_per_source_limit(p, 10).select("source", "url")


@query("sample_first_n", """
    SELECT place, arrival, sample_no FROM (SELECT place, arrival, row_number() OVER (PARTITION BY place ORDER BY arrival) AS sample_no
      FROM d_records) WHERE sample_no <= 3""")
def _(s, d):
    return shaping.sample_first_n(frame(s, d, "d_records"), "place", ["arrival"]).select("place", "arrival", "sample_no")


@query("cli_limit", "SELECT name, county FROM d_places ORDER BY name LIMIT 25")
def _(s, d):
    return shaping.in_name_order(frame(s, d, "d_places").select("name", "county"), "name", 25)


@query("task_order", "SELECT id, priority, created_at FROM d_tasks WHERE status = 'pending' ORDER BY priority, created_at, id")
def _(s, d):
    return shaping.task_order(frame(s, d, "d_tasks")).select("id", "priority", "created_at")


# Names

# Marks of several scripts, out of order and doubled; parts of syllables; letters that have another canonical form.
_MARKED = (
    "e" + chr(0x301), "a" + chr(0x302) + chr(0x323), "o" + chr(0x323) + chr(0x302) + chr(0x302), chr(0x212B) + chr(0x2126) + chr(0x1E9B) + chr(0x323),
    chr(0x1112) + chr(0x1161) + chr(0x11AB) + chr(0xAC00) + chr(0x11A8), chr(0x915) + chr(0x93C) + chr(0x928) + chr(0x93C),
    chr(0x5D9) + chr(0x5B4) + chr(0xFB1D), chr(0x627) + chr(0x654) + chr(0x653), chr(0x3B1) + chr(0x345) + chr(0x301), chr(0xF71) + chr(0xF74) + chr(0xF73),
    chr(0x30AB) + chr(0x3099), chr(0x11099) + chr(0x110BA), chr(0x323) + chr(0x302) + "x", chr(0x6D5) + chr(0x654))


@query("nfc_any_script", "SELECT doc_id, nfc_normalize(" + "".join("replace(" for _ in _MARKED) + "text" + "".join(
    f", '{word}', ' ' || " + " || ".join(f"chr({ord(c)})" for c in marked) + " || '!')"
    for word, marked in zip(("the ", "and ", "of ", "to ", "in ", "de ", "la ", "die ", "der ", "und ", "que ", "les ", "el ", "en "), _MARKED)) + ") AS text FROM documents")
def _(s, d):
    """Whole texts in which frequent words stand for letters with marks."""
    t = F.col("text")
    for word, marked in zip(("the ", "and ", "of ", "to ", "in ", "de ", "la ", "die ", "der ", "und ", "que ", "les ", "el ", "en "), _MARKED):
        t = F.replace(t, F.lit(word), F.lit(f" {marked}!"))
    return table(s, d, "documents").select("doc_id", composition.nfc_any(t).alias("text"))


@query("nfc", """
    SELECT doc_id, nfc_normalize(replace(replace(replace(text, 'é', 'e' || chr(769)), 'ä', 'a' || chr(776)), 'Ü', 'U' || chr(776))) AS text FROM documents""")
def _(s, d):
    t = F.col("text")
    for letter, pair in (("é", "e\u0301"), ("ä", "a\u0308"), ("Ü", "U\u0308")):
        t = F.replace(t, F.lit(letter), F.lit(pair))
    return table(s, d, "documents").select("doc_id", names.nfc(t).alias("text"))


_NAMED = {
    "normalize_municipality": (names.normalize_municipality, normal_place("name")),
    "normalize_to_ascii": (names.normalize_to_ascii, ascii_name("name")),
    "sanitize_name": (names.sanitize_name, sanitized("name")),
    "is_mangled_name": (names.is_mangled_name, "regexp_matches(name, '[a-zåäö][A-ZÅÄÖ]') OR regexp_matches(name, '^[åäö][A-Z]')"),
    "sql_name_normaliser": (names.health_name_key, "lower(" + rx(
        "name", (r"^Region\s+", "''", "i"), (r"\s+kommun$", "''", "i"), (r"\s+stad$", "''", "i")) + ")"),
    "municipality_to_domain": (names.municipality_to_domain, rx(fold(trim(rx("name", ("s$", "''", "")))), (r"\s+", "''", "g")) + " || '.se'"),
}
for _name, (_fn, _sql) in _NAMED.items():
    query(_name, f"SELECT id, name, {_sql} AS result FROM d_named")(
        lambda s, d, fn=_fn: frame(s, d, "d_named").select("id", "name", fn(F.col("name")).alias("result")))

_DOMAIN = rx(fold(trim(rx("name", ("s$", "''", "")))), (r"\s+", "''", "g"))


@query("candidate_hostnames", f"""
    WITH n AS (SELECT id, name, {_DOMAIN} AS dom, {ascii_name('name')} AS asc_name, {ascii_name("replace(name, '-', '')")} AS nohyp,
        {fold(rx('name', (chr(92) + 's+', "'-'", 'g')))} AS hyph FROM d_named),
    c AS (SELECT id, ['https://www.' || dom || '.se', 'https://' || dom || '.se', 'https://www.' || asc_name || '.se', 'https://' || asc_name || '.se',
        'https://www.' || asc_name || '.kommun.se'] || CASE WHEN contains(name, '-') THEN ['https://www.' || nohyp || '.se', 'https://' || nohyp || '.se'] ELSE [] END
        || CASE WHEN contains(name, ' ') THEN ['https://www.' || hyph || '.se', 'https://' || hyph || '.se'] ELSE [] END AS l FROM n)
    SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS hostnames FROM c""")
def _(s, d):
    return frame(s, d, "d_named").select("id", F.array_join(names.candidate_hostnames(F.col("name")), " ").alias("hostnames"))


# Pages

@query("html_to_text", f"SELECT page_id, {page_text('html')} AS text FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", html.to_text(F.col("html")).alias("text"))


@query("strip_non_content", f"SELECT page_id, {stripped('html')} AS html FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", html.strip_non_content(F.col("html")).alias("html"))


@query("extract_links", f"WITH {LINKS} SELECT page_id, url, pos, href, text FROM links")
def _(s, d):
    return links(s, d)


@query("page_extract", f"""
    WITH {LINKS}, n AS (SELECT page_id, count(*) AS links FROM links GROUP BY 1), p AS (SELECT page_id, url, {page_text('html')} AS c FROM pages)
    SELECT p.page_id, url, {host('url')} AS host, coalesce(links, 0) AS links, length(c) AS text_chars, {hash16('c')} AS content_hash
    FROM p LEFT JOIN n USING (page_id) WHERE octet_length(encode(c)) >= 500""")
def _(s, d):
    return daily_run.page_extract(table(s, d, "pages"))


_SIGNS = {"mobile": ("https://m.", "http://m."), "blog": ("//blog.",), "site": ("//www.", "cheap")}


@query("detect_platform", """
    SELECT page_id, CASE WHEN contains(x, 'https://m.') OR contains(x, 'http://m.') THEN 'mobile' WHEN contains(x, '//blog.') THEN 'blog'
      WHEN contains(x, '//www.') OR contains(x, 'cheap') THEN 'site' ELSE 'unknown' END AS platform
    FROM (SELECT page_id, lower(url || html) AS x FROM pages)""")
def _(s, d):
    return table(s, d, "pages").select("page_id", html.detect_platform(F.concat("url", "html"), _SIGNS).alias("platform"))


@query("decode_entities", """
    SELECT page_id, replace(replace(replace(html, '&amp;', '&'), '&lt;', '<'), '&quot;', '"') AS html FROM pages""")
def _(s, d):
    return table(s, d, "pages").select("page_id", html.decode_entities(F.col("html")).alias("html"))


@query("content_hash", f"SELECT doc_id, {hash16('text')} AS content_hash FROM documents")
def _(s, d):
    return table(s, d, "documents").select("doc_id", html.content_hash(F.col("text")).alias("content_hash"))


@query("truncate_content", "SELECT doc_id, length(substring(text, 1, 100000)) AS chars, sha256(substring(text, 1, 100000)) AS digest FROM documents")
def _(s, d):
    cut = html.truncate(F.col("text"))
    return table(s, d, "documents").select("doc_id", F.length(cut).alias("chars"), F.sha2(cut, 256).alias("digest"))


@query("base_url_board_id", f"""
    SELECT url, {extract('url', '^(https?://[^/]+)')} AS base_url, {extract('board', '(?i)/bulletinboard/public/([0-9a-f-]{36})')} AS board_id
    FROM (SELECT url, url || '/bulletinboard/public/' || CASE WHEN url LIKE '%www%' THEN 'x' ELSE
      substring(sha256(url), 1, 8) || '-0000-1111-2222-' || substring(sha256(url), 9, 12) END AS board FROM pages)""")
def _(s, d):
    sha = F.sha2("url", 256)
    ident = F.when(F.contains("url", F.lit("www")), "x").otherwise(
        F.concat(F.substring(sha, 1, 8), F.lit("-0000-1111-2222-"), F.substring(sha, 9, 12)))
    return table(s, d, "pages").select(
        "url", urls.origin(F.col("url")).alias("base_url"),
        urls.board_id(F.concat("url", F.lit("/bulletinboard/public/"), ident)).alias("board_id"))
