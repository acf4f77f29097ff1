"""Queries of the notice parsers, of cross-matching, discovery and curation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.derived import frame, table
from bindings.registry import query
from bindings.sources import PAGE_TERMS, links, notice_rows, tenders
from bindings.sqltext import (
    LINKS, any_word, extract, in_list, letters, loose_url, normal_place, normal_url, permit_class, q, rx, trim, word_list,
)
from noticeworks import config
from noticeworks.functions import html, records, urls
from noticeworks.operators import boards, curation, discovery, keyed_tables, loading, matching, quality, shaping
from noticeworks.plans import cross_match
from noticeworks.session import shared_folder

TED = "https://tenders.example/notice/"


# Boards

_TITLE = rf"""t AS (SELECT *, {trim("replace(title, chr(10), ' ')")} AS c FROM d_items), p AS (SELECT *,
      CASE WHEN regexp_matches(c, '^.+?\s*-\s*.+$') THEN {trim("regexp_extract(c, '^(.+?)" + chr(92) + "s*-" + chr(92) + "s*(.+)$', 1)")}
        ELSE nullif({trim("regexp_extract(c, '(?i)fastigheten" + chr(92) + "s+(.+)', 1)")}, '') END AS p_address,
      CASE WHEN regexp_matches(c, '^.+?\s*-\s*.+$') THEN {trim("regexp_extract(c, '^(.+?)" + chr(92) + "s*-" + chr(92) + "s*(.+)$', 2)")} ELSE c END AS p_text FROM t)"""


@query("parse_billboard_title", f"WITH {_TITLE} SELECT id, p_address AS address, p_text AS description FROM p")
def _(s, d):
    return frame(s, d, "d_items").select("id", records.parse_billboard_title(F.col("title")).alias("p")).select("id", "p.*")


@query("billboard_permits", f"""
    WITH {_TITLE} SELECT source AS municipality, nullif(diarie, '') AS case_number, p_address AS address, CAST(NULL AS VARCHAR) AS property, {permit_class('title')} AS permit_type,
      'beviljat' AS status, CAST(NULL AS VARCHAR) AS date, p_text AS description, CAST(NULL AS VARCHAR) AS applicant, {extract('base_url', '^(https?://[^/]+)')} || '/#!/billboard/' AS source_url
    FROM p WHERE regexp_matches(lower(title), {q(config.BILLBOARD_PATTERN)}) OR (diary_name IN {in_list(config.BUILDING_DIARIES)} AND {permit_class('title')} IS NOT NULL)""")
def _(s, d):
    return boards.billboard_permits(frame(s, d, "d_items"))


def announced(s, d):
    a = frame(s, d, "d_announced")
    types = a.select("source", "type_id", "type_name", "base_url").distinct()
    listed = a.select("source", "type_id", "id", "start_date", "title")
    details = a.where(F.col("description").isNotNull()).select("source", "id", "description", "document_title")
    return types, listed, details


@query("announcement_detail_join", f"""
    SELECT source, type_id, type_name, id, title, description, CASE WHEN description IS NOT NULL THEN document_title END AS document_title
    FROM d_announced WHERE {any_word('lower(type_name)', config.PBL_TYPE_KEYWORDS)}""")
def _(s, d):
    return boards.announcement_detail_join(*announced(s, d)).select(
        "source", "type_id", "type_name", "id", "title", "description", "document_title")


_PROP = r"([A-ZÅÄÖa-zåäö][a-zåäöéA-ZÅÄÖÉ-]+(?:[\s-]+\d+:\d+)?(?:\s+m\.?\s*fl\.?)?)"
_STREET = r"(?i)\(([^)]+(?:vägen|gatan|gränd|torget|platsen|stigen|allén|backen)[^)]*)\)"
_STREET_T = r"(?i)\(([^)]+(?:vägen|gatan|gränd|stigen)[^)]*)\)"
_ANN = rf"""b AS (SELECT *, coalesce(description, '') AS text, coalesce(document_title, '') AS doc FROM d_announced),
    f AS (SELECT *, {extract('text', '[Dd]iarienr(?:ummer)?:' + chr(92) + 's*([^' + chr(92) + 'n,]+)')} AS cn,
      coalesce({extract('title', '(?i)inom(?:' + chr(92) + 's+fastigheten)?' + chr(92) + 's+' + _PROP)}, {extract('text', '(?i)fastigheten' + chr(92) + 's+' + _PROP)},
        CASE WHEN regexp_matches({trim('title')}, '^[A-ZÅÄÖ][A-ZÅÄÖ\s-]+\d') THEN {trim('title')} END) AS prop,
      coalesce({extract('text', _STREET)}, {extract('title', _STREET_T)}) AS street, {extract('text', '(?i)(?:sökande|byggherre):' + chr(92) + 's*([^' + chr(92) + 'n]+)')} AS who FROM b)"""
_STATUS_NAME = """CASE WHEN contains(lower({0}), 'beviljade') OR contains(lower({0}), 'beslut') THEN 'beviljat'
      WHEN contains(lower({0}), 'inför') OR contains(lower({0}), 'ansökan') THEN 'ansökt' ELSE 'beviljat' END"""
_ORG = r"(?i)\b(AB|HB|KB|BRF|kommun|region|stiftelse|förening|fastigheter|bostäder|exploatering)\b"


@query("announcement_permits", f"""
    WITH {_ANN}, r AS (SELECT source AS municipality, trim(cn) AS case_number, coalesce(street, prop) AS address, CASE WHEN prop <> coalesce(street, prop) THEN prop END AS property,
      {permit_class("title || ' ' || text || ' ' || doc")} AS permit_type, {_STATUS_NAME.format("(type_name || ' ' || doc)")} AS status, start_date AS date,
      nullif({trim(rx('title', ('^kung[öo]relse:' + chr(92) + 's*', "''", 'i'), ('^anslag:' + chr(92) + 's*', "''", 'i')))}, '') AS description,
      CASE WHEN regexp_matches(who, {q(_ORG)}) THEN trim(who) END AS applicant,
      {extract('base_url', '^(https?://[^/]+)')} || '/digital-bulletin-board/announcements/' || id AS source_url FROM f)
    SELECT * FROM r WHERE permit_type IS NOT NULL OR case_number IS NOT NULL""")
def _(s, d):
    return boards.announcement_permits(frame(s, d, "d_announced"))


@query("classify_permit_type", f"SELECT id, {permit_class('title')} AS permit_type FROM d_announced")
def _(s, d):
    return frame(s, d, "d_announced").select("id", records.classify_permit_type(F.col("title")).alias("permit_type"))


@query("classify_status_type", f"SELECT id, {_STATUS_NAME.format('type_name')} AS status FROM d_announced")
def _(s, d):
    return frame(s, d, "d_announced").select("id", records.status_from_type_name(F.col("type_name")).alias("status"))


def _status_text(e):
    e = f"lower({e})"
    return f"""CASE WHEN {any_word(e, ('grannhöran', 'underrättelse', 'lovansökning', 'remiss'))} THEN 'ansökt' WHEN contains({e}, 'avslag') THEN 'avslag'
      WHEN contains({e}, 'överklag') THEN 'överklagat' WHEN contains({e}, 'startbesked') THEN 'startbesked' WHEN contains({e}, 'slutbesked') THEN 'slutbesked' ELSE 'beviljat' END"""


@query("classify_status_text", f"SELECT id, {_status_text('title || attachment')} AS status FROM d_noticed")
def _(s, d):
    return frame(s, d, "d_noticed").select("id", records.status_from_text(F.concat("title", "attachment")).alias("status"))


@query("org_applicant_only", f"""
    SELECT id, CASE WHEN regexp_matches(who, {q(_ORG)}) THEN trim(who) END AS applicant FROM (SELECT id, {extract("coalesce(description, '')", '(?i)(?:sökande|byggherre):' + chr(92) + 's*([^' + chr(92) + 'n]+)')} AS who FROM d_announced)""")
def _(s, d):
    return frame(s, d, "d_announced").select("id", records.organisation_applicant(F.col("description")).alias("applicant"))


_LINE = r"(?i)^([A-ZÅÄÖ][A-ZÅÄÖ\s-]+\d+(?::\d+)?)\s*(?:\(([^)]+)\))?\s*-\s*(.+)$"
_DECODED = rx("value", ("&#228;", "'ä'", "g"), ("&#246;", "'ö'", "g"), (r"<br\s*/?>", "''", "gi"))
_LINED = f"""l AS (SELECT *, {trim(_DECODED)} AS c, regexp_matches({trim(_DECODED)}, {q(_LINE)}) AS ok FROM d_noticed),
    m AS (SELECT *, CASE WHEN ok THEN trim(regexp_extract(c, {q(_LINE)}, 1)) END AS l_prop, CASE WHEN ok THEN nullif(trim(regexp_extract(c, {q(_LINE)}, 2)), '') END AS l_addr,
      CASE WHEN ok THEN trim(regexp_extract(c, {q(_LINE)}, 3)) ELSE nullif(c, '') END AS l_text FROM l)"""


@query("parse_notice_description", f"WITH {_LINED} SELECT id, l_prop AS property, l_addr AS address, l_text AS description FROM m")
def _(s, d):
    return frame(s, d, "d_noticed").select("id", records.parse_notice_description(F.col("value")).alias("p")).select("id", "p.*")


_NOTICE = f"""{_LINED}, a AS (SELECT m.*, {rx('value', ('&#228;', "'ä'", 'g'), ('&#246;', "'ö'", 'g'))} || ' ' || attachment || ' ' || coalesce(title, '') || ' ' || coalesce(text, '') AS all_text,
      coalesce(t1.name, t2.name, '') AS type_name, coalesce(cat.name, '') AS cat_name, coalesce(t1.name, '') AS own_type FROM m
      LEFT JOIN d_types t1 ON t1.board_id = m.board_id AND t1.type = m.type_key LEFT JOIN d_types t2 ON t2.board_id = m.board_id AND t2.id = m.type_key
      LEFT JOIN d_categories cat ON cat.board_id = m.board_id AND cat.id = m.category_id),
    n AS (SELECT *, {permit_class("all_text || ' ' || type_name")} AS kind, regexp_matches(all_text, {q('(?i)' + config.NOTICE_TEXT_PATTERN)}) AS kw,
      regexp_matches(own_type, {q('(?i)' + config.NOTICE_TEXT_PATTERN)}) AS is_type, regexp_matches(cat_name, {q('(?i)' + config.NOTICE_CATEGORY_PATTERN)}) AS is_cat FROM a),
    kept AS (SELECT * FROM n WHERE (is_cat OR is_type OR kw) AND (is_type OR kind IS NOT NULL OR kw))"""


@query("notice_filter", f"WITH {_NOTICE} SELECT id, kind AS permit_type, is_type AS is_building_type FROM kept")
def _(s, d):
    return boards.notice_filter(notice_rows(s, d), frame(s, d, "d_categories"), frame(s, d, "d_types")).select(
        "id", "permit_type", "is_building_type")


@query("notice_permits", rf"""
    WITH {_NOTICE} SELECT source AS municipality, {rx(extract('all_text', '(?i)diarienummer:' + chr(92) + 's*([^' + chr(92) + 's.]+(?:' + chr(92) + 's+[' + chr(92) + 'd-]+)?)'), (chr(92) + '.$', "''", ''))} AS case_number,
      coalesce(l_addr, l_prop) AS address, CASE WHEN l_addr IS NOT NULL THEN l_prop END AS property, coalesce(kind, CASE WHEN is_type THEN 'bygglov' END) AS permit_type,
      {_status_text("(all_text || ' ' || type_name)")} AS status, split_part(published, ' ', 1) AS date, l_text AS description, CAST(NULL AS VARCHAR) AS applicant,
      'https://boards.example/bulletinboard/public/' || board_id || '/' || id AS source_url FROM kept""")
def _(s, d):
    return boards.notice_permits(notice_rows(s, d), frame(s, d, "d_categories"), frame(s, d, "d_types"), "https://boards.example")


# Model answers, labels and phrases

@query("parse_model_response", """
    SELECT event_id, pos, CASE pos WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events, range(2) AS t(pos) WHERE event_type <> 'error'""")
def _(s, d):
    parsed = shaping.parse_model_response(frame(s, d, "d_answers"), "response", "array<struct<k:string>>")
    return parsed.withColumn("k", F.col("k").try_cast("bigint"))


# What titles and texts say is known from how they are made, see ``derived``.
@query("phrase_type_status", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN 'bygglov' WHEN 'P' THEN 'rivningslov' END AS permit_type,
      CAST(NULL AS VARCHAR) AS status FROM orders""")
def _(s, d):
    return frame(s, d, "d_announced").select(
        "id", records.phrase_type(F.col("title")).alias("permit_type"), records.phrase_status(F.col("title")).alias("status"))


@query("labelled_fields", """
    SELECT o_orderkey AS page_id, 1 AS pos, 'BN 2026/' || o_orderkey AS case_number, 'RUD 3:' || o_custkey AS property,
      CASE WHEN o_custkey % 3 = 0 THEN 'Storgatan ' || (o_custkey % 90) END AS address,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Installation av eldstad' WHEN '2-HIGH' THEN 'Rivning av garage' ELSE 'Tillbyggnad' END AS description,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CASE WHEN o_orderstatus = 'F' THEN 'Rud Fastigheter AB' END AS applicant,
      CASE WHEN o_orderstatus = 'F' THEN 'bygglov' WHEN o_orderstatus = 'P' THEN 'förhandsbesked' WHEN o_orderpriority = '1-URGENT' THEN 'anmälan'
        WHEN o_orderpriority = '2-HIGH' THEN 'rivningslov' ELSE 'bygglov' END AS permit_type,
      CASE o_orderstatus WHEN 'F' THEN 'beviljat' WHEN 'O' THEN 'startbesked' END AS status FROM orders""")
def _(s, d):
    return shaping.labelled_fields(frame(s, d, "d_blocks"))


# Notices whose type and status stand deeper than their number, or after a heading inside; what they say is known from how they are made.
_NESTED = """n AS (SELECT o_orderkey AS page_id, o_custkey % 3 AS layout, 'BN 2026/' || CAST(o_orderkey AS VARCHAR) AS case_number,
      CASE o_orderstatus WHEN 'F' THEN 'Beviljat bygglov' WHEN 'O' THEN 'Startbesked för rivning' ELSE 'Avslag marklov' END AS decision,
      CASE o_orderstatus WHEN 'F' THEN 'bygglov' WHEN 'O' THEN 'rivningslov' ELSE 'marklov' END AS permit_type,
      CASE o_orderstatus WHEN 'F' THEN 'beviljat' WHEN 'O' THEN 'startbesked' ELSE 'avslag' END AS status FROM orders)"""


@query("labelled_fields_nested", f"WITH {_NESTED} SELECT page_id, case_number, permit_type, status FROM n")
def _(s, d):
    o = table(s, d, "orders")
    number = F.concat(F.lit("BN 2026/"), F.col("o_orderkey").cast("string"))
    decision = F.when(F.col("o_orderstatus") == "F", "Beviljat bygglov").when(F.col("o_orderstatus") == "O", "Startbesked för rivning").otherwise("Avslag marklov")
    article = F.concat(F.lit("<article><p>Diarienummer: "), number, F.lit("</p><h4>Beslut</h4><p>"), decision, F.lit("</p></article>"))
    row = F.concat(F.lit("<table><tr><th>Diarienr</th><th>Beslut</th></tr><tr><td>"), number, F.lit("</td><td><ul><li>Fattat<li>"), decision, F.lit("</ul></td></tr></table>"))
    card = F.concat(F.lit('<div class="card wide"><h3>Anslag</h3><div><p>Dnr: '), number, F.lit("</p></div><section><h2>Beslut</h2><div>"), decision, F.lit("</div></section></div>"))
    page = F.when(F.col("o_custkey") % 3 == 0, article).when(F.col("o_custkey") % 3 == 1, row).otherwise(card)
    return shaping.labelled_fields(o.select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("<h1>Anslagstavla</h1>"), page).alias("html"))).select(
        "page_id", "case_number", "permit_type", "status")


_TEXT = "SELECT l_orderkey, l_linenumber, l_partkey, {0} FROM lineitem"


def project_text(s, d, **columns):
    return frame(s, d, "d_projects_text").select(
        "l_orderkey", "l_linenumber", "l_partkey", *[c.alias(n) for n, c in columns.items()])


@query("property_designation", _TEXT.format("""CASE l_suppkey % 4 WHEN 0 THEN 'Haga Norra ' WHEN 1 THEN 'Rud-Berg ' WHEN 2 THEN 'Lunda By ' END
      || l_linenumber || ':' || l_partkey AS designation"""))
def _(s, d):
    return project_text(s, d, designation=records.property_designation(F.col("text")))


def _mapped(expr, table):
    return f"CASE {expr} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " END"


@query("parse_sek", _TEXT.format("""CAST(CASE l_partkey % 7 WHEN 0 THEN l_quantity * 1000000000 + 500000000 WHEN 1 THEN l_quantity * 1000000 WHEN 2 THEN l_quantity * 1000000000 + 250000000
      WHEN 3 THEN l_quantity * 1000000 + 250000 WHEN 4 THEN l_quantity * 1000000000000 + 125500000000 END AS BIGINT) AS amount_sek"""))
def _(s, d):
    return project_text(s, d, amount_sek=records.parse_sek(F.col("text")))


@query("progress_to_maturity", _TEXT.format("""CASE WHEN l_tax > 0.03 AND l_quantity * 2 < 10 THEN 'planned' WHEN l_tax > 0.03 AND l_quantity * 2 <= 90 THEN 'tender'
      WHEN l_tax > 0.03 THEN 'awarded' ELSE CASE l_orderkey % 6 WHEN 0 THEN 'tender' WHEN 1 THEN 'planned' WHEN 2 THEN 'awarded' WHEN 3 THEN 'tender' WHEN 4 THEN 'awarded' END END AS maturity"""))
def _(s, d):
    return project_text(s, d, maturity=records.progress_to_maturity(F.col("done_pct"), F.col("text")))


@query("place_to_county", _TEXT.format("""CASE l_suppkey % 7 WHEN 0 THEN 'Stockholms län' WHEN 1 THEN 'Skåne län' WHEN 2 THEN 'Kiruna län' WHEN 3 THEN 'Västra Götalands län'
      WHEN 4 THEN 'Västerbottens län' WHEN 5 THEN 'Ort ' || l_partkey || ' län' END AS county"""))
def _(s, d):
    return project_text(s, d, county=records.place_to_county(F.col("place")))


@query("skip_news", """
    SELECT page_id, title FROM d_news WHERE regexp_matches(title, '(?i)\\bbygger\\b') OR NOT regexp_matches(title, '(?i)(hyr ut|\\bQ[1-4]\\b|sponsr)')""")
def _(s, d):
    return shaping.skip_news(frame(s, d, "d_news")).select("page_id", "title")


@query("excerpt_rules", """
    SELECT doc_id, excerpt, CASE WHEN length(excerpt) > 300 THEN source END AS summary FROM (SELECT doc_id, source, CASE WHEN length(text) <= 10000 THEN nullif(text, '')
      ELSE coalesce(nullif(regexp_extract(substring(text, 1, 10000), '^([\\s\\S]*[.!?])', 1), ''), substring(text, 1, 10000)) END AS excerpt FROM documents)""")
def _(s, d):
    docs = table(s, d, "documents").select("doc_id", "source", records.excerpt(F.col("text")).alias("excerpt"))
    return docs.select("doc_id", "excerpt", records.summary_allowed(F.col("excerpt"), F.col("source")).alias("summary"))


@query("usage_cost", """
    SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(CASE model WHEN 'claude-opus-4-7' THEN tokens_in * 0.000005 + tokens_out * 0.000025
      WHEN 'claude-sonnet-4-6' THEN tokens_in * 0.000003 + tokens_out * 0.000015 ELSE tokens_in * 0.0000008 + tokens_out * 0.000004 END AS DOUBLE), 6) AS cost_usd FROM d_usage""")
def _(s, d):
    u = frame(s, d, "d_usage")
    cost = records.usage_cost(F.col("model"), F.col("tokens_in"), F.col("tokens_out"))
    return u.select("l_orderkey", "l_linenumber", "l_partkey", F.round(cost.cast("double"), 6).alias("cost_usd"))


@query("date_part", "SELECT number, substring(publication_date, 1, 10) AS day FROM d_tenders")
def _(s, d):
    return frame(s, d, "d_tenders").select("number", records.date_part(F.col("publication_date")).cast("string").alias("day"))


# Tenders

_AMOUNT = "CAST(floor(CAST(value AS DOUBLE) * CASE WHEN coalesce(currency, 'SEK') = 'SEK' THEN 1.0 ELSE 11.5 END + 0.5) AS BIGINT)"
_NUTS_IN = extract(
    r"""regexp_extract(place, '(?i)"(nuts|code|nutscode|nuts-code|value)"\s*:\s*"SE[^"]*"|:\s*"SE[0-9]{3}"|[\[,]\s*"SE[^"]*"\s*[,\]]')""",
    '(?i)"(SE[^"]*)"' + chr(92) + 's*[,' + chr(92) + ']]?$')
_NUTS_BARE = extract("place", "(?i)^" + chr(92) + 's*"?(SE[^"' + chr(92) + '[{]*?)"?' + chr(92) + "s*$")
# Fields that name the region of an object come first, wherever they stand.
_NUTS_NAMED = "CASE WHEN starts_with(place, '{') THEN coalesce(" + ", ".join(
    f"CASE WHEN starts_with(upper(json_extract_string(place, '$.\"{f}\"')), 'SE') THEN json_extract_string(place, '$.\"{f}\"') END"
    for f in ("nuts", "code", "nutsCode", "nuts-code", "value")) + ") END"
_NUTS = f"upper(CASE WHEN regexp_matches(place, '^{chr(92)}s*[{chr(92)}[{{]') THEN coalesce({_NUTS_NAMED}, {_NUTS_IN}) ELSE {_NUTS_BARE} END)"
_COUNTY = _mapped(_NUTS, config.NUTS_COUNTY)
_BODY = "coalesce(nullif(body_swe, ''), nullif(body_eng, ''), '')"
_CATEGORY = f"""CASE WHEN cpv LIKE '45%' THEN CASE WHEN regexp_matches(lower({_BODY}), 'bost[aä]d|l[aä]genhet|student') THEN 'residential'
      WHEN regexp_matches(lower({_BODY}), 'skol|sjukhus|kultur|idrot|universite|campus') THEN 'public'
      WHEN regexp_matches(lower({_BODY}), 'v[aä]g|bro|tunnel|va-|vatten|avlopp') THEN 'infrastructure' ELSE 'commercial' END ELSE 'commercial' END"""


@query("pick_language_text", "SELECT number, substring(coalesce(nullif(title_swe, ''), nullif(title_eng, ''), '(okänd titel)'), 1, 80) AS title FROM d_tenders")
def _(s, d):
    return tenders(s, d).select("number", records.pick_language(F.col("title"), 80, "(okänd titel)").alias("title"))


@query("convert_amount", f"SELECT number, {_AMOUNT} AS amount_sek FROM d_tenders")
def _(s, d):
    return tenders(s, d).select("number", records.convert_amount(F.col("value"), F.col("currency")).alias("amount_sek"))


@query("map_category", f"SELECT number, {_CATEGORY} AS category FROM d_tenders")
def _(s, d):
    t = frame(s, d, "d_tenders")
    body = F.coalesce(F.nullif("body_swe", F.lit("")), F.nullif("body_eng", F.lit("")), F.lit(""))
    codes = F.when(F.col("cpv").isNotNull(), F.array("cpv"))
    return t.select("number", records.map_category(codes, body).alias("category"))


@query("nuts_region", f"SELECT number, {_NUTS} AS nuts_code, {_COUNTY} AS county FROM d_tenders")
def _(s, d):
    code = frame(s, d, "d_tenders").select("number", records.nuts_code(F.col("place")).alias("nuts_code"))
    return code.withColumn("county", records.nuts_county(F.col("nuts_code")))


_LINE_AMOUNT = f"replace(format('{{:,}}', {_AMOUNT}), ',', chr(160))"


@query("procurement_signals", f"""
    SELECT organization_id, s_name AS organization_name, substring(coalesce(nullif(title_swe, ''), nullif(title_eng, ''), '(okänd titel)'), 1, 80) AS title, coalesce(nullif(title_swe, ''), nullif(title_eng, '')) AS full_title, 'tender' AS maturity,
      {_AMOUNT} AS amount_sek, 'Anbudsfrist: ' || substring(deadline, 1, 10) AS timeline, nullif(substring({_BODY}, 1, 200), '') AS description, nullif({_BODY}, '') AS full_description, {q(TED)} || number AS source_url,
      substring(publication_date, 1, 10) AS source_date, {_COUNTY} AS region, {_CATEGORY} AS category, 'ted' AS source_type, number AS reference, {_NUTS} AS nuts_code,
      nullif(concat_ws(chr(10) || chr(10), 'Titel: ' || coalesce(nullif(title_swe, ''), nullif(title_eng, '')), nullif({_BODY}, ''), 'CPV: ' || cpv,
        CASE WHEN {_AMOUNT} <> 0 THEN 'Uppskattat varde: ' || {_LINE_AMOUNT} || ' SEK' END, 'Anbudsfrist: ' || substring(deadline, 1, 10), 'NUTS: ' || {_NUTS}), '') AS source_excerpt
    FROM d_tenders JOIN supplier ON s_suppkey = organization_id WHERE cpv IS NULL OR substring(cpv, 1, 2) IN ('45', '71', '44')""")
def _(s, d):
    orgs = table(s, d, "supplier").select(F.col("s_suppkey").alias("organization_id"), F.col("s_name").alias("name"))
    return cross_match.tender_signals(orgs, tenders(s, d), TED).withColumn("source_date", F.col("source_date").cast("string"))


# Permits and properties

_MATCH = f"""mt AS (SELECT p.*, r.organization_id, r.property_designation FROM d_permits p JOIN d_properties r
      ON {normal_place('p.municipality')} = {normal_place('r.municipality')} AND contains(lower(p.address), lower(r.property_designation)))"""


def matches(s, d):
    return matching.match_properties(frame(s, d, "d_permits"), frame(s, d, "d_properties"))


@query("match_properties_rarest", f"WITH {_MATCH} SELECT id, organization_id, property_designation FROM mt")
def _(s, d):
    found = matching.match_properties(frame(s, d, "d_permits"), frame(s, d, "d_properties"), rarest=True)
    return found.select("id", "organization_id", "property_designation")


_ALIKE = " norra hamnens industriområde, etapp två"


@query("match_alike_endings", f"""
    WITH r AS (SELECT organization_id, substring(property_designation, 9) || '{_ALIKE}' AS property_designation, municipality FROM d_properties),
    p AS (SELECT id, municipality, replace(address, ', hus 2', '{_ALIKE.upper()}, hus 2') AS address FROM d_permits)
    SELECT id, organization_id, property_designation FROM p JOIN r
      ON {normal_place('p.municipality')} = {normal_place('r.municipality')} AND contains(lower(p.address), lower(r.property_designation))""")
def _(s, d):
    """Designations that differ in their first letters only, and all end in more letters than a piece has."""
    r = frame(s, d, "d_properties").withColumn("property_designation", F.concat(F.substring("property_designation", 9, 99), F.lit(_ALIKE)))
    p = frame(s, d, "d_permits").withColumn("address", F.replace("address", F.lit(", hus 2"), F.lit(_ALIKE.upper() + ", hus 2")))
    return matching.match_properties(p, r, rarest=True).select("id", "organization_id", "property_designation")


@query("match_properties", f"WITH {_MATCH} SELECT id, organization_id, property_designation FROM mt")
def _(s, d):
    return matches(s, d).select("id", "organization_id", "property_designation")


_STAGE = "CASE lower(trim(status)) WHEN 'ansökt' THEN 'rumor' WHEN 'beviljat' THEN 'planned' END"


@query("status_to_maturity", f"SELECT id, {_STAGE} AS maturity FROM d_permits")
def _(s, d):
    return frame(s, d, "d_permits").select("id", records.status_to_maturity(F.col("status")).alias("maturity"))


@query("permit_signals", f"""
    WITH {_MATCH} SELECT mt.organization_id, c_name AS organization_name,
      upper(substring(coalesce(nullif(permit_type, ''), 'okänt'), 1, 1)) || substring(coalesce(nullif(permit_type, ''), 'okänt'), 2) || ' — ' || property_designation || coalesce(' (' || case_number || ')', '') AS title,
      {_STAGE} AS maturity, substring(description, 1, 200) AS description, coalesce(source_url, 'permit://' || id) AS source_url, date AS source_date, lan AS region, 'permit' AS source_type, property_designation,
      concat_ws(chr(10), 'Bygglov: ' || coalesce(nullif(permit_type, ''), 'okand typ'), 'Diarienummer: ' || case_number, 'Status: ' || status, 'Adress: ' || address, 'Kommun: ' || municipality,
        'Datum: ' || date, chr(10) || description) AS source_excerpt
    FROM mt LEFT JOIN customer ON c_custkey = mt.organization_id WHERE coalesce(lower(trim(status)), '') <> 'avslag'""")
def _(s, d):
    orgs = table(s, d, "customer").select(F.col("c_custkey").alias("organization_id"), F.col("c_name").alias("name"))
    return cross_match.property_signals(frame(s, d, "d_permits"), frame(s, d, "d_properties"), orgs)


@query("match_summary", f"""
    WITH {_MATCH} SELECT count(*) AS matched, count(*) FILTER (WHERE coalesce(lower(trim(status)), '') <> 'avslag') AS upserted,
      count(*) FILTER (WHERE lower(trim(status)) = 'avslag') AS skipped FROM mt""")
def _(s, d):
    return matching.match_summary(matches(s, d))


@query("property_from_title", "SELECT signal_id, substring(title, 11) AS designation FROM d_signals")
def _(s, d):
    return frame(s, d, "d_signals").select("signal_id", records.property_from_title(F.col("title")).alias("designation"))


@query("assign_exact_project", """
    SELECT signal_id, (SELECT min(p.project_id) FROM d_projects p WHERE p.organization_id IS NOT DISTINCT FROM s.organization_id
      AND p.property_designation = s.property_designation) AS matched_project FROM d_signals s""")
def _(s, d):
    return matching.assign_exact_project(frame(s, d, "d_signals"), frame(s, d, "d_projects")).select("signal_id", "matched_project")


_GROUPED = """pr AS (SELECT s.*, p.project_id AS m, row_number() OVER (PARTITION BY s.organization_id, s.property_designation ORDER BY arrival) AS n,
      first_value(title) OVER (PARTITION BY s.organization_id, s.property_designation ORDER BY arrival) AS first_title FROM d_signals s LEFT JOIN d_projects p
      ON p.organization_id IS NOT DISTINCT FROM s.organization_id AND p.property_designation = s.property_designation WHERE s.project_id IS NULL AND source_type = 'permit' AND s.property_designation IS NOT NULL),
    gp AS (SELECT signal_id, CASE WHEN m IS NULL AND n = 1 THEN 'new_project' ELSE 'grouped' END AS action, m AS project_id, CASE WHEN m IS NULL THEN first_title END AS new_project_title,
      property_designation, organization_id FROM pr),
    own AS (SELECT DISTINCT organization_id FROM (SELECT organization_id FROM d_projects UNION ALL SELECT organization_id FROM gp)),
    ot AS (SELECT s.*, EXISTS (SELECT 1 FROM own WHERE own.organization_id IS NOT DISTINCT FROM s.organization_id) AS owned, row_number() OVER (PARTITION BY organization_id ORDER BY arrival) AS n
      FROM d_signals s WHERE project_id IS NULL AND coalesce(source_type, '') <> 'permit'),
    g AS (SELECT signal_id, action, project_id, new_project_title, property_designation FROM gp UNION ALL
      SELECT signal_id, CASE WHEN NOT owned AND n = 1 THEN 'new_project' ELSE 'needs_review' END, NULL, CASE WHEN NOT owned AND n = 1 THEN substring(title, 1, 80) END, NULL FROM ot
      UNION ALL SELECT signal_id, 'needs_review', NULL, NULL, NULL FROM d_signals WHERE project_id IS NULL AND source_type = 'permit' AND property_designation IS NULL)"""


def grouped(s, d):
    return matching.group_signals(frame(s, d, "d_signals"), frame(s, d, "d_projects"))


@query("group_signals", f"WITH {_GROUPED} SELECT * FROM g")
def _(s, d):
    return grouped(s, d).select("signal_id", "action", "project_id", "new_project_title", "property_designation")


@query("grouping_summary", f"""
    WITH {_GROUPED} SELECT count(*) AS signals, count(*) FILTER (WHERE action = 'grouped') AS grouped, count(*) FILTER (WHERE action = 'new_project') AS new_project,
      count(*) FILTER (WHERE action = 'needs_review') AS needs_review FROM g""")
def _(s, d):
    return matching.grouping_summary(grouped(s, d))


def report(s, d):
    titled = grouped(s, d).where(F.col("new_project_title").isNotNull()).withColumnRenamed("new_project_title", "project_title")
    return matching.project_groups(titled).select("project_title", "signal_id", "action", "signals")


_REPORT = f"""WITH {_GROUPED} SELECT new_project_title AS project_title, signal_id, action, count(*) OVER (PARTITION BY new_project_title) AS signals
      FROM g WHERE new_project_title IS NOT NULL"""
query("project_groups", _REPORT)(report)


@query("write_report", _REPORT)
def _(s, d):
    """The report as JSON lines in the shared folder, read back."""
    path = f"{shared_folder(s)}/report-{uuid.uuid4().hex}"
    rows = report(s, d)
    loading.write_report(rows, path)
    return s.read.schema(rows.schema).json(path)


# Discovery

@query("score_links", f"""
    WITH {LINKS}, sc AS (SELECT page_id, pos, href, list_filter({word_list(PAGE_TERMS)}, lambda t: contains(lower(text), t) OR contains(lower(href), t)) AS m FROM links)
    SELECT page_id, pos, href, array_to_string(m, ',') AS terms, len(m) AS hits FROM sc WHERE len(m) > 0""")
def _(s, d):
    return discovery.score_links(links(s, d), PAGE_TERMS).select("page_id", "pos", "href", F.array_join("matched_terms", ",").alias("terms"), "hits")


@query("score_sitemap_urls", f"""
    SELECT page_id, url, array_to_string(m, ',') AS terms, len(m) AS hits FROM (SELECT page_id, url, list_filter(['/en/', 'blog', 'Page', 'html'], lambda t: contains(lower(url), lower(t))) AS m FROM pages) WHERE len(m) > 0""")
def _(s, d):
    return discovery.score_sitemap_urls(table(s, d, "pages"), ("/en/", "blog", "Page", "html")).select(
        "page_id", "url", F.array_join("matched_terms", ",").alias("terms"), "hits")


_PAGE_WORDS = ("pills", "Casino", "queou", "thereou", "schla")


@query("score_page_terms", f"""
    SELECT page_id, array_to_string(m, ',') AS terms, len(m) AS hits FROM (SELECT page_id, list_filter({word_list(_PAGE_WORDS)}, lambda t: contains(lower(html), lower(t))) AS m FROM pages)""")
def _(s, d):
    return discovery.score_page_terms(table(s, d, "pages"), _PAGE_WORDS).select("page_id", F.array_join("matched_terms", ",").alias("terms"), "hits")


_SCORED = f"""{LINKS}, sc AS (SELECT url AS source, page_id, pos, href, len(list_filter({word_list(PAGE_TERMS)}, lambda t: contains(lower(text), t) OR contains(lower(href), t))) AS hits FROM links)"""


def scored(s, d):
    return discovery.score_links(links(s, d), PAGE_TERMS)


@query("best_candidate", f"""
    WITH {_SCORED} SELECT page_id, pos, href, hits FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY (hits >= 2) DESC, CASE WHEN hits >= 2 THEN 0 ELSE hits END DESC, pos) AS r
      FROM sc WHERE hits > 0) WHERE r = 1""")
def _(s, d):
    return discovery.best_candidate(scored(s, d), "page_id", "pos").select("page_id", "pos", "href", "hits")


@query("top_alternatives", f"""
    WITH {_SCORED} SELECT page_id, href, hits, rank FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY hits DESC, pos) AS rank FROM sc WHERE hits > 0) WHERE rank BETWEEN 2 AND 4""")
def _(s, d):
    return discovery.top_alternatives(scored(s, d), "page_id").select("page_id", "href", "hits", "rank")


@query("match_confidence", f"""
    WITH {_SCORED} SELECT page_id, pos, CASE WHEN hits >= 2 THEN 'high' WHEN hits >= 1 THEN 'medium' ELSE 'low' END AS confidence FROM sc""")
def _(s, d):
    found = links(s, d).withColumn("hits", F.size(html.link_terms(F.col("text"), F.col("href"), PAGE_TERMS)))
    return found.select("page_id", "pos", html.match_confidence(F.col("hits")).alias("confidence"))


@query("discovery_ladder", f"""
    WITH {_SCORED}, u AS (SELECT page_id, url, 2 AS hits, 0 AS step FROM pages WHERE url LIKE '%blog%'
      UNION ALL SELECT page_id, href, hits, 1 FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY hits DESC, pos) AS r FROM sc WHERE hits >= 2) WHERE r = 1
      UNION ALL SELECT page_id, url || '/sitemap', 1, 2 FROM pages)
    SELECT page_id, url, hits, CASE step WHEN 0 THEN 'url_variants' WHEN 1 THEN 'crawl_homepage' ELSE 'sitemap' END AS method, CASE WHEN hits >= 2 THEN 'high' ELSE 'medium' END AS confidence
    FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY step) AS r FROM u) WHERE r = 1""")
def _(s, d):
    p = table(s, d, "pages")
    variants = p.where(F.contains("url", F.lit("blog"))).select("page_id", "url", F.lit(2).alias("hits"))
    crawl = discovery.best_link(scored(s, d).where(F.col("hits") >= 2), "page_id").select("page_id", F.col("href").alias("url"), "hits")
    sitemap = p.select("page_id", F.concat("url", F.lit("/sitemap")).alias("url"), F.lit(1).alias("hits"))
    return discovery.discovery_ladder("page_id", variants, crawl, sitemap)


_TEMPLATES = {"BUILDING": ("/anslag", "/kungorelser"), "MACHINERY": ("/wp/anslag",)}
_PATTERNS = ("/anslagstavla", "/kungorelser")
_CANDIDATES = """c AS (SELECT place_id, homepage, CASE county WHEN 'BUILDING' THEN ['/anslag', '/kungorelser', '/anslagstavla'] WHEN 'MACHINERY' THEN ['/wp/anslag', '/anslagstavla', '/kungorelser']
      ELSE ['/anslagstavla', '/kungorelser'] END AS l FROM d_places WHERE homepage IS NOT NULL)"""


@query("candidate_union", f"""
    WITH {_CANDIDATES} SELECT place_id, i AS position, homepage || l[i + 1] AS candidate_url FROM c, range(3) AS t(i) WHERE i < len(l)""")
def _(s, d):
    p = frame(s, d, "d_places").withColumn("homepage", F.concat("homepage", F.lit("/start?x=1")))
    return discovery.candidate_union(p, "homepage", "county", _PATTERNS, _TEMPLATES).select("place_id", "position", "candidate_url")


@query("build_candidate_urls", f"WITH {_CANDIDATES} SELECT place_id, array_to_string(list_transform(l, lambda x: homepage || x), ' ') AS candidates FROM c UNION ALL SELECT place_id, '' FROM d_places WHERE homepage IS NULL")
def _(s, d):
    found = urls.candidates(F.col("homepage"), F.col("county"), _PATTERNS, _TEMPLATES)
    return frame(s, d, "d_places").select("place_id", F.array_join(found, " ").alias("candidates"))


@query("platform_distribution", """
    SELECT platform, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM pages), 1) AS pct FROM (SELECT CASE WHEN url LIKE '%//m.%' THEN 'mobile' WHEN url LIKE '%//blog.%' THEN 'blog'
      WHEN url LIKE '%//www.%' THEN 'site' ELSE 'unknown' END AS platform FROM pages) GROUP BY 1""")
def _(s, d):
    signs = {"mobile": ("//m.",), "blog": ("//blog.",), "site": ("//www.",)}
    return discovery.platform_distribution(table(s, d, "pages").select(html.detect_platform(F.col("url"), signs).alias("platform")))


_VERIFIED = """v AS (SELECT *, records > 0 AS verified, records <= 0 AND has_keyword AS browser FROM d_results),
    w AS (SELECT event_id, cost_usd, verified, browser AS needs_browser, verified OR browser AS approved, CASE WHEN verified THEN 'verified' WHEN browser THEN 'needs_browser'
      WHEN error LIKE 'HTTP %' THEN 'http_error' ELSE 'failed' END AS status FROM v)"""


def verified(s, d):
    r = frame(s, d, "d_results").drop("status", "needs_browser").withColumnRenamed("records", "result_count")
    return discovery.verification_decision(r, approve_browser=True).select("event_id", "cost_usd", "verified", "needs_browser", "approved", "status")


@query("verification_decision", f"WITH {_VERIFIED} SELECT event_id, verified, needs_browser, approved, status FROM w")
def _(s, d):
    return verified(s, d).drop("cost_usd")


@query("verification_summary", f"WITH {_VERIFIED} SELECT status, count(*) AS sources, CAST(sum(cost_usd) AS DOUBLE) AS cost_usd FROM w GROUP BY 1")
def _(s, d):
    return quality.outcome_summary(verified(s, d)).withColumn("cost_usd", F.col("cost_usd").cast("double"))


_REDISC = """rd AS (SELECT *, new_url IS NULL AS nothing, new_url = previous_url AS same, new_url <> previous_url AND verified AND verify_result_count > 0 AS ok,
      coalesce(stale_rediscovery_count, 0) AS k FROM d_rediscovered),
    dec AS (SELECT *, coalesce(ok, false) AS success, CASE WHEN same THEN k + 1 WHEN ok THEN 0 ELSE k END AS new_stale_count, coalesce(same AND k + 1 >= 3, false) AS manual_review,
      CASE WHEN nothing THEN 'discovery found no URL' WHEN same THEN 'same URL found, skipping' WHEN NOT ok THEN 'verification failed' END AS error FROM rd)"""


def rediscovered(s, d):
    return discovery.rediscovery_decision(frame(s, d, "d_rediscovered"))


@query("rediscovery_decision", f"WITH {_REDISC} SELECT source, success, new_stale_count, manual_review, error FROM dec")
def _(s, d):
    return rediscovered(s, d).select("source", "success", "new_stale_count", "manual_review", "error")


@query("append_rediscovery_log", f"""
    WITH {_REDISC} SELECT source, 'zero_streak' AS triggered_by, previous_url, new_url, method, verified, verify_result_count, CAST(cost_usd AS DOUBLE) AS cost_usd, success, error FROM dec""")
def _(s, d):
    return loading.rediscovery_log(rediscovered(s, d), "zero_streak").withColumn("cost_usd", F.col("cost_usd").cast("double"))


@query("homepage_name_check", """
    SELECT page_id, len(list_filter(string_split_regex(lower(name), '[\\s-]+'), lambda p: length(p) >= 3 AND contains(lower(html), p))) > 0 AS name_found
    FROM (SELECT page_id, html, regexp_extract(url, '//(?:m\\.|www\\.|blog\\.)?([a-z-]+)', 1) || '-Xy le' AS name FROM pages)""")
def _(s, d):
    name = F.concat(F.regexp_extract("url", r"//(?:m\.|www\.|blog\.)?([a-z-]+)", 1), F.lit("-Xy le"))
    p = table(s, d, "pages").select("page_id", "html", name.alias("name"))
    return discovery.homepage_name_check(p, "name", "html").select("page_id", "name_found")


@query("zero_result_escalation", "SELECT event_id, CASE WHEN records = 0 AND NOT needs_browser THEN 'escalated' ELSE 'ok' END AS status FROM d_results")
def _(s, d):
    return discovery.zero_result_escalation(frame(s, d, "d_results")).select("event_id", "status")


# Curation

@query("normalize_url", f"SELECT page_id, {normal_url('url')} AS normal FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", urls.normalize(F.col("url")).alias("normal"))


@query("loose_normalize_url", f"SELECT page_id, {loose_url('new_url')} AS normal FROM d_seeds")
def _(s, d):
    return frame(s, d, "d_seeds").select("page_id", urls.normalize_loosely(F.col("new_url")).alias("normal"))


@query("classify_url_change", f"""
    SELECT page_id, CASE WHEN {normal_url('old_url')} = {normal_url('new_url')} OR {loose_url('old_url')} = {loose_url('new_url')} THEN 'minor_diff' ELSE 'upgrade' END AS category FROM d_seeds""")
def _(s, d):
    return frame(s, d, "d_seeds").select("page_id", urls.classify_change(F.col("old_url"), F.col("new_url")).alias("category"))


_PLAN = f"""pl AS (SELECT s.page_id, s.name, v.verified AS was_verified, CASE WHEN v.page_id IS NULL THEN 'created' WHEN {normal_url('v.old_url')} = {normal_url('s.new_url')} THEN 'skipped'
      WHEN {loose_url('v.old_url')} = {loose_url('s.new_url')} THEN 'minor_diff' ELSE 'upgrade' END AS category FROM d_seeds s LEFT JOIN d_seeds v ON v.page_id = s.page_id AND v.old_url NOT LIKE '%spam%')"""


def url_plan(s, d):
    seeds = frame(s, d, "d_seeds")
    sources = seeds.where(~F.contains("old_url", F.lit("spam"))).select(
        F.concat("name", F.lit("s kommun")).alias("source"), F.col("old_url").alias("listing_url"), "verified", "approved")
    return curation.plan_url_changes(seeds.select("page_id", "name", "new_url"), sources)


@query("plan_url_changes", f"WITH {_PLAN} SELECT page_id, was_verified, category FROM pl")
def _(s, d):
    return url_plan(s, d).select("page_id", "was_verified", "category")


@query("seed_plan_summary", f"WITH {_PLAN} SELECT category, count(*) AS urls, count(*) FILTER (WHERE was_verified) AS verified FROM pl GROUP BY 1")
def _(s, d):
    return curation.seed_plan_summary(url_plan(s, d))


@query("split_verified", f"WITH {_PLAN} SELECT page_id, CASE WHEN was_verified THEN 'review' ELSE 'apply' END AS part FROM pl WHERE category = 'upgrade'")
def _(s, d):
    apply, review = shaping.split_verified(url_plan(s, d).where(F.col("category") == "upgrade"))
    return apply.select("page_id", F.lit("apply").alias("part")).union(review.select("page_id", F.lit("review").alias("part")))


_LETTERS = f"k AS (SELECT id, name, approved, {letters('name')} AS letters FROM (SELECT p_partkey AS id, p_size > 25 AS approved, CASE WHEN p_type = 'SMALL' THEN 'åR' || p_name ELSE 'Ar' || p_name END AS name FROM part))"


def part_names(s, d):
    p = table(s, d, "part")
    prefix = F.when(F.col("p_type") == "SMALL", "åR").otherwise("Ar")
    return p.select(F.col("p_partkey").alias("id"), F.concat(prefix, F.col("p_name")).alias("name"), (F.col("p_size") > 25).alias("approved"))


@query("duplicate_groups", f"WITH {_LETTERS}, g AS (SELECT letters, count(*) AS members FROM k GROUP BY 1 HAVING count(*) > 1) SELECT letters, id, name, approved, members FROM k JOIN g USING (letters)")
def _(s, d):
    return curation.duplicate_groups(part_names(s, d)).select("letters", "id", "name", "approved", "members")


_DUP = f"""{_LETTERS}, ref AS (SELECT DISTINCT 'Ar' || p_name AS name FROM part), u AS (SELECT min(id) AS id, name, bool_or(approved) AS approved, letters FROM k GROUP BY name, letters),
    x AS (SELECT u.*, ref.name IS NOT NULL AS is_ref FROM u LEFT JOIN ref USING (name)),
    pl AS (SELECT letters, count(*) AS m, count(*) FILTER (WHERE is_ref) AS r, min((name, id)) FILTER (WHERE is_ref) AS c, min((name, id)) FILTER (WHERE approved) AS a, min((name, id)) AS f FROM x GROUP BY 1),
    del AS (SELECT x.id, x.name FROM x JOIN pl USING (letters) WHERE m > 1 AND r <= 1 AND x.name <> coalesce(c, a, f)[1]),
    ren AS (SELECT x.id, x.name, min(ref.name) AS new_name FROM x JOIN ref ON {letters('ref.name')} = x.letters
      WHERE regexp_matches(x.name, '[a-zåäö][A-ZÅÄÖ]') AND x.id NOT IN (SELECT id FROM del) AND ref.name <> x.name GROUP BY 1, 2)"""


def unique_names(s, d):
    return part_names(s, d).groupBy("name").agg(F.min("id").alias("id"), F.bool_or("approved").alias("approved")).select("id", "name", "approved")


def reference_names(s, d):
    p = table(s, d, "part")
    return p.select(F.concat(F.lit("Ar"), "p_name").alias("name")).distinct()


@query("plan_duplicate_fix", f"WITH {_DUP} SELECT id, name, 'delete' AS action, CAST(NULL AS VARCHAR) AS new_name FROM del UNION ALL SELECT id, name, 'rename', new_name FROM ren")
def _(s, d):
    return curation.plan_duplicate_fix(unique_names(s, d), reference_names(s, d))


_FIXED = f"WITH {_DUP} SELECT x.id, coalesce(ren.new_name, x.name) AS name, x.approved FROM x LEFT JOIN ren ON ren.id = x.id WHERE x.id NOT IN (SELECT id FROM del)"


@query("apply_fix_plan", _FIXED)
def _(s, d):
    configs, ref = unique_names(s, d), reference_names(s, d)
    deletions = curation.plan_duplicate_deletions(configs, ref)
    return loading.apply_fix_plan(configs, deletions, curation.plan_renames(configs, ref, deletions))


@query("apply_fix_plan_keyed", _FIXED)
def _(s, d):
    """The same plan on a stored table: buckets without a planned id stay as they are."""
    configs, ref = unique_names(s, d), reference_names(s, d)
    deletions = curation.plan_duplicate_deletions(configs, ref)
    stored = keyed_tables.create(configs, f"{shared_folder(s)}/configs-{uuid.uuid4().hex}", ["id"], 16)
    keyed_tables.apply_fix_plan(stored, deletions, curation.plan_renames(configs, ref, deletions))
    return stored.read()
