"""Operator inputs put together from the given tables, row for row.

Each text is read by both engines: ``{orders}`` names a given table and the few
words that differ are spelled in capitals (``SHA_HEX``, ``LIST_OF``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

_PLACE = "'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0')"

DERIVED = {
    "d_obs": """
        SELECT CAST(user_id AS STRING) || ':' || event_type AS source, ts, value, event_id, event_type
        FROM {events}""",
    "d_visits": """
        SELECT o_custkey AS source, o_orderdate AS ts FROM {orders}""",
    "d_records": f"""
        SELECT o_orderkey AS arrival, {_PLACE} AS place,
          CASE WHEN o_orderstatus = 'F' THEN {_PLACE} || 's kommun'
               WHEN o_orderstatus = 'O' THEN upper({_PLACE}) || ' STAD'
               WHEN o_orderpriority = '5-LOW' THEN 'Okänd ' || {_PLACE}
               ELSE {_PLACE} END AS municipality,
          CASE WHEN o_orderpriority <> '5-LOW'
               THEN 'BN ' || CAST(year(o_orderdate) AS STRING) || '/' || CAST(o_custkey AS STRING) END AS case_number,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
               ELSE 'Storgatan ' || CAST(o_custkey AS STRING) END AS address,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'bygglov' WHEN '2-HIGH' THEN 'rivningslov'
               WHEN '3-MEDIUM' THEN 'forhandsbesked' WHEN '4-NOT SPECIFIED' THEN 'anmälan' END AS permit_type,
          CASE o_orderstatus WHEN 'F' THEN 'beviljat' WHEN 'O' THEN 'ansökt' ELSE 'avslag' END AS status,
          CAST(CAST(o_orderdate AS DATE) AS STRING) AS date, o_orderdate AS created_at,
          CAST(floor(o_totalprice) AS BIGINT) AS amount_sek,
          'Ärende ' || CAST(o_orderkey AS STRING) AS description,
          CASE WHEN o_orderpriority <> '3-MEDIUM'
               THEN 'https://notice.example/' || CAST(o_custkey AS STRING) END AS source_url,
          CASE WHEN year(o_orderdate) >= 1997
               THEN substring(SHA_HEX(CAST(o_custkey AS STRING)), 1, 16) END AS page_hash
        FROM {{orders}}""",
    "d_places": """
        SELECT c_custkey AS place_id, c_name AS name, c_mktsegment AS county,
          CASE WHEN c_mktsegment <> 'HOUSEHOLD'
               THEN 'https://www.' || lower(replace(c_name, '#', '')) || '.example' END AS homepage
        FROM {customer}""",
    "d_configs": """
        SELECT c_custkey AS id, c_name AS municipality, c_mktsegment AS source_type,
          c_acctbal > 1000 AS approved,
          CASE WHEN c_nationkey > 2 THEN c_nationkey > 12 END AS verified,
          c_mktsegment = 'MACHINERY' AS row_browser,
          CASE WHEN c_nationkey > 20 THEN c_acctbal > 5000 END AS config_browser,
          CASE c_mktsegment
            WHEN 'BUILDING' THEN 'https://anslag.example/#!/billboard/' || CAST(c_custkey AS STRING)
            WHEN 'MACHINERY' THEN 'https://forum.sjostad.example/Digital-Bulletin-Board/' || CAST(c_custkey AS STRING)
            WHEN 'FURNITURE' THEN 'https://www.NetPublicator.com/bulletinboard/public/' || CAST(c_custkey AS STRING)
            WHEN 'HOUSEHOLD' THEN CASE WHEN c_acctbal > 2000 THEN 'https://kommun.example/a/' || CAST(c_custkey AS STRING) ELSE '' END
            ELSE 'https://ort.example/' || CAST(c_custkey AS STRING) END AS listing_url,
          CASE WHEN c_acctbal > 8000 THEN 4 WHEN c_acctbal > 6000 THEN 2 ELSE 0 END AS stale_rediscovery_count
        FROM {customer}""",
    "d_named": """
        SELECT c_custkey AS id,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'Åre ' || c_name WHEN 'MACHINERY' THEN 'Västra Gö-' || c_name || 's kommun'
            WHEN 'FURNITURE' THEN 'åRe ' || c_name WHEN 'HOUSEHOLD' THEN 'Linköpings  stad'
            ELSE upper(c_name) || ' kommun' END AS name, c_acctbal > 0 AS approved
        FROM {customer}""",
    "d_items": """
        SELECT p_partkey AS id, p_brand AS source,
          'https://' || lower(replace(p_brand, '#', '-')) || '.example/#!/billboard/' AS base_url,
          CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'LARGE') THEN 'BYGG' ELSE 'KS' END AS diary_name,
          CASE WHEN p_size < 10 THEN '' ELSE 'D ' || CAST(p_partkey AS STRING) END AS diarie,
          CASE p_type
            WHEN 'ECONOMY' THEN p_name || ' ' || CAST(p_size AS STRING) || ' - Bygglov för nybyggnad'
            WHEN 'SMALL' THEN p_name || ' - Protokoll'
            WHEN 'MEDIUM' THEN 'Yttrande över rivningslov fastigheten ' || p_name || ' ' || CAST(p_size AS STRING)
            WHEN 'LARGE' THEN p_name || ' - Anmälan om eldstad'
            WHEN 'PROMO' THEN p_name || ' ' || CAST(p_size AS STRING) || '-MARKLOV för schaktning'
            ELSE 'Sammanträde ' || p_name END AS title
        FROM {part}""",
    "d_announced": """
        SELECT 'S' || CAST(o_custkey AS STRING) AS source,
          'https://forum.s' || CAST(o_custkey AS STRING) || '.example/digital-bulletin-board' AS base_url,
          o_orderpriority AS type_id,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Beslut om Bygglov' WHEN '2-HIGH' THEN 'Ny lovansökning, ansökan'
            WHEN '3-MEDIUM' THEN 'Kungörelse lov' WHEN '4-NOT SPECIFIED' THEN 'Protokoll'
            ELSE 'Enligt plan- och bygglagen' END AS type_name,
          CAST(o_orderkey AS STRING) AS id,
          CAST(CAST(o_orderdate AS DATE) AS STRING) AS start_date,
          CASE o_orderstatus WHEN 'F' THEN 'Kungörelse: Bygglov inom fastigheten Ekbacken ' || CAST(o_custkey AS STRING) || ':4 m.fl.'
            WHEN 'O' THEN 'POSTILJONEN ' || CAST(o_custkey AS STRING)
            ELSE 'Anslag: Rivning av garage (Kvarngatan ' || CAST(o_custkey AS STRING) || ')' END AS title,
          CASE o_orderstatus
            WHEN 'F' THEN 'Diarienummer: BoM ' || CAST(o_orderkey AS STRING) || chr(10) || 'Sökande: Norrvik Bostäder AB'
            WHEN 'O' THEN 'Diarienr: B ' || CAST(o_orderkey AS STRING) || ', se karta (Storvägen ' || CAST(o_custkey AS STRING)
              || ')' || chr(10) || 'Sökande: Anna Svensson' END AS description,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'Marklov' END AS document_title
        FROM {orders}""",
    "d_noticed": """
        SELECT 'S' || CAST(o_custkey AS STRING) AS source, 'b-' || CAST(o_custkey AS STRING) AS board_id,
          CAST(o_orderkey AS STRING) AS id, 'c' || substring(o_orderpriority, 1, 1) AS category_id,
          CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE 'g-3' END AS type_key,
          CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 08:00' AS published,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Kungörelse om f&#246;rhandsbesked'
            WHEN '2-HIGH' THEN 'Grannhörande' ELSE 'Kallelse' END AS title,
          CASE o_orderstatus
            WHEN 'F' THEN 'EKBACKEN ' || CAST(o_custkey AS STRING) || ':4 (Storgatan 2) - nybyggnad av garage'
            WHEN 'O' THEN 'Till&#228;gg<br/> utan fastighet' ELSE '' END AS value,
          CASE o_orderstatus WHEN 'F' THEN 'Beskrivning' ELSE 'Information' END AS value_title,
          CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')
            THEN 'Diarienummer: BYGG 2026-' || CAST(o_orderkey AS STRING) || '.' END AS text,
          CASE WHEN o_orderpriority = '5-LOW' THEN 'Avslag' ELSE 'Bilaga' END AS attachment
        FROM {orders}""",
    "d_categories": """
        SELECT DISTINCT 'b-' || CAST(o_custkey AS STRING) AS board_id, 'c' || substring(o_orderpriority, 1, 1) AS id,
          CASE WHEN (o_custkey + CAST(substring(o_orderpriority, 1, 1) AS INT)) % 3 = 0 THEN 'Stadsbyggnadsnämnden' ELSE 'Kultur' END AS name
        FROM {orders}""",
    "d_types": """
        SELECT DISTINCT 'b-' || CAST(o_custkey AS STRING) AS board_id,
          CASE o_orderstatus WHEN 'F' THEN 'g-1' WHEN 'O' THEN 'g-2' ELSE 'g-3' END AS id,
          CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS type,
          CASE WHEN o_orderstatus = 'P' THEN 'Underrättelse' WHEN (o_orderstatus = 'F') = (o_custkey % 2 = 0) THEN 'Beslut om lov'
            ELSE 'Kallelse' END AS name
        FROM {orders}""",
    "d_tenders": """
        SELECT l_suppkey AS organization_id,
          CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS number,
          CASE WHEN l_returnflag = 'A' THEN 'Ombyggnad av skola, etapp ' || CAST(l_partkey AS STRING) END AS title_swe,
          CASE WHEN l_returnflag <> 'N' THEN 'School ' || CAST(l_partkey AS STRING) END AS title_eng,
          CASE WHEN l_linestatus = 'O' THEN 'Entreprenad för bostäder och väg ' || CAST(l_partkey AS STRING)
               WHEN l_returnflag = 'A' THEN 'Skolor och campus' ELSE '' END AS body_swe,
          CASE WHEN l_returnflag = 'R' THEN 'Bridge works' END AS body_eng,
          CAST(CAST(l_shipdate AS DATE) AS STRING) || '+01:00' AS publication_date,
          CASE WHEN l_tax > 0.01 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS value,
          CASE l_returnflag WHEN 'A' THEN 'SEK' WHEN 'R' THEN 'EUR' END AS currency,
          CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || 'Z' END AS deadline,
          CASE WHEN l_quantity <= 15 THEN '45210000' WHEN l_quantity <= 30 THEN '71000000'
               WHEN l_quantity <= 40 THEN '33100000' WHEN l_quantity <= 45 THEN '44110000' END AS cpv,
          CASE l_partkey % 9 WHEN 0 THEN '"se1' || CAST(l_partkey % 26 + 10 AS STRING) || '"'
               WHEN 1 THEN '[{{"country":"SWE"}},{{"nuts":"SE2' || CAST(l_partkey % 25 + 10 AS STRING) || '"}}]'
               WHEN 2 THEN '["NO01","SE' || CAST(l_partkey % 224 + 100 AS STRING) || '"]' WHEN 3 THEN '{{"a":{{"region":"SE999"}}}}'
               WHEN 4 THEN ' SE31' || CAST(l_partkey % 4 AS STRING) WHEN 5 THEN '{{"code" : "se33' || CAST(l_partkey % 3 AS STRING) || '","note":"SE110"}}'
               WHEN 6 THEN 'NO011' WHEN 7 THEN CASE WHEN l_partkey % 2 = 0 THEN '[]'
                 ELSE '{{"x":["SE23' || CAST(l_partkey % 3 AS STRING) || '"],"nuts":"SE11' || CAST(l_partkey % 5 AS STRING) || '"}}' END
               WHEN 8 THEN CASE WHEN l_partkey % 2 = 0 THEN
                 '{{"note":"SE312","place":{{"value":"SE22' || CAST(l_partkey % 5 AS STRING) || '"}},"nuts-code":"SE21' || CAST(l_partkey % 4 AS STRING) || '"}}' END
               END AS place
        FROM {lineitem}""",
    "d_seeds": """
        SELECT page_id, 'Ort ' || CAST(page_id AS STRING) AS name, url AS old_url,
          CASE WHEN url LIKE '%/en/%' THEN replace(replace(url, 'https://', 'https://www.'), 'https://www.www.', 'https://www.') || '/'
               WHEN url LIKE '%/fr/%' THEN url || '.1395' WHEN url LIKE '%/de/%' THEN url
               ELSE replace(url, '/es/', '/sv/') END AS new_url,
          url LIKE 'https%' AS verified, url LIKE '%www%' AS approved
        FROM {pages}""",
    "d_checks": """
        SELECT page_id, url, html AS body,
          CASE WHEN url LIKE '%spam%' THEN 404 WHEN url LIKE '%cheap%' THEN 410 WHEN url LIKE '%#top' THEN 0
               WHEN url LIKE '%.html' THEN 503 WHEN url LIKE 'http:%' THEN 301 ELSE 200 END AS status
        FROM {pages}""",
    "d_tasks": """
        SELECT CASE WHEN o_custkey % 20 > 0 THEN o_custkey END AS run,
          CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(substring(o_orderpriority, 1, 1) AS INT) END AS priority,
          CAST(o_orderdate AS DATE) AS created_on, o_orderdate AS created_at, o_orderkey AS id,
          CAST(o_totalprice AS DECIMAL(18,2)) AS max_cost, CAST(floor(o_totalprice / 2) AS DECIMAL(18,2)) AS cost,
          CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'completed' ELSE 'failed' END AS status
        FROM {orders}""",
    "d_results": """
        SELECT CAST(user_id AS STRING) || ':' || event_type AS source, event_id,
          CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'view' THEN 'unchanged'
            WHEN 'click' THEN 'escalated' ELSE 'ok' END AS status,
          CAST(floor(value / 20) AS BIGINT) AS records, CAST(floor(value / 40) AS BIGINT) AS inserted,
          CAST(floor(value / 20) AS BIGINT) - CAST(floor(value / 40) AS BIGINT) AS skipped,
          CAST(value AS DECIMAL(18,2)) AS cost_usd, event_type = 'click' AS needs_browser,
          CASE WHEN event_type = 'error' THEN 'HTTP 500' END AS error, event_type IN ('view', 'signup') AS has_keyword
        FROM {events}""",
    "d_signals": """
        SELECT o_orderkey AS signal_id, o_orderkey AS arrival,
          CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS organization_id,
          CASE WHEN o_orderstatus = 'F' THEN 'permit' WHEN o_orderpriority <> '2-HIGH' THEN 'ted' END AS source_type,
          'Bygglov — Haga ' || CAST(year(o_orderdate) AS STRING) || ':' || CAST(o_custkey AS STRING) AS title,
          CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '3-MEDIUM'
               THEN 'Haga ' || CAST(year(o_orderdate) AS STRING) || ':' || CAST(o_custkey AS STRING) END AS property_designation,
          CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN o_custkey END AS project_id
        FROM {orders}""",
    "d_projects": """
        SELECT c_custkey AS project_id,
          CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey ELSE c_custkey + 1000000000 END AS organization_id,
          'Haga 1996:' || CAST(c_custkey AS STRING) AS property_designation, c_name AS project_title
        FROM {customer}""",
    "d_properties": """
        SELECT c_custkey AS organization_id, 'Kvarnen ' || CAST(c_custkey AS STRING) || ':1' AS property_designation,
          CASE WHEN c_nationkey > 12 THEN 'Ort' || CAST(c_nationkey AS STRING) || 's kommun'
               ELSE 'ORT' || CAST(c_nationkey AS STRING) || ' Stad' END AS municipality
        FROM {customer}""",
    "d_permits": """
        SELECT o_orderkey AS id, 'Ort' || CAST(c_nationkey AS STRING) AS municipality, 'Lan ' || c_mktsegment AS lan,
          CASE WHEN o_orderstatus = 'P' THEN 'Storgatan 5' ELSE 'KVARNEN ' || CAST(o_custkey AS STRING) || ':1, hus 2' END AS address,
          CASE WHEN o_orderpriority <> '5-LOW' THEN 'BN ' || CAST(o_orderkey AS STRING) END AS case_number,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'bygglov' WHEN '2-HIGH' THEN '' ELSE 'anmälan' END AS permit_type,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Beviljat' WHEN '2-HIGH' THEN ' avslag' WHEN '3-MEDIUM' THEN 'ansökt' END AS status,
          CAST(CAST(o_orderdate AS DATE) AS STRING) AS date, CASE WHEN o_orderstatus = 'F' THEN 'Nybyggnad av villa' END AS description,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'https://p.example/' || CAST(o_orderkey AS STRING) END AS source_url,
          CAST(NULL AS STRING) AS applicant, CAST(NULL AS STRING) AS property
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "d_answers": """
        SELECT event_id, '```json' || chr(10) || '[' || props || CASE WHEN event_type = 'error' THEN '' ELSE ', {{"k": "x"}}]' END
          || chr(10) || '```' AS response FROM {events}""",
    "d_news": """
        SELECT page_id, CASE WHEN url LIKE 'https://www%' THEN 'Bolaget hyr ut 500 kvm i kvarteret'
            WHEN url LIKE '%blog%' THEN 'Bolaget bygger nytt kontor, hyr ut till bank' WHEN url LIKE '%.html' THEN 'Delårsrapport för Q3'
            WHEN url LIKE '%#top' THEN 'Nyheter från kvarteret' ELSE 'Bolaget sponsrar laget' END AS title, html
        FROM {pages}""",
    "d_projects_text": """
        SELECT l_orderkey, l_linenumber, l_partkey,
          'Investering ' || CAST(CAST(l_quantity AS INT) AS STRING) || CASE l_partkey % 7 WHEN 0 THEN ',5 mdr' WHEN 1 THEN ' mkr'
            WHEN 2 THEN ' 250 Mkr' WHEN 3 THEN ',25 miljoner' WHEN 4 THEN '.125,5 MILJARDER' WHEN 5 THEN ' mkrs' ELSE ' kvm' END
            || CASE l_suppkey % 4 WHEN 0 THEN ', fastighet Haga Norra ' WHEN 1 THEN ' i kvarteret Rud-Berg ' WHEN 2 THEN ', del av Lunda By ' ELSE ', nära haga ' END
            || CAST(l_linenumber AS STRING) || ':' || CAST(l_partkey AS STRING)
            || CASE l_orderkey % 6 WHEN 0 THEN ', Pågående' WHEN 1 THEN ', planerat' WHEN 2 THEN ', färdigställt' WHEN 3 THEN ', beslutat och pågående'
              WHEN 4 THEN ', slutredovisas' ELSE '' END AS text,
          CASE WHEN l_tax > 0.03 THEN l_quantity * 2 END AS done_pct,
          CASE l_suppkey % 7 WHEN 0 THEN 'Solna ' WHEN 1 THEN 'MALMÖ' WHEN 2 THEN 'Kiruna' WHEN 3 THEN ' göteborg' WHEN 4 THEN 'Umeå'
            WHEN 5 THEN 'Ort ' || CAST(l_partkey AS STRING) END AS place
        FROM {lineitem}""",
    "d_blocks": """
        SELECT o_orderkey AS page_id, '<h1>Anslag</h1><h3>Kungörelse - ' || CASE o_orderstatus WHEN 'F' THEN 'Beviljat bygglov'
            WHEN 'O' THEN 'Startbesked' ELSE 'Förhandsbesked' END || '</h3><p><strong>Diarienummer:</strong> BN 2026/' || CAST(o_orderkey AS STRING)
            || '</p><p>Fastighetsbeteckning: RUD 3:' || CAST(o_custkey AS STRING) || '</p><p>Åtgärd: '
            || CASE o_orderpriority WHEN '1-URGENT' THEN 'Installation av eldstad' WHEN '2-HIGH' THEN 'Rivning av garage' ELSE 'Tillbyggnad' END
            || CASE WHEN o_custkey % 3 = 0 THEN '</p><p>Gatuadress: Storgatan ' || CAST(o_custkey % 90 AS STRING) || ', Rud' ELSE '' END
            || '</p><p>Sökande: ' || CASE o_orderstatus WHEN 'F' THEN 'Rud Fastigheter AB' ELSE 'Eva Lund' END
            || '</p><p>Beslutsdatum: ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '</p>' AS html
        FROM {orders}""",
    "d_usage": """
        SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'claude-opus-4-7' WHEN 'R' THEN 'claude-sonnet-4-6' ELSE 'other' END AS model,
          CAST(floor(l_extendedprice) AS BIGINT) AS tokens_in, CAST(l_quantity AS BIGINT) AS tokens_out FROM {lineitem}""",
    "d_rediscovered": """
        SELECT c_name AS source, 'https://a.example/' || CAST(c_nationkey AS STRING) AS previous_url,
          CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'https://a.example/' || CAST(c_nationkey AS STRING)
            ELSE 'https://b.example/' || CAST(c_custkey AS STRING) END AS new_url, 'crawl_homepage' AS method,
          c_acctbal > 3000 AS verified, CASE WHEN c_acctbal > 3000 THEN CAST(c_nationkey AS INT) ELSE 0 END AS verify_result_count,
          CASE WHEN c_acctbal > 5000 THEN 2 WHEN c_acctbal > 0 THEN 1 END AS stale_rediscovery_count,
          CAST(c_acctbal AS DECIMAL(18,2)) AS cost_usd
        FROM {customer}""",
}

_DIALECT = {
    "spark": {"SHA_HEX": lambda arg: f"sha2({arg}, 256)"},
    "duckdb": {"SHA_HEX": lambda arg: f"sha256({arg})"},
}


def _spelled(text: str, engine: str) -> str:
    for word, write in _DIALECT[engine].items():
        text = re.sub(rf"{word}\((CAST\(\w+ AS STRING\))\)", lambda m: write(m.group(1)), text)
    return text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def frame(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table or one of the inputs derived from them."""
    if name in TABLES:
        return table(spark, folder, name)
    text = _spelled(DERIVED[name], "spark")
    used = {t: table(spark, folder, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def with_derived(sql: str) -> str:
    """SQL preceded by the derived inputs it mentions."""
    used = [n for n in DERIVED if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    plain = {t: t for t in TABLES}
    parts = [f"{n} AS ({_spelled(DERIVED[n], 'duckdb').format(**plain)})" for n in used]
    body = re.sub(r"^\s*WITH\s+", ", ", sql, count=1, flags=re.I) if re.match(r"^\s*WITH\b", sql, re.I) else " " + sql
    return "WITH " + ",\n".join(parts) + body
