"""Queries of the joins, loads and ordering operators."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from bindings.derived import frame, table
from bindings.registry import query
from bindings.sources import tenders
from bindings.sqltext import ascii_name, letters, normal_place, rx, sanitized, stripped_place
from noticeworks import config
from noticeworks.functions import records
from noticeworks.operators import archive, keyed_tables, loading, lookups, observed, ordering, shaping
from noticeworks.plans import cross_match, daily_run
from noticeworks.session import shared_folder


# Lookups

_ENRICHED = "SELECT r.arrival, r.place, p.county AS lan FROM d_records r LEFT JOIN d_places p ON r.municipality = p.name"


@query("enrich_lookup", _ENRICHED)
def _(s, d):
    return lookups.enrich_lookup(frame(s, d, "d_records"), frame(s, d, "d_places"), "municipality", "name", {"county": "lan"}).select(
        "arrival", "place", "lan")


@query("resolve_canonical_name", f"""
    SELECT arrival, coalesce(a.name, b.name, c.name, municipality) AS canonical FROM d_records r
    LEFT JOIN d_places a ON a.name = municipality LEFT JOIN d_places b ON b.name = {stripped_place('municipality')}
    LEFT JOIN (SELECT {normal_place('name')} AS n, max(name) AS name FROM d_places GROUP BY 1) c ON c.n = {normal_place('municipality')}""")
def _(s, d):
    return lookups.resolve_canonical_name(frame(s, d, "d_records"), "municipality", frame(s, d, "d_places"), "name").select("arrival", "canonical")


_BY_KEY = """dim AS (SELECT key, max_by(v, (name, v)) AS v FROM ({dims}) GROUP BY key),
    asked AS ({asked}), found AS (SELECT asked.name, min_by(v, rank) AS v FROM asked JOIN dim USING (key) GROUP BY 1)"""


@query("multi_key_lookup", "WITH " + _BY_KEY.format(
    dims=f"""SELECT name, homepage AS v, unnest([name, {rx(ascii_name('name'), (r'\s*kommun$', "''", 'i'), (r'\s*stad$', "''", 'i'))}, lower(name)]) AS key
        FROM d_places WHERE homepage IS NOT NULL""",
    asked=f"""SELECT name, unnest([0, 1, 2]) AS rank, unnest([name, {ascii_name('name')}, lower(name)]) AS key
        FROM (SELECT DISTINCT municipality AS name FROM d_records)""")
    + " SELECT arrival, municipality, v AS homepage FROM d_records LEFT JOIN found ON municipality = name")
def _(s, d):
    return lookups.multi_key_lookup(frame(s, d, "d_records"), "municipality",
                                    frame(s, d, "d_places"), "name", "homepage").select("arrival", "municipality", "homepage")


_DASHED = rx(ascii_name("name"), ("[^a-z0-9]", "'-'", "g"), ("-+", "'-'", "g"), ("^-|-$", "''", "g"))


@query("display_name_lookup", "WITH " + _BY_KEY.format(
    dims=f"SELECT name, name AS v, unnest([{_DASHED}, lower(name), name]) AS key FROM d_places",
    asked=f"SELECT name, unnest([0, 1]) AS rank, unnest([name, lower(name)]) AS key FROM (SELECT DISTINCT {_DASHED.replace('name', 'place')} AS name FROM d_records)")
    + f" SELECT arrival, coalesce(v, {_DASHED.replace('name', 'place')}) AS display_name FROM d_records LEFT JOIN found ON name = {_DASHED.replace('name', 'place')}")
def _(s, d):
    r = frame(s, d, "d_records").withColumn("ident", lookups._dashed_ascii(F.col("place")))
    return lookups.display_name_lookup(r, "ident", frame(s, d, "d_places"), "name").select("arrival", "display_name")


@query("match_seed_to_source", f"""
    WITH s AS (SELECT arrival, municipality, {normal_place('municipality')} AS n FROM d_records),
    c AS (SELECT {normal_place('name')} AS n, max(name) AS name FROM d_places GROUP BY 1)
    SELECT arrival, coalesce(a.name, b.name) AS matched_source FROM s LEFT JOIN c a ON a.n = s.n
    LEFT JOIN c b ON ends_with(s.n, 's') AND length(s.n) > 3 AND b.n = regexp_replace(s.n, 's$', '')""")
def _(s, d):
    return lookups.match_seed_to_source(frame(s, d, "d_records"), "municipality", frame(s, d, "d_places"), "name").select(
        "arrival", "matched_source")


@query("population_join", f"""
    SELECT o.source, o.n, p.name AS place, p.place_id * 1000 AS inhabitants FROM (SELECT {sanitized('place')} AS source, count(*) AS n
      FROM d_records GROUP BY 1) o JOIN d_places p ON o.source = {rx(ascii_name('p.name'), ('[^a-z0-9-]', "'-'", 'g'), ('-+', "'-'", 'g'), ('^-|-$', "''", 'g'))}""")
def _(s, d):
    from noticeworks.functions.names import sanitize_name

    counts = frame(s, d, "d_records").groupBy(sanitize_name(F.col("place")).alias("source")).agg(F.count("*").alias("n"))
    people = frame(s, d, "d_places").select("name", (F.col("place_id") * 1000).alias("inhabitants"))
    return lookups.population_join(counts, "source", people)


@query("org_name_lookup", """
    SELECT property_designation, organization_id, s_name AS organization_name FROM d_properties LEFT JOIN supplier ON organization_id = s_suppkey""")
def _(s, d):
    orgs = table(s, d, "supplier").select(F.col("s_suppkey").alias("organization_id"), F.col("s_name").alias("name"))
    return lookups.org_name_lookup(frame(s, d, "d_properties"), orgs).select("property_designation", "organization_id", "organization_name")


@query("in_set_semi", """
    SELECT n.id, n.category_id, c.id IS NOT NULL AS is_building FROM d_noticed n
    LEFT JOIN d_categories c ON c.board_id = n.board_id AND c.id = n.category_id AND c.name LIKE 'Stads%'""")
def _(s, d):
    wanted = frame(s, d, "d_categories").where(F.col("name").startswith("Stads"))
    return lookups.in_set_flag(frame(s, d, "d_noticed"), "category_id", wanted, "id", "is_building", ["board_id"]).select("id", "category_id", "is_building")


@query("type_name_lookup", """
    SELECT n.id, coalesce(a.name, b.name, '') AS type_name FROM d_noticed n
    LEFT JOIN d_types a ON a.board_id = n.board_id AND a.type = n.type_key LEFT JOIN d_types b ON b.board_id = n.board_id AND b.id = n.type_key""")
def _(s, d):
    return lookups.type_name_lookup(frame(s, d, "d_noticed"), frame(s, d, "d_types")).select("id", "type_name")


_WITHOUT = "SELECT doc_id AS source, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def _unlabelled(s, d):
    docs = table(s, d, "documents").select(F.col("doc_id").alias("source"), "lang")
    return lookups.sources_without_data(docs, table(s, d, "labels").select(F.col("doc_id").alias("source")))


query("sources_without_data", _WITHOUT)(_unlabelled)
query("difference", "SELECT doc_id AS source FROM documents EXCEPT SELECT doc_id FROM labels")(
    lambda s, d: _unlabelled(s, d).select("source"))


@query("notices_by_org", """
    SELECT s_name AS organization_name, number, publication_date FROM supplier JOIN d_tenders ON s_suppkey = organization_id""")
def _(s, d):
    orgs = table(s, d, "supplier").select(F.col("s_suppkey").alias("organization_id"), F.col("s_name").alias("organization_name"))
    return lookups.notices_by_org(orgs, tenders(s, d)).select("organization_name", "number", "publication_date")


@query("mangled_to_reference", f"""
    WITH ref AS (SELECT {letters('name')} AS l, min(name) AS name FROM (SELECT replace(name, 'åRe', 'Åre') AS name FROM d_named) GROUP BY 1)
    SELECT n.id, n.name, ref.name AS reference_name FROM d_named n JOIN ref ON ref.l = {letters('n.name')}
    WHERE (regexp_matches(n.name, '[a-zåäö][A-ZÅÄÖ]') OR regexp_matches(n.name, '^[åäö][A-Z]')) AND ref.name <> n.name""")
def _(s, d):
    n = frame(s, d, "d_named")
    ref = n.select(F.replace("name", F.lit("åRe"), F.lit("Åre")).alias("name"))
    return lookups.mangled_to_reference(n, ref).select("id", "name", "reference_name")


@query("expected_vs_actual", """
    WITH a AS (SELECT lower(regexp_replace(case_number, '\\s+', '', 'g')) AS k, min((permit_type, status)) AS pair,
      pair[1] AS permit_type, pair[2] AS status FROM d_permits WHERE case_number IS NOT NULL GROUP BY 1),
    e AS (SELECT 'bn' || o_orderkey AS case_number, CASE WHEN o_orderpriority = '1-URGENT' THEN 'bygglov' ELSE 'anmälan' END AS permit_type,
      CASE WHEN o_orderstatus = 'F' THEN 'Beviljat' END AS status FROM orders)
    SELECT e.case_number, a.k IS NOT NULL AS found, a.k IS NOT NULL AND e.permit_type IS NOT DISTINCT FROM a.permit_type AS permit_type_ok,
      a.k IS NOT NULL AND e.status IS NOT DISTINCT FROM a.status AS status_ok FROM e LEFT JOIN a ON e.case_number = a.k""")
def _(s, d):
    o = table(s, d, "orders")
    expected = o.select(
        F.concat(F.lit("bn"), F.col("o_orderkey").cast("string")).alias("case_number"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "bygglov").otherwise("anmälan").alias("permit_type"),
        F.when(F.col("o_orderstatus") == "F", "Beviljat").alias("status"))
    return lookups.expected_vs_actual(expected, frame(s, d, "d_permits"), ["permit_type", "status"])


# Loads: what was ordered before 1999 is the target, the rest arrives

# The same case is registered again in the later year.
_CASE = "'BN ' || place || '/' || permit_type"


def loads(s, d):
    r = frame(s, d, "d_records").withColumn(
        "case_number", F.when(F.col("case_number").isNotNull(), F.concat(F.lit("BN "), "place", F.lit("/"), "permit_type")))
    early = F.col("created_at") < F.lit("1999-01-01").cast("timestamp_ntz")
    return r.where(early), r.where(~early)


_LOADS = f"""r AS (SELECT * REPLACE (CASE WHEN case_number IS NOT NULL THEN {_CASE} END AS case_number) FROM d_records),
    target AS (SELECT * FROM r WHERE created_at < TIMESTAMP '1999-01-01'), batch AS (SELECT * FROM r WHERE created_at >= TIMESTAMP '1999-01-01')"""
_WITH_ID = """SELECT arrival, place, case_number FROM (SELECT *, row_number() OVER (PARTITION BY place, case_number ORDER BY arrival) AS n FROM batch b
      WHERE case_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM target t WHERE t.place = b.place AND t.case_number = b.case_number)) WHERE n = 1"""
_NO_ID = """SELECT arrival, place, case_number FROM (SELECT *, row_number() OVER (PARTITION BY place, address, source_url ORDER BY arrival) AS n FROM batch b
      WHERE case_number IS NULL AND NOT EXISTS (SELECT 1 FROM target t WHERE t.case_number IS NULL AND t.place IS NOT DISTINCT FROM b.place
        AND t.address IS NOT DISTINCT FROM b.address AND t.source_url IS NOT DISTINCT FROM b.source_url)) WHERE n = 1"""


@query("insert_ignore", f"WITH {_LOADS} {_WITH_ID} UNION ALL SELECT arrival, place, case_number FROM batch WHERE case_number IS NULL")
def _(s, d):
    target, batch = loads(s, d)
    return loading.insert_ignore(target, batch, ["place", "case_number"], ["arrival"]).select(
        "arrival", "place", "case_number")


@query("insert_if_absent_nullkey", f"WITH {_LOADS} {_NO_ID}")
def _(s, d):
    return loading.insert_if_absent_nullkey(*loads(s, d), "case_number", ["place", "address", "source_url"], ["arrival"]).select(
        "arrival", "place", "case_number")


def inserted(s, d):
    target, batch = loads(s, d)
    return batch, loading.insert_records(
        target, batch, "case_number", ["place", "case_number"], ["place", "address", "source_url"], ["arrival"])


@query("insert_counts", f"""
    WITH {_LOADS}, ins AS ({_WITH_ID} UNION ALL {_NO_ID}), i AS (SELECT place, count(*) AS n FROM ins GROUP BY 1)
    SELECT place, count(*) AS offered, coalesce(any_value(i.n), 0) AS inserted, count(*) - coalesce(any_value(i.n), 0) AS skipped
    FROM batch LEFT JOIN i USING (place) GROUP BY place""")
def _(s, d):
    return loading.insert_counts(*inserted(s, d), "place")


@query("insert_in_one_pass", f"WITH {_LOADS} {_WITH_ID} UNION ALL {_NO_ID}")
def _(s, d):
    target, batch = loads(s, d)
    return loading.insert_in_one_pass(
        target, batch, ["place", "case_number"], ["arrival"], "case_number", ["place", "address", "source_url"]).select("arrival", "place", "case_number")


_CHECKED = """c AS (SELECT *, source_url IS NULL AS no_url, created_at >= TIMESTAMP '2000-01-01' AND page_hash IS NULL AS no_hash,
      nullif(permit_type, '') IS NULL AS no_type FROM batch)"""


@query("observed_load_counts", f"""
    WITH {_LOADS}, {_CHECKED}, ok AS (SELECT * FROM c WHERE NOT (no_url OR no_hash OR no_type)),
    ins AS ({_WITH_ID.replace("FROM batch b", "FROM ok b")} UNION ALL {_NO_ID.replace("FROM batch b", "FROM ok b")})
    SELECT unnest(['offered', 'storable', 'missing_identifier', 'missing_source_url', 'missing_page_hash', 'inserted', 'skipped']) AS name,
      unnest([(SELECT count(*) FROM c), (SELECT count(*) FROM ok), (SELECT count(*) FROM c WHERE no_type), (SELECT count(*) FROM c WHERE no_url),
        (SELECT count(*) FROM c WHERE no_hash), (SELECT count(*) FROM ins), (SELECT count(*) FROM ok) - (SELECT count(*) FROM ins)]) AS records""")
def _(s, d):
    """What a load offered, dropped by reason, stored and skipped, counted by the job that writes the new rows."""
    target, batch = loads(s, d)
    checked = shaping.require_technical_fields(batch, "permit_type", "created_at", date(2000, 1, 1))
    load = observed.observed_load(checked, target, "case_number", ["place", "case_number"], ["place", "address", "source_url"], ["arrival"])
    loading.append(load.to_append, f"{shared_folder(s)}/load-{uuid.uuid4().hex}")
    return s.createDataFrame(list(load.counts().items()), "name string, records long")


@query("tender_counts", """
    WITH r AS (SELECT * FROM d_tenders WHERE cpv IS NULL OR substring(cpv, 1, 2) IN ('45', '71', '44')),
    known AS (SELECT DISTINCT number FROM d_tenders WHERE organization_id % 3 = 0)
    SELECT unnest(['fetched', 'relevant', 'inserted']) AS name,
      unnest([(SELECT count(*) FROM d_tenders), (SELECT count(*) FROM r),
        (SELECT count(DISTINCT number) FROM r WHERE number NOT IN (SELECT number FROM known)) + (SELECT count(*) FROM r WHERE number IS NULL)]) AS records""")
def _(s, d):
    """Tenders of a run: fetched, relevant by their codes, and new to the stored ones; counted by the job that writes."""
    t = tenders(s, d).select("organization_id", "number", "cpv")
    known = t.where(F.col("organization_id") % 3 == 0)
    run = observed.observed_relevant(t, records.relevant_cpv(F.col("cpv")), known, ["number"], ["organization_id"])
    loading.append(run.rows, f"{shared_folder(s)}/tenders-{uuid.uuid4().hex}")
    return s.createDataFrame(list(run.counts().items()), "name string, records long")


_RUN = """run AS (SELECT arrival, created_at, place AS organization_name, CASE WHEN arrival % 11 > 0 THEN arrival % 3 END AS organization_id,
      'Projekt ' || permit_type AS title, CASE status WHEN 'beviljat' THEN 'planned' WHEN 'ansökt' THEN 'rumor' ELSE 'tender' END AS maturity,
      amount_sek * 100 AS amount_sek, source_url, date AS source_date, page_hash FROM d_records)"""
_STORED = "organization_id, organization_name, title, maturity, amount_sek, source_url, source_date, source_type, arrival"


def signal_run(s, d):
    r = frame(s, d, "d_records")
    stage = F.when(F.col("status") == "beviljat", "planned").when(F.col("status") == "ansökt", "rumor").otherwise("tender")
    found = r.select(
        "arrival", "created_at", F.col("place").alias("organization_name"), F.when(F.col("arrival") % 11 > 0, F.col("arrival") % 3).alias("organization_id"),
        F.concat(F.lit("Projekt "), "permit_type").alias("title"), stage.alias("maturity"), (F.col("amount_sek") * 100).alias("amount_sek"),
        "source_url", F.col("date").alias("source_date"), "page_hash", F.lit(None).cast("string").alias("page_url"))
    early = F.col("created_at") < F.lit("1999-01-01").cast("timestamp_ntz")
    return found.where(early).withColumn("source_type", F.lit("old")).select(*_STORED.split(", ")), found.where(~early)


@query("daily_load_signals", f"""
    WITH {_RUN}, target AS (SELECT * FROM run WHERE created_at < TIMESTAMP '1999-01-01'),
    batch AS (SELECT organization_id, organization_name, title, CASE WHEN maturity IN ('planned', 'tender', 'awarded') THEN maturity END AS maturity,
      CASE WHEN amount_sek BETWEEN 1000000 AND 50000000000 THEN amount_sek END AS amount_sek, source_url, source_date, 'project_page' AS source_type, arrival
      FROM run WHERE created_at >= TIMESTAMP '1999-01-01' AND source_url IS NOT NULL AND NOT (created_at >= TIMESTAMP '2000-01-01' AND page_hash IS NULL)),
    named AS (SELECT *, row_number() OVER (PARTITION BY organization_id, source_url, title ORDER BY arrival) AS n FROM batch
      WHERE organization_id IS NOT NULL AND title IS NOT NULL)
    SELECT {_STORED} FROM named b WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM target t WHERE t.organization_id = b.organization_id
      AND t.source_url = b.source_url AND t.title = b.title)
    UNION ALL SELECT {_STORED} FROM batch WHERE organization_id IS NULL OR title IS NULL""")
def _(s, d):
    target, found = signal_run(s, d)
    hashes = s.createDataFrame([], "source string, url string, content_hash string")
    pages = s.createDataFrame([], "source string, url string, content_hash string, skipped boolean")
    return daily_run.load(found, target, None, pages, hashes, config.PROJECT_PAGES, "m", datetime(2000, 1, 1)).to_append


_STORE_SIGNALS = f"""
    WITH {_RUN}, ranked AS (SELECT *, created_at >= TIMESTAMP '1999-01-01' AS fresh, row_number() OVER (PARTITION BY organization_id, source_url, title,
      created_at >= TIMESTAMP '1999-01-01' ORDER BY source_date DESC, arrival DESC) AS n FROM run WHERE organization_id IS NOT NULL AND source_url IS NOT NULL AND title IS NOT NULL),
    stored AS (SELECT * FROM ranked WHERE NOT fresh AND n = 1), new AS (SELECT * FROM ranked WHERE fresh AND n = 1)
    SELECT organization_id, source_url, title, coalesce(new.arrival, stored.arrival) AS arrival, CASE WHEN new.arrival IS NULL THEN stored.maturity ELSE new.maturity END AS maturity
      FROM stored FULL JOIN new USING (organization_id, source_url, title)
    UNION ALL SELECT organization_id, source_url, title, arrival, maturity FROM run
      WHERE organization_id IS NULL OR source_url IS NULL OR title IS NULL"""


def signals_to_store(s, d):
    """What was known before is unique by its key, what arrives is not."""
    target, found = signal_run(s, d)
    key = list(cross_match.SIGNAL_KEY)
    complete = F.col("organization_id").isNotNull() & F.col("source_url").isNotNull() & F.col("title").isNotNull()
    columns = ["organization_id", "source_url", "title", "arrival", "maturity", "source_date"]
    known = ordering.first_wins(target.where(complete), key, [F.col("source_date").desc(), F.col("arrival").desc()])
    return known.unionByName(target.where(~complete)).select(*columns), found.select(*columns)


@query("store_signals", _STORE_SIGNALS)
def _(s, d):
    return cross_match.store_signals(*signals_to_store(s, d)).drop("source_date")


def laid_out(s, rows, key, buckets=16):
    """A table laid out by its key in a folder of its own."""
    return keyed_tables.create(rows, f"{shared_folder(s)}/keyed-{uuid.uuid4().hex}", key, buckets)


@query("store_signals_keyed", _STORE_SIGNALS)
def _(s, d):
    stored, found = signals_to_store(s, d)
    signals = laid_out(s, stored, cross_match.SIGNAL_KEY)
    cross_match.merge_signals(signals, found)
    return signals.read().drop("source_date")


_UPSERT = f"""
    WITH {_LOADS}, t1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place, case_number ORDER BY arrival) AS n FROM target WHERE case_number IS NOT NULL) WHERE n = 1),
    b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place, case_number ORDER BY arrival DESC) AS n FROM batch WHERE case_number IS NOT NULL) WHERE n = 1)
    SELECT coalesce(b1.place, t1.place) AS place, coalesce(b1.case_number, t1.case_number) AS case_number,
      CASE WHEN b1.arrival IS NOT NULL THEN b1.address ELSE t1.address END AS address, coalesce(b1.arrival, t1.arrival) AS arrival, t1.description
    FROM t1 FULL JOIN b1 ON t1.place = b1.place AND t1.case_number = b1.case_number
    UNION ALL SELECT place, NULL, address, arrival, description FROM target WHERE case_number IS NULL
    UNION ALL SELECT place, NULL, address, arrival, NULL FROM batch WHERE case_number IS NULL"""


def merge_sides(s, d):
    target, batch = (f.select("place", "case_number", "address", "arrival", "description") for f in loads(s, d))
    full = F.col("case_number").isNotNull()
    stored = ordering.first_wins(target.where(full), ["place", "case_number"], [F.col("arrival")]).unionByName(target.where(~full))
    return stored, batch.drop("description")


@query("upsert_merge", _UPSERT)
def _(s, d):
    return loading.upsert_merge(*merge_sides(s, d), ["place", "case_number"], ["arrival"])


@query("upsert_merge_keyed", _UPSERT)
def _(s, d):
    """The same merge into a stored table, of which only the buckets of the batch's keys are read and swapped."""
    stored, batch = merge_sides(s, d)
    records = laid_out(s, stored, ["place", "case_number"])
    keyed_tables.merge(records, batch, ["arrival"])
    return records.read()


@query("merge_touched_buckets", f"""
    WITH {_LOADS} SELECT count(DISTINCT case_number) = 10 AS ten_keys, true AS others_untouched FROM (
      SELECT case_number FROM batch WHERE case_number IS NOT NULL GROUP BY case_number ORDER BY min(arrival) LIMIT 10)""")
def _(s, d):
    """A merge of ten keys replaces the files of their buckets and leaves all others as they were."""
    stored, batch = merge_sides(s, d)
    records = laid_out(s, stored, ["place", "case_number"])
    first = batch.where(F.col("case_number").isNotNull()).groupBy("case_number").agg(F.min("arrival").alias("at")).orderBy("at").limit(10)
    few = batch.join(first.select("case_number"), "case_number")
    before = records.files()
    swapped = keyed_tables.merge(records, few, ["arrival"])
    after = records.files()
    kept = all(before[b] == after[b] for b in before if b not in swapped)
    changed = all(not before.get(b, {}).keys() & after[b].keys() for b in swapped)
    return few.agg((F.count_distinct("case_number") == 10).alias("ten_keys"), F.lit(kept and changed and 0 < len(swapped) <= 10).alias("others_untouched"))


_HASHES = """run AS (SELECT source, doc_id AS url, CASE WHEN n_chars > 300 THEN substring(sha256(text), 1, 16) END AS content_hash
      FROM documents),
    stored AS (SELECT source, doc_id AS url, 'old' AS content_hash FROM documents UNION ALL SELECT url, page_id, 'old' FROM pages)"""


@query("update_page_hashes", f"""
    WITH {_HASHES} SELECT * FROM stored WHERE source NOT IN (SELECT source FROM run)
    UNION ALL SELECT * FROM run WHERE content_hash IS NOT NULL""")
def _(s, d):
    docs = table(s, d, "documents")
    run = docs.select(
        "source", F.col("doc_id").alias("url"), F.when(F.col("n_chars") > 300, F.substring(F.sha2("text", 256), 1, 16)).alias("content_hash"))
    stored = docs.select("source", F.col("doc_id").alias("url"), F.lit("old").alias("content_hash")).unionByName(
        table(s, d, "pages").select(F.col("url").alias("source"), F.col("page_id").alias("url"), F.lit("old").alias("content_hash")))
    return loading.update_page_hashes(stored, run)


_QC = """qc AS (SELECT 'permits' AS vertical, source, CAST(ts AS DATE) AS run_date, count(*) AS extracted, false AS alert_sent FROM d_obs GROUP BY 1, 2, 3)"""


def qc_rows(s, d):
    return frame(s, d, "d_obs").groupBy("source", F.to_date("ts").alias("run_date")).agg(F.count("*").alias("extracted")).select(
        F.lit("permits").alias("vertical"), "source", "run_date", "extracted", F.lit(False).alias("alert_sent"))


@query("upsert_daily_qc", f"""
    WITH {_QC} SELECT vertical, source, CAST(run_date AS VARCHAR) AS run_date,
      CASE WHEN run_date >= DATE '2024-01-28' AND source LIKE '%click' THEN extracted + 100 ELSE extracted END AS extracted FROM qc""")
def _(s, d):
    qc = qc_rows(s, d)
    again = qc.where((F.col("run_date") >= F.lit("2024-01-28").cast("date")) & F.col("source").endswith("click")).withColumn(
        "extracted", F.col("extracted") + 100)
    return loading.upsert_daily_qc(qc, again).select("vertical", "source", F.col("run_date").cast("string").alias("run_date"), "extracted")


@query("mark_alerted", f"""
    WITH {_QC} SELECT source, CAST(run_date AS VARCHAR) AS run_date, run_date = DATE '2024-01-29' AND source LIKE '%error' AS alert_sent FROM qc""")
def _(s, d):
    qc = qc_rows(s, d)
    streaks = qc.where(F.col("source").endswith("error")).select("source")
    return loading.mark_alerted(qc, streaks, "permits", date(2024, 1, 29)).select(
        "source", F.col("run_date").cast("string").alias("run_date"), "alert_sent")


@query("update_by_key", """
    SELECT name, CASE WHEN county = 'BUILDING' THEN 'https://new.example/' || place_id ELSE homepage END AS homepage FROM d_places""")
def _(s, d):
    p = frame(s, d, "d_places")
    new = p.where(F.col("county") == "BUILDING").select("name", F.concat(F.lit("https://new.example/"), F.col("place_id").cast("string")).alias("homepage"))
    return loading.update_by_key(p, new, "name", "homepage").select("name", "homepage")


@query("update_by_key_keyed", """
    SELECT name, CASE WHEN county = 'BUILDING' THEN 'https://new.example/' || place_id ELSE homepage END AS homepage FROM d_places""")
def _(s, d):
    p = frame(s, d, "d_places")
    places = laid_out(s, p.select("name", "county", "homepage"), ["name"])
    new = p.where(F.col("county") == "BUILDING").select("name", F.concat(F.lit("https://new.example/"), F.col("place_id").cast("string")).alias("homepage"))
    keyed_tables.update(places, new, "homepage")
    return places.read().select("name", "homepage")


@query("unknown_keys", "SELECT DISTINCT municipality AS name FROM d_records WHERE municipality NOT IN (SELECT name FROM d_places)")
def _(s, d):
    asked = frame(s, d, "d_records").select(F.col("municipality").alias("name")).distinct()
    return loading.unknown_keys(frame(s, d, "d_places"), asked, "name")


@query("write_run_log", "SELECT 'r' || priority AS run_id, event_id, source, status, records, CAST(cost_usd AS DOUBLE) AS cost_usd FROM (SELECT *, event_id % 3 AS priority FROM d_results)")
def _(s, d):
    """Three runs are appended one after another, each as its own partition, and read back."""
    rows = frame(s, d, "d_results").select("event_id", "source", "status", "records", F.col("cost_usd").cast("double").alias("cost_usd"))
    path = f"{shared_folder(s)}/run-log-{uuid.uuid4().hex}"
    for n in range(3):
        loading.write_run_log(loading.run_log(rows.where(F.col("event_id") % 3 == n), f"r{n}"), path)
    return s.read.parquet(path).select("run_id", *rows.columns)


# Three runs over the pages: as they are, with every fourth page changed, and without a further change.
_RUNS = """r0 AS (SELECT 'page' AS kind, url AS source, CAST(page_id AS VARCHAR) AS name, CAST(0 AS BIGINT) AS part, html AS content FROM pages),
    r1 AS (SELECT kind, source, name, part, CASE WHEN CAST(name AS BIGINT) % 4 = 0 THEN content || '<!-- new -->' ELSE content END AS content FROM r0),
    w AS (SELECT 'row' AS kind, source, status AS name, event_id AS part, '{"source":"' || source || '","status":"' || status || '","event_id":' || event_id || '}' AS content
      FROM d_results),
    runs AS (SELECT 'r0' AS run_id, * FROM r0 UNION ALL SELECT 'r1', * FROM r1 UNION ALL SELECT 'r2', * FROM r1
      UNION ALL SELECT run_id, w.* FROM w, (VALUES ('r0'), ('r1'), ('r2')) AS t(run_id))"""


def archived(s, d):
    path = f"{shared_folder(s)}/archive-{uuid.uuid4().hex}"
    pages = table(s, d, "pages").select(F.col("url").alias("source"), F.col("page_id").alias("url"), F.col("html").alias("content"))
    later = pages.withColumn("content", F.when(F.col("url") % 4 == 0, F.concat("content", F.lit("<!-- new -->"))).otherwise(F.col("content")))
    rows = archive.row_items(frame(s, d, "d_results").select("source", "status", "event_id"), "source", "status", "event_id")
    for run_id, read in (("r0", pages), ("r1", later), ("r2", later)):
        archive.archive_run(archive.page_items(read).unionByName(rows), path, run_id)
    return path


@query("archive_rebuild", f"""
    WITH {_RUNS} SELECT run_id, kind, source, name, part, sha256(content) AS content_sha256 FROM runs""")
def _(s, d):
    path = archived(s, d)
    back = [archive.rebuild(s, path, r).select(F.lit(r).alias("run_id"), "kind", "source", "name", "part", F.sha2("content", 256).alias("content_sha256"))
            for r in ("r0", "r1", "r2")]
    return back[0].unionByName(back[1]).unionByName(back[2])


@query("archive_run_sizes", f"""
    WITH {_RUNS}, first AS (SELECT content, min(run_id) AS run_id FROM runs GROUP BY 1)
    SELECT run_id, (SELECT count(*) FROM runs x WHERE x.run_id = r.run_id) AS items,
      (SELECT count(*) FROM first f WHERE f.run_id = r.run_id) AS blobs_added,
      coalesce((SELECT sum(octet_length(encode(content))) FROM first f WHERE f.run_id = r.run_id), 0) AS bytes_added
    FROM (SELECT DISTINCT run_id FROM runs) r""")
def _(s, d):
    return archive.run_sizes(s, archived(s, d))


# Ordering

_DAILY = "daily AS (SELECT source, CAST(ts AS DATE) AS day, count(*) AS n FROM d_obs GROUP BY 1, 2)"


@query("last_n_dates", f"""
    WITH {_DAILY} SELECT source, CAST(day AS VARCHAR) AS day, n, recency FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS recency
      FROM daily) WHERE recency <= 4""")
def _(s, d):
    from noticeworks.operators.quality import count_per_source_day

    return ordering.last_n_dates(count_per_source_day(frame(s, d, "d_obs")), "source", "day").select(
        "source", F.col("day").cast("string").alias("day"), "n", "recency")


@query("first_wins", "SELECT o_custkey, month(o_orderdate) AS month, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2")
def _(s, d):
    o = table(s, d, "orders").withColumn("month", F.month("o_orderdate"))
    return ordering.first_wins(o, ["o_custkey", "month"], [F.col("o_orderkey")]).select("o_custkey", "month", "o_orderkey")


_SPENT = """spent AS (SELECT *, coalesce(sum(cost) OVER (PARTITION BY run ORDER BY priority NULLS FIRST, created_at, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent_before FROM d_tasks)"""


@query("budget_cutoff", f"""
    WITH {_SPENT}, flagged AS (SELECT *, spent_before + max_cost > 500000 AS over FROM spent)
    SELECT run, id, CAST(spent_before AS DOUBLE) AS spent_before, CASE WHEN max(CAST(over AS INT)) OVER (PARTITION BY run ORDER BY priority NULLS FIRST, created_at, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 THEN 'budget_exhausted' ELSE 'run' END AS status FROM flagged""")
def _(s, d):
    tasks = frame(s, d, "d_tasks")
    return ordering.budget_cutoff(tasks, 500000, ["run"], ["priority", "created_at", "id"], ["priority", "created_on"]).select(
        "run", "id", F.col("spent_before").cast("double").alias("spent_before"), "status")


@query("budget_cutoff_one_run", """
    WITH spent AS (SELECT *, coalesce(sum(cost) OVER (ORDER BY priority NULLS FIRST, created_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent_before FROM d_tasks),
    total AS (SELECT sum(cost) * 0.6 AS budget FROM d_tasks),
    flagged AS (SELECT *, spent_before + max_cost > (SELECT budget FROM total) AS over FROM spent)
    SELECT id, CAST(spent_before AS DOUBLE) AS spent_before, CASE WHEN max(CAST(over AS INT)) OVER (ORDER BY priority NULLS FIRST, created_at, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 THEN 'budget_exhausted' ELSE 'run' END AS status FROM flagged""")
def _(s, d):
    """All tasks are one run, which no column cuts into chunks."""
    tasks = frame(s, d, "d_tasks").withColumn("run", F.lit("all"))
    budget = tasks.agg((F.sum("cost") * F.lit("0.6").cast("decimal(2,1)")).alias("b")).first()["b"] or 0
    return ordering.budget_cutoff(tasks, budget, ["run"], ["priority", "created_at", "id"]).select(
        "id", F.col("spent_before").cast("double").alias("spent_before"), "status")


@query("spend_until", f"WITH {_SPENT} SELECT run, id, CAST(spent_before AS DOUBLE) AS spent_before FROM spent WHERE spent_before < 400000")
def _(s, d):
    return ordering.spend_until(frame(s, d, "d_tasks"), 400000, ["run"], ["priority", "created_at", "id"], ["priority", "created_on"]).select(
        "run", "id", F.col("spent_before").cast("double").alias("spent_before"))
