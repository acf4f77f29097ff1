"""Field parsing with wording the test tables do not contain."""

from datetime import date

from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions import records
from noticeworks.operators import boards, shaping
from noticeworks.sources import scans


def test_permit_types_in_order(apply):
    given = ["Rivning av lada", "Bygglov och rivning", "Marklov för schakt", "Anmälan om kamin", "FASADÄNDRING", "Kallelse", None]
    assert apply(records.classify_permit_type, given) == [
        "rivningslov", "bygglov", "marklov", "anmälan", "bygglov", None, None]


def test_status_texts(apply):
    given = ["Grannhörande pågår", "Avslag på ansökan", "Beslutet är överklagat", "Slutbesked", "Beslut"]
    assert apply(records.status_from_text, given) == ["ansökt", "avslag", "överklagat", "slutbesked", "beviljat"]


def test_private_applicants_are_dropped(apply):
    given = ["Sökande: Kvarnens Bostäder AB\nx", "Sökande: Eva Ek", "Byggherre: Lunda kommun", "inget"]
    assert apply(records.organisation_applicant, given) == ["Kvarnens Bostäder AB", None, "Lunda kommun", None]


def test_phrases(apply):
    given = ["Installation av eldstad", "Positivt förhandsbesked för nybyggnad", "Beslutet kan överklagas senast i maj", "Har överklagats", "Schaktning"]
    assert apply(records.phrase_type, given)[:2] == ["anmälan", "förhandsbesked"]
    assert apply(records.phrase_status, given) == [None, "beviljat", None, "överklagat", None]


def test_amounts(apply):
    assert apply(records.parse_sek, ["925 mkr", "1,2 mdr", "3,5 miljarder kronor", "1 200 mkr", "900 kvm"]) == [
        925_000_000, 1_200_000_000, 3_500_000_000, 1_200_000_000, None]
    assert apply(lambda c: records.convert_amount(c, F.lit("SEK")), ["100.5", "0", "-2.5", "x", None]) == [101, 0, -2, None, None]
    assert apply(lambda c: records.convert_amount(c, F.lit("EUR")), ["100"]) == [1150]


def test_region_codes_in_any_shape(apply):
    given = ['"se110"', "SE110", '["NO1","SE224"]', '[{"country":{"code":"DK"}},{"x":{"nuts":"SE231"}}]', '{"a":{"b":"SE311"}}', '{"a":"Seattle"}', None]
    assert apply(records.nuts_code, given) == ["SE110", "SE110", "SE224", "SE231", "SE311", None, None]
    ordered = {
        '{"x":["SE232"],"nuts":"SE110"}': "SE110", '{"a":{"nuts":"SE231"},"value":"se 12","code":"DK"}': "SE 12", '{"note":"SE312","b":[{"code":"SE224"}]}': "SE312",
        '{"note":"SE3123","b":[{"code":"SE224"}]}': "SE224", '{"value":"SE1","nuts":"SE2"}': "SE2", '[["SE1x","SE123"],"SE9"]': "SE123",
        '[[["SE1x"]]]': "SE1X", '{"nuts":["SE123"],"a":"SE321"}': "SE123", '{"nuts":"SE110"': None, '{"nuts":5,"a":null}': None, "[]": None,
        "[" * 2000 + "]" * 2000: None}
    assert apply(records.nuts_code, list(ordered)) == list(ordered.values())


def test_excerpts(apply):
    text = "En mening. En till! " + "x" * 20
    assert apply(lambda c: records.excerpt(c, 25), [text, "kort", ""]) == ["En mening. En till!", "kort", None]


def test_news(apply):
    given = ["Bolaget hyr ut 300 kvm", "Bolaget bygger nytt, hyr ut till X", "Delårsrapport Q2", "Ny detaljplan antagen"]
    assert apply(records.skipped_news, given) == ["letting", None, "report", None]


PAGE = """<main><h1>Tavla</h1>
<h3>Kungörelse - Beviljat marklov</h3><p><b>Diarienummer:</b> BN 2026/7</p><p>Fastighetsbeteckning: KVARNEN 3:12</p>
<p>Åtgärd: Schaktning</p><p>Sökande: Eva Ek</p><p>Beslutsdatum: 2026-03-15</p><p>Beslutet kan överklagas.</p>
<h3>Startbesked</h3><p>Dnr: BN 2025/9<br>Fastighet: RAPSEN 2:8<br>Åtgärd: Tillbyggnad<br>Sökande: Stiftelsen Rapsen</p>
<table><tr><th>Diarienr</th></tr><tr><td>SBN/2026/00321</td><td>FORS 14:2</td><td>Uppsättning av skylt</td><td>Avslag</td><td>2026-03-13</td></tr></table>
<ul><li><b>BN 2026/00134</b> — ALEN 2:67 — Installation av eldstad — Startbesked — 2026-03-21</li></ul></main>"""


def test_labelled_notices(spark):
    df = spark.createDataFrame([("u", PAGE)], "url string, html string")
    got = {r["case_number"]: r for r in shaping.labelled_fields(df).collect()}
    assert set(got) == {"BN 2026/7", "BN 2025/9", "SBN/2026/00321", "BN 2026/00134"}
    assert (got["BN 2026/7"]["permit_type"], got["BN 2026/7"]["status"], got["BN 2026/7"]["applicant"]) == ("marklov", "beviljat", None)
    assert (got["BN 2025/9"]["status"], got["BN 2025/9"]["applicant"]) == ("startbesked", "Stiftelsen Rapsen")
    assert (got["SBN/2026/00321"]["permit_type"], got["SBN/2026/00321"]["status"], got["SBN/2026/00321"]["date"]) == ("bygglov", "avslag", "2026-03-13")
    assert (got["BN 2026/00134"]["permit_type"], got["BN 2026/00134"]["property"]) == ("anmälan", "ALEN 2:67")


def test_model_answers(spark):
    rows = [(1, '```json\n[{"case_number": "A 1", "status": "ansokt"}, {"case_number": "B"}]\n```'), (2, "inget hittat"), (3, "[]")]
    df = spark.createDataFrame(rows, "page int, answer string")
    got = shaping.parse_model_response(df, "answer", "array<struct<case_number:string,status:string>>")
    clean = shaping.null_invalid_enums(got, {"status": config.STATUSES})
    assert [tuple(r) for r in clean.orderBy("pos").collect()] == [(1, 0, "A 1", None), (1, 1, "B", None)]


def test_files_are_read_by_name(spark, tmp_path):
    for name, text in {"lund_extracted.json": '[{"case_number":"1"},{"case_number":"2"}]', "other.json": "[]"}.items():
        (tmp_path / name).write_text(text)
    got = scans.scan_extracted_json(spark, str(tmp_path)).select("source", "case_number").collect()
    assert sorted(map(tuple, got)) == [("lund", "1"), ("lund", "2")]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "p.html").write_text("<p>Hej</p>")
    (tmp_path / "b" / "q.html").write_bytes(b"%PDF-1.7 x")
    pages = {r["url"][-6:]: r for r in scans.scan_pages(spark, str(tmp_path / "b")).collect()}
    assert pages["p.html"]["content"] == "Hej" and pages["q.html"]["is_pdf"] and pages["q.html"]["content"] is None


def test_notice_fields(spark):
    notice = spark.createDataFrame(
        [("s", "b", "1", "c", "9", "2026-03-01 10:00", "Kung&#246;relse", "diarienummer: BYGG 2026-40.",
          [("Beskrivning", "LYAN 7:3 (Åvägen 2) - f&#246;rhandsbesked f&#246;r villa")], [("Bilaga",)])],
        "source string, board_id string, id string, category_id string, type_key string, published string, title string, text string, "
        "metadata array<struct<title:string,value:string>>, attachments array<struct<title:string>>")
    categories = spark.createDataFrame([("b", "c", "Kultur")], "board_id string, id string, name string")
    types = spark.createDataFrame([("b", "g", "9", "Kallelse")], "board_id string, id string, type string, name string")
    r = boards.notice_permits(notice, categories, types, "https://x").first()
    assert (r["case_number"], r["address"], r["property"], r["permit_type"], r["date"]) == (
        "BYGG 2026-40", "Åvägen 2", "LYAN 7:3", "förhandsbesked", "2026-03-01")


def test_dates(apply):
    assert apply(records.date_part, ["2026-03-05+01:00", "x", None]) == [date(2026, 3, 5), None, None]


def test_notice_texts_are_made_after_the_joins(spark):
    notice = spark.createDataFrame(
        [("s", "b", "1", "c", "9", "2026-03-01", "Bygglov", "", [("Beskrivning", "x")], [("Bilaga",)])],
        "source string, board_id string, id string, category_id string, type_key string, published string, title string, text string, "
        "metadata array<struct<title:string,value:string>>, attachments array<struct<title:string>>")
    categories = spark.createDataFrame([("b", "c", "Kultur")], "board_id string, id string, name string")
    types = spark.createDataFrame([("b", "g", "9", "Kallelse")], "board_id string, id string, type string, name string")
    made = boards.notice_permits(notice, categories, types, "https://x")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "all_text" in plan and "all_text" not in plan.split("Join", 1)[1]
    assert made.count() == 1
