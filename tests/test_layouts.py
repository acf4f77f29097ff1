"""Shares of fields that the parser finds on invented pages in ten layouts."""

from noticeworks.functions.blocks import blocks_of
from noticeworks.operators import lookups, shaping

#: (case number, type, status, applicant) of every page
LAYOUTS = {
    "inline": ("""<main><h2>Anslag</h2><h3>Beviljat bygglov</h3><p><strong>Diarienummer:</strong> BN 2026/11</p><p>Fastighet: Sjövik 1:2</p><p>Sökande: Sjövik Bostäder AB</p>
        <h3>Startbesked för rivning</h3><p>Diarienummer: BN 2026/12</p><p>Sökande: Eva Ek</p></main>""",
               [("BN 2026/11", "bygglov", "beviljat", "Sjövik Bostäder AB"), ("BN 2026/12", "rivningslov", "startbesked", None)]),
    "table": ("""<table><tr><th>Diarienr</th><th>Ärende</th></tr><tr><td>TN 2026-000021</td><td>Avslag bygglov</td></tr>
        <tr><td>TN 2026-000022</td><td>Anmälan om installation av eldstad</td></tr></table>""",
              [("TN 2026-000021", "bygglov", "avslag", None), ("TN 2026-000022", "anmälan", None, None)]),
    "articles": ("<article><p>Diarienummer: A 31/26</p><p>Ansökan om bygglov har inkommit</p></article><article><p>Diarienummer: A 32/26</p><p>Ansökan om marklov</p></article>",
                 [("A 31/26", "bygglov", "ansökt", None), ("A 32/26", "marklov", "ansökt", None)]),
    "blocks": ("<div><h3>Förhandsbesked</h3><p>Diarienummer: B 41</p></div><div><h3>Slutbesked nybyggnad</h3><p>Diarienummer: B 42</p></div>",
               [("B 41", "förhandsbesked", None, None), ("B 42", "bygglov", "slutbesked", None)]),
    "subpages": ("<h1>Start</h1><!-- SUBPAGE: https://a.example/1 --><h3>Beviljat marklov</h3><p>Dnr: S 51</p><!-- SUBPAGE: https://a.example/2 --><h3>Bygglov överklagat</h3><p>Dnr: S 52</p>",
                 [("S 51", "marklov", "beviljat", None), ("S 52", "bygglov", "överklagat", None)]),
    "details": ("<details><summary>Bygglov</summary><ul><li>Beviljat bygglov — Dnr: D 61</li><li>Startbesked rivning — Dnr: D 62</li></ul></details>",
                [("D 61", "bygglov", "beviljat", None), ("D 62", "rivningslov", "startbesked", None)]),
    "cards": ('<div class="grid"><div class="box card"><p>Diarienummer: C 71</p><p>Överklagat bygglov</p></div><div class="box card"><p>Diarienummer: C 72</p><p>Beviljat strandskydd</p></div></div>',
              [("C 71", "bygglov", "överklagat", None), ("C 72", "strandskyddsdispens", "beviljat", None)]),
    "mixed": ("<h2>Marklov</h2><p>Dnr: M 81</p><p>beviljat</p><ul><li>Dnr: M 82 — rivningslov, ansökan</li></ul>",
              [("M 81", "marklov", "beviljat", None), ("M 82", "rivningslov", "ansökt", None)]),
    "heading inside": ("<article><p>Diarienummer: A 33/26</p><h4>Beslut</h4><p>Beviljat bygglov</p></article><article><h4>Beslut</h4><p>Avslag marklov</p><p>Diarienummer: A 34/26</p></article>",
                       [("A 33/26", "bygglov", "beviljat", None), ("A 34/26", "marklov", "avslag", None)]),
    "list in a cell": ("<table><tr><th>Diarienr</th><th>Beslut</th></tr><tr><td>TN 2026-000023</td><td><ul><li>Avslag<li>bygglov</ul></td></tr><tr><td>TN 2026-000024<td>Beviljat marklov</table>",
                       [("TN 2026-000023", "bygglov", "avslag", None), ("TN 2026-000024", "marklov", "beviljat", None)]),
    "empty": ("<main><h2>Anslag</h2><p>Inga kungörelser just nu.</p></main>", []),
    "private": ("<h3>Bygglov</h3><p>Diarienummer: P 91</p><p>Sökande: Anna Lind</p><h3>Bygglov</h3><p>Diarienummer: P 92</p><p>Sökande: Linds förening</p>",
                [("P 91", "bygglov", None, None), ("P 92", "bygglov", None, "Linds förening")]),
}
FIELDS = ["permit_type", "status", "applicant"]


def test_field_shares(spark):
    pages = spark.createDataFrame([(k, f"https://{k}.example", v[0]) for k, v in LAYOUTS.items()], "layout string, url string, html string")
    wanted = spark.createDataFrame([(k, *r) for k, v in LAYOUTS.items() for r in v[1]], "layout string, case_number string, permit_type string, status string, applicant string")
    found = shaping.labelled_fields(shaping.split_subpages(pages)).cache()
    checked = lookups.expected_vs_actual(wanted, found, FIELDS).collect()
    share = {f: sum(r[f] for r in checked) / len(checked) for f in ["found", *[f"{f}_ok" for f in FIELDS]]}

    assert share["found"] == 1.0
    assert share["applicant_ok"] == 1.0  # a private name is never kept
    assert share["permit_type_ok"] >= 0.9 and share["status_ok"] >= 0.8
    assert found.count() == len(checked)
    urls = {r["case_number"]: r["source_url"] for r in found.collect()}
    assert urls["S 51"] == "https://a.example/1" and urls["S 52"] == "https://a.example/2" and urls["C 71"] == "https://cards.example"


def test_blocks_end_where_their_element_closes():
    assert blocks_of("") == [] and blocks_of("bare") == ["bare"]
    assert blocks_of("<div><h3>Dnr: A 1</h3>a</div>after") == ["<div>after", "<h3>Dnr: A 1</h3>a</div>"]
    assert blocks_of("<h2>A</h2>Dnr: A 1<h4>B</h4>b<h2>C</h2>Dnr: C 1") == ["<h2>A</h2>Dnr: A 1<h4>B</h4>b", "", "<h2>C</h2>Dnr: C 1"]
    assert blocks_of("<ul><li>Dnr: X 1<ul><li>Dnr: X 2</li></ul>tail</li></ul>") == ["<li>Dnr: X 1<ul></ul>tail</li>", "<li>Dnr: X 2</li>"]
    assert blocks_of("</div></li><li>Dnr: 1/1<li>Dnr: 1/2</ul>c") == ["<li>Dnr: 1/1", "<li>Dnr: 1/2</ul>c"]


def test_deep_pages_take_time_in_proportion():
    deep = "<article>" * 20_000 + "Dnr: X 9" + "</article>" * 20_000
    assert blocks_of(deep)[-1] == "<article>Dnr: X 9</article>" and sum(map(len, blocks_of(deep))) <= len(deep)
    assert sum(map(len, blocks_of("<li>" * 20_000 + "<ul><li>" * 5_000))) <= 120_000
