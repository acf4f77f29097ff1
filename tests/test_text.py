"""Names, pages and URLs: spelling traps the test tables do not contain."""

import random
import unicodedata

from pyspark.sql import functions as F

from noticeworks.functions import composition, html, names, urls

NBSP = "\u00a0"


def test_composed_and_decomposed_names_agree(apply):
    assert apply(names.nfc, ["Bora\u030as", "A\u030are", "Malmo\u0308"]) == ["Borås", "Åre", "Malmö"]
    assert apply(names.nfc_any_script, ["n\u0303", "o\u0308"]) == ["ñ", "ö"]


def test_normalize_municipality(apply):
    given = ["Eslövs kommun", "MALMÖ STAD", f"Lunds{NBSP}kommun", "Borås", "  Åre\t", "Växjö kommun"]
    assert apply(names.normalize_municipality, given) == ["eslöv", "malmö", "lund", "borå", "åre", "växjö"]


def test_domains_keep_the_known_exceptions(apply):
    given = ["Ängelholms", "Karlshamns", "Upplands Väsby", "Stockholms", "Dals-Eds", "Västerås", "Hällefors"]
    assert apply(names.municipality_to_domain, given) == [
        "engelholm.se", "karlshamn.se", "upplandsvasby.se", "start.stockholm", "dalsed.se", "vastera.se", "hallefor.se"]
    assert apply(lambda c: names.municipality_to_domain(c, exceptions_first=True), ["Hällefors"]) == ["hellefors.se"]


def test_sanitize_and_mangled(apply):
    assert apply(names.sanitize_name, ["Upplands Väsby", "a---b", "-test-", "", "Höör"]) == ["upplands-vasby", "a-b", "test", "", "hoor"]
    assert apply(names.is_mangled_name, ["åMåL", "åRe", "Åmål", "Dals-Ed"]) == [True, True, False, False]


def test_page_text(apply):
    pages = [
        "<p>Ett</p><SCRIPT>x<p></SCRIPT><p>Två &amp; tre &lt;4&gt; &quot;5&quot;</p>",
        "Rad1<br>Rad2<br/>Rad3", "<nav>Meny</nav><main>Innehåll</main><footer>Fot</footer><!-- c -->",
        "<p>  för   många    blanksteg  </p>", f"{NBSP}<p>a</p>\n\n\n\n<p>b&#229;</p>", ""]
    assert apply(html.to_text, pages) == [
        'Ett\n Två & tre <4> "5"'.replace("\n ", "\n"), "Rad1\nRad2\nRad3", "Innehåll", "för många blanksteg", "a\n\nb", ""]


def test_strip_keeps_tags(apply):
    given = ['<link rel="x"><meta a="b"><style>.x{}</style><svg><r/></svg><!-- c --><img src="p.jpg"><p>Kvar     här</p>']
    assert apply(html.strip_non_content, given) == ["<p>Kvar här</p>"]


def test_links_are_resolved(spark):
    page = (
        '<a href="/a/../b">B <b>fet</b></a><a href="sida?x=1#d">S</a><a href="//cdn.example/å z">C</a><a href="#x">nej</a>'
        '<a href="javascript:f()">nej</a><a class="k" href="HTTPS://Annan.Example">Annan</a><a href="?p=2">P</a><a href="../upp">U</a>')
    df = spark.createDataFrame([("https://www.ort.example/mapp/sub/index.html?q=1", page)], "url string, html string")
    got = {r["text"]: r["href"] for r in html.extract_links(df).collect()}
    assert got == {
        "B fet": "https://www.ort.example/b", "S": "https://www.ort.example/mapp/sub/sida?x=1#d",
        "C": "https://cdn.example/%C3%A5%20z", "Annan": "https://annan.example/",
        "P": "https://www.ort.example/mapp/sub/index.html?p=2", "U": "https://www.ort.example/mapp/upp"}


def test_same_site_and_hints(spark):
    rows = [("https://ort.example/a",), ("https://sub.ort.example/b",), ("https://annan.example/c",),
            ("https://www.ort.example/d.PDF",), ("https://minort.example/e",)]
    df = spark.createDataFrame(rows, "u string")
    got = df.select(urls.same_site(F.col("u"), F.lit("https://www.ort.example/x"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, False]
    hint = html.href_matches_hints(F.col("u"), F.lit("a[href*='/a'], a[href*='B']"))
    assert [r[0] for r in df.select(hint).collect()] == [True, False, True, False, False]


def test_platforms(apply):
    pages = ['<div class="SV-Portlet">', '<meta content="EPiServer">', '<link href="/wp-content/x">', "<p>ren</p>"]
    assert apply(html.detect_platform, pages) == ["sitevision", "episerver", "wordpress", "unknown"]


def test_source_kinds(apply):
    given = ["https://a.example/#!/billboard/", "https://FORUM.ort.se/x", "https://www.netpublicator.com/bulletinboard/public/1", "https://b.example"]
    assert apply(lambda c: urls.source_kind(c, F.lit(False)), given) == ["ciceron", "meetingplus", "netpublicator", "http"]
    assert apply(lambda c: urls.source_kind(c, F.lit(True)), given[3:]) == ["browser"]


def test_composition_of_any_script_is_that_of_the_library(spark):
    rng = random.Random(1)
    _, classes, pairs = composition._tables()
    marks, starters = list(classes), [*"aouAÅÄn", *(p[0] for p in pairs), *map(chr, (0x1112, 0xAC00, 0xAC01, 0x3131, 0x212B, 0x2126, 0xF73, 0x1F71, 0xF900, 0x1D15E))]
    joining = [p[1] for p in pairs] + [chr(0x1161), chr(0x11A8), chr(0x11A7)]
    texts = ["", "abc", None, "é" * 3, "\r\né\x00", chr(0x323) + chr(0x302), "x" * 5000 + "e" + chr(0x301)]
    texts += ["".join(rng.choice(rng.choice((starters, marks, joining))) for _ in range(rng.randint(1, 8))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    made = df.select("i", composition.nfc_any(F.col("t")).alias("t"))
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()[:100_000].split("LocalTableScan")[0]
    got = [r["t"] for r in made.orderBy("i").collect()]
    assert got == [t if t is None else unicodedata.normalize("NFC", t) for t in texts]


def test_composition_of_long_texts_takes_one_pass(spark):
    """A stretch of many marks took time with its square, and every marked segment its own lambdas."""
    texts = ["a" + chr(0x301) * 20_000 + chr(0x323), ("e" + chr(0x301) + " ") * 200_000, (chr(0x1112) + chr(0x1161) + chr(0x11AB)) * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    made = df.select("i", composition.nfc_any(F.col("t")).alias("t"))
    assert "lambda" not in made._jdf.queryExecution().executedPlan().toString().split("LocalTableScan")[0]
    assert [r["t"] for r in made.orderBy("i").collect()] == [unicodedata.normalize("NFC", t) for t in texts]
