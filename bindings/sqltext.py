"""SQL spellings of text rules, for the comparison queries."""

from __future__ import annotations


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(expr: str, *steps: tuple[str, str, str]) -> str:
    """Nested replacements: (pattern, replacement expression, flags)."""
    for pattern, by, flags in steps:
        expr = f"regexp_replace({expr}, {q(pattern)}, {by}, '{flags}')"
    return expr


def trim(expr: str) -> str:
    return rx(expr, (r"^\s+|\s+$", "''", "g"))


def null_if_blank(expr: str) -> str:
    return f"nullif({expr}, '')"


def extract(expr: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({expr}, {q(pattern)}, {group}), '')"


def fold(expr: str) -> str:
    return f"translate(lower(nfc_normalize({expr})), 'åäöéü', 'aaoeu')"


def ascii_name(expr: str) -> str:
    return rx(fold(expr), (r"\s+", "''", "g"))


def letters(expr: str) -> str:
    return rx(ascii_name(expr), ("[^a-z]", "''", "g"))


def normal_place(expr: str) -> str:
    return rx(trim(f"lower(nfc_normalize({expr}))"), (r"s?\s+kommun$", "''", "i"), (r"s?\s+stad$", "''", "i"), ("s$", "''", ""))


def stripped_place(expr: str) -> str:
    return trim(rx(f"nfc_normalize({expr})", (r"s?\s+kommun$", "''", "i"), (r"s?\s+stad$", "''", "i"), ("s$", "''", "")))


def sanitized(expr: str) -> str:
    return rx(fold(expr), ("[^a-z0-9-]", "'-'", "g"), ("-+", "'-'", "g"), ("^-|-$", "''", "g"))


def hash16(expr: str) -> str:
    return f"substring(sha256({expr}), 1, 16)"


def block(tag: str) -> tuple[str, str, str]:
    return (rf"<{tag}[\s\S]*?</{tag}>", "''", "gi")


INVISIBLE = [block(t) for t in ("script", "style", "svg")]
COMMENT = (r"<!--[\s\S]*?-->", "''", "g")


def page_text(expr: str) -> str:
    return trim(rx(
        expr, *INVISIBLE, *[block(t) for t in ("nav", "header", "footer")], COMMENT,
        (r"<br\s*/?>", "chr(10)", "gi"), (r"</(?:p|div|h[1-6]|li|tr|dt|dd|section|article)>", "chr(10)", "gi"),
        ("<[^>]+>", "' '", "g"), ("&nbsp;", "' '", "gi"), ("&amp;", "'&'", "gi"), ("&lt;", "'<'", "gi"),
        ("&gt;", "'>'", "gi"), ("&quot;", "'\"'", "gi"), (r"&#\d+;", "''", "g"), (r"[ \t]+", "' '", "g"),
        (r"\n[ \t]+", "chr(10)", "g"), (r"\n{3,}", "chr(10) || chr(10)", "g")))


def stripped(expr: str) -> str:
    return trim(rx(expr, *INVISIBLE, COMMENT, ("<link[^>]*>", "''", "gi"), ("<meta[^>]*>", "''", "gi"),
                   ("<img[^>]*>", "''", "gi"), (r"\s{2,}", "' '", "g")))


ANCHOR = r"""<a\s[^>]*href="([^"]*)"[^>]*>([\s\S]*?)</a>"""
ENCODED = (
    "array_to_string(list_transform(string_split({0}, ''), lambda x: CASE WHEN regexp_matches(x, '^[\\x21-\\x7e]$') "
    "THEN x WHEN x = ' ' THEN '%20' ELSE url_encode(x) END), '')"
)


def resolved(href: str, base: str) -> str:
    """Links of the test pages are root-relative or absolute."""
    site = f"regexp_extract({base}, '^[a-z]+://[^/?#]*')"
    return ENCODED.format(f"CASE WHEN {href} LIKE 'http%' THEN {href} ELSE {site} || {href} END")


LINKS = f"""links AS (
  SELECT page_id, url, pos, {resolved('raw', 'url')} AS href, text FROM (
    SELECT page_id, url, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS raw,
      unnest(list_transform(texts, lambda x: {trim(rx('x', ('<[^>]+>', "' '", 'g'), (chr(92) + 's+', "' '", 'g')))})) AS text
    FROM (SELECT page_id, url, regexp_extract_all(html, {q('(?i)' + ANCHOR)}, 1) AS hrefs,
            regexp_extract_all(html, {q('(?i)' + ANCHOR)}, 2) AS texts FROM pages))
  WHERE raw <> '' AND raw NOT LIKE '#%' AND raw NOT LIKE 'javascript:%')"""


def host(expr: str) -> str:
    return f"lower({extract(expr, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)')})"


def bare_host(expr: str) -> str:
    return rx(host(expr), (r"^www\.", "''", ""))


def path(expr: str) -> str:
    return f"coalesce({extract(expr, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)')}, '/')"


def normal_url(expr: str) -> str:
    return f"lower({bare_host(expr)} || {rx(path(expr), ('/+$', chr(39) * 2, ''))})"


def loose_url(expr: str) -> str:
    steps = rx(path(expr), ("/+$", "''", ""), (r"\.html?$", "''", ""), (r"\.\d[\w.]*", "''", "g"))
    return f"lower({bare_host(expr)} || {steps})"


def any_word(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {q(w)})" for w in words) + ")"


def word_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def permit_class(expr: str) -> str:
    t = f"lower({expr})"
    return f"""CASE WHEN contains({t}, 'rivningslov') OR (contains({t}, 'rivning') AND NOT contains({t}, 'bygglov')) THEN 'rivningslov'
      WHEN contains({t}, 'marklov') THEN 'marklov' WHEN contains({t}, 'förhandsbesked') THEN 'förhandsbesked'
      WHEN contains({t}, 'strandskydd') THEN 'strandskyddsdispens' WHEN contains({t}, 'anmälan') THEN 'anmälan'
      WHEN {any_word(t, ('bygglov', 'nybyggnad', 'tillbyggnad', 'ombyggnad', 'fasadändring'))} THEN 'bygglov' END"""


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"
