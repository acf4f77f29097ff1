"""HTML pages to text, links and scores, as native expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions import urls
from noticeworks.functions.text import any_of, let, squeeze, strip, words_found

# The replacements that turn markup into text, in order.
_INVISIBLE = tuple(rf"(?i)<{tag}[\s\S]*?</{tag}>" for tag in ("script", "style", "svg"))
_FRAME = tuple(rf"(?i)<{tag}[\s\S]*?</{tag}>" for tag in ("nav", "header", "footer"))
_COMMENT = r"<!--[\s\S]*?-->"
_HEAD_TAGS = tuple(rf"(?i)<{tag}[^>]*>" for tag in ("link", "meta", "img"))
_ANCHOR = r"""(?i)<a\s[^>]*href="([^"]*)"[^>]*>([\s\S]*?)</a>"""
_ENTITIES = {"&nbsp;": " ", "&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"'}
_NOTICE_ENTITIES = {
    "&#228;": "ä", "&#246;": "ö", "&#229;": "å", "&#196;": "Ä", "&#214;": "Ö", "&#197;": "Å",
    "&#233;": "é", "&#252;": "ü", "&#167;": "§", "&#160;": " ", "&amp;": "&", "&lt;": "<",
    "&gt;": ">", "&quot;": '"', "&#39;": "'",
}


def _drop(c: Column, patterns: Iterable[str], by: str = "") -> Column:
    for pattern in patterns:
        c = F.regexp_replace(c, pattern, by)
    return c


def _plain_entities(c: Column) -> Column:
    for entity, char in _ENTITIES.items():
        c = F.regexp_replace(c, f"(?i){entity}", char)
    return F.regexp_replace(c, r"&#\d+;", "")


def visible(html: Column) -> Column:
    """The markup without scripts, styles, frames of the site and comments."""
    return _drop(html, (*_INVISIBLE, *_FRAME, _COMMENT))


def to_text(html: Column) -> Column:
    c = visible(html)
    c = _drop(c, (r"(?i)<br\s*/?>", r"(?i)</(?:p|div|h[1-6]|li|tr|dt|dd|section|article)>"), "\n")
    c = F.regexp_replace(c, "<[^>]+>", " ")
    c = let(c, lambda t: F.when(F.contains(t, F.lit("&")), _plain_entities(t)).otherwise(t))
    # A single blank is already what it would be replaced by.
    c = F.regexp_replace(c, r"[ \t]{2,}|\t", " ")
    c = F.regexp_replace(c, r"\n[ \t]+", "\n")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def strip_non_content(html: Column) -> Column:
    return strip(_drop(_drop(html, (*_INVISIBLE, _COMMENT, *_HEAD_TAGS)), (r"\s{2,}",), " "))


def decode_entities(c: Column) -> Column:
    decoded = c
    for entity, char in _NOTICE_ENTITIES.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def truncate(c: Column, limit: int = config.MAX_CONTENT_CHARS) -> Column:
    return F.left(c, F.lit(limit))


def content_hash(c: Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def anchors(html: Column) -> Column:
    """Array of ``{href, text}`` as written, fragments and scripts left out."""
    found = F.transform(
        F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0)),
        lambda a: F.struct(
            F.regexp_extract(a, _ANCHOR, 1).alias("href"),
            squeeze(F.regexp_replace(F.regexp_extract(a, _ANCHOR, 2), "<[^>]+>", " ")).alias("text"),
        ),
    )
    return F.filter(found, lambda a: (a["href"] != "") & ~a["href"].rlike("^(#|javascript:)"))


def absolute_anchors(html: Column, url: Column) -> Column:
    """As ``anchors`` with the links resolved against the page's address."""
    return F.transform(
        anchors(html),
        lambda a: F.struct(urls.resolve(a["href"], url).alias("href"), a["text"].alias("text")))


def extract_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per link: the page's other columns, ``pos``, absolute ``href``, ``text``."""
    rest = [c for c in pages.columns if c != html]
    links = absolute_anchors(F.col(html), F.col(url))
    return pages.select(*rest, F.posexplode(links).alias("pos", "link")).select(*rest, "pos", "link.*")


def selector_hints(selector: Column) -> Column:
    """The ``x`` of every ``href*='x'`` in a selector."""
    return F.regexp_extract_all(selector, F.lit(r"href\*='([^']+)'"), F.lit(1))


def href_matches_hints(href: Column, selector: Column) -> Column:
    """True when the selector names no hint or one of them occurs in the lower-cased link."""
    hints = selector_hints(selector)
    low = F.lower(href)
    return (F.coalesce(F.size(hints), F.lit(0)) == 0) | F.exists(hints, lambda h: F.contains(low, h))


def has_keyword(c: Column, keywords: Iterable[str]) -> Column:
    return let(F.lower(c), lambda t: any_of(t, keywords))


def detect_platform(html: Column, signatures: dict[str, Iterable[str]] | None = None) -> Column:
    """First platform one of whose signatures occurs in the page, else unknown."""
    def first(low: Column) -> Column:
        found = None
        for name, words in (signatures or config.PLATFORM_SIGNATURES).items():
            test = any_of(low, [w.lower() for w in words])
            found = F.when(test, name) if found is None else found.when(test, name)
        return found.otherwise("unknown")

    return let(F.lower(html), first)


def matched_terms(c: Column, terms: Iterable[str]) -> Column:
    return words_found(F.lower(c), terms)


def link_terms(text: Column, href: Column, terms: Iterable[str]) -> Column:
    """Search terms that occur in the text or in the address of a link."""
    both = F.concat(F.lower(text), F.lit("\n"), F.lower(href))
    return words_found(both, terms)


def match_confidence(hits: Column) -> Column:
    return F.when(hits >= 2, "high").when(hits >= 1, "medium").otherwise("low")


def is_meetingplus_page(html: Column) -> Column:
    return has_keyword(html, config.PLATFORM_SIGNATURES["meetingsplus"])


def sitemap_urls(xml: Column) -> Column:
    found = F.regexp_extract_all(xml, F.lit(r"(?i)<loc>\s*(https?://[^<]+?)\s*</loc>"), F.lit(1))
    return F.transform(found, strip)
