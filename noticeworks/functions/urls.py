"""URL parts, resolution and normal forms, as native expressions.

Patterns are used instead of ``try_parse_url`` where a URL with unusual
characters must still give its host.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks.functions.text import blank_to_null, extract, let

_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:"
_BINARY = r"(?i)\.(pdf|doc|docx|xlsx|xls|zip|png|jpg|jpeg|gif)\z"


def scheme(url: Column) -> Column:
    return F.lower(extract(url, "^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))


def host(url: Column) -> Column:
    """Lower-cased host without port and credentials; null when there is none."""
    return F.lower(extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    """Path of an absolute URL; a missing path is ``/``."""
    raw = F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(host(url).isNotNull(), F.coalesce(blank_to_null(raw), F.lit("/")))


def origin(url: Column) -> Column:
    """Scheme and host with port, as the URL spells them."""
    return extract(url, "^(https?://[^/]+)", 1)


def board_id(url: Column) -> Column:
    return extract(url, "(?i)/bulletinboard/public/([0-9a-f-]{36})", 1)


def _without_dot_segments(p: Column) -> Column:
    """Resolve ``.`` and ``..`` in a path that starts with a slash."""
    parts = F.split(F.substr(p, F.lit(2)), "/")
    ends_open = p.rlike(r"/\.{1,2}\z")

    def step(done: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(part == ".", done)
            .otherwise(F.concat(done, F.array(part)))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(ends_open & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def _percent_encoded(c: Column) -> Column:
    """Blanks and non-ASCII letters percent-encoded, everything else untouched."""
    letters = F.transform(
        F.split(c, ""),
        lambda ch: F.when(ch == " ", F.lit("%20"))
        .when(F.ascii(ch) > 127, F.url_encode(ch))
        .otherwise(ch),
    )
    return F.when(c.rlike(r"[^\x21-\x7e]"), F.array_join(letters, "")).otherwise(c)


def resolve(href: Column, base: Column) -> Column:
    """Absolute form of a link found on the page ``base``."""
    site = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_path = path(base)
    folder = F.regexp_replace(base_path, r"[^/]*\z", "")
    tail = F.regexp_extract(href, r"([?#].*)\z", 1)
    own_path = F.regexp_replace(href, r"[?#].*\z", "")

    def tidy(p: Column) -> Column:
        return F.when(p.rlike(r"/\.{1,2}(/|\z)"), _without_dot_segments(p)).otherwise(p)

    absolute = F.concat(
        F.lower(F.regexp_extract(href, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)),
        tidy(path(href)),
        tail,
    )
    return let(
        F.when(href.rlike("(?i)^https?://"), absolute)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, tidy(own_path), tail))
        .when(href.startswith("?"), F.concat(site, base_path, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*\z", ""), href))
        .otherwise(F.concat(site, tidy(F.concat(folder, own_path)), tail)),
        _percent_encoded,
    )


def same_site(url: Column, site_url: Column) -> Column:
    """Neither a binary file nor outside the host (or sub-domains) of ``site_url``."""
    h, wanted = bare_host(url), bare_host(site_url)
    inside = (h == wanted) | h.endswith(F.concat(F.lit("."), wanted))
    return ~url.rlike(_BINARY) & F.coalesce(inside, F.lit(False))


def normalize(url: Column) -> Column:
    """Host without www plus path without trailing slashes, lower-cased."""
    parsed = F.concat(bare_host(url), F.regexp_replace(path(url), r"/+\z", ""))
    rough = F.regexp_replace(
        F.regexp_replace(F.lower(url), r"^https?://(www\.)?", ""), r"/+\z", ""
    )
    return F.coalesce(F.lower(parsed), rough, F.lit(""))


def normalize_loosely(url: Column) -> Column:
    """As ``normalize`` with page extensions and numeric CMS suffixes dropped."""
    p = F.regexp_replace(path(url), r"/+\z", "")
    p = F.regexp_replace(F.regexp_replace(p, r"\.html?\z", ""), r"\.\d[\w.]*", "")
    return F.coalesce(F.lower(F.concat(bare_host(url), p)), F.lower(url), F.lit(""))


def classify_change(old: Column, new: Column) -> Column:
    """minor_diff when both URLs lead to the same page, otherwise upgrade."""
    minor = (normalize(old) == normalize(new)) | (normalize_loosely(old) == normalize_loosely(new))
    return F.when(minor, F.lit("minor_diff")).otherwise(F.lit("upgrade"))


def candidates(homepage: Column, platform: Column, patterns: Iterable[str],
               templates: dict[str, Iterable[str]]) -> Column:
    """Listing pages to try: the platform's own templates first, then the general ones."""
    site = F.concat(F.concat(scheme(homepage), F.lit("://")),
                    F.lower(extract(homepage, "^[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#@]+)", 1)))
    own = F.array().cast("array<string>")
    for name, paths in templates.items():
        own = F.when(platform == name, F.array(*[F.lit(p) for p in paths])).otherwise(own)
    every = F.array_distinct(F.concat(own, F.array(*[F.lit(p) for p in patterns])))
    return F.when(site.isNotNull(), F.transform(every, lambda p: F.concat(site, p))).otherwise(
        F.array().cast("array<string>")
    )


def source_kind(url: Column, needs_browser: Column) -> Column:
    """Which reader a listing URL belongs to; the first kind that applies wins."""
    low = F.lower(url)
    return (
        F.when(F.contains(url, F.lit("#!/billboard")) | F.contains(url, F.lit("ciceron")), "ciceron")
        .when(
            F.contains(low, F.lit("/digital-bulletin-board"))
            | F.contains(low, F.lit("meetingsplus."))
            | low.rlike(r"forum\.[a-zåäö-]+\.se")
            | F.contains(low, F.lit(".ondemand.formpipe.com")),
            "meetingplus",
        )
        .when(low.rlike(r"netpublicator\.com/bulletinboard"), "netpublicator")
        .when(needs_browser, "browser")
        .otherwise("http")
    )


def http_class(status: Column) -> Column:
    return (
        F.when(status.between(200, 299), "live")
        .when(status.between(300, 399), "redirect")
        .when(status == 404, "not_found")
        .when(status.between(400, 499), "client_error")
        .when(status >= 500, "server_error")
        .otherwise("error")
    )
