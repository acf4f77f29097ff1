"""Place and organisation names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions.composition import nfc_any
from noticeworks.functions.text import SPACE, any_of, compose, fold, let, lookup, strip


def nfc(c: Column) -> Column:
    return compose(c)


def nfc_any_script(c: Column) -> Column:
    """Canonical composition beyond the letters ``nfc`` knows."""
    return nfc_any(c)


def _without_suffixes(c: Column) -> Column:
    c = F.regexp_replace(c, rf"(?iu)s?{SPACE}+kommun\z", "")
    return F.regexp_replace(c, rf"(?iu)s?{SPACE}+stad\z", "")


def normalize_municipality(c: Column) -> Column:
    return F.regexp_replace(_without_suffixes(strip(F.lower(compose(c)))), r"s\z", "")


def strip_municipality_suffix(c: Column) -> Column:
    """Suffixes and genitive s removed, case kept."""
    return strip(F.regexp_replace(_without_suffixes(compose(c)), r"s\z", ""))


def normalize_to_ascii(c: Column) -> Column:
    return F.regexp_replace(fold(c), rf"{SPACE}+", "")


def municipality_to_domain(c: Column, exceptions_first: bool = False) -> Column:
    """Expected host name.

    One final s is dropped before the exception table is consulted, so names that
    end in s themselves miss it; ``exceptions_first`` looks the whole name up first.
    """
    whole = F.lower(strip(compose(c)))
    stem = F.lower(strip(F.regexp_replace(compose(c), r"s\z", "")))
    regular = F.concat(normalize_to_ascii(stem), F.lit(".se"))
    found = lookup(stem, config.DOMAIN_EXCEPTIONS)
    if exceptions_first:
        found = F.coalesce(lookup(whole, config.DOMAIN_EXCEPTIONS), found)
    return F.coalesce(found, regular)


def sanitize_name(c: Column) -> Column:
    dashed = F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9-]", "-"), "-+", "-")
    return F.regexp_replace(dashed, r"^-|-\z", "")


def sanitize_ascii_name(c: Column) -> Column:
    """As ``sanitize_name`` but with white space dropped instead of dashed."""
    return sanitize_name(normalize_to_ascii(c))


def letters_key(c: Column) -> Column:
    return F.regexp_replace(normalize_to_ascii(c), "[^a-z]", "")


def is_mangled_name(c: Column) -> Column:
    return c.rlike("[a-zåäö][A-ZÅÄÖ]") | c.rlike("^[åäö][A-Z]")


def health_name_key(c: Column) -> Column:
    """The name key of the health report: region prefix and two suffixes removed."""
    for pattern in (r"(?iu)^Region\s+", r"(?iu)\s+kommun\z", r"(?iu)\s+stad\z"):
        c = F.regexp_replace(c, pattern, "")
    return F.lower(c)


def candidate_hostnames(c: Column) -> Column:
    """Home pages worth trying for a name, most likely first."""
    domain = municipality_to_domain(c)
    ascii_name = normalize_to_ascii(c)
    no_hyphen = normalize_to_ascii(F.replace(c, F.lit("-"), F.lit("")))
    hyphenated = fold(F.regexp_replace(c, rf"{SPACE}+", "-"))

    def both(name: Column) -> Column:
        return F.array(
            F.concat(F.lit("https://www."), name, F.lit(".se")),
            F.concat(F.lit("https://"), name, F.lit(".se")),
        )

    none = F.array().cast("array<string>")
    return F.array_distinct(
        F.concat(
            F.array(
                F.concat(F.lit("https://www."), F.regexp_replace(domain, r"\.se\z", ""), F.lit(".se")),
                F.concat(F.lit("https://"), domain),
            ),
            both(ascii_name),
            F.array(F.concat(F.lit("https://www."), ascii_name, F.lit(".kommun.se"))),
            F.when(F.contains(c, F.lit("-")), both(no_hyphen)).otherwise(none),
            F.when(F.contains(c, F.lit(" ")), both(hyphenated)).otherwise(none),
        )
    )


def page_mentions_name(name: Column, page: Column) -> Column:
    """Does the page contain a part of the name of at least three letters?"""
    parts = F.filter(F.split(F.lower(name), r"[\s-]+"), lambda p: F.length(p) >= 3)
    return let(F.lower(page), lambda text: F.exists(parts, lambda p: F.contains(text, p)))


def name_in_list(c: Column, wanted: str) -> Column:
    """Case-insensitive "contains any" against a comma separated list."""
    return let(F.lower(c), lambda t: any_of(t, [w.strip().lower() for w in wanted.split(",")]))
