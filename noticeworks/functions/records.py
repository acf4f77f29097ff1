"""Column functions that read record fields out of notice texts and payloads."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from noticeworks import config
from noticeworks.functions.html import decode_entities
from noticeworks.functions.text import any_of, blank_to_null, extract, fold, let, lookup, round_half_up, strip

# Patterns the parsed fields follow.
_PROPERTY = r"([A-ZÅÄÖ][a-zåäöé-]+(?:[\s-]+\d+:\d+)?(?:\s+m\.?\s*fl\.?)?)"
_STREETS = "vägen|gatan|gränd|torget|platsen|stigen|allén|backen"
_STREETS_IN_TITLE = "vägen|gatan|gränd|stigen"
_NOTICE_LINE = r"(?iu)^([A-ZÅÄÖ][A-ZÅÄÖ\s-]+\d+(?::\d+)?)\s*(?:\(([^)]+)\))?\s*-\s*(.+)\z"
_DESIGNATION = r"\b([A-ZÅÄÖ][A-Za-zÅÄÖåäöé-]*(?: [A-ZÅÄÖ][A-Za-zÅÄÖåäöé-]*)* \d+:\d+)"
CASE_LABEL = r"(?iu)(?:diarienummer|diarienr|dnr|ärendenummer)\s*:\s*([^\n,—]+)"
CASE_SHAPE = r"\b([A-ZÅÄÖ]{2,5}[ /-]\d{4}[/-]\d+|\d{4}-\d{6})\b"
_PROPERTY_LABEL = r"(?iu)(?:fastighetsbeteckning|fastighet)\s*:\s*([^\n,]+)"
_ADDRESS_LABEL = r"(?iu)(?:gatuadress|adress)\s*:\s*([^\n,]+)"
_APPLICANT_LABEL = r"(?iu)sökande\s*:\s*([^\n—]+)"
_DATE_LABEL = r"(?iu)(?:beslutsdatum|datum)\s*:\s*(\d{4}-\d{2}-\d{2})"
_MEASURE_LABEL = r"(?iu)åtgärd\s*:\s*([^\n]+)"
_ORGANISATION_NAME = r"(?iu)\b(AB|HB|KB|BRF|kommun|region|stiftelse\p{L}*|\p{L}*förening|fastigheter|bostäder|exploatering)\b"
_AMOUNT = r"(?iu)(\d+(?:[ \u00a0.]\d{3})*(?:,\d+)?)\s*(mkr|mdr|miljoner|miljarder)\b"
_AMOUNT_UNITS = {"mkr": "1000000", "miljoner": "1000000", "mdr": "1000000000", "miljarder": "1000000000"}

# The fields of a place that name its region, in the order they are looked at.
REGION_FIELDS = ("nuts", "code", "nutsCode", "nuts-code", "value")

# Phrases by class; the first class with a phrase in the text applies.
EXPLICIT_TYPES = (
    ("strandskyddsdispens", ("strandskydd",)),
    ("förhandsbesked", ("forhandsbesked",)),
    ("rivningslov", ("rivningslov",)),
    ("marklov", ("marklov",)),
    ("anmälan", ("anmalan", "anmalningsarende")),
    ("bygglov", ("bygglov",)),
)
IMPLIED_TYPES = (
    ("anmälan", (
        "eldstad", "kamin", "installation av kassett", "ventilation", "barande", "planlossning",
        "va-installation", "installation av hiss", "ytterligare bostad", "inredning av vind",
        "attefall",
    )),
    ("rivningslov", ("rivning",)),
    ("marklov", ("schaktning", "utfyllnad", "tradfall", "terrassering")),
    ("bygglov", (
        "nybyggnad", "tillbyggnad", "ombyggnad", "andrad anvandning", "fasadandring",
        "farg pa fasad", "skylt", "ljusanordning", "uppforande av", "inglasning av balkong",
    )),
)
STATUS_PHRASES = (
    ("slutbesked", ("slutbesked",)),
    ("startbesked", ("startbesked",)),
    ("överklagat", ("overklagat", "overklagande", "under provning")),
    ("avslag", ("avslag", "nekat", "negativt forhandsbesked")),
    ("beviljat", (
        "beviljat", "beviljade", "bifall", "beslut om lov", "beslutat", "godkant",
        "positivt forhandsbesked",
    )),
    ("ansökt", (
        "inkommet", "inkommen ansokan", "under handlaggning", "remiss", "grannehorande",
        "ansokan om",
    )),
)
REPORT_STAGES = (
    ("awarded", ("fardigstall", "slutredovisa")),
    ("tender", ("pagaende",)),
    ("planned", ("planera", "beslutat")),
)
PAGE_STAGES = (
    ("planned", ("planerat", "kommande", "forberedelse")),
    ("tender", ("upphandling", "anbud")),
    ("awarded", ("byggs", "pagaende bygge", "produktion", "fardigt", "slutfort", "inflyttat")),
)
_BUILDING_NEWS = r"(?iu)\b(bygger|nybyggnation|nybyggnad|ombyggnad|bygger om|renover\w*)"
_SKIPPED_NEWS = {
    "letting": r"(?iu)\b(hyr ut|hyr|uthyrning|flyttar in)\b",
    "report": r"(?iu)(\bQ[1-4]\b|delårsrapport|kvartalsrapport|bokslutskommuniké)",
    "award": r"(?iu)(prisutdelning|tilldelas pris|utmärkelse)",
    "sponsorship": r"(?iu)sponsr",
}


def first_class(c: Column, rules) -> Column:
    """Class of the first rule one of whose phrases occurs in the text, else null."""
    found = None
    for name, phrases in rules:
        test = any_of(c, phrases)
        found = F.when(test, name) if found is None else found.when(test, name)
    return found


def classify_permit_type(c: Column) -> Column:
    def first(t: Column) -> Column:
        def has(*words: str) -> Column:
            return any_of(t, words)

        return (
            F.when(has("rivningslov") | (has("rivning") & ~has("bygglov")), "rivningslov")
            .when(has("marklov"), "marklov")
            .when(has("förhandsbesked"), "förhandsbesked")
            .when(has("strandskydd"), "strandskyddsdispens")
            .when(has("anmälan"), "anmälan")
            .when(has("bygglov", "nybyggnad", "tillbyggnad", "ombyggnad", "fasadändring"), "bygglov")
        )

    return let(F.lower(c), first)


def status_from_type_name(c: Column) -> Column:
    t = F.lower(c)
    return (
        F.when(any_of(t, ("beviljade", "beslut")), "beviljat")
        .when(any_of(t, ("inför", "ansökan")), "ansökt")
        .otherwise("beviljat")
    )


def status_from_text(c: Column) -> Column:
    rules = (
        ("ansökt", ("grannhöran", "underrättelse", "lovansökning", "remiss")),
        ("avslag", ("avslag",)),
        ("överklagat", ("överklag",)),
        ("startbesked", ("startbesked",)),
        ("slutbesked", ("slutbesked",)),
    )
    return F.coalesce(let(F.lower(c), lambda t: first_class(t, rules)), F.lit("beviljat"))


def phrase_type(c: Column) -> Column:
    return let(
        fold(c), lambda t: F.coalesce(first_class(t, EXPLICIT_TYPES), first_class(t, IMPLIED_TYPES)))


def phrase_status(c: Column) -> Column:
    return let(fold(c), lambda t: first_class(t, STATUS_PHRASES))


def parse_billboard_title(title: Column) -> Column:
    """``PLACE - text`` or ``… fastigheten PLACE`` as struct ``{address, description}``."""
    dash = r"^(.+?)\s*-\s*(.+)\z"

    def parts(clean: Column) -> Column:
        return F.struct(
            F.when(clean.rlike(dash), strip(F.regexp_extract(clean, dash, 1)))
            .otherwise(blank_to_null(strip(F.regexp_extract(clean, r"(?iu)fastigheten\s+(.+)", 1))))
            .alias("address"),
            F.when(clean.rlike(dash), strip(F.regexp_extract(clean, dash, 2)))
            .otherwise(clean)
            .alias("description"),
        )

    return let(strip(F.regexp_replace(title, "\n", " ")), parts)


def parse_notice_description(c: Column) -> Column:
    """``PROPERTY (ADDRESS) - text`` as struct ``{property, address, description}``."""
    def parts(clean: Column) -> Column:
        shaped = clean.rlike(_NOTICE_LINE)

        def part(group: int) -> Column:
            return F.when(shaped, blank_to_null(strip(F.regexp_extract(clean, _NOTICE_LINE, group))))

        return F.struct(
            part(1).alias("property"),
            part(2).alias("address"),
            F.when(shaped, part(3)).otherwise(blank_to_null(clean)).alias("description"),
        )

    clean = F.regexp_replace(F.regexp_replace(decode_entities(c), r"(?i)<br\s*/?>", ""), "\r", "")
    return let(strip(clean), parts)


def announcement_property(title: Column, description: Column) -> Column:
    own_title = F.when(strip(title).rlike(r"^[A-ZÅÄÖ][A-ZÅÄÖ\s-]+\d"), strip(title))
    return F.coalesce(
        strip(extract(title, rf"(?iu)inom(?:\s+fastigheten)?\s+{_PROPERTY}")),
        strip(extract(description, rf"(?iu)fastigheten\s+{_PROPERTY}")),
        own_title,
    )


def announcement_street(title: Column, description: Column) -> Column:
    return F.coalesce(
        strip(extract(description, rf"(?iu)\(([^)]+(?:{_STREETS})[^)]*)\)")),
        strip(extract(title, rf"(?iu)\(([^)]+(?:{_STREETS_IN_TITLE})[^)]*)\)")),
    )


def announcement_case_number(description: Column) -> Column:
    return strip(extract(description, r"[Dd]iarienr(?:ummer)?:\s*([^\n,]+)"))


def announcement_text(title: Column) -> Column:
    c = F.regexp_replace(title, r"(?iu)^kung[öo]relse:\s*", "")
    return blank_to_null(strip(F.regexp_replace(c, r"(?iu)^anslag:\s*", "")))


def organisation_applicant(description: Column) -> Column:
    """The applicant when it is an organisation; private persons are never kept."""
    name = strip(extract(description, r"(?iu)(?:sökande|byggherre):\s*([^\n]+)"))
    return F.when(name.rlike("(?iu)" + config.ORGANISATION_PATTERN), name)


def notice_case_number(text: Column) -> Column:
    found = strip(extract(text, r"(?iu)diarienummer:\s*([^\s.]+(?:\s+[\d-]+)?)"))
    return F.regexp_replace(found, r"\.\z", "")


def property_designation(c: Column) -> Column:
    """``NAME n:n`` when written out in the text, never guessed."""
    return extract(c, _DESIGNATION)


def has_case_number(text: Column) -> Column:
    return text.rlike(CASE_LABEL) | text.rlike(CASE_SHAPE)


def labelled_block(text: Column) -> Column:
    """Fields of one notice block, by label first and by shape second."""
    name = strip(extract(text, _APPLICANT_LABEL))
    return F.struct(
        strip(F.coalesce(extract(text, CASE_LABEL), extract(text, CASE_SHAPE))).alias("case_number"),
        strip(F.coalesce(extract(text, _PROPERTY_LABEL), property_designation(text))).alias("property"),
        strip(extract(text, _ADDRESS_LABEL)).alias("address"),
        strip(extract(text, _MEASURE_LABEL)).alias("description"),
        F.coalesce(
            extract(text, _DATE_LABEL), extract(text, r"\b(\d{4}-\d{2}-\d{2})\b")
        ).alias("date"),
        F.when(name.rlike(_ORGANISATION_NAME), name).alias("applicant"),
        phrase_type(text).alias("permit_type"),
        phrase_status(text).alias("status"),
    )


def parse_sek(c: Column) -> Column:
    """First amount written with a unit, in kronor."""
    number = F.regexp_replace(extract(c, _AMOUNT, 1), r"[ \u00a0.]", "")
    number = F.replace(number, F.lit(","), F.lit(".")).try_cast("decimal(18,6)")
    unit = lookup(F.lower(extract(c, _AMOUNT, 2)), _AMOUNT_UNITS).cast("decimal(18,0)")
    return round_half_up((number * unit).cast("double"))


def progress_to_maturity(done_pct: Column, text: Column, stages=REPORT_STAGES,
                         default: str | None = None) -> Column:
    by_word = F.coalesce(let(fold(text), lambda t: first_class(t, stages)), F.lit(default))
    return (
        F.when(done_pct < 10, "planned")
        .when(done_pct <= 90, "tender")
        .when(done_pct > 90, "awarded")
        .otherwise(by_word)
    )


def place_to_county(place: Column) -> Column:
    return F.coalesce(
        lookup(F.lower(strip(place)), config.PLACE_COUNTY), F.concat(strip(place), F.lit(" län"))
    )


def skipped_news(title: Column) -> Column:
    """Why a press item is left out; null when it is kept."""
    reason = F.when(title.rlike(_BUILDING_NEWS), F.lit(None).cast("string"))
    for name, pattern in _SKIPPED_NEWS.items():
        reason = reason.when(title.rlike(pattern), name)
    return reason


def excerpt(c: Column, limit: int = 10_000) -> Column:
    """The text, beyond the limit cut after its last whole sentence."""
    cut = F.left(c, F.lit(limit))
    sentence = extract(cut, r"^([\s\S]*[.!?])")
    return F.when(F.length(c) <= limit, blank_to_null(c)).otherwise(F.coalesce(sentence, cut))


def summary_allowed(excerpt_text: Column, summary: Column, minimum: int = 300) -> Column:
    return F.when(F.length(excerpt_text) > minimum, summary)


def status_to_maturity(status: Column) -> Column:
    return lookup(F.lower(strip(status)), config.STATUS_MATURITY)


def is_rejected(status: Column) -> Column:
    return F.coalesce(F.lower(strip(status)) == "avslag", F.lit(False))


def property_from_title(title: Column) -> Column:
    return blank_to_null(strip(F.regexp_extract(title, r"^.+?\s*—\s*(.+)\z", 1)))


def pick_language(texts: Column, limit: int, default: str | None = None) -> Column:
    found = F.coalesce(blank_to_null(texts["swe"]), blank_to_null(texts["eng"]), F.lit(default))
    return F.left(found, F.lit(limit))


def convert_amount(value: Column, currency: Column, rates: dict[str, float] | None = None) -> Column:
    """Whole kronor; a currency without a rate of its own is taken as euro."""
    number = extract(value, r"^\s*([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)").try_cast("double")
    rate = F.when(F.coalesce(blank_to_null(currency), F.lit("SEK")) == "SEK", F.lit(1.0))
    for code, value_in_sek in (rates or {}).items():
        rate = rate.when(currency == code, F.lit(value_in_sek))
    return round_half_up(number * rate.otherwise(F.lit(config.EUR_TO_SEK)))


def date_part(c: Column) -> Column:
    return F.left(c, F.lit(10)).try_cast("date")


def relevant_cpv(codes: Column) -> Column:
    return codes.isNull() | F.exists(codes, lambda c: F.left(c, F.lit(2)).isin(*config.RELEVANT_CPV))


def map_category(codes: Column, description: Column) -> Column:
    """Category of a tender by its first code; construction work by its description."""
    text = F.lower(F.coalesce(description, F.lit("")))
    works = (
        F.when(text.rlike("bost[aä]d|l[aä]genhet|student"), "residential")
        .when(text.rlike("skol|sjukhus|kultur|idrot|universite|campus"), "public")
        .when(text.rlike("v[aä]g|bro|tunnel|va-|vatten|avlopp"), "infrastructure")
        .otherwise("commercial")
    )
    return F.when(F.get(codes, F.lit(0)).startswith("45"), works).otherwise("commercial")


def _region_codes(place: object) -> Iterator[str]:
    """Swedish region codes of a parsed place, the one that counts first."""
    for item in place if isinstance(place, list) else [place]:
        if isinstance(item, str):
            yield from [item] if item[:2].upper() == "SE" else []
        elif isinstance(item, (dict, list)):
            fields = item if isinstance(item, dict) else dict(enumerate(item))
            yield from (v for v in map(fields.get, REGION_FIELDS) if isinstance(v, str) and v[:2].upper() == "SE")
            for value in fields.values():
                if isinstance(value, (dict, list)):
                    yield from _region_codes(value)
                elif isinstance(value, str) and re.fullmatch(r"(?i)SE[0-9]{3}", value):
                    yield value


def _first_region_code(place: str) -> str | None:
    try:
        return next(_region_codes(json.loads(place)), None)
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def _nested_region_code(places: pd.Series) -> pd.Series:
    """Each different place of a batch is parsed once."""
    return places.map({p: _first_region_code(p) for p in places.dropna().unique()}).astype(object)


def nuts_code(place: Column) -> Column:
    """First Swedish region code in a place given as a string, object or nested array.

    In an object the fields that name a region come before all others, and before what is nested
    in it, wherever they stand. Objects and arrays nest without bound, so they are walked
    in Python; text that is no JSON, or nested a thousand deep, has no code.
    """
    bare = F.regexp_extract(place, r'(?i)^\s*"?(SE[^"\[{]*?)"?\s*\z', 1)
    nested = place.rlike(r"^\s*[\[{]")
    return F.upper(blank_to_null(F.coalesce(_nested_region_code(F.when(nested, place)), F.when(~nested, bare))))


def nuts_county(code: Column) -> Column:
    return lookup(code, config.NUTS_COUNTY)


def usage_cost(model: Column, tokens_in: Column, tokens_out: Column) -> Column:
    def price(side: int) -> Column:
        table = {name: prices[side] for name, prices in config.TOKEN_PRICES.items()}
        found = F.coalesce(lookup(model, table), F.lit(config.FALLBACK_PRICE[side]))
        return found.cast("decimal(12,10)")

    return tokens_in.cast("decimal(18,0)") * price(0) + tokens_out.cast("decimal(18,0)") * price(1)


def allowed_or_null(c: Column, allowed) -> Column:
    return F.when(c.isin(*allowed), c)


def thousands(c: Column) -> Column:
    """Digits grouped by no-break spaces."""
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit("\u00a0"))
