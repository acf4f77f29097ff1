"""Verticals: the enumerations, keywords and thresholds operators are run with."""

from __future__ import annotations

from dataclasses import dataclass, field

# Enumerations, keyword lists and lookup tables that results depend on.
PERMIT_TYPES = (
    "bygglov", "marklov", "rivningslov", "förhandsbesked", "strandskyddsdispens", "anmälan",
)
STATUSES = ("ansökt", "beviljat", "avslag", "överklagat", "startbesked", "slutbesked")
PERMIT_KEYWORDS = (
    "bygglov", "rivningslov", "marklov", "förhandsbesked", "plan- och bygglagen", "pbl",
    "kungörelse om beslut i lov", "strandskyddsdispens", "bygganmälan",
)
URL_PATTERNS = (
    "/anslagstavla", "/kungorelser", "/bygglov/anslagstavla", "/bygga-bo/anslagstavla",
    "/bygga-bo-miljo/anslagstavla", "/kommun/anslagstavla", "/nyheter-och-press/anslagstavla",
    "/politik-och-paverkan/anslagstavla",
)
PLATFORM_TEMPLATES = {
    "sitevision": (
        "/nyheter-och-press/anslagstavla", "/politik/anslagstavla", "/kommun/anslagstavla",
        "/bygga-bo/anslagstavla",
    ),
    "episerver": ("/bygga-bo/anslagstavla", "/anslagstavla"),
    "wordpress": ("/anslagstavla", "/kungorelser"),
    "municipio": ("/anslagstavla", "/kungorelser"),
}
PLATFORM_SIGNATURES = {
    "sitevision": ("sitevision", "sv-portlet", "sv-layout", "sv-template", "/sitevision/"),
    "episerver": ("episerver", "epi-", "optimizely"),
    "wordpress": ("wp-content", "wp-includes", "wordpress"),
    "municipio": ("municipio", "developer.flavor"),
    "netpublicator": ("netpublicator", "digicomm"),
    "meetingsplus": ("meetingsplus", "meetings plus", "digital-bulletin-board", "/api/dbb/"),
}
PBL_TYPE_KEYWORDS = (
    "plan- och bygglagen", "bygglov", "bygganmälan", "förhandsbesked", "rivningslov", "marklov",
    "strandskyddsdispens", "lovbeslut", "lovansökning", "kungörelse lov",
)
BUILDING_DIARIES = ("STBYGG", "STADSBYGG", "BYGG", "BYGGLOV", "SBN", "MBN", "SAMBYGG")
BILLBOARD_PATTERN = (
    "bygglov|rivningslov|marklov|förhandsbesked|strandskydd|bygganmälan|nybyggnad|tillbyggnad"
    "|ombyggnad|fasadändring|rivning"
)
NOTICE_CATEGORY_PATTERN = "milj|samhällsbygg|bygg|plan|stadsbygg|mbn|msn"
NOTICE_TEXT_PATTERN = (
    "bygglov|rivningslov|marklov|förhandsbesked|strandskydd|grannhöran|lovansök"
    "|meddelande om.*lov|kungörelse.*lov|beslut.*lov|plan- och bygg"
)
ORGANISATION_PATTERN = (
    r"\b(AB|HB|KB|BRF|Brf|kommun|region|stiftelse|förening|fastigheter|bostäder|exploatering)\b"
)
HEALTH_CHECK_KEYWORDS = (
    "bygglov", "ansökan", "beviljat", "fastighetsbeteckning", "diarienummer", "byggnadsnämnden",
    "startbesked", "marklov", "rivningslov",
)
DOMAIN_EXCEPTIONS = {
    "ängelholm": "engelholm.se", "härjedalen": "herjedalen.se", "hällefors": "hellefors.se",
    "stockholm": "start.stockholm", "falun": "falun.se", "falu": "falun.se",
    "mora": "morakommun.se", "habo": "habokommun.se", "dals-ed": "dalsed.se",
    "falkenberg": "kommun.falkenberg.se", "värnamo": "kommun.varnamo.se",
}
NAME_ALIASES = {"falu": "falun"}
STATUS_MATURITY = {
    "ansökt": "rumor", "beviljat": "planned", "startbesked": "planned", "slutbesked": "awarded",
    "överklagat": "rumor",
}
RELEVANT_CPV = ("45", "71", "44")
NUTS_COUNTY = {
    "SE110": "Stockholms län", "SE121": "Uppsala län", "SE122": "Södermanlands län",
    "SE123": "Östergötlands län", "SE124": "Örebro län", "SE125": "Västmanlands län",
    "SE211": "Jönköpings län", "SE212": "Kronobergs län", "SE213": "Kalmar län",
    "SE214": "Gotlands län", "SE221": "Blekinge län", "SE224": "Skåne län",
    "SE231": "Hallands län", "SE232": "Västra Götalands län", "SE311": "Värmlands län",
    "SE312": "Dalarnas län", "SE313": "Gävleborgs län", "SE321": "Västernorrlands län",
    "SE322": "Jämtlands län", "SE331": "Västerbottens län", "SE332": "Norrbottens län",
}
PLACE_COUNTY = {
    "stockholm": "Stockholms län", "solna": "Stockholms län", "kista": "Stockholms län",
    "flemingsberg": "Stockholms län", "uppsala": "Uppsala län", "ultuna": "Uppsala län",
    "göteborg": "Västra Götalands län", "lund": "Skåne län", "malmö": "Skåne län",
    "alnarp": "Skåne län", "linköping": "Östergötlands län", "norrköping": "Östergötlands län",
    "umeå": "Västerbottens län", "luleå": "Norrbottens län",
}
# US dollars per token: (input, output).
TOKEN_PRICES = {
    "claude-haiku-4-5-20251001": ("0.0000008", "0.000004"),
    "claude-sonnet-4-6": ("0.000003", "0.000015"),
    "claude-opus-4-7": ("0.000005", "0.000025"),
}
FALLBACK_PRICE = ("0.0000008", "0.000004")
EUR_TO_SEK = 11.5
MIN_CONTENT_BYTES = 500
MAX_CONTENT_CHARS = 100_000


@dataclass(frozen=True)
class Vertical:
    """What differs between the kinds of records that share the operators."""

    name: str
    required_fields: tuple[str, ...]
    allowed_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    numeric_ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    field_mapping: dict[str, str] = field(default_factory=dict)
    keywords: tuple[str, ...] = ()
    default_source_type: str | None = None
    stale_days: int = 14
    stale_days_sparse: int = 28
    anomaly_ratio: float = 0.5
    anomaly_min_difference: int = 3
    zero_streak_threshold: int = 3
    active_minimum: int = 5
    #: the column that names the source, the primary id, the key on which loads conflict, and the
    #: columns by which rows without primary id are told apart
    source_field: str = "municipality"
    primary: str = "case_number"
    conflict_key: tuple[str, ...] = ("municipality", "case_number")
    dedup_fields: tuple[str, ...] = ("municipality", "address", "date")
    #: columns of the place table that are added to records, and their names there
    enrichment: dict[str, str] = field(default_factory=dict)
    #: columns that may only name organisations
    organisation_fields: tuple[str, ...] = ()


PERMITS = Vertical(
    name="permits",
    required_fields=("case_number", "address", "permit_type", "status"),
    allowed_values={"permit_type": PERMIT_TYPES, "status": STATUSES},
    field_mapping={
        "municipality": "municipality", "case_number": "case_number", "address": "address",
        "permit_type": "permit_type", "status": "status", "date": "date",
        "description": "description", "applicant": "applicant", "property": "property",
        "source_url": "source_url",
    },
    keywords=PERMIT_KEYWORDS,
    enrichment={"county": "lan"},
    organisation_fields=("applicant",),
)

_SIGNAL_FIELDS = (
    "organization_name", "title", "maturity", "amount_sek", "timeline", "description",
    "source_url", "source_date", "region", "category", "source_type", "source_excerpt",
)
#: how signals are loaded, and the least difference that is an anomaly among them
_SIGNALS = {
    "source_field": "organization_name", "primary": "source_url", "conflict_key": ("organization_id", "source_url", "title"),
    "dedup_fields": ("organization_name", "title", "source_date"), "anomaly_ratio": 1.0, "anomaly_min_difference": 2,
}
ANNUAL_REPORTS = Vertical(
    name="annual_reports",
    required_fields=("title", "description", "maturity", "amount_sek", "region"),
    allowed_values={"maturity": ("planned", "tender", "awarded")},
    numeric_ranges={"amount_sek": (1_000_000, 50_000_000_000)},
    field_mapping={f: f for f in _SIGNAL_FIELDS},
    keywords=(
        "investering", "projekt", "ombyggnad", "renovering", "nybyggnad", "investeringsram",
        "mkr", "mdr", "miljoner", "miljarder", "upparbetad", "fardigstallande",
    ),
    zero_streak_threshold=999,
    stale_days=270,
    stale_days_sparse=540,
    **_SIGNALS,
)
PROJECT_PAGES = Vertical(
    name="project_pages",
    required_fields=("title", "description", "maturity", "region"),
    allowed_values={"maturity": ("planned", "tender", "awarded")},
    numeric_ranges={"amount_sek": (1_000_000, 50_000_000_000)},
    field_mapping={f: f for f in (*_SIGNAL_FIELDS, "property_designation", "ai_summary")},
    keywords=("projekt", "byggprojekt", "stadsutveckling", "nybyggnad", "ombyggnad", "utveckling"),
    default_source_type="project_page",
    zero_streak_threshold=7,
    stale_days=90,
    stale_days_sparse=180,
    **_SIGNALS,
)
PRESSROOM = Vertical(
    name="pressroom",
    required_fields=("title", "description", "maturity", "region"),
    allowed_values={"maturity": ("rumor", "planned", "tender", "awarded")},
    numeric_ranges={"amount_sek": (1_000_000, 50_000_000_000)},
    field_mapping={f: f for f in (*_SIGNAL_FIELDS, "property_designation", "ai_summary")},
    keywords=(
        "byggprojekt", "renovering", "restaurering", "ombyggnad", "tillbyggnad", "investering",
        "upphandling", "entreprenor", "forvarv", "fastighet", "kontrakt", "miljoner", "miljarder",
        "mkr", "mdr", "projektering", "detaljplan", "byggstart",
    ),
    default_source_type="pressroom",
    stale_days=21,
    stale_days_sparse=42,
    **_SIGNALS,
)
