"""Projections and filters over pages, links, records and sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions import blocks, html, names, records, urls
from noticeworks.functions.text import blank_to_null, with_once
from noticeworks.functions.times import moment
from noticeworks.operators.ordering import first_wins, top_per_group


def map_fields(df: DataFrame, mapping: Mapping[str, str], zero_is_null: bool = True) -> DataFrame:
    """Extracted fields under their column names; empty values become null."""
    types = dict(df.dtypes)

    def value(field: str) -> Column:
        if field not in types:
            return F.lit(None).cast("string")
        c = F.col(field)
        if types[field] == "string":
            return blank_to_null(c)
        if types[field] == "boolean":
            return F.when(c, c)
        if zero_is_null and types[field] in ("int", "bigint", "double", "float"):
            return F.when(c != 0, c)
        return c

    mapped = [value(f).alias(t) for f, t in mapping.items()]
    kept = [c for c in df.columns if c not in mapping and c not in mapping.values()]
    return df.select(*kept, *mapped)


def add_metadata(df: DataFrame, model: str, batch_hash: str | None, page_hash: str = "page_hash") -> DataFrame:
    return df.withColumns({
        "extraction_model": F.lit(model),
        "extraction_cost_usd": F.lit(None).cast("decimal(10,8)"),
        "raw_html_hash": F.coalesce(F.col(page_hash), F.lit(batch_hash)),
    })


def default_fields(df: DataFrame, page_url: str, override: str, default_source_type: str | None) -> DataFrame:
    """Fills the source URL from the page and the source type from the configuration."""
    return df.withColumns({
        "source_url": F.coalesce(blank_to_null(F.col("source_url")), F.col(page_url)),
        "source_type": F.coalesce(
            blank_to_null(F.col("source_type")), blank_to_null(F.col(override)), F.lit(default_source_type)),
    })


def legacy_flag(df: DataFrame, created: str, cut_over: datetime) -> DataFrame:
    return df.withColumn("is_legacy", F.col(created) < moment(cut_over))


def filter_by_name_list(df: DataFrame, name: str, wanted: str) -> DataFrame:
    return df.where(names.name_in_list(F.col(name), wanted))


def route_source_kind(df: DataFrame, url: str = "listing_url") -> DataFrame:
    return df.withColumn("kind", urls.source_kind(F.col(url), F.col("needs_browser")))


def keyword_filter(df: DataFrame, text: str, keywords: Iterable[str]) -> DataFrame:
    return df.where(html.has_keyword(F.col(text), keywords))


def domain_filter(links: DataFrame, href: str, site_url: str, order: Iterable[str]) -> DataFrame:
    """Links inside the configured site, each address once per page."""
    inside = links.where(urls.same_site(F.col(href), F.col(site_url)))
    return first_wins(inside, [site_url, href], [F.col(c) for c in order])


def href_pattern_filter(links: DataFrame, href: str, selector: str) -> DataFrame:
    return links.where(html.href_matches_hints(F.col(href), F.col(selector)))


def gate_and_hash(pages: DataFrame, content: str = "content",
                  minimum: int = config.MIN_CONTENT_BYTES) -> DataFrame:
    """Content hash of every page, or the error of pages too small to be hashed."""
    big = F.octet_length(F.col(content)) >= minimum
    return pages.withColumns({
        "content_hash": F.when(big, html.content_hash(F.col(content))),
        "error": F.when(~big, "content_too_small"),
    })


def min_content_gate(pages: DataFrame, content: str = "content",
                     minimum: int = config.MIN_CONTENT_BYTES) -> DataFrame:
    return pages.where(F.octet_length(F.col(content)) >= minimum)


def flag_unchanged(pages: DataFrame, hashes: DataFrame, force: bool = False) -> DataFrame:
    """Adds ``skipped``: a verified source's page whose stored hash equals the new one."""
    stored = hashes.select("source", "url", F.col("content_hash").alias("_stored"))
    same = F.col("verified") & (F.col("_stored") == F.col("content_hash"))
    skipped = F.lit(False) if force else F.coalesce(same, F.lit(False))
    return pages.join(stored, ["source", "url"], "left").withColumn("skipped", skipped).drop("_stored")


def unchanged_page_filter(pages: DataFrame, hashes: DataFrame, force: bool = False) -> DataFrame:
    return flag_unchanged(pages, hashes, force).where(~F.col("skipped")).drop("skipped")


def source_status(flagged: DataFrame) -> DataFrame:
    """Per source: pages read and skipped; all skipped means the source is unchanged."""
    return flagged.groupBy("source").agg(
        F.count_if("skipped").alias("skipped_pages"),
        F.count_if(~F.col("skipped")).alias("read_pages"),
        F.when(F.bool_and("skipped"), "unchanged").otherwise("changed").alias("status"),
    )


def require_technical_fields(df: DataFrame, identifying: str, created: str, cut_over: date) -> DataFrame:
    """Adds the reasons why a record may not be stored; an empty list means it may."""
    reasons = F.array_compact(F.array(
        F.when(blank_to_null(F.col(identifying)).isNull(), "missing_identifier"),
        F.when(blank_to_null(F.col("source_url")).isNull(), "missing_source_url"),
        F.when(
            (F.col(created) >= moment(datetime(cut_over.year, cut_over.month, cut_over.day)))
            & blank_to_null(F.col("page_hash")).isNull(), "missing_page_hash"),
    ))
    return df.withColumn("drop_reasons", reasons)


def storable(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("drop_reasons") == 0).drop("drop_reasons")


def drop_reason_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("drop_reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("records"))


def status_is_rejected(df: DataFrame) -> DataFrame:
    """Records left after rejected ones are dropped; unknown statuses stay without a stage."""
    return df.where(~records.is_rejected(F.col("status"))).withColumn(
        "maturity", records.status_to_maturity(F.col("status")))


def split_verified(plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes to apply (source never verified) and changes to review."""
    verified = F.coalesce(F.col("was_verified"), F.lit(False))
    return plan.where(~verified), plan.where(verified)


def ungrouped_split(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signals without a project: permits and all others, those of unknown type among them."""
    open_ones = signals.where(F.col("project_id").isNull())
    permit = F.coalesce(F.col("source_type"), F.lit("")) == "permit"
    return open_ones.where(permit), open_ones.where(~permit)


def keep_identified(df: DataFrame) -> DataFrame:
    return df.where(F.col("permit_type").isNotNull() | F.col("case_number").isNotNull())


def null_invalid_enums(df: DataFrame, allowed: Mapping[str, Iterable[str]]) -> DataFrame:
    return df.withColumns({f: records.allowed_or_null(F.col(f), v) for f, v in allowed.items()})


def null_out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({f: F.when(F.col(f).between(*r), F.col(f)) for f, r in ranges.items()})


def union_records(*frames: DataFrame) -> DataFrame:
    """Records of all readers; columns a reader lacks are null."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def distinct_links(links: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    return first_wins(links, list(keys), [F.col(c) for c in order])


def pages_per_source_limit(pages: DataFrame, limit: int) -> DataFrame:
    return top_per_group(pages, ["source"], [F.col("pos"), F.col("url")], limit)


def sample_first_n(df: DataFrame, source: str, order: Iterable[str], n: int = 3) -> DataFrame:
    return top_per_group(df, [source], [F.col(c) for c in order], n, rank="sample_no")


def in_name_order(df: DataFrame, name: str, limit: int) -> DataFrame:
    return df.orderBy(name).limit(limit)


def task_order(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("status") == "pending").orderBy("priority", "created_at", "id")


def parse_model_response(df: DataFrame, response: str, schema: str) -> DataFrame:
    """Records of a model's answer; an answer that is not a JSON list gives none."""
    bare = F.regexp_replace(F.regexp_replace(F.col(response), r"```json\s*", ""), r"```\s*", "")
    rest = [c for c in df.columns if c != response]
    return df.select(*rest, F.posexplode(F.from_json(bare, schema)).alias("pos", "r")).select(*rest, "pos", "r.*")


def split_subpages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The pages that were joined by ``<!-- SUBPAGE: url -->`` marks, each with its ``source_url`` and ``part``.

    What stands before the first mark belongs to the page's own URL; an empty beginning gives no row.
    """
    rest = [c for c in pages.columns if c != html]
    parts = pages.select(*rest, F.posexplode(F.split(F.col(html), r"(?i)(?=<!--\s*SUBPAGE:)")).alias("part", html))
    own = F.regexp_extract(html, r"(?i)^<!--\s*SUBPAGE:\s*(\S+?)\s*-->", 1)
    return parts.withColumn("source_url", F.coalesce(F.nullif(own, F.lit("")), F.col(url))).where(F.col(html) != "")


def labelled_fields(pages: DataFrame, source_html: str = "html") -> DataFrame:
    """One record per notice block of a page: a heading, table row, list item or card with a case number.

    Blocks nest, see ``blocks.blocks_of``; what stands in a block without a number of its own is read
    with the block around it.
    """
    rest = [c for c in pages.columns if c != source_html]
    found = pages.select(*rest, F.posexplode(blocks.notice_blocks(F.col(source_html))).alias("pos", "_block"))
    texts = with_once(found, text=html.to_text(F.col("_block"))).drop("_block")
    numbered = texts.where(records.has_case_number(F.col("text")))
    parsed = with_once(numbered, r=records.labelled_block(F.col("text")))
    return parsed.where(F.col("r.case_number").isNotNull()).select(*rest, "pos", "r.*")


def skip_news(items: DataFrame, title: str = "title") -> DataFrame:
    return items.where(records.skipped_news(F.col(title)).isNull())
