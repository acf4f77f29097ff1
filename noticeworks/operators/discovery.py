"""Finding the listing page of a source among candidates, links and site maps."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions import html, urls
from noticeworks.functions.names import name_in_list, page_mentions_name
from noticeworks.functions.text import with_once
from noticeworks.operators.ordering import top_per_group

METHODS = ("url_variants", "crawl_homepage", "sitemap")


def candidate_union(places: DataFrame, homepage: str = "homepage", platform: str = "platform",
                    patterns: Iterable[str] = config.URL_PATTERNS, templates=None) -> DataFrame:
    """One row per URL to try, platform templates before general patterns."""
    tried = urls.candidates(F.col(homepage), F.col(platform), patterns, templates or config.PLATFORM_TEMPLATES)
    return places.select("*", F.posexplode(tried).alias("position", "candidate_url"))


def score_page_terms(pages: DataFrame, terms: Sequence[str], page: str = "html") -> DataFrame:
    found = with_once(pages, matched_terms=html.matched_terms(F.col(page), terms))
    return found.withColumn("hits", F.size("matched_terms"))


def score_links(links: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Links with at least one search term in text or address."""
    scored = with_once(links, matched_terms=html.link_terms(F.col("text"), F.col("href"), terms))
    return scored.withColumn("hits", F.size("matched_terms")).where(F.col("hits") > 0)


def score_sitemap_urls(found: DataFrame, terms: Sequence[str], url: str = "url") -> DataFrame:
    scored = with_once(found, matched_terms=html.matched_terms(F.col(url), terms))
    return scored.withColumn("hits", F.size("matched_terms")).where(F.col("hits") > 0)


def best_candidate(scored: DataFrame, source: str, position: str = "position") -> DataFrame:
    """First candidate with two terms or more, else the one with most terms, the earlier on a tie."""
    strong = F.col("hits") >= 2
    order = [strong.desc(), F.when(strong, F.lit(0)).otherwise(F.col("hits")).desc(), F.col(position)]
    return top_per_group(scored.where(F.col("hits") > 0), [source], order, 1)


def best_link(scored: DataFrame, source: str, position: str = "pos") -> DataFrame:
    return top_per_group(scored, [source], [F.col("hits").desc(), F.col(position)], 1)


def top_alternatives(scored: DataFrame, source: str, position: str = "pos") -> DataFrame:
    """The three runners-up of the best link."""
    return top_per_group(
        scored, [source], [F.col("hits").desc(), F.col(position)], 4, rank="rank", skip=1)


def discovery_ladder(source: str, *found: DataFrame) -> DataFrame:
    """Per source the first method, in the given order, that found a page."""
    steps = [
        df.select(source, "url", "hits", F.lit(METHODS[i]).alias("method"), F.lit(i).alias("step"))
        for i, df in enumerate(found)
    ]
    merged = steps[0]
    for s in steps[1:]:
        merged = merged.unionByName(s)
    best = top_per_group(merged, [source], [F.col("step")], 1)
    return best.drop("step").withColumn("confidence", html.match_confidence(F.col("hits")))


def platform_distribution(pages: DataFrame, platform: str = "platform") -> DataFrame:
    """Pages per platform and their share of all pages."""
    counted = pages.groupBy(platform).agg(F.count("*").alias("n"))
    total = pages.agg(F.count("*").alias("c")).scalar()
    return counted.withColumn("pct", F.round(100.0 * F.col("n") / total, 1))


def verification_decision(results: DataFrame, approve_browser: bool = False) -> DataFrame:
    """Outcome of a verification run: records found, keywords without records, or neither.

    ``approve_browser`` also approves sources that merely need a browser.
    """
    verified = F.coalesce(F.col("result_count") > 0, F.lit(False))
    needs_browser = ~verified & F.col("has_keyword")
    approved = verified | needs_browser if approve_browser else verified
    status = (
        F.when(verified, "verified").when(needs_browser, "needs_browser")
        .when(F.col("error").startswith("HTTP "), "http_error").otherwise("failed"))
    return results.withColumns(
        {"verified": verified, "needs_browser": needs_browser, "approved": approved, "status": status})


def rediscovery_decision(found: DataFrame, manual_after: int = 3) -> DataFrame:
    """What follows from a rediscovery: nothing found, same URL again, or a new URL to approve."""
    nothing = F.col("new_url").isNull()
    same = F.col("new_url").eqNullSafe(F.col("previous_url")) & ~nothing
    approve = ~nothing & ~same & F.coalesce(F.col("verified") & (F.col("verify_result_count") > 0), F.lit(False))
    count = F.coalesce("stale_rediscovery_count", F.lit(0))
    new_count = F.when(same, count + 1).when(approve, 0).otherwise(count)
    return found.withColumns({
        "success": approve,
        "new_stale_count": new_count,
        "manual_review": same & (count + 1 >= manual_after),
        "error": F.when(nothing, "discovery found no URL").when(same, "same URL found, skipping")
        .when(~approve, "verification failed"),
    })


def zero_result_escalation(results: DataFrame) -> DataFrame:
    """Sources that gave nothing over HTTP are handed to the browser."""
    escalated = (F.col("records") == 0) & ~F.col("needs_browser")
    return results.withColumn("status", F.when(escalated, "escalated").otherwise("ok"))


def homepage_name_check(places: DataFrame, name: str, page: str) -> DataFrame:
    return places.withColumn("name_found", page_mentions_name(F.col(name), F.col(page)))


def select_sources(sources: DataFrame, wanted: str | None) -> DataFrame:
    return sources if wanted is None else sources.where(name_in_list(F.col("name"), wanted))


def check_urls(responses: DataFrame, keywords: Iterable[str] = config.HEALTH_CHECK_KEYWORDS,
               body: str = "body") -> DataFrame:
    """Class and keywords of logged responses."""
    text = F.lower(F.col(body))
    return responses.withColumns({
        "classification": urls.http_class(F.col("status")),
        "keyword_hits": html.matched_terms(text, list(keywords))})
