"""Cross-matching: permits against properties, tenders of organisations, signals into projects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.operators import boards, keyed_tables, loading, lookups, matching

SIGNAL_KEY = ("organization_id", "source_url", "title")


def property_signals(permits: DataFrame, properties: DataFrame, organizations: DataFrame) -> DataFrame:
    named = lookups.org_name_lookup(matching.match_properties(permits, properties), organizations)
    return matching.permit_signals(named)


def tender_signals(organizations: DataFrame, tenders: DataFrame, site: str) -> DataFrame:
    owned = lookups.notices_by_org(
        organizations.select("organization_id", F.col("name").alias("organization_name")), tenders)
    return boards.procurement_signals(owned, site)


def store_signals(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The signal table after new signals overwrote those with the same key.

    Of several new ones with one key the latest wins, among those of one day the one that
    arrived last.
    """
    return loading.upsert_merge(stored, new, SIGNAL_KEY, ["source_date", "arrival"])


def merge_signals(stored: keyed_tables.KeyedTable, new: DataFrame) -> list[int]:
    """As ``store_signals``, into a table laid out by ``SIGNAL_KEY``: reads and swaps the touched buckets only."""
    return keyed_tables.merge(stored, new, ["source_date", "arrival"])
