"""Loads that count what they do in the pass that does it.

The counts are observed metrics: Spark sums them while the rows go by on their way to the
target, so neither the batch nor what was stored is read again. Observe a result that is written by
one action; where a lost executor makes Spark repeat tasks of a shuffle, repeated rows may be counted again,
while the rows written are right. Where counts must be exact then, use ``loading.insert_counts`` and
``shaping.drop_reason_counts`` on stored rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from noticeworks.operators import loading, shaping

#: What ``shaping.require_technical_fields`` may say.
DROP_REASONS = ("missing_identifier", "missing_source_url", "missing_page_hash")


class ObservedLoad(NamedTuple):
    """Rows to append, and what is known when they have been written."""

    to_append: DataFrame
    offered: Observation
    stored: Observation

    def counts(self) -> dict[str, int]:
        """Waits for the write: offered, storable, inserted, skipped, and dropped by reason."""
        offered, inserted = self.offered.get, self.stored.get["inserted"]
        return {**offered, "inserted": inserted, "skipped": offered["storable"] - inserted}


def observed_load(checked: DataFrame, target: DataFrame, primary: str, key: Sequence[str], dedup: Sequence[str], order: Sequence[str]) -> ObservedLoad:
    """``loading.insert_in_one_pass`` of the storable rows of a checked batch, with counts.

    ``checked`` has ``drop_reasons`` from ``shaping.require_technical_fields``. A record with several
    reasons counts for each.
    """
    offered, stored = Observation(), Observation()
    dropped = [F.count_if(F.array_contains("drop_reasons", r)).alias(r) for r in DROP_REASONS]
    seen = checked.observe(offered, F.count(F.lit(1)).alias("offered"), F.count_if(F.size("drop_reasons") == 0).alias("storable"), *dropped)
    new = loading.insert_in_one_pass(target, shaping.storable(seen).select(*target.columns), key, order, primary, dedup)
    return ObservedLoad(new.observe(stored, F.count(F.lit(1)).alias("inserted")), offered, stored)


class ObservedFilter(NamedTuple):
    """Rows of a run that passed a test, and what is known when they have been written."""

    rows: DataFrame
    seen: Observation
    kept: Observation

    def counts(self) -> dict[str, int]:
        """Waits for the write: fetched, relevant and inserted."""
        return {**self.seen.get, **self.kept.get}


def observed_relevant(fetched: DataFrame, relevant: Column, target: DataFrame, key: Sequence[str], order: Sequence[str]) -> ObservedFilter:
    """Fetched rows that are relevant and new to the target, with counts of all three.

    Tells how many rows of a run were fetched, how many were about the subject, and how many the
    target did not have.
    """
    seen, kept = Observation(), Observation()
    counted = fetched.withColumn("_relevant", F.coalesce(relevant, F.lit(False))).observe(
        seen, F.count(F.lit(1)).alias("fetched"), F.count_if("_relevant").alias("relevant"))
    new = loading.insert_in_one_pass(target, counted.where("_relevant").drop("_relevant"), key, order)
    return ObservedFilter(new.observe(kept, F.count(F.lit(1)).alias("inserted")), seen, kept)
