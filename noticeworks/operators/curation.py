"""Cleaning of the source list: duplicates, mangled names and changed URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.functions import names, urls
from noticeworks.functions.text import with_once
from noticeworks.operators.lookups import mangled_to_reference, match_seed_to_source


def duplicate_groups(configs: DataFrame) -> DataFrame:
    """Members of groups that share the same letters, one row each, with the group's size.

    Groups are counted before the shuffle and joined back, so a name that many rows have is split
    like any hot key of a join.
    """
    keyed = with_once(configs, letters=names.letters_key(F.col("name")))
    sizes = keyed.groupBy("letters").agg(F.count("*").alias("members")).where(F.col("members") > 1)
    return keyed.join(sizes, "letters").select(*keyed.columns, "members")


def plan_duplicate_deletions(configs: DataFrame, reference: DataFrame) -> DataFrame:
    """Configurations to delete because a better one of their group stays.

    A group with two reference names is left alone.  Otherwise the reference name
    stays, else the first approved configuration, else the first.
    """
    known = reference.select("name").distinct().withColumn("is_reference", F.lit(True))
    keyed = configs.withColumn("letters", names.letters_key(F.col("name"))).join(known, "name", "left").withColumn(
        "is_reference", F.coalesce("is_reference", F.lit(False)))
    place = F.struct("name", "id")
    plan = keyed.groupBy("letters").agg(
        F.count("*").alias("members"), F.count_if("is_reference").alias("references"),
        F.min(F.when(F.col("is_reference"), place)).alias("_correct"),
        F.min(F.when(F.col("approved"), place)).alias("_approved"), F.min(place).alias("_first"),
    ).where((F.col("members") > 1) & (F.col("references") <= 1)).select(
        "letters", F.coalesce("_correct", "_approved", "_first").alias("keep"),
        F.col("_correct").isNotNull().alias("has_reference"))
    return keyed.join(plan, "letters").where(F.col("id") != F.col("keep.id")).select(
        "id", "name", F.col("keep.name").alias("kept_name"),
        F.when(F.col("has_reference"), "duplicate of reference name").otherwise("duplicate (no reference match)").alias("reason"))


def plan_renames(configs: DataFrame, reference: DataFrame, deletions: DataFrame) -> DataFrame:
    """Mangled names that stay and have a reference spelling."""
    remaining = configs.join(deletions.select("id"), "id", "left_anti")
    return mangled_to_reference(remaining, reference).select("id", "name", F.col("reference_name").alias("new_name"))


def plan_duplicate_fix(configs: DataFrame, reference: DataFrame) -> DataFrame:
    deletions = plan_duplicate_deletions(configs, reference)
    renames = plan_renames(configs, reference, deletions)
    return deletions.select("id", "name", F.lit("delete").alias("action"), F.lit(None).cast("string").alias("new_name")).unionByName(
        renames.select("id", "name", F.lit("rename").alias("action"), "new_name"))


def plan_url_changes(seeds: DataFrame, sources: DataFrame) -> DataFrame:
    """Listed URLs against configured ones: created, skipped, minor_diff or upgrade."""
    matched = match_seed_to_source(seeds, "name", sources, "source").join(
        sources.select(
            F.col("source").alias("matched_source"), F.col("listing_url").alias("old_url"),
            F.col("verified").alias("was_verified"), F.col("approved").alias("was_approved")),
        "matched_source", "left")
    same = urls.normalize(F.col("old_url")) == urls.normalize(F.col("new_url"))
    return matched.withColumn(
        "category",
        F.when(F.col("matched_source").isNull(), "created").when(same, "skipped")
        .otherwise(urls.classify_change(F.col("old_url"), F.col("new_url"))))


def seed_plan_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("category").agg(
        F.count("*").alias("urls"), F.count_if(F.coalesce("was_verified", F.lit(False))).alias("verified"))
