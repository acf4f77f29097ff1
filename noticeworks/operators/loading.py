"""Loads into target tables: what to append, what to overwrite, what to keep.

Every operator returns rows; the write functions at the end store them.  Duplicates
inside the batch are dropped first, before the shuffle, so a hot key sends one row
per task; the anti join against the target then uses the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions.times import day
from noticeworks.operators.ordering import top_per_group


def insert_ignore(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Batch rows to append: key not in the target, first of the batch wins.

    A row with a null in its key equals no other row and is always added.
    """
    complete = F.lit(True)
    for k in key:
        complete = complete & F.col(k).isNotNull()
    first = top_per_group(batch.where(complete), list(key), [F.col(c) for c in order], 1)
    new = first.join(target.select(*key).distinct(), list(key), "left_anti")
    return new.unionByName(batch.where(~complete))


def insert_if_absent_nullkey(target: DataFrame, batch: DataFrame, primary: str,
                             dedup: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows without primary id to append: no such row with equal fields, null equal to null."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.where(F.col(primary).isNull()).withColumn("_key", F.struct(*dedup))

    first = top_per_group(keyed(batch), ["_key"], [F.col(c) for c in order], 1)
    return first.join(keyed(target).select("_key").distinct(), "_key", "left_anti").drop("_key")


def insert_records(target: DataFrame, batch: DataFrame, primary: str, key: Sequence[str],
                   dedup: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows to append of a mixed batch, with and without primary id.

    As ``insert_ignore`` for rows with, ``insert_if_absent_nullkey`` for rows without primary id, but
    in one ranking and one anti join: the key is a struct that says which of the two holds.
    A row with primary id and a null elsewhere in its key is always added.
    """
    named = F.col(primary).isNotNull()

    def keyed(df: DataFrame) -> DataFrame:
        part = [F.when(named, F.col(k)).alias(f"k{i}") for i, k in enumerate(key)]
        rest = [F.when(~named, F.col(c)).alias(f"d{i}") for i, c in enumerate(dedup)]
        return df.withColumn("_key", F.struct(named.alias("named"), *part, *rest))

    open_ = F.lit(False)
    for k in key:
        open_ = open_ | (named & F.col(k).isNull())
    first = top_per_group(keyed(batch.where(~open_)), ["_key"], [F.col(c) for c in order], 1)
    new = first.join(keyed(target).select("_key").distinct(), "_key", "left_anti").drop("_key")
    return new.unionByName(batch.where(open_))


def insert_in_one_pass(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str],
                       primary: str | None = None, dedup: Sequence[str] = ()) -> DataFrame:
    """As ``insert_records``, or ``insert_ignore`` without ``primary``, with a single look at the batch.

    Rows with a null in their key are told apart by all their columns instead of being set aside;
    those that agree in every column, their place in the order included, are one row delivered twice.
    """
    named = F.col(primary).isNotNull() if primary else F.lit(True)
    open_ = F.lit(False)
    for k in key:
        open_ = open_ | (named & F.col(k).isNull())

    def keyed(df: DataFrame, apart: Column) -> DataFrame:
        part = [F.when(named, F.col(k)).alias(f"k{i}") for i, k in enumerate(key)]
        rest = [F.when(~named, F.col(c)).alias(f"d{i}") for i, c in enumerate(dedup)]
        return df.withColumn("_key", F.struct(named.alias("named"), *part, *rest, apart.alias("apart")))

    itself = F.to_json(F.struct(*batch.columns))
    first = top_per_group(keyed(batch, F.when(open_, itself)), ["_key"], [F.col(c) for c in order], 1)
    known = keyed(target.where(~open_), F.lit(None).cast("string")).select("_key").distinct()
    return first.join(known, "_key", "left_anti").drop("_key")


def insert_counts(batch: DataFrame, inserted: DataFrame, source: str) -> DataFrame:
    """Per source: rows offered, inserted and skipped."""
    offered = batch.groupBy(source).agg(F.count("*").alias("offered"))
    stored = inserted.groupBy(source).agg(F.count("*").alias("inserted"))
    return offered.join(stored, source, "left").select(
        source, "offered", F.coalesce("inserted", F.lit(0)).alias("inserted"),
        (F.col("offered") - F.coalesce("inserted", F.lit(0))).alias("skipped"))


def upsert_merge(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target after the batch: equal keys are overwritten, the last of the batch wins.

    A row with a null in its key equals no other row and is always added.  Columns
    only the target has keep their values.
    """
    complete = F.lit(True)
    for k in key:
        complete = complete & F.col(k).isNotNull()
    last = top_per_group(batch.where(complete), list(key), [F.col(c).desc() for c in order], 1)
    value_columns = [c for c in target.columns if c not in key]
    new = last.select(*key, F.struct(*[c for c in batch.columns if c not in key]).alias("_new"))
    old = target.where(complete).select(*key, F.struct(*value_columns).alias("_old"))

    def merged(c: str) -> Column:
        if c not in batch.columns:
            return F.col("_old")[c].alias(c)
        return F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col("_old")[c]).alias(c)

    joined = old.join(new, list(key), "full_outer").select(*key, *[merged(c) for c in value_columns])
    rest = target.where(~complete).unionByName(batch.where(~complete), allowMissingColumns=True)
    return joined.unionByName(rest.select(*joined.columns))


def update_page_hashes(stored: DataFrame, run: DataFrame) -> DataFrame:
    """Hash table after a run: sources that were read get their new hashes only."""
    untouched = stored.join(run.select("source").distinct(), "source", "left_anti")
    fresh = run.where(F.col("content_hash").isNotNull()).select("source", "url", "content_hash")
    return untouched.select("source", "url", "content_hash").unionByName(fresh)


def upsert_daily_qc(stored: DataFrame, today: DataFrame) -> DataFrame:
    """One row per vertical, source and day; today's row replaces an earlier one."""
    key = ["vertical", "source", "run_date"]
    return stored.join(today.select(*key), key, "left_anti").unionByName(today)


def mark_alerted(qc: DataFrame, streaks: DataFrame, vertical: str, run_date: date) -> DataFrame:
    alerted = streaks.select("source").distinct().withColumn("_hit", F.lit(True))
    today = (F.col("vertical") == vertical) & (F.col("run_date") == day(run_date))
    return qc.join(alerted, "source", "left").withColumn(
        "alert_sent", F.when(today & F.col("_hit"), F.lit(True)).otherwise(F.col("alert_sent"))
    ).drop("_hit").select(*qc.columns)


def apply_fix_plan(configs: DataFrame, deletions: DataFrame, renames: DataFrame) -> DataFrame:
    """Configurations without the deleted ids and with the planned names."""
    names = renames.select("id", F.col("new_name").alias("_new"))
    kept = configs.join(deletions.select("id"), "id", "left_anti").join(names, "id", "left")
    return kept.withColumn("name", F.coalesce("_new", "name")).drop("_new").select(*configs.columns)


def update_by_key(dim: DataFrame, updates: DataFrame, key: str, value: str) -> DataFrame:
    new = updates.groupBy(key).agg(F.max(value).alias("_new"))
    return dim.join(new, key, "left").withColumn(value, F.coalesce("_new", value)).drop("_new")


def unknown_keys(dim: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    return updates.join(dim.select(key), key, "left_anti")


def rediscovery_log(outcomes: DataFrame, trigger: str) -> DataFrame:
    """Rows for the append-only log of rediscovery attempts."""
    return outcomes.select(
        "source", F.lit(trigger).alias("triggered_by"), "previous_url", "new_url", "method",
        "verified", "verify_result_count", "cost_usd", "success", "error")


def run_log(results: DataFrame, run_id: str) -> DataFrame:
    return results.withColumn("run_id", F.lit(run_id))


# Writes

def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_run_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("run_id").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces only the partitions the rows belong to."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def store_daily_qc(spark: SparkSession, today: DataFrame, path: str, run_date: date) -> None:
    """Upsert of one day's rows; only that day is read and replaced.

    Partitions are swapped when the job commits, so the day may be read by the job
    that replaces it.
    """
    stored = spark.read.schema(today.schema).parquet(path).where(F.col("run_date") == day(run_date))
    overwrite_partitions(upsert_daily_qc(stored, today), path, "run_date")
