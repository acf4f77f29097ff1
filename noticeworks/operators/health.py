"""The health report: production, null rates, silent sources and name variants."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.functions import names
from noticeworks.functions.times import day, moment


def production_status(records: DataFrame, as_of: datetime, source: str = "source", ts: str = "ts",
                      excluded: tuple[date, date] | None = None, history_days: int = 35) -> DataFrame:
    """Records of the last 24 hours against the same weekday of the weeks before.

    One scan: rows are labelled with their period, counted per period and the few
    periods are compared.
    """
    yesterday = moment(as_of - timedelta(days=1))
    t = F.col(ts)
    comparable = (t < yesterday) & (F.dayofweek(t) == F.dayofweek(day(as_of.date())))
    if excluded:
        comparable = comparable & ~F.to_date(t).between(day(excluded[0]), day(excluded[1]))
    periods = (
        records.where(t > moment(as_of - timedelta(days=history_days)))
        .withColumn("_period", F.when(t > yesterday, "today").when(comparable, F.to_date(t).cast("string")))
        .where(F.col("_period").isNotNull())
        .groupBy("_period").agg(F.count("*").alias("n"), F.countDistinct(source).alias("sources"))
    )
    today = F.col("_period") == "today"
    summed = periods.agg(
        F.coalesce(F.max(F.when(today, F.col("n"))), F.lit(0)).alias("records_today"),
        F.coalesce(F.max(F.when(today, F.col("sources"))), F.lit(0)).alias("sources_today"),
        F.avg(F.when(~today, F.col("n"))).alias("mean"),
        F.avg(F.when(~today, F.col("sources"))).alias("mean_sources"),
        F.count_if(~today).alias("baseline_days"),
    )
    return summed.select(
        "records_today", "sources_today", F.round("mean", 1).alias("baseline_records"),
        F.round("mean_sources", 1).alias("baseline_sources"), "baseline_days",
        F.when(F.col("baseline_days") == 0, "INGEN BASELINE")
        .when(F.col("records_today") >= F.col("mean") * 0.5, "GRON")
        .when(F.col("records_today") >= F.col("mean") * 0.2, "GUL")
        .otherwise("ROD").alias("status"),
    )


def _null_share(c: str) -> Column:
    return F.round(100.0 * F.count_if(F.col(c).isNull()) / F.count("*"), 1).alias(f"pct_null_{c}")


def null_rates(records: DataFrame, columns: Sequence[str], since: datetime, ts: str = "created_at") -> DataFrame:
    return records.where(F.col(ts) > moment(since)).agg(
        F.count("*").alias("total"), *[_null_share(c) for c in columns])


def null_rates_by_period(records: DataFrame, columns: Sequence[str], as_of: datetime, cut_over: datetime,
                         ts: str = "created_at", window_days: int = 60) -> DataFrame:
    """Null shares before and after a change, within the last days."""
    period = F.when(F.col(ts) <= moment(cut_over), "1_before").otherwise("2_after")
    recent = records.where(F.col(ts) > moment(as_of - timedelta(days=window_days)))
    return recent.groupBy(period.alias("period")).agg(
        F.count("*").alias("total"), *[_null_share(c) for c in columns])


def source_activity(records: DataFrame, as_of: datetime, source: str = "source", ts: str = "ts",
                    history: tuple[int, int] = (90, 30), recent_days: int = 7,
                    excluded: tuple[date, date] | None = None) -> DataFrame:
    """Per source the records of the history window and of the recent one, in one scan."""
    t = F.col(ts)
    in_history = t.between(moment(as_of - timedelta(days=history[0])), moment(as_of - timedelta(days=history[1])))
    if excluded:
        in_history = in_history & ~F.to_date(t).between(day(excluded[0]), day(excluded[1]))
    in_recent = t > moment(as_of - timedelta(days=recent_days))
    return records.where(in_history | in_recent).groupBy(F.col(source).alias("source")).agg(
        F.count_if(in_history).alias("history_records"), F.count_if(in_recent).alias("recent_records"))


def silent_sources(activity: DataFrame, weeks: float = 8.0, minimum: int = 10, share: float = 0.5) -> DataFrame:
    """Sources that lately gave less than a share of their weekly mean."""
    mean = F.col("history_records") / F.lit(weeks)
    return activity.where(
        (F.col("history_records") >= minimum) & (F.col("recent_records") < mean * share)
    ).select(
        "source", F.round(mean, 1).alias("weekly_mean"), "recent_records",
        F.round(100.0 * F.col("recent_records") / mean, 0).alias("pct_of_normal"))


def top_silent(silent: DataFrame, n: int = 20) -> DataFrame:
    return silent.orderBy(F.col("weekly_mean").desc(), "source").limit(n)


def silent_source_join(history: DataFrame, recent: DataFrame) -> DataFrame:
    """History of every source with its recent count, zero when it has none."""
    return history.join(recent, "source", "left").withColumn(
        "recent_records", F.coalesce("recent_records", F.lit(0)))


def name_variants(records: DataFrame, name: str, key=names.health_name_key) -> DataFrame:
    """Spellings of names that are written in more than one way, one row each, ranked by frequency."""
    counted = records.groupBy(F.col(name).alias("variant")).agg(F.count("*").alias("n")).withColumn(
        "normal_name", key(F.col("variant")))
    groups = counted.groupBy("normal_name").agg(
        F.count("*").alias("variant_count"), F.sum("n").alias("total")).where(F.col("variant_count") > 1)
    in_order = Window.partitionBy("normal_name").orderBy(F.col("n").desc(), "variant")
    return counted.join(groups, "normal_name").select(
        "normal_name", "variant", "n", F.row_number().over(in_order).alias("rank"), "variant_count", "total")


def top_name_variants(variants: DataFrame, n: int = 20) -> DataFrame:
    """The names with most records, with their spellings as one text; only these are put together."""
    top = variants.where(F.col("rank") == 1).orderBy(F.col("total").desc(), "normal_name").limit(n).select("normal_name")
    spelled = F.array_sort(F.collect_list(F.struct("rank", "variant")))
    return variants.join(top, "normal_name").groupBy("normal_name").agg(
        F.array_join(F.transform(spelled, lambda x: x["variant"]), " | ").alias("variants"),
        F.max("variant_count").alias("variant_count"), F.max("total").alias("total"))


def scalar_cross(summary: DataFrame, extra: DataFrame, name: str) -> DataFrame:
    """A one-row summary with the only value of another one-row frame."""
    return summary.withColumn(name, extra.scalar())
