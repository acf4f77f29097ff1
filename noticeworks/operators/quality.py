"""Quality control: baselines, stale and silent sources, anomalies, flags and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.config import Vertical
from noticeworks.functions.text import round_half_up
from noticeworks.functions.times import day, moment
from noticeworks.operators.lookups import population_join
from noticeworks.operators.ordering import last_n_dates


def count_per_source_day(records: DataFrame, source: str = "source", ts: str = "ts") -> DataFrame:
    return records.where(F.col(ts).isNotNull()).groupBy(
        F.col(source).alias("source"), F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))


def source_baseline(daily: DataFrame, dates: int = 4) -> DataFrame:
    """Mean records of the last days with data, the last such day and how many there were."""
    return last_n_dates(daily, "source", "day", dates).groupBy("source").agg(
        round_half_up(F.avg("n")).alias("avg_records"),
        F.max("day").alias("last_day"),
        F.count("*").alias("run_count"),
    )


def detect_stale(baseline: DataFrame, as_of: date, regular_days: int = 14, sparse_days: int = 28) -> DataFrame:
    """Sources without data for longer than their allowance."""
    threshold = F.when(F.col("run_count") >= 2, regular_days).otherwise(sparse_days)
    return baseline.withColumns({
        "days_since_data": F.datediff(day(as_of), "last_day"), "threshold": threshold,
    }).where(F.col("days_since_data") > F.col("threshold"))


def detect_anomalies(baseline: DataFrame, counts: DataFrame, ratio: float = 0.5, minimum: int = 3) -> DataFrame:
    """Sources whose count is far from their baseline."""
    gap = F.abs(F.col("n") - F.col("avg_records"))
    deviation = gap / F.greatest(F.lit(1), F.col("avg_records"))
    return counts.join(baseline, "source").where(
        (F.col("run_count") >= 2) & (deviation > ratio) & (gap > minimum)
    ).select(
        "source", F.col("avg_records").alias("expected"), F.col("n").alias("actual"),
        round_half_up(deviation * 100).alias("deviation_pct"),
        F.when(F.col("n") > F.col("avg_records"), "MORE than expected").otherwise("FEWER than expected").alias("direction"),
    )


def population_flags(counts: DataFrame, baseline: DataFrame, population: DataFrame, as_of: date,
                     rates: Sequence[tuple[int, float]] = ((100_000, 10), (50_000, 5)),
                     silent: tuple[int, int] = (20_000, 14), default_days: int = 3) -> DataFrame:
    """Places that publish less than their size suggests, with a text per reason."""
    placed = population_join(counts, "source", population).join(
        baseline.select("source", "last_day"), "source", "left")
    days = F.coalesce(F.datediff(day(as_of), "last_day"), F.lit(default_days))
    placed = placed.withColumn("days_covered", days).withColumn(
        "monthly_rate", F.col("n") / F.greatest(F.col("days_covered"), F.lit(1)) * 30)
    label = F.concat(F.col("place"), F.format_string(" (%.0fk inv): ", F.col("inhabitants") / 1000))
    low: Column | None = None
    for size, rate in rates:
        test = (F.col("inhabitants") > size) & (F.col("monthly_rate") < rate)
        text = F.concat(label, F.format_string(f"%.1f ärenden/mån, förväntat >= {rate}", F.col("monthly_rate")))
        low = F.when(test, text) if low is None else low.when(test, text)
    size, quiet = silent
    gone = F.when(
        (F.col("inhabitants") > size) & (F.col("days_covered") >= quiet) & (F.col("n") == 0),
        F.concat(label, F.format_string("0 ärenden på %d dagar", F.col("days_covered"))))
    return placed.select("source", F.explode(F.array_compact(F.array(low, gone))).alias("flag"))


def validate_records(df: DataFrame, vertical: Vertical) -> DataFrame:
    """Records that break a rule of their vertical, with identifier and issues."""
    def text(f: str) -> Column:
        return F.col(f).cast("string")

    checks = [F.when(F.col(f).isNull(), f"missing required field: {f}") for f in vertical.required_fields]
    checks += [
        F.when(F.col(f).isNotNull() & ~F.col(f).isin(*allowed), F.concat(F.lit(f"invalid {f}: "), text(f)))
        for f, allowed in vertical.allowed_values.items()
    ]
    for f, (low, high) in vertical.numeric_ranges.items():
        checks.append(F.when(
            (F.col(f) < low) | (F.col(f) > high),
            F.concat(F.lit(f"{f} out of range: "), text(f), F.lit(f" (expected {low}-{high})"))))
    own = [F.nullif(F.col(c), F.lit("")) for c in ("title", "case_number") if c in df.columns]
    identifier = F.coalesce(*own, *[text(f) for f in vertical.required_fields], F.lit("unknown"))
    return df.withColumns({
        "identifier": identifier, "issues": F.array_compact(F.array(*checks)),
    }).where(F.size("issues") > 0)


def active_zero_today(records: DataFrame, as_of: date, source: str = "source", ts: str = "ts",
                      minimum: int = 5, window_days: int = 30) -> DataFrame:
    """Sources active in the last days that gave nothing today."""
    since = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=window_days)
    return records.where((F.col(ts) >= moment(since)) & F.col(source).isNotNull()).groupBy(F.col(source).alias("source")).agg(
        F.count("*").alias("records"), F.count_if(F.to_date(ts) == day(as_of)).alias("today"),
    ).where((F.col("records") >= minimum) & (F.col("today") == 0)).drop("today")


def latest_with_data(runs: DataFrame) -> DataFrame:
    """Most recent run of each source that extracted something."""
    return runs.groupBy("source").agg(F.max(F.when(F.col("n") > 0, F.col("day"))).alias("last_data_day"))


def zero_streak(runs: DataFrame, as_of: date, threshold: int = 3) -> DataFrame:
    """Sources without data on the last days; a missing run counts as a day without data.

    The streak follows from the last day with data, so no calendar has to be joined; a source
    that never had any is silent since its first run. Runs after ``as_of`` do not count.
    """
    last = runs.where(F.col("day") <= day(as_of)).groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("n") > 0, F.col("day"))), F.date_sub(F.min("day"), 1)).alias("_last"))
    return last.withColumn("zero_days", F.datediff(day(as_of), "_last")).where(
        F.col("zero_days") >= threshold
    ).select(
        "source", "zero_days",
        F.transform(F.sequence(F.lit(0), F.col("zero_days") - 1), lambda i: F.date_sub(day(as_of), i)).alias("dates"))


def worst_streaks(streaks: DataFrame, n: int) -> DataFrame:
    return streaks.orderBy(F.col("zero_days").desc(), "source").limit(n)


def date_spine_join(runs: DataFrame, as_of: date, days: int) -> DataFrame:
    """Every source on every one of the last days, zero where it has no run."""
    recent = runs.where(F.col("day").between(day(as_of - timedelta(days=days - 1)), day(as_of)))
    calendar = F.sequence(day(as_of - timedelta(days=days - 1)), day(as_of))
    spine = recent.select("source").distinct().select("source", F.explode(calendar).alias("day"))
    return spine.join(recent, ["source", "day"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def coverage(records: DataFrame, sources: DataFrame, as_of: datetime, days: int = 7,
             source: str = "source", ts: str = "ts") -> DataFrame:
    """Sources with data in the last days against all approved sources."""
    active = records.where(F.col(ts) >= moment(as_of - timedelta(days=days))).agg(
        F.countDistinct(source).alias("active"))
    total = sources.agg(F.count("*").alias("total"))
    return active.withColumn("total", total.scalar()).withColumn(
        "coverage_pct", F.round(F.try_divide(100.0 * F.col("active"), F.col("total")), 1))


def coverage_report(records: DataFrame, sources: DataFrame, as_of: datetime, source: str = "source",
                    ts: str = "ts", days: int = 7) -> DataFrame:
    """Coverage of the last days, of the days before them and the change between the two."""
    edge, start = moment(as_of - timedelta(days=days)), moment(as_of - timedelta(days=2 * days))
    seen = records.where(F.col(ts) >= start).groupBy(F.col(source)).agg(
        F.bool_or(F.col(ts) >= edge).alias("now"), F.bool_or(F.col(ts) < edge).alias("before"))
    counted = seen.agg(
        F.count_if("now").alias("active"), F.count_if("before").alias("active_before"),
        F.count_if(F.col("now") & ~F.col("before")).alias("gained"),
        F.count_if(F.col("before") & ~F.col("now")).alias("lost"))
    total = sources.agg(F.count("*").alias("total"))
    return counted.withColumn("total", total.scalar()).withColumn(
        "coverage_pct", F.round(F.try_divide(100.0 * F.col("active"), F.col("total")), 1))


def self_healed(rediscoveries: DataFrame, as_of: datetime) -> DataFrame:
    """Sources repaired in the last 24 hours."""
    return rediscoveries.where(
        F.col("success") & (F.col("created_at") >= moment(as_of - timedelta(days=1)))).select("source").distinct()


def needs_attention(sources: DataFrame) -> DataFrame:
    return sources.where(F.col("stale_rediscovery_count") >= 3).select("source")


def run_summary(results: DataFrame) -> DataFrame:
    """Sources by outcome, records, cost and cost per record of a run."""
    return results.agg(
        F.count("*").alias("sources"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "error", "unchanged", "escalated")],
        F.sum("records").alias("records"), F.sum("inserted").alias("inserted"),
        F.sum("skipped").alias("skipped"), F.sum("cost_usd").alias("cost_usd"),
    ).withColumn("cost_per_record", F.coalesce(
        F.try_divide(F.col("cost_usd"), F.col("records")).cast("double"), F.lit(0.0)))


def qc_per_source(counts: DataFrame, issues: DataFrame, stale: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Per source of today's run: records, issues and the flags that apply."""
    found = issues.groupBy("source").agg(F.count("*").alias("issue_count"))
    flagged = (
        counts.join(found, "source", "left")
        .join(stale.select("source", F.lit(True).alias("is_stale")), "source", "left")
        .join(anomalies.select("source", F.lit(True).alias("is_anomaly")), "source", "left")
    )
    return flagged.select(
        "source", "n", F.coalesce("issue_count", F.lit(0)).alias("issue_count"),
        F.coalesce("is_stale", F.lit(False)).alias("is_stale"),
        F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"))


def qc_flags(per_source: DataFrame) -> DataFrame:
    flags = F.array_compact(F.array(
        F.when(F.col("issue_count") > 0, "validation_issues"), F.when(F.col("is_stale"), "stale"),
        F.when(F.col("is_anomaly"), "anomaly"), F.when(F.col("n") == 0, "zero_permits")))
    return per_source.withColumn("flags", flags)


def qc_summary(per_source: DataFrame) -> DataFrame:
    return per_source.agg(
        F.sum("n").alias("records"), F.count("*").alias("sources"), F.sum("issue_count").alias("flagged"),
        F.count_if("is_stale").alias("stale"), F.count_if("is_anomaly").alias("anomalies"))


def daily_qc_rows(flagged: DataFrame, baseline: DataFrame, inserted: DataFrame, vertical: str,
                  run_date: date) -> DataFrame:
    """Rows for the daily quality table; ``inserted`` holds what the load really stored."""
    return (
        flagged.join(baseline.select("source", "avg_records"), "source", "left")
        .join(inserted.select("source", "inserted"), "source", "left")
        .select(
            F.lit(vertical).alias("vertical"), "source", day(run_date).alias("run_date"),
            F.col("n").alias("extracted"), F.coalesce("inserted", F.lit(0)).alias("inserted"),
            F.col("avg_records").alias("expected_avg"), "flags", F.lit(False).alias("alert_sent"))
    )


def produced_since(records: DataFrame, since: datetime, ts: str = "created_at") -> DataFrame:
    """How many records there are since a point in time; none raises the alert."""
    return records.where(F.col(ts) >= moment(since)).agg(F.count("*").alias("records")).withColumn(
        "alert", F.col("records") == 0)


def escalation_check(streaks: DataFrame, sources: DataFrame, normal_limit: int, ceiling: int,
                     share: float = 0.2) -> DataFrame:
    """How many sources may be rediscovered, more when many are silent at once."""
    counted = streaks.agg(F.count("*").alias("streaks")).withColumn(
        "approved", sources.agg(F.count("*").alias("c")).scalar())
    wide = (F.col("approved") > 0) & (F.col("streaks") > F.col("approved") * share)
    return counted.withColumns({
        "escalated": wide,
        "limit": F.when(wide, F.least("streaks", F.lit(ceiling))).otherwise(F.lit(normal_limit))})


def task_summary(tasks: DataFrame) -> DataFrame:
    return tasks.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("completed", "failed", "skipped")])


def excerpt_stats(signals: DataFrame, listing_url: str, excerpt_length: str | None = None,
                  empty_is_set: bool = False) -> DataFrame:
    """Lengths of excerpts, summaries, different URLs and signals that have the URL of their listing.

    An empty excerpt is not set and has no length; where none is set both lengths are 0. With ``empty_is_set`` it
    has length 0, and where all excerpts are null both lengths are null. ``excerpt_length`` names a column of
    lengths to take instead of ``source_excerpt``, so that joins before need not move the texts.
    """
    size = F.length("source_excerpt") if excerpt_length is None else F.col(excerpt_length)
    longest, shortest = F.max(size), F.min(size if empty_is_set else F.nullif(size, F.lit(0)))
    if not empty_is_set:
        longest, shortest = F.coalesce(longest, F.lit(0)), F.coalesce(shortest, F.lit(0))
    summarised = F.coalesce(F.col("ai_summary") != "", F.lit(False))
    return signals.agg(
        F.count("*").alias("signals"), longest.alias("longest"), shortest.alias("shortest"),
        F.count_if(summarised).alias("with_summary"), F.count_if(~summarised).alias("without_summary"),
        F.countDistinct("source_url").alias("distinct_urls"),
        F.count_if(F.col("source_url") == F.col(listing_url)).alias("listing_urls"))


def source_quality_daily(records: DataFrame, fields: Sequence[str], dropped: DataFrame | None = None,
                         vertical: str = "permits", window_days: int = 30, reasons: Sequence[str] = ()) -> DataFrame:
    """Per source and day: records, null share per field, drops by reason and the usual publishing interval.

    ``dropped`` has ``source, created_at, drop_reason``; a day on which everything was dropped
    is a day too, with null shares. ``reasons`` become columns ``dropped_<reason>`` beside the
    total. The interval is the median number of days between days with records over the last
    ``window_days``.
    """
    stored = records.select("source", F.to_date("created_at").alias("day"), F.lit(None).cast("string").alias("_reason"),
                            F.lit(1).alias("_stored"), *fields)
    if dropped is not None:
        stored = stored.unionByName(dropped.select(
            "source", F.to_date("created_at").alias("day"), F.coalesce("drop_reason", F.lit("")).alias("_reason"),
            F.lit(0).alias("_stored")), allowMissingColumns=True)
    kept = F.col("_stored") == 1
    daily = stored.groupBy("source", "day").agg(
        F.count_if(kept).alias("records"),
        *[F.round(F.try_divide(100.0 * F.count_if(kept & F.col(f).isNull()), F.count_if(kept)), 1).alias(f"pct_null_{f}") for f in fields],
        F.count_if(~kept).alias("dropped"), *[F.count_if(F.col("_reason") == r).alias(f"dropped_{r}") for r in reasons])
    before = Window.partitionBy("source").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    rolling = Window.partitionBy("source").orderBy("_n").rangeBetween(-(window_days - 1), 0)
    with_data = F.when(F.col("records") > 0, F.col("day"))
    return (
        daily.withColumn("_gap", F.datediff(with_data, F.max(with_data).over(before)))
        .withColumn("_n", F.datediff("day", day(date(1970, 1, 1))))
        .withColumn("median_interval_days", F.percentile("_gap", 0.5).over(rolling))
        .drop("_gap", "_n").withColumn("vertical", F.lit(vertical))
    )


def counts_by(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def outcome_summary(results: DataFrame) -> DataFrame:
    """Outcomes of a verification batch with their cost."""
    return results.groupBy("status").agg(
        F.count("*").alias("sources"), F.sum("cost_usd").alias("cost_usd"))


def url_check_summary(checks: DataFrame) -> DataFrame:
    hits = F.size("keyword_hits")
    return checks.groupBy("classification").agg(
        F.count("*").alias("urls"), F.count_if(hits > 0).alias("with_keywords"),
        F.count_if(hits == 0).alias("without_keywords"))


def load_summary(inserted: Mapping[str, DataFrame]) -> DataFrame:
    """Rows each load stored."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("load"), "rows")
             for name, df in inserted.items()]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return merged
