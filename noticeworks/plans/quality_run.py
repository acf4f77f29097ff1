"""The quality run: today's extraction against baselines, flags and what to rediscover."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.config import Vertical
from noticeworks.functions.names import sanitize_ascii_name
from noticeworks.operators import quality


@dataclass(frozen=True)
class QualityRun:
    baseline: DataFrame
    stale: DataFrame
    anomalies: DataFrame
    flagged: DataFrame
    summary: DataFrame
    rows: DataFrame


def run(extracted: DataFrame, stored: DataFrame, inserted: DataFrame, vertical: Vertical, as_of: date) -> QualityRun:
    """Extracted records of today and the stored ones, both keyed by the source's name.

    Counts and baselines are joined on one canonical id, the sanitised name.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("source", sanitize_ascii_name(F.col("source")))

    today = keyed(extracted)
    counts = today.groupBy("source").agg(F.count("*").alias("n"))
    baseline = quality.source_baseline(quality.count_per_source_day(keyed(stored), ts="created_at"))
    stale = quality.detect_stale(baseline, as_of, vertical.stale_days, vertical.stale_days_sparse)
    anomalies = quality.detect_anomalies(
        baseline, counts, vertical.anomaly_ratio, vertical.anomaly_min_difference)
    per_source = quality.qc_per_source(counts, quality.validate_records(today, vertical), stale, anomalies)
    flagged = quality.qc_flags(per_source)
    return QualityRun(
        baseline, stale, anomalies, flagged, quality.qc_summary(per_source),
        quality.daily_qc_rows(flagged, baseline, keyed(inserted), vertical.name, as_of))
