"""Daily activity of sources as mergeable state, of which a run replaces its own part only.

The state has partial aggregates per source, day and run: the number of records and a sketch of their
different keys. Partials are sums and unions, so a baseline over days merges them instead of
reading records again. They stand in folders by day and run. A run that is repeated replaces
its own partials; late records of an earlier day are one more partial of that day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions.times import day as literal_day

STATE = "source string, n long, keys binary, last_ts timestamp_ntz, day date, run_id string"
#: Registers of a sketch, as a power of two; the error of a count is about 1.04 / sqrt(2 ** LOG2).
LOG2 = 12


def partials(records: DataFrame, run_id: str, source: str = "source", ts: str = "ts", key: str | None = None) -> DataFrame:
    """The state that the records of a run add; records without time have no day and no part."""
    sketch = F.hll_sketch_agg(F.col(key).cast("string"), LOG2) if key else F.lit(None).cast("binary")
    return records.where(F.col(ts).isNotNull()).groupBy(F.col(source).alias("source"), F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"), sketch.alias("keys"), F.max(F.col(ts).cast("timestamp_ntz")).alias("last_ts")).select(
        "source", "n", "keys", "last_ts", "day", F.lit(run_id).alias("run_id"))


def add_run(records: DataFrame, path: str, run_id: str, source: str = "source", ts: str = "ts", key: str | None = None) -> None:
    """Stores the partials of a run. Neither the state nor earlier records are read."""
    partials(records, run_id, source, ts, key).repartition("day").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day", "run_id").parquet(path)


def read(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The partials of some days; other days' folders are not looked into."""
    state = spark.read.schema(STATE).parquet(path)
    for bound, test in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            state = state.where(test(F.col("day"), literal_day(bound)))
    return state


def daily_counts(state: DataFrame) -> DataFrame:
    """As ``quality.count_per_source_day``: ``source, day, n``."""
    return state.groupBy("source", "day").agg(F.sum("n").alias("n"))


def distinct_keys(state: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """About how many different keys there are, over any days and runs."""
    return state.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("keys"))


def coverage(state: DataFrame, sources: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """As ``quality.coverage`` at the beginning of a day: sources with records since ``days`` days before."""
    since = F.date_sub(literal_day(as_of), days)
    active = state.where(F.col("day") >= since).agg(F.count_distinct("source").alias("active"))
    total = sources.agg(F.count("*").alias("total"))
    return active.withColumn("total", total.scalar()).withColumn(
        "coverage_pct", F.round(F.try_divide(100.0 * F.col("active"), F.col("total")), 1))
