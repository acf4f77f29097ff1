"""First-wins, top-n and running totals that stay spread out when one key is hot.

``row_number() <= n`` is planned with a limit per group before the shuffle, so a
hot key sends at most n rows per task.  Running totals are taken in chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.session import stored


def top_per_group(df: DataFrame, keys: Sequence, order: Sequence[Column], n: int,
                  rank: str | None = None, skip: int = 0) -> DataFrame:
    """Rows ``skip + 1 … n`` of every group in the given order."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= n)
    if skip:
        kept = kept.where(F.col(name) > skip)
    return kept if rank else kept.drop(name)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys meet each other; the keys stand in the result once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same).drop(*[f"_right_{k}" for k in keys])


def first_wins(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1)


def last_n_dates(counts: DataFrame, source: str, day: str, n: int = 4) -> DataFrame:
    return top_per_group(counts, [source], [F.col(day).desc()], n, rank="recency")


def running_total(df: DataFrame, run: Sequence[str], order: Sequence[str], chunk: Sequence[str],
                  value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the run, the row itself left out.

    ``chunk`` columns must rise with the order.  Only chunk totals are lined up per
    run; the rows themselves are summed chunk by chunk, so one long run is shared
    by as many tasks as it has chunks.
    """
    part = [*run, *chunk]
    totals = df.groupBy(*part).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*run).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_carried", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        join_null_safe(df, carried.drop("_total"), part)
        .withColumn(name, F.col("_carried") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_carried")
    )


def ranged_total(df: DataFrame, run: Sequence[str], order: Sequence[str], value: str, name: str, pieces: int | None = None) -> DataFrame:
    """As ``running_total``, without a chunk column: one run of any length is shared by all tasks.

    Rows are dealt out by ranges of run and order, so every piece follows the one before; the rows are
    stored with the number of their piece. Sums per run and piece are lined up, one row for each
    piece that a run reaches into, and added to the sums inside the pieces.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(pieces, *run, *order).withColumn("_piece", F.spark_partition_id()), "ranged")
    return running_total(dealt, run, order, ["_piece"], value, name).drop("_piece")


def _spent(tasks: DataFrame, run: Sequence[str], order: Sequence[str], chunk: Sequence[str] | None, cost: str) -> DataFrame:
    if chunk is None:
        return ranged_total(tasks, run, order, cost, "spent_before")
    return running_total(tasks, run, order, chunk, cost, "spent_before")


def budget_cutoff(tasks: DataFrame, limit, run: Sequence[str], order: Sequence[str],
                  chunk: Sequence[str] | None = None, cost: str = "cost", max_cost: str = "max_cost") -> DataFrame:
    """Tasks in order until the first whose own limit no longer fits the budget.

    That task and every later one of the run is ``budget_exhausted``. Without ``chunk`` the order
    itself is cut into pieces, see ``ranged_total``.
    """
    spent = _spent(tasks, run, order, chunk, cost)
    place = F.struct(*order)
    too_much = F.col("spent_before") + F.coalesce(F.col(max_cost), F.lit(0)) > F.lit(limit)
    first = spent.groupBy(*run).agg(F.min(F.when(too_much, place)).alias("_stop"))
    status = F.when(place >= F.col("_stop"), "budget_exhausted").otherwise("run")
    return join_null_safe(spent, first, list(run)).withColumn("status", status).drop("_stop")


def spend_until(tasks: DataFrame, limit, run: Sequence[str], order: Sequence[str],
                chunk: Sequence[str] | None = None, cost: str = "cost") -> DataFrame:
    """Tasks started while the money spent so far is below the limit."""
    spent = _spent(tasks, run, order, chunk, cost)
    return spent.where(F.col("spent_before") < F.lit(limit))
