"""Tables laid out by a hash of their key, of which a change reads and replaces only what it touches.

Rows stand in one folder per bucket, a hash of the key. A change finds the buckets of its
keys, reads these alone (the others are pruned by their folder), works out their new rows and swaps
them when the job commits. Rows with a null in their key equal no other row; they stand in
a bucket of their own that is only ever appended to.

One writer at a time. A change may be repeated after a failure: buckets that were swapped already
come out the same, except that rows without key are added again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.operators import loading

BUCKET = "_bucket"
NO_KEY = -1


class KeyedTable(NamedTuple):
    """Where a table is and how it is laid out; the number of buckets never changes."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def bucket(self) -> Column:
        return F.when(self.complete(), F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")).otherwise(F.lit(NO_KEY))

    def complete(self) -> Column:
        return functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in self.key])

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys: numbers, at most as many as there are buckets."""
        return sorted(r[0] for r in keys.where(self.complete()).select(self.bucket().alias("b")).distinct().collect())

    def part(self, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets, without a look at the others."""
        return self.spark.read.parquet(self.path).where(F.col(BUCKET).isin(*buckets)).drop(BUCKET)

    def files(self) -> dict[int, dict[str, int]]:
        """Of each bucket its files and when they were written."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        system = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        found = {}
        for each in system.listStatus(folder):
            name = each.getPath().getName()
            if name.startswith(BUCKET + "="):
                found[int(name.removeprefix(BUCKET + "="))] = {
                    f.getPath().getName(): f.getModificationTime() for f in system.listStatus(each.getPath()) if not f.getPath().getName().startswith("_")}
        return found

    def _write(self, rows: DataFrame, mode: str) -> None:
        # Rows without key are spread by their content; buckets are even, as their keys are unique.
        spread = F.when(F.col(BUCKET) == NO_KEY, F.pmod(F.xxhash64(*rows.columns), F.lit(self.buckets)))
        out = rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET, spread)
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def _drop(self, buckets: Sequence[int]) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for b in buckets:
            folder = hadoop.Path(f"{self.path}/{BUCKET}={b}")
            folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def create(rows: DataFrame, path: str, key: Sequence[str], buckets: int) -> KeyedTable:
    """Lays out rows whose complete keys are unique; ``path`` must not exist."""
    table = KeyedTable(rows.sparkSession, path.rstrip("/"), tuple(key), buckets)
    table._write(rows, "errorifexists")
    return table


def rewrite(table: KeyedTable, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Replaces the buckets of some keys by what ``change`` makes of their rows; returns them.

    ``change`` gets the rows of these buckets only and may drop rows, change their values or
    add rows whose keys are among ``keys``. Rows without key are out of its reach.
    """
    buckets = table.touched(keys)
    if buckets:
        before = table.files()
        table._write(change(table.part(buckets)), "overwrite")
        after = table.files()
        # A bucket that got no rows was not swapped and still has its old files.
        table._drop([b for b in buckets if b in before and before[b].keys() & after[b].keys()])
    return buckets


def merge(table: KeyedTable, batch: DataFrame, order: Sequence[str]) -> list[int]:
    """``loading.upsert_merge`` into a table: equal keys are overwritten, the last of the batch wins.

    Returns the buckets that were replaced. The batch is read for its buckets, for the merge
    and for its rows without key, so one that is costly should be stored.
    """
    complete = batch.where(table.complete())
    buckets = rewrite(table, batch, lambda old: loading.upsert_merge(old, complete, table.key, order))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.read().schema if f.name not in batch.columns]
    rest = batch.where(~table.complete())
    if not rest.isEmpty():
        table._write(rest.select("*", *missing), "append")
    return buckets


def update(table: KeyedTable, updates: DataFrame, value: str) -> list[int]:
    """``loading.update_by_key`` in a table with a key of one column."""
    (key,) = table.key
    return rewrite(table, updates, lambda old: loading.update_by_key(old, updates, key, value))


def apply_fix_plan(table: KeyedTable, deletions: DataFrame, renames: DataFrame) -> list[int]:
    """``loading.apply_fix_plan`` in a table of configurations with the key ``id``."""
    keys = deletions.select("id").unionByName(renames.select("id"))
    return rewrite(table, keys, lambda old: loading.apply_fix_plan(old, deletions, renames))
