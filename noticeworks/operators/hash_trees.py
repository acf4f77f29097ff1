"""Hash trees over the pages of sources: one root per source, and changes found by descending.

A leaf is the hash of a page at its position. A node of the next level is the hash of up to ``FAN`` neighbours,
each with its place among them, so the order of the pages is in the shape of the tree. Nodes
are made by grouping, ``FAN`` rows to a group: a source of any size is shared by all tasks.

Levels are stored by ``level`` and below ``BLOCK`` levels by a bucket of source and block, a subtree of
``FAN ** BLOCK`` pages. Two archives are compared from the top; of the lower levels only the
buckets are read that hold a block in which something differs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.session import stored

FAN = 16
NODES = "source string, pos long, hash string, bucket int"
#: Levels of a block, and buckets the blocks are dealt to.
BLOCK, BUCKETS = 3, 64


class HashTree(NamedTuple):
    """Where the levels of an archive are, the highest of which has one node per source."""

    spark: SparkSession
    path: str
    top: int

    def level(self, number: int) -> DataFrame:
        """``source, pos, hash`` of a level, and the bucket of lower ones."""
        return self.spark.read.schema(NODES).parquet(f"{self.path}/level={number}")

    def roots(self) -> DataFrame:
        return self.level(self.top).select("source", F.col("hash").alias("root"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The nodes above; a group has ``FAN`` rows at most."""
    child = F.struct((F.col("pos") % FAN).alias("place"), "hash")
    listed = F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(":", c["place"].cast("string"), c["hash"]))
    return nodes.groupBy("source", F.floor(F.col("pos") / FAN).alias("pos")).agg(F.sha2(F.array_join(listed, ","), 256).alias("hash"))


def build(pages: DataFrame, path: str, source: str = "source", content: str = "content", position: str = "pos") -> HashTree:
    """Stores the tree of ``pages``; ``path`` must not exist.

    Positions are numbers from 0 that are unique within their source; they need not be without gaps. Null
    content counts as empty. Of equal positions the greatest hash stays, so that a page that
    was delivered twice is one leaf. Rows without source or position are not part of a tree.
    """
    spark = pages.sparkSession
    leaves = pages.where(F.col(source).isNotNull() & F.col(position).isNotNull()).groupBy(
        F.col(source).cast("string").alias("source"), F.col(position).cast("long").alias("pos")).agg(
        F.max(F.sha2(F.coalesce(F.col(content), F.lit("")), 256)).alias("hash"))
    tree = HashTree(spark, path.rstrip("/"), 0)
    nodes, level, last = leaves, 0, None
    while last is None or last > 0:
        if level < BLOCK:
            block = F.floor(F.col("pos") / FAN ** (BLOCK - level))
            nodes.withColumn("bucket", _bucket(block)).repartition("bucket").write.partitionBy(
                "bucket").parquet(f"{tree.path}/level={level}")
        else:
            nodes.write.parquet(f"{tree.path}/level={level}")
        written = tree.level(level)
        last = written.agg(F.max("pos")).first()[0] or 0
        nodes, level = _parents(written), level + 1
    return tree._replace(top=level - 1)


def _differing(old: HashTree, new: HashTree, level: int, within: DataFrame | None, buckets: list[int] | None) -> DataFrame:
    """The nodes of a level that are not the same in both trees, below the nodes ``within``."""
    sides = []
    for tree, name in ((old, "_old"), (new, "_new")):
        nodes = tree.level(level)
        if buckets is not None:
            nodes = nodes.where(F.col("bucket").isin(*buckets))
        if within is not None:
            above = within.select("source", F.col("pos").alias("_above"))
            nodes = nodes.withColumn("_above", F.floor(F.col("pos") / FAN)).join(above, ["source", "_above"], "left_semi")
        sides.append(nodes.select("source", "pos", F.col("hash").alias(name)))
    return sides[0].join(sides[1], ["source", "pos"], "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))


def changed_positions(old: HashTree, new: HashTree) -> DataFrame:
    """``source, pos, change`` of the pages that are ``added``, ``removed`` or ``changed``."""
    within, buckets = None, None
    for level in range(min(old.top, new.top), 0, -1):
        # Stored, as both sides of the next level read it.
        within = stored(_differing(old, new, level, within, buckets).select("source", "pos"), "differing")
        if level == BLOCK:
            buckets = sorted(r[0] for r in within.select(_bucket(F.col("pos"))).distinct().collect())  # BUCKETS numbers at most
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return _differing(old, new, 0, within, buckets).select("source", "pos", change.alias("change"))


def _bucket(block: Column) -> Column:
    return F.pmod(F.xxhash64("source", block), F.lit(BUCKETS)).cast("int")
