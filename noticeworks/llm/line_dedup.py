"""Removal of lines that many sites share, by HyperLogLog sketches of the sites of each line."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import stored

#: log2 of the registers of a sketch
SKETCH_BITS = 12


def spread_lines(lines: DataFrame, min_sites: int, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Hashes of lines on ``min_sites`` sites or more, with the smallest id that has the line.

    ``lines`` has ``doc_id, site, h``. A sketch of the sites of each line is merged by the
    aggregation, partly before the shuffle. Lines whose estimate is further from the threshold
    than three standard errors are decided by it, the others by an exact distinct count.
    """
    margin = max(1, math.ceil(3 * 1.04 / math.sqrt(2 ** sketch_bits) * min_sites))
    estimated = stored(
        lines.groupBy("h").agg(F.hll_sketch_agg("site", sketch_bits).alias("sketch"), F.min("doc_id").alias("keeper"))
        .select("h", "keeper", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - margin), "line-sites")
    near = estimated.where(F.col("sites") <= min_sites + margin)
    exact = (
        lines.join(near.select("h"), "h", "left_semi").groupBy("h").agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites).select("h")
    )
    sure = estimated.where(F.col("sites") > min_sites + margin).select("h", "keeper")
    return stored(sure.unionByName(near.join(exact, "h", "left_semi").select("h", "keeper")), "spread-lines")


def line_dedup(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """All columns of ``docs``, the text without lines that ``min_sites`` sites or more share.

    A line is what stands between line feeds; spaces, tabs and carriage returns around it do not
    count, and blank lines always stay. The document with the smallest id that has such a line
    keeps the first occurrence there, every other occurrence goes; lines that only rows without
    id have go everywhere. Rows with the same id are the same document in this. Null sites do
    not count, null texts stay null. Added: ``n_lines`` and ``n_removed`` (columns of these names
    in ``docs`` are replaced). An empty table gives no rows.

    Only hashes travel for the counts. A line on a third of all documents is one row per task in
    the aggregation; in the join that follows, its rows can be split as the other side is unique.
    """
    def hashed(text):
        return F.transform(F.split(text, "\n"), lambda x: F.xxhash64(F.btrim(x, F.lit(" \t\r"))))

    lines = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(site_col).alias("site"), F.explode(F.array_distinct(hashed(F.col(text_col)))).alias("h"))
        .where(F.col("h") != F.xxhash64(F.lit(""))), "lines")
    keeps = F.col("doc_id").eqNullSafe(F.col("keeper")) & F.col("doc_id").isNotNull()
    found = stored(
        lines.join(spread_lines(lines, min_sites), "h").groupBy(F.col("doc_id").alias("own")).agg(
            F.collect_set(F.when(keeps, F.col("h"))).alias("once"), F.collect_set(F.when(~keeps, F.col("h"))).alias("never")), "found-lines")
    marked = (  # a merge join at every size: what is found grows with the table
        docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(found.hint("merge"), F.col("id").eqNullSafe(F.col("own")), "left")
        .withColumns({"parts": F.split("text", "\n"), "hashed": F.when(F.col("never").isNotNull(), hashed(F.col("text")))})
        # a generator of one row: without it a filter on the counts would work the lines out again for each use
        .withColumn("kept", F.explode(F.array(F.when(F.col("never").isNull(), F.col("parts")).otherwise(_kept()))))
    )
    added = {
        text_col: F.when(F.size("kept") == F.size("parts"), F.col("text")).otherwise(F.array_join("kept", "\n")),
        "n_lines": F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts")),
        "n_removed": F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts") - F.size("kept")),
    }
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    return marked.select(*[added.get(c, F.col("row")[c]).alias(c) for c in names])


def _kept():
    """Lines that stay: not of ``never``, and of ``once`` only the first."""
    def stays(i):
        h = F.element_at("hashed", i)
        return ~F.array_contains(F.col("never"), h) & (
            ~F.array_contains(F.col("once"), h) | (F.array_position(F.col("hashed"), h) == i))

    return F.transform(F.filter(F.sequence(F.lit(1), F.size("parts")), stays), lambda i: F.element_at("parts", i))
