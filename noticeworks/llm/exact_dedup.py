"""Exact dedup by an extendible-hash index on shared files. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.common import lower_az, stored

#: The directory has at most ``2 ** DIRECTORY_BITS`` cells, so it is safe to broadcast.
DIRECTORY_BITS = 16


def directory(hashes: DataFrame, capacity: int, bits: int = DIRECTORY_BITS) -> DataFrame:
    """Cells of the directory with the bucket that each points at.

    ``hashes`` has a column ``h``, one row per distinct hash. A bucket is a hash prefix. As
    long as one holds more than ``capacity`` hashes it is split by its next bit, which
    doubles the directory when the bucket is as deep as the directory; at ``bits`` bits
    the splitting ends and longer chains are accepted. The bucket of a cell is the
    shallowest prefix of the cell that fits, so all splits follow from one sum per prefix.
    """
    cells = (
        hashes.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("cell")).agg(F.count("*").alias("n"))
        .withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(bits))))
        .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {bits} - depth)"))
    )
    fits = cells.groupBy("depth", "prefix").agg(F.sum("n").alias("held")).where(
        (F.col("held") <= capacity) | (F.col("depth") == bits))
    return (
        cells.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("local_depth"))
        .withColumn("bucket", F.expr(f"shiftleft(shiftrightunsigned(cell, {bits} - local_depth), {bits} - local_depth)"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096) -> DataFrame:
    """One row per document: which of its equal texts stays.

    Texts are equal when their bytes are after lower-casing A-Z; null counts as empty.
    The row with the largest id stays; a null id is smaller than any other, and of
    repeated rows with the largest id exactly one stays. An empty table gives no rows.
    Other columns of ``docs`` are not read.

    First every row is fingerprinted, and the directory of the index is doubled until the
    buckets fit. Then equal texts, compared byte by byte, are reduced to one entry, before the
    shuffle as far as one task sees them, so a text that fills a third of the table travels
    once per task. Every bucket is a range of hashes and is written by one owner task; entries
    of one hash with different bytes are chained there. At last the small fingerprint rows
    look their entry up by hash and digest; texts are not moved again.
    """
    norm = docs.select(F.col(id_col).alias("doc_id"), lower_az(F.col(text_col)).alias("norm"))
    prints = stored(norm.select(
        "doc_id", F.xxhash64("norm").alias("h"), F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "prints")
    groups = prints.groupBy("h", "digest").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("rows"))
    cells = stored(directory(prints.select("h").distinct(), capacity), "directory")

    entries = (
        norm.withColumn("h", F.xxhash64("norm")).groupBy("h", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("h", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").alias("octets"), "keep_id", "group_size")
        .withColumn("cell", F.shiftrightunsigned("h", 64 - DIRECTORY_BITS))
        .join(F.broadcast(cells), "cell").drop("cell")
    )
    index = stored(
        entries.repartition("bucket")
        .withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("digest")) - 1)
        .sortWithinPartitions("bucket", "h", "chain"), "index")
    kept = index.join(groups.select("h", "digest", F.col("last.row").alias("keep_row")), ["h", "digest"])
    return prints.join(kept, ["h", "digest"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "bucket", "local_depth", "chain", "octets")
